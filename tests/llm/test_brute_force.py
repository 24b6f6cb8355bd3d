"""Methods against plain reimplementations: training and scores of the classifier, fused posteriors, bands, document scores, bootstrapping."""

import itertools
import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.test_operators import DE, EN, WORD, labelled_langs, nasty, prose, spans_by_hand, toxic_texts
from wickworks.llm import common, compression, langid, pii, quality, simhash, templates, toxicity

# 1: quality ------------------------------------------------------------------------------------------------------------------


def features_by_hand(text, scale):
    """Named features with their values: each kind's mean over its features."""

    def shape(word):
        kinds = ["A" if 65 <= b <= 90 else "a" if 97 <= b <= 122 or b >= 128 else "0" if 48 <= b <= 57 else chr(b) for b in word.encode()]
        return "".join(k for k, _ in itertools.groupby(kinds))

    w = WORD.findall(text or "")
    s = [shape(x) for x in w]
    echo = [(i > 0 and w[i] == w[i - 1]) + 2 * (i > 1 and w[i] == w[i - 2]) for i in range(len(w))]
    out = defaultdict(float)
    for kind, found in (("word", w), ("shape", s), ("echo", echo), ("words", list(zip(w, w[1:], strict=False))), ("shapes", list(zip(s, s[1:], strict=False)))):
        for x in found:
            out[kind, x] += scale / max(1, len(found))
    return out


def ftrl_by_hand(texts, labels, s):
    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        return 0.0 if abs(z[f]) <= s.l1 else -(z[f] - math.copysign(s.l1, z[f])) / ((s.beta + math.sqrt(n[f])) / s.alpha + s.l2)

    rows = [features_by_hand(t, s.scale) | {"intercept": 1.0} for t in texts]
    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for i in order.permutation(len(rows)):
            w = {f: weight(f) for f in rows[i]}
            p = 1 / (1 + math.exp(-sum(w[f] * x for f, x in rows[i].items())))
            for f, x in rows[i].items():
                g = (p - labels[i]) * x
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / s.alpha * w[f]
                n[f] += g * g
    return lambda t: 1 / (1 + math.exp(-sum(weight(f) * x for f, x in (features_by_hand(t, s.scale) | {"intercept": 1.0}).items())))


def test_quality_equals_plain_ftrl():
    rng = random.Random(3)
    texts = [prose(rng, 14) if i % 2 else " ".join(x.upper() + "!" for x in prose(rng, 5).split()) + " 12 12 12 é" for i in range(14)]
    y = np.array([float(i % 2) for i in range(14)])
    s = quality.Settings(bits=22, epochs=3)
    w, by_hand = quality.train(pa.array(texts), y, s), ftrl_by_hand(texts, y, s)
    new = [prose(rng, 9), texts[0] + " " + texts[1], "", "a a a a", "X! Y!"]
    np.testing.assert_allclose(quality.scores(pa.array(texts + new), w, s), [by_hand(t) for t in texts + new], rtol=1e-4)


def test_bounded_sample_keeps_to_its_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (1000 if i % 3 else 50)) for i in range(60)] + [(60, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(70)], "doc_id long, quality int")
    texts, y = common.bounded_sample(docs, labels, "quality", 40)
    assert len(texts) == len(y) <= 40
    some, _ = common.bounded_sample(docs, labels, "quality", 40, 5000)
    assert 0 < sum(len(t.as_py()) for t in some) <= 5000 and set(some.to_pylist()) <= set(texts.to_pylist())
    assert len(common.bounded_sample(docs.limit(0), labels, "quality", 40)[0]) == 0


# 2: compression bands --------------------------------------------------------------------------------------------------------


def verdict_by_hand(text, bands):
    raw = (text or "").encode()
    press = lambda b: len(b) / len(zstandard.ZstdCompressor(level=bands.level).compress(b)) if b else 0.0
    low, high = next((low, high) for below, low, high in bands.whole if len(raw) < below)
    pieces = [raw[i : i + bands.chunk_bytes] for i in range(0, len(raw), bands.chunk_bytes)] if len(raw) >= bands.chunk_bytes else []
    if pieces and len(pieces[-1]) < bands.chunk_bytes:
        pieces[-1] = raw[-bands.chunk_bytes :]
    bad = [not bands.chunk[0] <= press(p) <= bands.chunk[1] for p in pieces]
    return low <= press(raw) <= high and sum(bad) <= bands.max_bad_chunks * len(bad)


def test_compression_verdict_equals_plain_bands():
    rng = random.Random(8)
    junk = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))
    texts = [" ".join(rng.choices(EN + DE, k=n)) for n in (5, 30, 100, 400, 900, 2000)] + [prose(rng, n) for n in (25, 200, 900, 1500)]
    texts += [prose(rng, 700) + " " + junk(4000), prose(rng, 690), "same words here " * 900, junk(9000), " ".join(junk(60) for _ in range(100)), None, ""]
    for t, r in zip(texts, compression.assess(pa.array(texts, pa.string())).to_pylist(), strict=True):
        assert r["kept"] == (not r["base_failed"] and verdict_by_hand(t, compression.PRODUCTION)), (t or "")[:60]


# 3: language -----------------------------------------------------------------------------------------------------------------


def test_language_equals_plain_fusion(spark):
    rng = random.Random(18)
    rows = []
    for i in range(60):
        host = rng.choice(["a.one.de", "b.one.de", "c.two.de", "d.three.com", "e.three.com:80"])
        said = rng.choice(["", ' lang="de"', " lang='en-GB'", " lang=xx"])
        rows.append((i, f"https://{host}/{i}", f"<html{said}><body><p>{' '.join(rng.choices(DE if rng.random() < 0.5 else EN, k=rng.randint(0, 6)))}</p></body></html>"))
    labelled, s = labelled_langs(spark), langid.Settings(prior_weight=3.0)
    names, model = langid.train(*common.bounded_sample(labelled, labelled, "lang", s.max_rows), s)
    k = len(names)
    ll = langid.likelihoods(pa.array([re.sub("<[^>]*>", " ", h) for _, _, h in rows]), model, s)
    post = np.exp(ll) / np.exp(ll).sum(axis=1, keepdims=True)
    hosts = [u.split("/")[2] for _, u, _ in rows]
    names_of = [".".join(re.sub(":[0-9]*$", "", h).split(".")[-2:]) for h in hosts]
    suffixes = [x.split(".")[-1] for x in names_of]
    said = [(re.search(r"""lang=["']?([a-z]+)""", h) or [None, ""])[1] for _, _, h in rows]
    mass = post.sum(axis=0)
    smooth = lambda counts, above: (counts + s.prior_weight * above) / (counts.sum() + s.prior_weight)
    of = lambda keys, key: post[[i for i, x in enumerate(keys) if x == key]].sum(axis=0)
    claim = lambda x: "none" if x == "" else x if x in names else "other"
    kinds = [*names, "none", "other"]
    want = {}
    for i, (page, _, _) in enumerate(rows):
        prior = smooth(of(names_of, names_of[i]), smooth(of(suffixes, suffixes[i]), (mass + 1) / (mass.sum() + k)))
        counts = of(hosts, hosts[i])
        prior = (np.maximum(counts - post[i], 0) + s.prior_weight * prior) / (max(counts.sum() - 1, 0) + s.prior_weight)
        trust = (of([claim(x) for x in said], claim(said[i])) + 0.5) / (mass + 0.5 * len(kinds))
        total = np.exp(ll[i]) * trust * prior
        want[page] = (names[int(np.argmax(total))], (total / total.sum()).max())
    out = langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), labelled, None, s).collect()
    assert len(out) == len(rows) and len({r["lang"] for r in out}) == 2
    for r in out:
        lang, p = want[r["page_id"]]
        assert r["lang"] == lang and abs(r["confidence"] - p) < 1e-6


# 5: near-duplicates ----------------------------------------------------------------------------------------------------------


def test_near_duplicates_measure_recall_in_crowds(spark, monkeypatch):
    """Families of short texts around the similarity, some in tiles of a few: no link is lost and none is made."""
    rng, rows = random.Random(12), []
    for g in range(20):
        base = prose(rng, rng.randint(90, 130)).split(" ")
        for k in range(15):
            w = list(base)
            for at in rng.sample(range(len(w)), rng.randint(1, 2)):
                w[at] = f"v{k}x{at}"
            rows.append((100 * g + k, " ".join(w)))
    sets = {d: {tuple(t.split(" ")[i : i + 5]) for i in range(len(t.split(" ")) - 4)} for d, t in rows}
    pairs = [(a, b) for (a, _), (b, _) in itertools.combinations(rows, 2) if a // 100 == b // 100 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (simhash.TILE, 40):
        monkeypatch.setattr(simhash, "TILE", tile)
        got = {r["id"]: r["first_id"] for r in simhash.near_duplicates(docs).collect()}
        assert len(pairs) > 100 and got == {d: root(d) for d in sets}


# 6: toxicity -----------------------------------------------------------------------------------------------------------------


def test_document_score_equals_enumeration():
    texts, y = toxic_texts()
    model = toxicity.train(pa.array(texts[:160]), y[:160])
    short = ["you idiot there", "a quiet word", "moron, stupid moron", "one", ""]
    got = toxicity.assess(pa.array(short), model).to_pylist()
    for t, r in zip(short, got, strict=True):
        data, offsets = np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])
        low, starts, ends, of = toxicity._tokens(data, offsets)
        e = model.weights[toxicity._features(low, starts, ends, of, toxicity.Settings.bits)].sum(axis=1) if len(of) else []
        p, total = np.zeros(len(e)), 0.0
        for ys in itertools.product((0, 1), repeat=len(e)):
            w = math.exp(model.start * (ys[0] if ys else 0) + sum(a * b for a, b in zip(e, ys, strict=True)) + sum(model.edges[a, b] for a, b in itertools.pairwise(ys)))
            total, p = total + w, p + w * np.array(ys, float)
        p = p / total
        top = max([-10, *(min(10, max(-10, math.log(x / (1 - x)))) for x in p)])
        x = np.array([1, top / 5, math.log1p(sum(v for v in p if v >= 0.2))])
        assert abs(r["score"] - 1 / (1 + math.exp(-(x @ model.calibration)))) < 1e-6


def test_toxicity_learns_from_labels_with_errors():
    """Words in a few documents labelled clean still mark; a word that others explain is no clean word."""
    texts, y = toxic_texts(600)
    rng = np.random.default_rng(6)
    noisy = y.copy()
    noisy[rng.choice(np.flatnonzero(y > 0), 4, replace=False)] = 0
    noisy[rng.choice(np.flatnonzero(y == 0), 4, replace=False)] = 1
    extra = [t.replace("idiot", "idiot wretch") for t in texts[:400]]
    model = toxicity.train(pa.array(extra), noisy[:400])
    new = ["a wretch came by today", *texts[400:]]
    got = [r["score"] >= 0.3 for r in toxicity.assess(pa.array(new), model).to_pylist()]
    assert got[0] and np.mean(np.array(got[1:]) == (y[400:] > 0)) > 0.97


# 9: personal data ------------------------------------------------------------------------------------------------------------


def bootstrap_by_hand(edges, b):
    """Scores of patterns from (value, kind, patterns) rows, as the module's text says."""
    kind, of = {}, defaultdict(set)
    for value, k, patterns in edges:
        if k is not None:
            kind[value] = max(kind.get(value, ""), k)
        for p in patterns:
            of[p].add(value)
    kind = {v: k for v, k in kind.items() if any(v in x for x in of.values())}
    scores = {v: (1.0, k) for v, k in kind.items()}
    for i in range(b.rounds):
        out = {}
        for p, values in of.items():
            good = [v for v in values if v in scores and scores[v][0] >= b.good]
            if len(good) < b.least_seeds:
                continue
            by = defaultdict(float)
            for v in values:
                if v in scores:
                    by[scores[v][1]] += scores[v][0]
            out[p] = (sum(by.values()) / len(values), max((s, k) for k, s in by.items())[1])
        scores = {v: (1.0, k) for v, k in kind.items()}
        for v in {v for p in out for v in of[p]} - set(kind):
            found = [out[p] for p in out if v in of[p]]
            scores[v] = (1 - math.prod(1 - b.damping * s for s, _ in found), max(found)[1])
    return {p: (s, k) for p, (s, k) in out.items() if s >= b.confident}


def test_bootstrapping_equals_plain_scores(spark):
    rng = random.Random(14)
    rows = []
    for _ in range(300):
        v = rng.randrange(60)
        rows.append((f"v{v}", ("email" if v % 5 else "phone") if v % 3 == 0 and rng.random() < 0.8 else None, [f"p{(v * 7 + rng.randrange(3)) % 25}" for _ in range(rng.randint(0, 2))]))
    b = pii.Bootstrap(confident=0.55)
    want = bootstrap_by_hand(rows, b)
    got = {r["pattern"]: (r["score"], r["kind"]) for r in pii.confident_patterns(spark.createDataFrame(rows, "value string, kind string, patterns array<string>"), b).collect()}
    assert len(want) > 3 and set(got) == set(want)
    for p, (s, k) in want.items():
        assert abs(got[p][0] - s) < 1e-9 and got[p][1] == k


FORMS = [lambda r: f"(310) 555-{r:04d}", lambda r: f"310 555 {r:04d}", lambda r: f"4111 1111 1111 {r:04d}", lambda r: f"310-555-{r:04d}", lambda r: f"555.{r:04d}x"]


def test_unseen_forms_are_found_whole_by_their_context(spark):
    rng, rows, planted = random.Random(15), [], {}
    for i in range(40):
        rows.append((i, f"{prose(rng, 12)} please call us at +1 (555) 123-{i:04d} during the day {prose(rng, 5)}"))
    for i in range(100):
        value = FORMS[i % len(FORMS)](i)
        ahead = f"{prose(rng, rng.randint(3, 30))} please call us at "
        rows.append((1000 + i, f"{ahead}{value} during the day {prose(rng, 4)}"))
        planted[1000 + i] = (len(ahead), len(ahead) + len(value))
    for i in range(100):
        rows.append((2000 + i, f"{prose(rng, 8)} it costs {FORMS[i % len(FORMS)](5000 + i)} per dozen {prose(rng, 8)}"))
    out = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    caught = [d for d, (a, b) in planted.items() if out[d].endswith(f":{a}:{b}")]
    assert len(caught) == len(planted), [dict(rows)[d] for d in set(planted) - set(caught)][:3]
    base = {d: ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans_by_hand(t)) for d, t in rows}
    assert all(out[2000 + i] == base[2000 + i] for i in range(100)), "the same forms elsewhere are left alone"


def test_contexts_are_whole_words_and_count_instances(spark):
    long = "x" * 300
    texts = [f"{a}{long} {b} 10.0.0.{i}" for i, (a, b) in enumerate([("p", "at"), ("q", "at")])] + ["call 12345 or 23456 or 10.0.0.9 now"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(pii._instances(F.col("text"), pii.base_spans(F.col("text"))).alias("f"))
    got = [[(x["value"], x["patterns"]) for x in r["f"]["instances"]] for r in df.collect()]
    assert got[0][0][1] == [f"2:p{long} at"] and got[1][0][1] == [f"2:q{long} at"]
    assert got[2] == [("12345", ["1:call _ or"]), ("23456", ["2:0 or", "1:or _ or"]), ("10.0.0.9", ["2:0 or", "1:or _ now"])]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000])
def test_running_totals(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(100) for _ in range(n)]
    got = spark.createDataFrame([(values,)], "v array<int>").select(pii._running(F.col("v"), lambda x, y: x + y).alias("s"), pii._running(F.col("v"), lambda x, y: F.greatest(x, y)).alias("m")).first()
    assert got["s"] == list(itertools.accumulate(values)) and got["m"] == list(itertools.accumulate(values, max))


def test_a_text_with_very_many_matches(spark):
    rng = random.Random(2)
    text = " ".join(rng.choice(["10.0.0.%d", "word %d", "a%d@b.co", "%d", "+1 555 12%d 4567"]) % rng.randrange(200) for _ in range(50_000))
    out = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    want = spans_by_hand(text)
    assert out["n_ip"] == sum(k == "ip" for *_, k in want) and out["n_email"] == sum(k == "email" for *_, k in want)
    assert {f"{k}:{a}:{b}" for a, _, b, k in want} <= set(out["spans"].split(","))


# Columns that clash with names of the operators' own ---------------------------------------------------------------------------


def test_reserved_names_pass_unchanged(spark):
    own = ("__ww_id", "__ww_hash", "__ww_lines", "__ww_dropped", "__ww_split", "__ww_out", "row", "id", "text_hash", "dropped", "lines", "salt", "window", "hits", "sub", "a.b")
    docs = nasty(spark).drop("id", "text_hash").withColumns({c: F.lit(f"mine {c}") for c in own})
    from wickworks.llm import decontam

    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    for out in (templates.clean(docs), simhash.keep_one(docs), decontam.keep(docs, bench), compression.keep(docs)):
        assert out.columns == docs.columns
        assert out.where(" or ".join(f"`{c}` <> 'mine {c}'" for c in own)).count() == 0 and out.count() > 0
