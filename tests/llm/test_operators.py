"""Each text operator against brute force, a round trip or held-out labels, and on nulls, empties, long texts, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from wickworks.llm import bpe, common, compression, decontam, langid, pii, quality, queries, simhash, templates, textbytes, toxicity, urlfilter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"
have_tables = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
TOXIC = ["idiot", "stupid", "moron"]


def prose(rng, n, letters="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))


def nasty_rows():
    """(doc_id, text): nulls, blanks, a very long text, repeated rows, one id with two texts, copies, odd characters."""
    rng = random.Random(5)
    a, b = prose(rng, 80), prose(rng, 60)
    long = prose(rng, 30_000)
    return [
        (1, a), (1, a), (2, a), (3, b), (3, a + " more"), (None, b), (None, None), (4, None), (5, ""), (6, " \n\t "), (7, long), (8, "x"), (9, "é" * 5000),
        (10, "line one has some words in it here\nline one has some words in it here\n\nlast"), (11, "😀 \u0000 \ufffd <|endoftext|> 'll"), (-12, "a b c d"), (13, "A B C D"), (14, "1" * 3000 + " 4111 1111 1111 1111 a@b.co +1 (555) 123-4567 10.0.0.1"),
    ]


CLASH = ("id", "text_hash", "fp", "node", "key", "v", "score", "kept", "predicted", "component", "label", "w", "size", "item_id", "no", "line", "tokens", "cell", "__ww_id", "value")


def nasty(spark, empty=False):
    df = spark.createDataFrame([] if empty else nasty_rows(), "doc_id long, text string")
    df = df.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("long")})
    return df.withColumns({c: F.lit("clash") for c in CLASH if c != "__ww_id"})


def labels_of(spark, empty=False):
    rows = [] if empty else [(1, 1, 0), (1, 1, 0), (3, 0, 1), (None, 1, 1), (7, None, None), (999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


def benchmark_of(spark, empty=False):
    rng = random.Random(5)
    rows = [] if empty else [(1, prose(rng, 80)), (1, "dup of an id with other words in it"), (2, None), (3, ""), (None, "no id here at all"), (4, "A b")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumns({"w": F.lit("clash"), "size": F.lit("clash"), "h": F.lit("clash")})


# Shared parts ----------------------------------------------------------------------------------------------------------------


def test_span_hashes_depend_on_bytes_only():
    texts = pa.array(["ab cd ab", None, "", "cd", "é\x0bab"])
    found = {}
    for _, data, offsets in textbytes.blocks(texts):
        s, e = textbytes.words(data, offsets)
        for i, j, h in zip(s, e, textbytes.spans_hash(data, s, e), strict=True):
            found.setdefault(data[i:j].tobytes(), set()).add(int(h))
    assert set(found) == {b"ab", b"cd", "é".encode()} and all(len(v) == 1 for v in found.values())


def test_blocks_cut_between_texts(monkeypatch):
    monkeypatch.setattr(textbytes, "BLOCK_BYTES", 10)
    texts = pa.array(["aaaa", "bbbbbbbbbbbbbbb", "", "cc", None, "dd"])
    got = []
    for row, data, offsets in textbytes.blocks(texts):
        assert row == len(got)
        got += [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == ["aaaa", "bbbbbbbbbbbbbbb", "", "cc", "", "dd"]


def components_by_hand(edges):
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("kind", ["path", "shuffled path", "star", "random", "none"])
def test_connected_components(spark, kind):
    rng = random.Random(2)
    n = list(range(-60, 60))
    if kind == "shuffled path":
        rng.shuffle(n)
    edges = {"path": list(zip(n, n[1:], strict=False)), "shuffled path": list(zip(n, n[1:], strict=False)), "star": [(50, x) for x in n if x != 50], "random": [(rng.choice(n), rng.choice(n)) for _ in range(70)], "none": []}[kind]
    out = common.connected_components(spark.createDataFrame(edges, "src long, dst long"))
    want = {k: v for k, v in components_by_hand([e for e in edges if e[0] != e[1]]).items()}
    assert {r["node"]: r["component"] for r in out.collect()} == want


def test_held_out(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(-20, 200), None]], "doc_id long")
    for r in ids.select("doc_id", common.held_out(F.col("doc_id")).alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


# 1: quality ------------------------------------------------------------------------------------------------------------------


def labelled_texts(n=300):
    rng = random.Random(9)
    good = [prose(rng, rng.randint(30, 90)) for _ in range(n)]
    bad = [" ".join(w.upper() + "!!" for w in prose(rng, rng.randint(30, 90)).split()) if i % 2 else " ".join([prose(rng, 1)] * 60) for i in range(n // 4)]
    return good + bad, np.array([1.0] * len(good) + [0.0] * len(bad))


def test_quality_learns_and_scores_by_features():
    texts, y = labelled_texts()
    s = quality.Settings(bits=16)
    order = np.random.default_rng(1).permutation(len(texts))
    train, test = order[: len(order) // 2], order[len(order) // 2 :]
    w = quality.train(pa.array([texts[i] for i in train]), y[train], s)
    p = quality.scores(pa.array([texts[i] for i in test]), w, s)
    assert ((p >= 0.5) == (y[test] > 0)).mean() > 0.97
    for (at, x), want in zip(quality.rows(pa.array(texts[:5]), s), quality.scores(pa.array(texts[:5]), w, s), strict=True):
        assert abs(1 / (1 + np.exp(-(w[at] @ x + w[-1]))) - want) < 1e-5
    assert quality.scores(pa.array(["", None]), w, s).tolist() == [1 / (1 + np.exp(-float(w[-1])))] * 2


def test_quality_on_odd_tables(spark):
    for docs, labels in ((nasty(spark), labels_of(spark)), (nasty(spark), labels_of(spark, True)), (nasty(spark, True), labels_of(spark))):
        out = quality.classify(docs, labels).collect()
        assert len(out) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)


# 2: compression bands --------------------------------------------------------------------------------------------------------


def counts_by_hand(text):
    text = text or ""
    w, seen, again, wins = WORD.findall(text), set(), 0, {}
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    for i in range(len(w) - 7):
        wins.setdefault(tuple(w[i : i + 8]), []).append(i)
    cover = {i + k for v in wins.values() if len(v) > 1 for i in v for k in range(8)}
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(cover)]


def test_compression_counts_match_brute_force():
    rng = random.Random(4)
    parts = ["a", "b c", "é", "x y z w v u t s", "\n", "a\n", " ", "#", "|", "1 2 3 4 5 6 7 8 9", "\t", "\x0b", "😀"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(400)] + [t for _, t in nasty_rows()]
    for t, r in zip(texts, compression.assess(pa.array(texts, pa.string())).to_pylist(), strict=True):
        c = counts_by_hand(t)
        assert list(r.values())[:5] == c, t
        assert r["base_failed"] == (c[0] < 20 or 100 * c[4] > 30 * c[0]) and (not r["base_failed"] or not r["kept"])


def test_compression_bands_tell_text_apart():
    rng = random.Random(3)
    base64 = " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60)) for _ in range(100))
    same = " ".join(f"item {i % 7} of the list and so on to the end" for i in range(400))
    assert [r["kept"] for r in compression.assess(pa.array([base64, same])).to_pylist()] == [False, False]


def test_compression_on_odd_tables(spark):
    docs = nasty(spark)
    assert compression.report(docs).count() == docs.count() and compression.report(nasty(spark, True)).count() == 0
    kept = compression.keep(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} <= {1, 2, 3, 7, None}


# 3: language -----------------------------------------------------------------------------------------------------------------

EN, DE = "the of and to in is that it was for on with as by at from this have are".split(), "der die und das ist nicht mit auf für sich auch ein eine von zu dem den im".split()


def labelled_langs(spark):
    rng = random.Random(8)
    return spark.createDataFrame([(i, " ".join(rng.choices(EN if i % 2 else DE, k=40)), "en" if i % 2 else "de") for i in range(60)], "doc_id long, text string, lang string")


def test_language_fuses_evidence(spark):
    rng = random.Random(8)
    page = lambda i, host, words, lang: (i, f"https://{host}/x/{i}", f'<!DOCTYPE html><HTML class=a lang="{lang}"><head><script>der die das</script></head><body><p>{" ".join(words)}</p></body></html>')
    rows = [page(i, "a.site.de", rng.choices(DE, k=40), "de") for i in range(60)] + [page(100 + i, "b.site.com", rng.choices(EN, k=40), "en") for i in range(60)]
    rows += [page(500, "a.site.de", [], ""), page(501, "b.site.com", [], ""), page(502, "new.site.de", [], "de"), page(503, "b.site.com", rng.choices(DE, k=60), "en"), (504, None, None), (504, None, None), (None, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("clash"), "post": F.lit("clash"), "lang": F.lit("clash")})
    out = [r for r in langid.identify(pages, labelled_langs(spark)).collect()]
    by = {r["page_id"]: r for r in out}
    assert len(out) == len(rows)
    assert all(by[i]["lang"] == "de" for i in range(60)) and all(by[100 + i]["lang"] == "en" for i in range(60))
    assert by[500]["lang"] == "de" and by[501]["lang"] == "en" and by[502]["lang"] == "de", "host, suffix and declaration decide without text"
    assert by[503]["lang"] == "de", "enough text overrules declaration and host"
    assert langid.identify(pages.limit(0), labelled_langs(spark)).count() == 0
    both = langid.identify(pages, labelled_langs(spark), nasty(spark).union(nasty(spark).limit(0)))
    assert Counter(r["doc_id"] for r in both.where("page_id is null and doc_id is not null").collect()) == Counter(d for d, _ in nasty_rows() if d is not None)
    assert both.count() == len(rows) + len(nasty_rows())
    texts = langid.identify(pages.limit(0), labelled_langs(spark), labelled_langs(spark).withColumn("source", F.lit(None).cast("string")))
    assert all(r["lang"] == ("en" if r["doc_id"] % 2 else "de") for r in texts.collect())
    assert {r["lang"] for r in langid.identify(pages, labelled_langs(spark).limit(0)).collect()} == {"und"}


# 4: BPE ----------------------------------------------------------------------------------------------------------------------


def test_bpe_equals_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    theirs, ours = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json"))), bpe.coder("byte_bpe_50k.json")
    rng = random.Random(6)
    parts = ["a", "th", "the", " ", "  ", "\n", "é", "日本", "😀", "'s", "'ll", "1", "23", "\t", "<|endoftext|>", "<|endof", "!!", "%%%", "\u00a0", "\0", "\0\0<|endoftext|>", "ing", "İ", "ß", "\x1c", "²"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["".join(rng.choice("abcdefghij"[: rng.randint(1, 10)]) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [t for _, t in nasty_rows() if t is not None] + ["a" * 20_000, "ab1" * 5000, " " * 5000]
    for t, (n, ids, decoded) in zip(texts, ours.code(texts), strict=True):
        want = theirs.encode(t, add_special_tokens=False).ids
        assert ids == ",".join(map(str, want)) and n == len(want), t[:80]
        assert decoded == theirs.decode(want, skip_special_tokens=False) == ours.decode(want)


def test_bpe_cache_generations(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    c = bpe.Coder(bpe.coder("byte_bpe_50k.json").__dict__.get("path") or str(__import__("public_tokenizers").path("byte_bpe_50k.json")))
    rng = random.Random(1)
    texts = [prose(rng, 40) for _ in range(30)]
    first = [c.code([t])[0] for t in texts]
    assert first == [c.code([t])[0] for t in texts] == c.code(texts)


def test_bpe_on_odd_tables(spark):
    docs = nasty(spark)
    out = bpe.encoded(docs).collect()
    assert len(out) == docs.count() and bpe.digests(nasty(spark, True)).count() == 0
    nothing = hashlib.sha256(b"").hexdigest()
    assert all((r["n_tokens"], r["ids"], r["ids_sha256"], r["decoded_sha256"]) == (0, [], nothing, nothing) for r in out if r["doc_id"] in (4, 5))
    back = docs.select("text", bpe.decode(bpe.coded(F.col("text"))["ids"]).alias("again"))
    assert all(r["again"] == (r["text"] or "") for r in back.collect())


# 5: SimHash ------------------------------------------------------------------------------------------------------------------


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(text, k):
    w = WORD.findall(lower(text))
    return ([" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]) if w else []


def print_by_hand(text):
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def copies():
    """Random texts with exact copies, and near copies from one changed word to many."""
    rng = random.Random(7)
    rows, n = [], 0
    for _ in range(12):
        words = prose(rng, rng.randint(60, 400)).split()
        for changes in (0, 0, 1, 1, 2, 5, 12, 30):
            w = list(words)
            for i in rng.sample(range(len(w)), changes):
                w[i] = prose(rng, 1)
            rows.append((n, " ".join(w)))
            n += 1
    return rows


def grouped(rows, linked):
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if linked(i, j)]
    up = components_by_hand(edges)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[up.get(i, i)] = min(least.get(up.get(i, i), d), d)
    return [least.get(up.get(i, i)) for i in range(len(rows))]


def test_simhash_components_equal_brute_force(spark):
    rows = copies() + nasty_rows()
    fps = [print_by_hand(t) for _, t in rows]
    want = Counter((d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, grouped(rows, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2), strict=True))
    got = simhash.components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()) == want


def test_tile_comparison_finds_every_close_pair(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.int64)
    prints = {int(b) ^ int(sum(1 << int(k) for k in rng.choice(62, rng.integers(0, 4), replace=False))) for b in base for _ in range(6)}
    prints = sorted(prints)
    nodes = spark.createDataFrame([(p, p) for p in prints], "node long, w0 long")
    quarter = lambda i: F.bit_count(F.shiftrightunsigned("w0", 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long")))
    cell = ((quarter(3) * 64 + quarter(2)) * 64 + quarter(1)) * 64 + quarter(0)
    links = [(r["src"], r["dst"]) for r in simhash.links(nodes, 1, 2, cell, simhash._offsets(2)).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    every = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 2]
    assert components_by_hand(links) == components_by_hand(every)


def test_forest_of_a_crowd_in_bounded_steps(monkeypatch):
    rng = np.random.default_rng(3)
    base = np.uint64(0x123456789ABCDEF0)
    crowd = np.array([base ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False))) for _ in range(300)], np.uint64)
    other = crowd[::-1].copy()[:100]
    whole = [simhash.near_forest([crowd], [b], same, 3) for same, b in ((True, crowd), (False, other))]
    monkeypatch.setattr(simhash, "STEP_PAIRS", 900)
    monkeypatch.setattr(simhash, "HELD_LINKS", 50)
    for (same, b), (i, j, d) in zip(((True, crowd), (False, other)), whole, strict=True):
        x, y, z = simhash.near_forest([crowd], [b], same, 3)
        assert components_by_hand([(int(p), int(q) + 300 * (not same)) for p, q in zip(i, j, strict=True)]) == components_by_hand([(int(p), int(q) + 300 * (not same)) for p, q in zip(x, y, strict=True)])
        assert d.sum() == z.sum() and all((crowd[p] ^ b[q]).bit_count() == r <= 3 for p, q, r in zip(x, y, z, strict=True))


def test_tiles_split_crowded_cells(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 5)
    test_simhash_components_equal_brute_force(spark)


def test_near_duplicates_equal_brute_force(spark):
    rows = copies()
    sets = [set(shingles(t, 5)) for _, t in rows]
    near = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    want = grouped(rows, near)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: r["first_id"] for r in simhash.near_duplicates(docs).collect()}
    assert [got[d] for d, _ in rows] == want
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == set(want)


@pytest.mark.parametrize("set_bytes", [1 << 17, 8000])
def test_links_are_verified_before_they_are_cut_to_a_forest(spark, monkeypatch, set_bytes):
    """Texts about the similarity from each other: the nearest candidates are often under it, and must not displace links over it."""
    monkeypatch.setattr(simhash, "SET_BYTES", (set_bytes, set_bytes))
    rng, rows = random.Random(41), []
    for g in range(3):
        base = prose(rng, 150).split(" ")
        for k in range(30):
            words = list(base)
            for at in rng.sample(range(0, 150, 6), rng.randint(1, 3)):
                words[at] = f"v{k}x{at}"
            rows.append((100 * g + k, " ".join(words)))
    sets = [set(shingles(t, 5)) for _, t in rows]
    want = grouped(rows, lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    got = {r["id"]: r["first_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[d] for d, _ in rows] == want


def test_keep_one_on_odd_tables(spark):
    docs = nasty(spark)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    left = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert max(left.values()) == 1 and (2, nasty_rows()[0][1]) not in left and (1, nasty_rows()[0][1]) in left
    assert len([1 for _, t in left if not (t or "").strip()]) == 1, "texts without words are one group"
    assert simhash.keep_one(nasty(spark, True)).count() == 0 and simhash.components(nasty(spark, True)).count() == 0


# 6: toxicity -----------------------------------------------------------------------------------------------------------------


def toxic_texts(n=240):
    rng = random.Random(12)
    texts, y = [], []
    for i in range(n):
        w = prose(rng, rng.randint(20, 150)).split()
        if i % 4 == 0:
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(TOXIC) + rng.choice(["", ",", "!!"])
        texts.append(" ".join(w))
        y.append(float(any(t in texts[-1] for t in TOXIC)))
    return texts, np.array(y)


def test_toxicity_learns_words_and_offsets():
    texts, y = toxic_texts()
    model = toxicity.train(pa.array(texts[:160]), y[:160])
    out = toxicity.assess(pa.array(texts[160:]), model).to_pylist()
    assert [r["score"] >= 0.3 for r in out] == [v > 0 for v in y[160:]]
    for t, r in zip(texts[160:], out, strict=True):
        tagged = [t[int(a) : int(b)] for a, b in (x.split(":") for x in r["spans"].split(",") if x)]
        assert sorted(tagged) == sorted(x for x in re.findall("[a-z]+", t) if x in TOXIC)
    shifted = toxicity.assess(pa.array(["é😀 you IDIOT here"]), model).to_pylist()[0]
    assert shifted["spans"] == "7:12"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    e, edges, start = rng.normal(size=(3, 5)), rng.normal(size=(2, 2)), 0.3
    length = np.array([5, 3, 1])
    p, counts = toxicity.marginals(e, length, edges, start)
    seen = np.zeros((2, 2))
    for c in range(3):
        n, total, on, two = length[c], 0.0, np.zeros(length[c]), np.zeros((2, 2))
        for m in range(2**n):
            ys = [(m >> k) & 1 for k in range(n)]
            weight = np.exp(start * ys[0] + sum(e[c, k] * ys[k] for k in range(n)) + sum(edges[ys[k], ys[k + 1]] for k in range(n - 1)))
            total += weight
            on += weight * np.array(ys)
            for k in range(n - 1):
                two[ys[k], ys[k + 1]] += weight
        np.testing.assert_allclose(p[c, :n], on / total, rtol=1e-9)
        seen += two / total
    np.testing.assert_allclose(counts, seen, rtol=1e-9)


def test_toxicity_on_odd_tables(spark):
    for docs, labels in ((nasty(spark), labels_of(spark)), (nasty(spark), labels_of(spark, True)), (nasty(spark, True), labels_of(spark))):
        out = toxicity.classify(docs, labels).collect()
        assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)


# 7: decontamination ----------------------------------------------------------------------------------------------------------


def leaky(spark):
    """Passages whole, changed at a word, in other letters; then, in odd orders: halves swapped, cut off at the end, with repeats."""
    rng = random.Random(21)
    items = [(i, prose(rng, n, "abcdefgh")) for i, n in enumerate((15, 30, 30, 59, 3, 5, 8))]
    docs = [(i, prose(rng, rng.randint(0, 200), "abcdefgh")) for i in range(30)]
    for i in range(24):
        passage = items[i % len(items)][1].split()
        if i % 3 == 1 and len(passage) > 20:
            passage[rng.randrange(len(passage))] = "changed"
        if i % 3 == 2:
            passage = [w.upper() + rng.choice(["", ",", "."]) for w in passage]
        d, w = docs[i][0], docs[i][1].split()
        at = rng.randrange(len(w) + 1)
        docs[i] = (d, " ".join(w[:at] + passage + w[at:]))
    items += [(20, prose(rng, 60, "abcdefgh")), (21, "a b c d e f " * 6 + prose(rng, 9)), (22, prose(rng, 60, "abcdefgh"))]
    long, tune = items[-3][1].split(), items[-2][1].split()
    pad = lambda n: prose(rng, n).split()
    docs += [(100 + i, " ".join(x)) for i, x in enumerate((
        pad(40) + long[30:] + long[:30] + pad(40), long[30:] + long[:30], pad(10) + long[:48], pad(30) + long[:50], long[8:] + pad(40), pad(20) + long[:54] + pad(20), long[:20] + pad(1) + long[20:],
        pad(20) + tune + tune[:30] + pad(9), tune[6:] + tune[:6], tune[:36] * 3, long[20:40] + long[:20] + long[40:] + pad(7), items[-1][1].split()[30:] + long[:30] + pad(12), long[4:] + long[:4] + long,
    ))]
    return docs, items


def windows_by_hand(docs, items):
    """The best similarity of each document and item over every window."""
    clean = lambda t: t.translate({ord(c): None for c in decontam.PUNCTUATION}).lower().split()
    out = {}
    for d, text in docs:
        w = clean(text)
        for item, passage in items:
            v = clean(passage)
            k = min(5, len(v))
            bag = lambda x: Counter(tuple(x[i : i + k]) for i in range(len(x) - k + 1))  # noqa: B023, E731
            a = bag(v)
            for at in range(len(w) - k + 1):
                b = bag(w[at : at + len(v)])
                s = (a & b).total() / (a | b).total()
                if s >= 0.8:
                    out[d, item] = max(out.get((d, item), 0), round(s, 6))
    return sorted((*k, v) for k, v in out.items())


def test_decontamination_equals_sql(spark):
    docs, items = leaky(spark)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    want = sorted(con.execute(decontam.REPORT_SQL).fetchall())
    assert len(want) > 20 and want == windows_by_hand(docs, items)
    assert {100, 101, 103, 105, 106, 107, 108, 112} <= {x for x, item, _ in want if item in (20, 21)}, "halves swapped, cut off or repeated"
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontam.report(d, b).select("doc_id", "item_id", "similarity")
    assert sorted(tuple(r) for r in got.collect()) == want
    blocks = decontam.report(d, b, decontam.Match(block_shingles=7)).select("doc_id", "item_id", "similarity")
    assert sorted(tuple(r) for r in blocks.collect()) == want, "blocks of the items' shingles change nothing"
    assert {r["doc_id"] for r in decontam.keep(d, b).collect()} == {x for x, _ in docs} - {w[0] for w in want}


def test_blocks_leave_no_pair_within_the_radius(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(-(2**63), 2**63, 200, dtype=np.int64)
    flips = [sum(1 << int(k) for k in rng.choice(64, 24, replace=False)) for _ in a]
    b = (a.view(np.uint64) ^ np.array(flips, np.uint64)).view(np.int64)
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b, strict=True)], "a long, b long")
    shared = df.select(F.arrays_overlap(decontam.blocks(F.col("a"), 24), decontam.blocks(F.col("b"), 24)).alias("s"))
    assert all(r["s"] for r in shared.collect())


def test_radius_holds_similar_windows():
    rng = np.random.default_rng(11)
    worst = 0
    for n in (1, 3, 8, 11, 20, 36, 55):
        for _ in range(400):
            h = rng.integers(0, 2**64, n, dtype=np.uint64)
            most = int(n * 0.2 / 1.8)  # changed shingles that leave a similarity of 0.8
            g = h.copy()
            if most:
                g[rng.choice(n, most, replace=False)] = rng.integers(0, 2**64, most, dtype=np.uint64)
            worst = max(worst, ((simhash.majority(h) ^ simhash.majority(g)) & (2**64 - 1)).bit_count())
            cut = h[: -(-4 * n // 5)]  # a window at the end of a document
            worst = max(worst, ((simhash.majority(h) ^ simhash.majority(cut)) & (2**64 - 1)).bit_count())
    assert worst <= decontam.Match.radius


def test_simhash_column_equals_numpy(spark):
    rng = np.random.default_rng(1)
    arrays = [[int(x) for x in rng.integers(-(2**63), 2**63, n, dtype=np.int64)] for n in (1, 2, 7, 40, 4095, 4096, 5000)]
    df = spark.createDataFrame([(a,) for a in arrays], "h array<long>")
    got = [r["s"] for r in df.select(decontam.simhash(F.col("h")).alias("s")).collect()]
    assert got == [simhash.majority(np.array(a, np.int64).view(np.uint64)) for a in arrays]


def test_counted_arrays_meet_as_often_as_both_have_an_element(spark):
    rng = random.Random(4)
    rows = [([rng.randrange(6) for _ in range(rng.randint(0, 12))], [rng.randrange(6) for _ in range(rng.randint(0, 12))]) for _ in range(200)]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").select(F.size(F.array_intersect(decontam.counted(F.col("a")), decontam.counted(F.col("b")))).alias("n"))
    assert [r["n"] for r in df.collect()] == [(Counter(a) & Counter(b)).total() for a, b in rows]


def test_decontamination_on_odd_tables(spark):
    docs = nasty(spark)
    for b in (benchmark_of(spark), benchmark_of(spark, True)):
        assert decontam.keep(docs, b).columns == docs.columns
    kept = decontam.keep(docs, benchmark_of(spark))
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()}
    assert {1, 2, -12, 13} <= gone and {7, 8} & gone == set()
    assert decontam.keep(docs, benchmark_of(spark, True)).count() == docs.count() and decontam.keep(nasty(spark, True), benchmark_of(spark)).count() == 0


# 8: url filter ---------------------------------------------------------------------------------------------------------------

PAGES = [
    (1, "https://a.x.io/p", '<LINK href="https://www.b.com/en/1" REL=canonical>'), (2, "https://a.x.io/q/?k=1#f", '<meta http-equiv="refresh" content="0; URL=../x">'),
    (3, "http://c.io/r/s", '<meta http-equiv=refresh content="0;url=t"><link rel="canonical" href="/q">'), (4, "https://c.io/q/", '<link rel=canonical href="//d.io/m">'),
    (5, "http://d.io/m", '<link rel="canonical" href="https://z.org/es/1">'), (6, "https://c.io/r/t", ""), (7, None, None), (8, "nourl", '<link rel=canonical href="https://www.b.com/en/1">'),
    (9, "https://e.io/1", '<link rel=canonical href="https://b.org/es/4">'), (10, "https://e.io/1?x", '<link rel=canonical href="https://e.io/1"><meta http-equiv="refresh" content="1;url=https://y.net/de/3">'),
    (11, "https://f.io", '<link rel=canonical href="g?a=1&amp;b=2">'), (12, "https://f.io/g?a=1&b=2", '<link rel=canonical href="http://sub.EXAMPLE.net/de/8x">'), (12, "https://f.io/g?a=1&b=2", '<link rel=canonical href="http://sub.EXAMPLE.net/de/8x">'),
    (None, "http://Example.com/en/77", None), (14, "x://notexample.com/en/7", None), (15, "http://example.com?/en/7", None), (16, "://", ""), (17, "http://com/en/", "<p>"),
    (18, "https://a.org/es", '<meta http-equiv=refresh content="0;url=https://a.org/es/">'), (19, "https://q.io/1", '<link rel=canonical href="https://h.org/es">'), (20, "https://h.org/es/", ""), (21, "https://self.io", '<link rel=canonical href="https://self.io/">'),
]


def test_url_filter_equals_sql(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("host", "path", "node", "rule", "link", "to")})
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    want = sorted(map(str, con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({urlfilter.JUDGE_SQL})").fetchall()))
    got = urlfilter.judge(pages)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    by = {r["page_id"]: r for r in got.collect()}
    assert by[1]["verdict"] == "block" and by[9]["verdict"] == "allow" and by[10]["verdict"] == "allow", "an explicit allow in the component wins"
    assert by[18]["verdict"] == by[19]["verdict"] == by[20]["verdict"] == "block" and by[21]["verdict"] == "allow", "addresses that differ by a last slash are one"
    assert by[None]["rule"] == "example.com/en/7" and by[14]["rule"] == "com/en/" and by[15]["rule"] is None
    assert urlfilter.judge(pages.limit(0)).count() == 0


# 9: personal data ------------------------------------------------------------------------------------------------------------

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(c if i % 2 == 0 else 2 * c - 9 * (c > 4) for i, c in enumerate(map(int, reversed(d)))) % 10 == 0


def spans_by_hand(text):
    out = []
    for o, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (12 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), o, m.end(), kind))
    return sorted(out)


def test_pii_base_and_discovery(spark):
    rng = random.Random(3)
    parts = ["1", "2", "4", "25", "255", "256", "0", ".", "-", " ", "+", "(", ")", "@", "a", "x.y", "é", "😀", "\n", "4111 1111 1111 1111", "+1 (555) 123-4567", "a@b.co", "..", "%", "10.0.0.1", "001", "A_b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(700)]
    texts += [t for _, t in nasty_rows()] + ["1" * 5000 + " x", "a" * 6000, "a" * 3000 + "@", "1 " * 800, "+" + "1-" * 3000]
    base = len(texts)
    texts += [f"w{n} please call number +1 (555) 123-45{n:02d} today q{n}" for n in range(12)] + ["zz please call number 555x12399 today uu", "zz you pay the sum 555x12399 now uu"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"id": F.lit("c"), "value": F.lit("c"), "base": F.lit("c"), "pattern": F.lit("c")})
    out = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        want = spans_by_hand(t)
        line = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert out[i]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest(), t
        assert [out[i][f"n_{k}"] for k, _ in BASE] == [sum(w[3] == k for w in want) for k, _ in BASE]
        assert set(filter(None, line.split(","))) <= set(filter(None, out[i]["spans"].split(",")))
    assert out[base + 12]["spans"] == "phone:22:31", "a seed context discovers an identifier that no base pattern has"
    assert out[base + 13]["spans"] == "", "the same text elsewhere isn't one"
    assert pii.find(docs.limit(0)).count() == 0


def test_pii_rows_stay(spark):
    docs = nasty(spark)
    assert Counter(r["doc_id"] for r in pii.find(docs).collect()) == Counter(d for d, _ in nasty_rows())


# 10: line templates ----------------------------------------------------------------------------------------------------------


def lined():
    rng = random.Random(31)
    common_line = prose(rng, 20)
    rows = []
    for i in range(40):
        lines = [prose(rng, rng.randint(1, 25)) for _ in range(rng.randint(0, 6))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), common_line)
        if i % 4 == 0:
            lines.append(f"request {i} served at 10:{i} from host{i} with status 200 ok")
        if i % 5 == 0:
            lines.append(f"a user by name of {prose(rng, 1)} logged in from the office network today")
        if i % 2 == 0:
            lines.append("see also")
        rows.append((i, "\n".join(lines)))
    return rows + [(40, rows[3][1]), (41, rows[3][1]), (42, None), (43, ""), (44, "\n\n"), (45, " \t \n x")]


def test_line_templates_equal_sql(spark):
    rows = lined()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(map(str, con.execute(f"SELECT doc_id, text, n_lines, n_dropped FROM ({templates.REPORT_SQL})").fetchall()))
    got = templates.report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    text = {r["doc_id"]: r["text"] or "" for r in got.collect()}
    assert sum("served at" in t for t in text.values()) == sum("logged in from" in t for t in text.values()) == 1, "variable fields are one template, whose first line stays"
    assert sum("see also" in t for t in text.values()) == 20, "lines of few tokens stay"
    assert text[40] == text[41] == "" or all(x not in text[40] for x in rows[3][1].split("\n") if len(x.split()) >= 8)


@pytest.mark.parametrize("others", [0, 60])
def test_a_leaf_holds_several_templates(spark, others):
    """Templates with the same opening and length are all found, among unrelated lines of that opening too."""
    rng = random.Random(7)
    lines = [f"This page was last edited by {x} during the weekly site review" for x in ("anna", "boris", "carla")]
    lines += [f"This page was last printed for {x} at our local branch desk" for x in ("dora", "emil")]
    unrelated = [f"This page was last {prose(rng, 8)}" for _ in range(others)]
    docs = spark.createDataFrame(list(enumerate(lines + unrelated)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in templates.report(docs).collect()}
    assert [got[i] for i in range(5)] == [lines[0], "", "", lines[3], ""]
    assert all(got[5 + i] == x for i, x in enumerate(unrelated))


def rows_generated(spark, run):
    """The most rows that one Generate made while run() ran."""
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    bus.waitUntilEmpty()
    before, most = store.executionsCount(), 0
    run()
    bus.waitUntilEmpty()
    executions = store.executionsList()
    for i in range(before, executions.size()):
        at = executions.apply(i).executionId()
        made, nodes = store.executionMetrics(at), store.planGraph(at).allNodes()
        for node in (nodes.apply(j) for j in range(nodes.size())):
            for metric in (node.metrics().apply(k) for k in range(node.metrics().size())):
                if node.name() == "Generate" and metric.name() == "number of output rows" and made.get(metric.accumulatorId()).isDefined():
                    most = max(most, int(made.get(metric.accumulatorId()).get().replace(",", "")))
    return most


def test_shared_blocks_make_no_row_of_each_token(spark):
    """A leaf of lines that share many blocks makes rows of lines and blocks; the tokens of a block are counted as arrays."""
    rng = random.Random(43)
    base, tree = prose(rng, 40).split(), templates.Tree()
    rows = [(1, i, [prose(rng, 1) if rng.random() < 0.4 else w for w in base]) for i in range(60)]
    lines = spark.createDataFrame(rows, "leaf long, whole long, rest array<string>").persist()
    lines.count()
    blocks = 13  # of 40 places at most 12 differ
    assert 0 < rows_generated(spark, lambda: templates._further(lines, lines.limit(0).select("leaf", "whole"), tree)) <= len(rows) * blocks
    lines.unpersist()


def test_blocks_counted_as_arrays_equal_those_counted_in_rows(spark):
    """Ties and single lines too, and whole leaves with every block counted in rows."""
    rng = random.Random(44)
    rows = [(g, g, 100 * g + i, [rng.choice(["a", "b", "B", "é", "😀", "ﬀ"][: rng.randint(2, 6)]) for _ in range(g % 7 + 1)]) for g in range(60) for i in range(g % 9 + 1)]
    lines = spark.createDataFrame(rows, "sub long, leaf long, whole long, rest array<string>")
    tree = templates.Tree(similarity=0.5)
    want = sorted(map(tuple, templates._agreeing(lines, "sub", tree).select("sub", "leaf", "whole").collect()))
    assert want and sorted(map(tuple, templates._agreeing_together(lines, "sub", tree).collect())) == want
    base = prose(rng, 30).split()
    texts = [" ".join(base[:4] + [prose(rng, 1) if rng.random() < q else w for w in base[4 + s :] + base[4 : 4 + s]]) for s in range(3) for q in (0.1, 0.3, 0.5) for _ in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, other = (sorted(map(str, templates.report(docs, templates.Tree(together=n)).collect())) for n in (templates.Tree().together, 100))
    assert one == other and sum("n_dropped=1" in r for r in one) > 4


def families(rng, n_leaves, n_families, size, places, changed):
    """{(leaf, whole): (family, tokens)}: leaves of several families of lines, each line with so many places of its family's changed."""
    lines = {}
    for leaf in range(n_leaves):
        for f in range(n_families):
            base = prose(rng, places).split()
            for _ in range(size):
                at = set(rng.sample(range(places), changed))
                lines[leaf, len(lines)] = ((leaf, f), [prose(rng, 1) if i in at else w for i, w in enumerate(base)])
    return lines


def frame(spark, lines):
    rows = [(leaf, whole, tokens) for (leaf, whole), (_, tokens) in lines.items()]
    return spark.createDataFrame(rows, "leaf long, whole long, rest array<string>")


@pytest.mark.parametrize("places", [30, 150])
def test_further_templates_recall_against_brute_force(spark, places):
    """Of the lines that agree with another at enough places (all pairs looked at), at least 0.9 are found, and no template mixes families."""
    rng, tree = random.Random(places), templates.Tree()
    lines = families(rng, 12, 5, 4, places, round(places * 0.14))
    lines |= {(leaf, 10_000 + whole): (None, prose(rng, places).split()) for leaf in range(12) for whole in range(10)}
    df = frame(spark, lines)
    got = {(r["leaf"], r["whole"]): r["joint"] for r in templates._further(df, df.limit(0).select("leaf", "whole"), tree)[0].collect()}
    alike = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True)) >= tree.similarity * places
    want = {k for k, (_, a) in lines.items() if any(k != j and k[0] == j[0] and alike(a, b) for j, (_, b) in lines.items())}
    assert len(want) > 200 and len(want & got.keys()) >= 0.9 * len(want)
    by_joint = {}
    for k, joint in got.items():
        by_joint.setdefault(joint, set()).add(lines[k][0])
    assert all(len(f) == 1 and f != {None} for f in by_joint.values())


def test_what_is_compared_grows_with_the_length_of_a_line(spark):
    """Places compared in blocks: in proportion to a line's places from the probe's size on, and to the lines."""
    tree = templates.Tree()

    def compared(size, places):
        df = frame(spark, families(random.Random(1), 1, 2, size, places, round(places * 0.2)))
        asked = templates._shared(templates._blocks(df, tree), tree).join(templates._probes(df, tree), ["leaf", "whole"])
        return asked.agg(F.sum(F.size("rest"))).first()[0] + 2 * size * places

    lengths = [compared(11, n) for n in (100, 200, 400, 800)]
    counts = [compared(n, 200) for n in (10, 50)]
    print("places compared by length 100, 200, 400, 800:", lengths, "by lines 20, 100:", counts)
    assert all(b <= 2.3 * a for a, b in zip(lengths, lengths[1:], strict=False)) and counts[1] <= 6 * counts[0]


def test_long_lines_agree_whole_and_blocks_in_rows_give_the_same(spark):
    """Lines that agree at the probed places but not whole are no template; a block too large for a task is counted in rows."""
    rng = random.Random(6)
    tree = templates.Tree()
    probed = templates._probes(spark.createDataFrame([(0, 0, [str(i) for i in range(400)])], "leaf long, whole long, rest array<string>"), tree).first()["rest"]
    assert len(set(probed)) == tree.probe
    keep, base = set(map(int, probed)), prose(rng, 400).split()
    lines = {(0, w): (None, [x if i in keep or i < 60 else prose(rng, 1) for i, x in enumerate(base)]) for w in range(5)}
    lines |= {(1, 100 + w): v for (_, w), v in families(rng, 1, 2, 6, 400, 60).items()}
    df = frame(spark, lines)
    one, other = ({tuple(r) for r in templates._further(df, df.limit(0).select("leaf", "whole"), templates.Tree(together=n))[0].collect()} for n in (tree.together, 1000))
    assert one == other and {leaf for leaf, *_ in one} == {1} and len(one) == 12


def test_line_templates_on_odd_tables(spark):
    docs = nasty(spark)
    out = templates.clean(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(d for d, _ in nasty_rows())
    assert templates.report(nasty(spark, True)).count() == 0


# Queries ---------------------------------------------------------------------------------------------------------------------


@have_tables
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = queries.queries()[name](spark, SMALL)
    cursor = con.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in cursor.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(str(tuple(r)) for r in got.select(*cols).collect()) == sorted(map(str, cursor.fetchall()))


@have_tables
def test_every_operator_has_its_query(spark):
    names = queries.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    for n in ("op1_quality", "op2_compression_bands", "op4_bpe", "op5_simhash", "op6_toxicity", "op9_pii", "op12_licenses"):
        out = names[n](spark, SMALL)
        assert out.columns[0] == "doc_id" and out.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
