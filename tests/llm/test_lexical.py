"""Collocations, license scans and ranked search against plain Python, and on nulls, empties, repeats, hot words and clashing columns."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest

from tests.llm.test_operators import benchmark_of, nasty
from wickworks.llm import collocations, lexical, licences

SMALL_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def oracle(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df)
    return con.sql(sql)


def same_as_sql(df, sql, **tables):
    found = oracle(sql, **tables)
    at = [found.columns.index(c) for c in df.columns]
    want = sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows_of(df) == want


# Collocations ------------------------------------------------------------------------------------------------------------------


def plain_collocations(docs, m):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL_AZ)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, m.longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= m.support}
        kept = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * b >= m.inside * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in frequent.items()):
                continue
            score, cut = min((1_000_000 * a * a // (f[p[:c]] * f[p[c:]]), c) for c in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(kept)[: m.top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def phrase_rows(rng, n=400):
    vocabulary = [f"w{i}" for i in range(30)] + ["New", "york", "city", "é", "x" * 300, "a b"]
    rows = []
    for _ in range(n):
        words = rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(len(vocabulary))], k=rng.randint(0, 40))
        if rng.random() < 0.4:
            words[len(words) // 2 : len(words) // 2] = ["New", "York", "City"]
        text = "".join(w + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " \r "] if rng.random() < 0.2 else [" "]) for w in words)
        rows.append((rng.choice(["en", "de", None, "und"]), text))
    return rows + [("en", None), ("en", ""), (None, " . , "), ("en", "a a a a a a a a a a a a a"), ("fr", "one two")] + [("en", "hot pair here")] * 200


@pytest.mark.parametrize("mining", [collocations.Mining(buckets=1 << 16), collocations.Mining(support=3, held=50, top=7, buckets=1 << 16, rank_salts=3), collocations.Mining(longest=4, support=300, buckets=1 << 17)])
def test_collocations_equal_plain_counting(spark, mining):
    rows = phrase_rows(random.Random(3))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert rows_of(collocations.mine(docs, mining)) == plain_collocations(rows, mining)


def test_full_bitmaps_prune_nothing_and_change_nothing(spark, monkeypatch):
    """With bits that phrases share, more is counted and the result is the same."""
    rows = phrase_rows(random.Random(4), 150)
    docs = spark.createDataFrame(rows, "lang string, text string")
    mining = collocations.Mining(buckets=1 << 16, support=4)
    monkeypatch.setattr(collocations, "_hashed_bitmap", lambda raw, m: collocations.np.full(m.buckets // 8, 255, "uint8"))
    monkeypatch.setattr(collocations, "_common_bitmap", lambda frequent, k, m: collocations.np.full(m.buckets // 8, 255, "uint8"))
    assert rows_of(collocations.mine(docs, mining)) == plain_collocations(rows, mining)


def test_buckets_and_apriori_prune_what_is_rare(spark, monkeypatch):
    rows = [("en", "common pair again")] * 20 + [("en", f"common u{i} pair v{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    seen = {}
    real = collocations.table

    def spy(df, name):
        out = real(df, name)
        if name.startswith("phrases"):
            seen[name] = out[0].where("run is null").count()
        return out

    monkeypatch.setattr(collocations, "table", spy)
    collocations.mine(docs, collocations.Mining(buckets=1 << 20)).collect()
    assert seen == {"phrases1": 403, "phrases2": 2, "phrases3": 1}


def test_collocations_of_nasty_rows_and_of_none(spark):
    docs = nasty(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    mining = collocations.Mining(buckets=1 << 16)
    assert rows_of(collocations.mine(docs, mining)) == plain_collocations(rows, mining)
    assert collocations.mine(nasty(spark, True), mining).collect() == []


def test_collocation_sql(spark):
    rows = phrase_rows(random.Random(5))
    docs = spark.createDataFrame(rows, "lang string, text string")
    same_as_sql(collocations.mine(docs, collocations.Mining(buckets=1 << 16)), collocations.MINE_SQL, documents=pd.DataFrame(rows, columns=["lang", "text"]))


# License scans -----------------------------------------------------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_scan(text, rules=licences.RULES):
    w = WORDS.findall((text or "").translate(SMALL_AZ))
    spaced, starts = " " + "  ".join(w) + " ", {}
    at = 0
    for i, x in enumerate(w):
        starts[at], at = i, at + len(x) + 2
    spans = []
    for no, r in enumerate(rules):
        if r.keyword in w:
            for m in re.finditer(licences._spaced(r.pattern), spaced):
                first = starts[m.start()]
                spans.append((first, first + len(m.group(1).split("  ")), r.kind, no, r.label, r.base))

    def goes(d):
        for e in spans:
            if e is not d:
                if e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and (e[1] - e[0] > d[1] - d[0] or (e[2], e[3]) < (d[2], d[3])):
                    return True
                if e[0] >= d[0] and e[1] <= d[1] and e[2] < d[2]:
                    return True
        return False

    kept = [d for d in spans if not goes(d)]
    base = [d for d in spans if d[5]]
    labels = sorted({d[4] for d in kept} | {d[4] for d in base}, key=str.encode)
    score = licences.WEIGHTS[min(d[2] for d in kept)] if kept else 0.0
    return (len(w), len(base), min((d[0] for d in base), default=None), max((d[0] for d in base), default=None), ",".join(sorted({d[4] for d in base})), ",".join(labels), score)


LICENSED = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); see the LICENSE file for details.", "MIT License\n\nCopyright (c) 2020", "SPDX-License-Identifier: GPL-3.0-or-later",
    "licensed under CC BY-NC-SA 4.0 and CC-BY", "GNU Lesser General Public License version 2.1 or later; all rights reserved. All Rights Reserved!", "cc by cc by cc, by CC\nBY", "dual licensed under MIT License or Apache 2.0",
    "General public. License general public license", "Creative Commons Attribution-ShareAlike 3.0", "Creative Commons Attribution Share Alike 4.0", "under the license", "under the MIT license, in the public domain", "frégpl gplé CC0 1.0 Universal",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", None, "", " -- ", "ccby by cc by2",
]


def test_licenses_equal_plain_search(spark):
    rng = random.Random(6)
    rows = [(i, t) for i, t in enumerate(LICENSED)]
    pool = [t for t in LICENSED if t]
    rows += [(100 + i, " ".join(rng.choices([*pool, "plain", "words", "Of", "the license"], k=rng.randint(1, 12)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in licences.report(docs).collect()}
    for i, text in rows:
        assert got[i] == plain_scan(text), text
    same_as_sql(licences.report(docs), licences.REPORT_SQL, documents=pd.DataFrame(rows, columns=["doc_id", "text"]))


def test_each_rule_finds_what_it_names_and_holds_its_keyword():
    assert len(licences.RULES) > 300
    for text, label in [("SPDX-License-Identifier: MPL-2.0", "mpl-2.0"), ("Released under the MIT License.", "mit"), ("GPLv2", "gpl-2.0"), ("GNU GPL v3 or later", "gpl-3.0-or-later"), ("BSD 3-Clause License", "bsd-3-clause"), ("Creative Commons Attribution-NonCommercial 2.5", "cc-by-nc-2.5"), ("GNU Affero General Public License", "agpl")]:
        assert label in plain_scan(text)[5].split(","), text


def test_suppression_of_contained_detections(spark):
    docs = spark.createDataFrame([(1, "Licensed under the Apache License, Version 2.0"), (2, "Apache License")], "doc_id long, text string")
    found = {r["doc_id"]: [(d["label"], d["start"], d["end"], d["kept"]) for d in r["detections"]] for r in licences.scan(docs).collect()}
    assert [d for d in found[1] if d[3]] == [("apache-2.0", 0, 8, True)] and ("apache", 3, 5, False) in found[1] and ("licensed", 0, 2, False) in found[1]
    assert [d for d in found[2] if d[3]] == [("apache", 0, 2, True)]


def test_fifty_thousand_detections_in_one_text(spark):
    docs = spark.createDataFrame([(1, "cc by x " * 50_000)], "doc_id long, text string")
    row = licences.report(docs).first()
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"], row["labels"], row["score"]) == (150_000, 50_000, 0, 149_997, "cc-by", "cc-by", 0.8)


def test_license_scans_of_nasty_rows_and_of_none(spark):
    docs = nasty(spark)
    want = sorted(((r["doc_id"], *plain_scan(r["text"])) for r in docs.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows_of(licences.report(docs)) == want
    out = licences.scan(docs)
    assert set(docs.columns) <= set(out.columns) and out.count() == docs.count()
    assert licences.report(nasty(spark, True)).collect() == []


# Ranked search -----------------------------------------------------------------------------------------------------------------

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, top=10):
    terms = [(i, Counter(TERMS.findall((t or "").translate(SMALL_AZ)))) for i, t in docs]
    terms = [(i, c, sum(c.values())) for i, c in terms if c]
    N, L = len(terms), sum(n for *_, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERMS.findall((t or "").translate(SMALL_AZ)))
    out = []
    for item, some in wanted.items():
        ranked = []
        for doc, c, n in terms:
            m = 10 + 90 * n * N // L
            score = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in some if t in c)
            if score > 0:
                ranked.append((-score, doc is not None, doc or 0))
        out += [(item, k + 1, doc if known else None, -s) for k, (s, known, doc) in enumerate(sorted(ranked)[:top])]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_search_equals_plain_ranking(spark):
    rng = random.Random(7)
    vocabulary = [f"t{i}" for i in range(80)] + ["The", "é", "Ünder", "2020"]
    rows = [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", "-", "\n", ", "]) for _ in range(rng.randint(0, 60))) + " the") for i in range(300)]
    rows += [(500 + i, "same words twice same") for i in range(30)] + [(7, "the the")] * 3 + [(900, None), (901, ""), (902, "--")]
    items = [(i, " ".join(rng.choices(vocabulary, k=8))) for i in range(20)] + [(50, "same"), (51, None), (52, "nowhere"), (53, "the"), (50, "twice"), (None, "t1 t2"), (54, "THE the ThE")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_search(rows, items)
    assert rows_of(lexical.search(lexical.index(docs)[0], bench)) == want
    # The same where nothing is broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(lexical.search(lexical.index(docs)[0], bench)) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    unique = [r for r in rows if r[0] != 7]
    known = [i for i in items if i[0] is not None]
    same_as_sql(lexical.search(lexical.index(spark.createDataFrame(unique, "doc_id long, text string"))[0], spark.createDataFrame(known, "item_id long, text string")), lexical.SEARCH_SQL,
                documents=pd.DataFrame(unique, columns=["doc_id", "text"]), benchmark=pd.DataFrame(known, columns=["item_id", "text"]))


def test_index_holds_every_term_of_every_document(spark):
    rows = [(1, "A b a"), (1, "c"), (2, None), (3, "é-É")]
    postings, _ = lexical.index(spark.createDataFrame(rows, "doc_id long, text string"))
    found = postings.collect()
    docs = {r["row"]: (r["doc_id"], r["tf"]) for r in found if r["term"] is None}
    assert sorted(docs.values()) == [(1, 1), (1, 3), (3, 2)] and {r["bucket"] for r in found if r["term"] is None} == {lexical.DOCUMENTS}
    assert sorted((*docs[r["row"]], r["term"], r["tf"]) for r in found if r["term"]) == [(1, 1, "c", 1), (1, 3, "a", 2), (1, 3, "b", 1), (3, 2, "É", 1), (3, 2, "é", 1)]


def test_search_of_nasty_rows_and_of_none(spark):
    docs, bench = nasty(spark), benchmark_of(spark)
    want = plain_search([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert rows_of(lexical.search(lexical.index(docs)[0], bench)) == want
    assert lexical.search(lexical.index(nasty(spark, True))[0], bench).collect() == []
    assert lexical.search(lexical.index(docs)[0], benchmark_of(spark, True)).collect() == []
