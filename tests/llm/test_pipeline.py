"""The pipeline: stages on small and odd tables, against brute force where a stage can be done by hand."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import WORD, benchmark_of, counts_by_hand, lower, nasty, prose, shingles


@pytest.fixture
def corpus(spark, tmp_path):
    """Clean texts, copies, near copies, junk, a leak and a line that recurs, as a folder of tables."""
    rng = random.Random(17)
    item = prose(rng, 30)
    clean = [prose(rng, 120) + "\n" + prose(rng, 40) for _ in range(12)]
    near = clean[0].split(" ")
    near[50] = "changed"
    line = prose(rng, 15)
    rows = list(enumerate(clean))
    rows += [(20, clean[1]), (21, " ".join(near)), (22, "WORD!! " * 60), (23, prose(rng, 5)), (24, prose(rng, 60) + " " + item + " " + prose(rng, 30)), (25, prose(rng, 90) + "\n" + line), (26, prose(rng, 90) + "\n" + line), (27, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), dict(rows), line, item


def test_stages_take_effect(spark, corpus):
    folder, texts, line, item = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{folder}/out/{name.replace(' ', '_')}")
        docs = spark.read.parquet(f"{folder}/out/{name.replace(' ', '_')}")
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    first = seen["quality rules"]
    assert {22, 23, 27} & set(first) == set() and set(range(12)) | {20, 21, 24, 25, 26} == set(first)
    for d in first:
        c = counts_by_hand(texts[d])
        assert c[0] >= 20 and 100 * c[4] <= 30 * c[0]
    lines = seen["line dedup"]
    assert set(lines) == set(first) and line in lines[25]["text"] and line not in lines[26]["text"] and lines[20]["text"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values()) and lines[5]["text"] == texts[5]
    one = seen["SimHash near-dedup"]
    sets = {d: set(shingles(r["text"], 5)) for d, r in lines.items()}
    gone = {d for d in lines if any(e < d and len(sets[d] & sets[e]) >= 0.8 * len(sets[d] | sets[e]) for e in lines)}
    assert set(one) == set(lines) - gone
    rest = seen["benchmark decontamination"]
    assert set(one) - set(rest) == {24}
    final = seen["BPE encoding and decoding"]
    assert set(final) == set(rest) and all(final[d]["n_tokens"] == len(final[d]["ids"]) for d in final)
    assert corpus_pipeline.run(spark, folder).count() == len(final)


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_tables(spark, tmp_path, empty):
    benchmark_of(spark, empty).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = nasty(spark, empty)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert out.count() <= docs.count()
        if i < 4:
            assert out.columns == docs.columns


def test_near_copies_go_and_clean_texts_stay(spark):
    rng = random.Random(23)
    base = prose(rng, 300).split(" ")
    copy = list(base)
    for i in (40, 150, 260):
        copy[i] = "other"
    other = prose(rng, 300)
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(copy)), (3, lower(" ".join(base)).upper()), (4, other)], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {1, 4}
    assert len(WORD.findall(other)) == 300
