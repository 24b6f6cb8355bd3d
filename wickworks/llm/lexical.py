"""Ranked lexical search: an index of postings dealt by term, and integer scores of a set of items against all its documents.

index() makes a posting of each distinct term of each document, (bucket, term, row, tf), and a row without a term of each document, with its
doc_id and, as tf, its number of terms; row tells apart documents that share a doc_id. All are written partitioned by term bucket, a hash of
the term (documents' rows in one of their own), so a search reads only the buckets that its terms fall into; a bucket with a term that a third of all documents hold is split over tasks (rebalanced).

search() joins the items' terms with the postings and scores each match in 64-bit integers. Scored postings are then dealt by document, so
that a document's matches with all items are summed where they meet, by (item, document), and each item's first documents are picked by
row_number within the item. Spark broadcasts the items' terms only if their size, which it knows as they are a written table, is under
its threshold, and else joins by shuffles; the results are the same.

Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, only A-Z lower-cased. Null and empty texts and items
have no terms; documents without a term aren't in the index and do not count. Rows repeated whole, and rows that share a doc_id, are
documents by themselves, ranked one after the other. Benchmark rows that share an item_id, a null one included, are one item. Other
columns play no part. A text is handled whole in its task. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickworks.llm.collocations import SMALL, _gather
from wickworks.llm.common import shared_folder, table
from wickworks.llm.textbytes import blocks, pair, runs, spans_hash, texts_of

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Ranking:
    top: int = 10
    buckets: int = 64
    k1_1000: int = 1000  # weight of tf in a match's saturation
    norm_base: int = 10
    norm_length: int = 90


POSTING = "term string, row long, tf long, doc_id long"
_ARROW = pa.schema([("term", pa.string()), ("row", pa.int64()), ("tf", pa.int64()), ("doc_id", pa.int64())])
#: The bucket of documents' own rows.
DOCUMENTS = -1


def _postings(batches):
    """Distinct terms of each row with their counts, and for each row that has any one without a term, with its id and number of terms."""
    row, part = 0, TaskContext.get().partitionId() << 33
    for batch in batches:
        ids = batch.column("doc_id")
        for first, data, offsets in blocks(batch.column("text")):
            data = SMALL[data]
            starts, ends = runs(TERM[data], offsets)
            of = texts_of(offsets, starts)
            keys = pair(spans_hash(data, starts, ends), of.astype(np.uint64))
            kinds, at, tf = np.unique(keys, return_index=True, return_counts=True)
            order = np.argsort(at)
            at, tf = at[order], tf[order].astype(np.int64)
            terms, rows = _gather(data, starts[at], ends[at]), of[at] + (first + row + part)
            for i in range(0, len(at), 50_000):
                cut = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays([terms[cut].cast(pa.string()), pa.array(rows[cut]), pa.array(tf[cut]), pa.nulls(len(rows[cut]), pa.int64())], schema=_ARROW)
            n = np.bincount(of, minlength=len(offsets) - 1)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.string()), pa.array(some + (first + row + part)), pa.array(n[some].astype(np.int64)), ids.take(pa.array(some + first))], schema=_ARROW)
        row += batch.num_rows


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.array_distinct(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")), "")


def bucket(term: Column, ranking: Ranking) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(ranking.buckets)).cast("int")


def index(docs: DataFrame, ranking: Ranking = Ranking()) -> tuple[DataFrame, str]:
    """All postings and documents' rows, written by bucket, and where they lie."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where("text <> ''")
    found = texts.mapInArrow(_postings, POSTING).withColumn("bucket", F.coalesce(F.when(F.col("term").isNotNull(), bucket(F.col("term"), ranking)), F.lit(DOCUMENTS)))
    path = f"{shared_folder(spark)}/wickworks-postings-{uuid.uuid4().hex}"
    found.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    return spark.read.schema(found.schema).parquet(path), path


def search(postings: DataFrame, items: DataFrame, ranking: Ranking = Ranking()) -> DataFrame:
    """item_id, rank, doc_id and score of each item's first documents."""
    documents = postings.where(F.col("bucket") == DOCUMENTS).select("row", F.col("doc_id"), F.col("tf").alias("n"))
    N, L = documents.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    wanted, _ = table(items.select("item_id", F.explode(terms(F.col("text"))).alias("term")).distinct(), "items")
    some = wanted.select("term").distinct()
    buckets = [r[0] for r in some.select(bucket(F.col("term"), ranking).alias("b")).distinct().collect()]  # ranking.buckets at most
    hits = postings.where(F.col("bucket").isin(buckets)).select("term", "row", "tf").join(some, "term", "left_semi")
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    weights, _ = table(df.withColumn("w", F.floor(1000 * F.ln(F.lit(float(2 * N + 2)) / (2 * F.col("df") + 1))).cast("long")).where("w > 0").select("term", "w"), "weights")
    # 90 * n * N can pass 64 bits for a very long text among very many: then it is a decimal.
    most, per = (1 << 62) // max(ranking.norm_length * N, 1), ranking.norm_length
    share = f"CASE WHEN n <= {most}L THEN ({per}L * n * {N}L) div {max(L, 1)}L ELSE (cast({per}L * n AS decimal(20,0)) * cast({N}L AS decimal(18,0))) div cast({max(L, 1)}L AS decimal(20,0)) END"
    sizes = documents.select("row", "doc_id", (F.lit(ranking.norm_base) + F.expr(share)).alias("m"))
    # A document's matches meet once, narrow; all joins and sums after that leave them where they are.
    scored = hits.repartition("row").join(weights, "term").join(sizes, "row")
    scored = scored.select("row", "doc_id", "term", F.expr(f"w * ((1000000000L * tf) div ({ranking.k1_1000}L * tf + 8L * m))").alias("s"))
    sums = scored.join(wanted, "term").groupBy("item_id", "row").agg(F.first("doc_id").alias("doc_id"), F.sum("s").alias("score")).where("score > 0")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id"), F.asc("row"))
    return sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranking.top).select("item_id", "rank", "doc_id", "score")


#: search() over the index of all documents in DuckDB SQL.
SEARCH_SQL = r"""
WITH terms_ AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes_ AS (SELECT doc_id, len(w)::BIGINT AS n FROM terms_ WHERE len(w) > 0),
totals_ AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sizes_),
post_ AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS term FROM terms_) GROUP BY doc_id, term),
wanted_ AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
df_ AS (SELECT term, count(*)::BIGINT AS df FROM post_ GROUP BY term),
w_ AS (SELECT d.term, floor(1000 * ln((2 * t.docs + 2)::DOUBLE / (2 * d.df + 1)::DOUBLE))::BIGINT AS w FROM df_ d, totals_ t),
sums_ AS (SELECT q.item_id, p.doc_id, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * s.n * t.docs) // t.words))))::BIGINT AS score
  FROM wanted_ q JOIN post_ p ON p.term = q.term JOIN w_ w ON w.term = q.term JOIN sizes_ s ON s.doc_id = p.doc_id, totals_ t GROUP BY q.item_id, p.doc_id),
ranked_ AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sums_ WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked_ WHERE rank <= 10
"""
