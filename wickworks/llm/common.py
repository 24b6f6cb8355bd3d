"""Shared plumbing: sessions' shared folder, tables that cut lineage, connected components, row keys."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a missing id where ids are compared: after every real one.
NO_ID = 9223372036854775807


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or, where that is unset and all runs on this machine (tests), one made here."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="wickworks-shared-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes df as Parquet in the shared folder and reads it again: lineage ends there and a lost executor loses nothing."""
    path = f"{shared_folder(df.sparkSession)}/wickworks-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Removes what table() wrote."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, remainder 2 of 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bounded_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int = 1 << 28) -> tuple[pa.Array, list]:
    """Whole texts and labels of at most max_rows documents: those with a label, first by a hash of the id, the least label of several.

    Of these the texts come up to max_bytes in that order; a text that doesn't fit is left out whole. Only ids are sorted and cut; the
    texts come by a join with those ids, which max_rows bounds, so they are broadcast.
    """
    spark = docs.sparkSession
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__ww_id")).agg(F.min(label).alias("__ww_label"))
    ids = ids.orderBy(F.xxhash64("__ww_id"), "__ww_id").limit(max_rows)
    found = docs.select(F.col("doc_id").alias("__ww_id"), F.col("text").alias("__ww_text")).where(F.col("__ww_text").isNotNull()).join(F.broadcast(ids), "__ww_id")
    found, at = table(found.groupBy("__ww_id", "__ww_label").agg(F.min("__ww_text").alias("__ww_text")), "sample")
    room, left = max_bytes, []
    for r in sorted(found.select("__ww_id", F.xxhash64("__ww_id").alias("h"), F.octet_length("__ww_text").alias("size")).collect(), key=lambda r: (r["h"], r["__ww_id"])):
        if r["size"] <= room:
            room -= r["size"]
        else:
            left.append(r["__ww_id"])
    chosen = (found.where(~F.col("__ww_id").isin(left)) if left else found).toArrow().sort_by("__ww_id")
    drop_table(spark, at)
    return chosen["__ww_text"].combine_chunks(), chosen["__ww_label"].to_pylist()


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Components of an undirected graph: (src long, dst long) to (node, component = its smallest node).

    Labels start at the smallest neighbour. In each round a node offers its label and its neighbours' to itself and to its own
    label's node (so that whole trees hook on at once), then jumps to its label's label. Labels only fall, so their sum stands
    still when all is done. Every step is a partial aggregate or a join on node, and each round is written out.
    """
    spark = edges.sparkSession
    both = edges.select(F.col("src").cast("long"), F.col("dst").cast("long")).where("src <> dst")
    both, both_at = table(both.union(both.select(F.col("dst"), F.col("src"))).distinct(), f"{name}-edges")
    first = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("least"))
    labels, at = table(first.select("node", F.least("node", "least").alias("label")), f"{name}-labels")

    def weight(df: DataFrame):
        return df.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]

    before = weight(labels)
    while before is not None:
        seen = both.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("offer"))
        now = labels.join(seen, "node").select("node", "label", F.least("label", "offer").alias("offer"))
        hooked = now.select("node", "offer").union(now.select(F.col("label"), F.col("offer"))).groupBy("node").agg(F.min("offer").alias("up"))
        parents = hooked.select(F.col("node").alias("up"), F.col("up").alias("label"))
        after, after_at = table(hooked.join(parents, "up").select("node", "label"), f"{name}-labels")
        drop_table(spark, at)
        labels, at = after, after_at
        then, before = before, weight(labels)
        if then == before:
            break
    drop_table(spark, both_at)
    return labels.select("node", F.col("label").alias("component"))
