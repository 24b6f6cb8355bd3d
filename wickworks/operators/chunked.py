"""Features of long histories in parallel: time chunks with a halo of earlier rows, and recursions carried over chunk summaries.

compute() gives a (series, segment) to one task. Here a chunk of chunk_rows steps is the unit instead. Gaps are found inside chunks and,
between them, from one summary row a chunk; the last HALO rows of a chunk are handed to the next as history, which covers the longest
window; and a recursion is smoothed inside each chunk from zero, its carry coming from the summaries of the chunks before, one number a
chunk and scan. Joins with summaries are by chunk, and what they join is written out once. Only summaries, chunk_rows times fewer than candles, are ever brought together by series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickworks.functions import catalogue as cat
from wickworks.functions import smoothing
from wickworks.operators import features, segments
from wickworks.sinks import scratch

#: Rows of history that any fixed window, and any return or lag in it, reaches back.
HALO = 176
CHUNK, OWN = "__chunk", "__own"


def indexed(candles: DataFrame, keys: Sequence[str], step_ms: int, chunk_rows: int) -> DataFrame:
    """Adds the chunk, gap, segment_id, the row's index in its segment and its __place in the series, without a window over a whole series."""
    df = candles.withColumn(CHUNK, F.floor(F.col("end_ms") / (step_ms * chunk_rows)))
    inside = Window.partitionBy(*keys, CHUNK).orderBy("end_ms")
    df = df.withColumns({"__n": F.row_number().over(inside).cast("long") - 1, "__jump": F.coalesce(F.col("end_ms") - F.lag("end_ms").over(inside) != step_ms, F.lit(False))})
    df = df.withColumn("__jumps", F.sum(F.col("__jump").cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("__since", F.last(F.when(F.col("__jump"), F.col("__n")), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))

    chunks = df.groupBy(*keys, CHUNK).agg(F.min("end_ms").alias("__lo"), F.max("end_ms").alias("__hi"), F.count("*").alias("__rows"), F.max("__jumps").alias("__inner"), F.max("__since").alias("__last"))
    series = Window.partitionBy(*keys).orderBy(CHUNK)
    chunks = chunks.withColumn("__starts", F.coalesce(F.col("__lo") - F.lag("__hi").over(series) != step_ms, F.lit(False)))
    # Rows of the open segment at a chunk's end: all rows since the last start, be it in this chunk or at one before.
    closed = F.when(F.col("__last").isNotNull(), F.col("__rows") - F.col("__last"))
    chunks = chunks.withColumns({"__total": F.coalesce(F.sum("__rows").over(series.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "__closed": closed})
    first_row = F.when(F.col("__last").isNotNull(), F.col("__total") + F.col("__last")).when(F.col("__starts"), F.col("__total"))
    chunks = chunks.withColumn("__opened", F.coalesce(F.last(first_row, ignorenulls=True).over(series.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    chunks = chunks.withColumns({
        "__carried": F.when(F.col("__starts"), 0).otherwise(F.col("__total") - F.col("__opened")),
        "__before": F.coalesce(F.sum(F.col("__inner") + F.col("__starts").cast("long")).over(series.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("__starts").cast("long"),
    })
    df = df.join(chunks.select(*keys, CHUNK, "__carried", "__before", "__starts", "__total"), [*keys, CHUNK])
    return df.withColumns({
        "__place": F.col("__total") + F.col("__n"),
        "gap": F.col("__jump") | (F.col("__starts") & (F.col("__n") == 0)),
        "segment_id": F.col("__before") + F.col("__jumps"),
        features.ROW: F.when(F.col("__since").isNull(), F.col("__carried") + F.col("__n")).otherwise(F.col("__n") - F.col("__since")),
    }).drop("__n", "__jump", "__jumps", "__since", "__carried", "__before", "__starts", "__total")


def _smooth(keys: Sequence[str], within: Sequence[str] = ("segment_id",)):
    def run(df: DataFrame, scans: Sequence[smoothing.Scan], partition: Sequence[str], row: str, order: str) -> DataFrame:
        """Inside each chunk over its own rows from zero, then the carry of the chunks before. within tells apart what is seeded by itself."""
        segment, partition = [*keys, *within], list(dict.fromkeys([*partition, *within]))
        df = scratch.table(df, "chunks")  # each join below would make its input again
        # A seed's rows can lie in two chunks: sums by chunk, then by segment, of own rows only.
        sums = df.where(OWN).groupBy(*segment, CHUNK).agg(*[F.sum(F.when(F.col(row).between(s.start, s.seed_row), F.col(s.x))).alias(f"__sum_{s.out}") for s in scans])
        seeds = sums.select(*segment, CHUNK, *[(F.sum(f"__sum_{s.out}").over(Window.partitionBy(*segment)) / s.period).alias(f"__seed_{s.out}") for s in scans])
        df = _joined(df, seeds, [*segment, CHUNK])
        own = Window.partitionBy(*partition).orderBy("end_ms")
        df = df.withColumn("__pos", F.sum(F.col(OWN).cast("long")).over(own.rowsBetween(Window.unboundedPreceding, 0)) - 1)
        df = smoothing.smooth(df, scans, partition, row, order, at="__pos", live=F.col(OWN), seeded=True)
        df = scratch.table(df, "smoothed")
        ends = df.where(OWN).groupBy(*segment, CHUNK).agg(F.count("*").alias("__len"), *[F.max_by(s.out, "end_ms").alias(f"__end_{s.out}") for s in scans])
        before = Window.partitionBy(*segment).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)

        def carried(s: smoothing.Scan):
            parts = F.collect_list(F.struct(F.coalesce(f"__end_{s.out}", F.lit(0.0)).alias("e"), F.col("__len").alias("n"))).over(before)
            return F.aggregate(parts, F.lit(0.0), lambda acc, x: x["e"] + F.pow(F.lit(1 - s.alpha), x["n"]) * acc)

        carry = ends.select(*segment, CHUNK, *[carried(s).alias(f"__carry_{s.out}") for s in scans])
        df = _joined(df, carry, [*segment, CHUNK])
        full = {s.out: F.when(F.col(row) >= s.seed_row, F.col(s.out) + F.pow(F.lit(1 - s.alpha), F.col("__pos") + 1) * F.col(f"__carry_{s.out}")) for s in scans}
        return df.withColumns(full).drop("__pos", *[f"__{x}_{s.out}" for s in scans for x in ("carry", "seed")])

    return run


def _joined(df: DataFrame, found: DataFrame, by: Sequence[str]) -> DataFrame:
    """df with what was found for each of its groups; rows before a first run have a null in by, and keep their place."""
    renamed = found.select(*[F.col(c).alias(f"__j_{c}") for c in by], *[c for c in found.columns if c not in by])
    on = [F.col(c).eqNullSafe(F.col(f"__j_{c}")) for c in by]
    return df.join(renamed, on, "left").drop(*[f"__j_{c}" for c in by])


def smooth_runs(keys: Sequence[str]):
    """As _smooth(), for columns with breaks: a run goes on over chunks, and is seeded once."""

    def run(df: DataFrame, scans: Sequence[smoothing.Scan], partition: Sequence[str], row: str, order: str) -> DataFrame:
        segment = [*keys, "segment_id"]

        def starts(d: DataFrame, x: str) -> DataFrame:
            d = scratch.table(smoothing.run_starts(d, x, partition, row, order, F.col(OWN)), "runs")
            last = d.where(OWN).groupBy(*segment, CHUNK).agg(F.max(f"__run_{x}").alias("__last"))
            before = last.select(*segment, CHUNK, F.max("__last").over(Window.partitionBy(*segment).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)).alias("__before"))
            return _joined(d, before, [*segment, CHUNK]).withColumn(f"__run_{x}", F.coalesce(f"__run_{x}", "__before")).drop("__before")

        return smoothing.each_column(df, scans, row, starts, lambda d, mine, start, at: _smooth(keys, ("segment_id", start))(d, mine, partition, at, order))

    return run


def ranked(rows: DataFrame, keys: Sequence[str], chunk_rows: int) -> DataFrame:
    """The rows policy's view of indexed rows: one segment a series, the row's index in the series, and chunks of chunk_rows rows."""
    return rows.withColumns({features.ROW: F.col("__place"), "segment_id": F.lit(0).cast("long"), CHUNK: F.floor(F.col("__place") / chunk_rows)})


def split(candles: DataFrame, keys: Sequence[str], step_ms: int, policy: str = "reset", chunk_rows: int = 16_384) -> DataFrame:
    """Rows in chunks, each with a copy of its last HALO rows in the chunk after it (OWN is false for those).

    reset: chunks of time, segments end at gaps. rows: chunks of rows, numbered over a series by sums of its time chunks' counts, so that
    the halo is HALO observed rows however far apart.
    """
    if chunk_rows <= HALO:
        raise ValueError(f"a chunk must be longer than its halo of {HALO} rows")
    if policy not in segments.POLICIES:
        raise ValueError(f"gap policy must be one of {segments.POLICIES}")
    rows = indexed(candles, keys, step_ms, chunk_rows)
    if policy == "rows":
        rows = ranked(rows, keys, chunk_rows)
        place = F.pmod(F.col(features.ROW), F.lit(chunk_rows))
    else:
        place = F.pmod(F.floor(F.col("end_ms") / step_ms), F.lit(chunk_rows))
    both = F.when(place >= chunk_rows - HALO, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.drop("__place").withColumn("__ahead", F.explode(both)).withColumns({CHUNK: F.col(CHUNK) + F.col("__ahead"), OWN: F.col("__ahead") == 0}).drop("__ahead")


def compute(candles: DataFrame, keys: Sequence[str], step_ms: int, names: Sequence[str] = cat.NAMES, chunk_rows: int = 16_384, policy: str = "reset", reseed: bool = False) -> DataFrame:
    """features.compute() under either gap policy, with equal results, for histories too long for a task."""
    rows = split(candles, keys, step_ms, policy, chunk_rows)
    return features.compute_over(rows, keys, [*keys, "segment_id", CHUNK], names, (smooth_runs if reseed else _smooth)(keys), keep=F.col(OWN))


def smoothed(candles: DataFrame, scans: Sequence[smoothing.Scan], keys: Sequence[str], step_ms: int, chunk_rows: int = 16_384, policy: str = "reset") -> DataFrame:
    """candles with each scan's column, seeded anew after each break, in chunks."""
    rows = split(candles, keys, step_ms, policy, chunk_rows)
    return smooth_runs(keys)(rows, scans, [*keys, "segment_id", CHUNK], features.ROW, "end_ms").where(OWN).drop(OWN, CHUNK)
