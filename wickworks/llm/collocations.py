"""Phrase collocations: frequent phrases of each language by hashed bucket counts and Apriori pruning, scored exactly.

Pass k over the texts counts the phrases of k words exactly and, at the same time, the phrases of k + 1 words in hash buckets. A phrase
of k words is counted only if its bucket reached the support in the pass before (direct hashing and pruning) and both phrases of k - 1
words in it were frequent (Apriori). Both tests read bitmaps of `buckets` bits, which is all that is broadcast, however large the corpus:
bits that several phrases share let more phrases be counted, never fewer, and the exact counts decide. Nothing is pruned that is frequent.

Within a task numpy counts blocks of about 256 kB of text by a 64-bit hash of language and phrase (phrases of one task that share all 64
bits would be counted as one); distinct phrases are put out whenever more than `held` are waiting. Bucket counts leave a task once, as the
filled buckets of each run of 65,536, cut off at the support, and are summed run by run as they stream by. Spark sums the exact counts by
language and phrase, joins each cut's parts by a salted key, and ranks within salts before it ranks within a language.

Texts lower-case A-Z only and are split at .,;:!? and line ends into pieces; words are parted by blanks and tabs. Null texts are empty and
count for nothing; a null lang is `und`. Repeated rows count as often as they stand. Other columns play no part. A text is handled whole
in its task, with some hundred bytes of arrays for each of its bytes. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickworks.llm.common import drop_table, table
from wickworks.llm.textbytes import blocks, pair, runs, spans_hash, texts_of


@dataclass(frozen=True)
class Mining:
    longest: int = 3
    support: int = 10
    inside: int = 50  # a phrase goes if a longer one has this share of its count, in hundredths
    top: int = 2000
    buckets: int = 1 << 25  # a power of 2, 65,536 at least
    held: int = 1 << 19
    salts: int = 8
    rank_salts: int = 256


RUN = 1 << 16
SLICE, BLOCK = 512, 1 << 18  # rows and bytes looked at together
PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~PIECE_END
WORD[[0x20, 0x09]] = False
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32
SCHEMA = "lang string, phrase string, n long, run int, at binary, counts binary"
_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64()), ("run", pa.int32()), ("at", pa.binary()), ("counts", pa.binary())])


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of bytes as strings."""
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    picked = data[np.repeat(starts - at[:-1], ends - starts) + np.arange(at[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(picked)])


def _lang_hash(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")


def _keys(words: np.ndarray, salts: np.ndarray, longest: int) -> list[np.ndarray]:
    """By length, the key of the phrase of that many words that starts at each place."""
    keys = [pair(words, salts)]
    for size in range(1, longest):
        keys.append(pair(keys[-1][:-1], words[size:], size))
    return keys


class _Waiting:
    """Counts of distinct phrases of a task: merged when many wait, put out when many are distinct. langs are numbers of names."""

    def __init__(self, held: int):
        self.held, self.parts, self.size, self.names = held, [], 0, {}

    def add(self, keys, counts, langs, phrases) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, counts, langs, phrases.cast(pa.string())))
        self.size += len(keys)
        if self.size > self.held:
            self.merge()
            if self.size > self.held // 2:
                yield from self.out()

    def merge(self) -> None:
        keys, counts, langs = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1, 2))
        phrases = pa.chunked_array([p[3] for p in self.parts])
        self.parts = []
        kinds, first, of = np.unique(keys, return_index=True, return_inverse=True)
        counts = np.bincount(of, weights=counts, minlength=len(kinds)).astype(np.int64)
        self.parts, self.size = [(kinds, counts, langs[first], phrases.take(first).combine_chunks())], len(kinds)

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self.merge()
            (keys, counts, langs, phrases), self.parts, self.size = self.parts[0], [], 0
            names = pa.array(list(self.names), pa.string())
            for i in range(0, len(keys), 50_000):
                part = slice(i, i + 50_000)
                n = len(keys[part])
                yield pa.RecordBatch.from_arrays([names.take(pa.array(langs[part])), phrases[part], pa.array(counts[part]), *(pa.nulls(n, f.type) for f in list(_ARROW)[3:])], schema=_ARROW)


def _sparse(totals: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The filled buckets of each run: their places in it, and their counts."""
    for run in range(len(totals) // RUN):
        counts = totals[run * RUN : (run + 1) * RUN]
        at = np.flatnonzero(counts)
        if len(at):
            row = [None, None, None, run, at.astype(np.uint16).tobytes(), counts[at].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)


def _counter(k: int, mining: Mining, filters):
    """Pass k as a function of Arrow batches; filters are the broadcast bitmaps (buckets of k, frequent of k - 1)."""
    mask = np.uint64(mining.buckets - 1)
    kind = np.uint8 if mining.support < 256 else np.uint32

    def passes(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
        at = (keys & mask).astype(np.int64)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def count(batches):
        next_totals = np.zeros(mining.buckets, kind) if k < mining.longest else None
        hashed, common = filters.value if filters is not None else (None, None)
        waiting, lang_hashes = _Waiting(mining.held), {}
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            langs = batch.column("lang").dictionary_encode()
            numbers = np.array([waiting.names.setdefault(v, len(waiting.names)) for v in langs.dictionary.to_pylist()], np.int32)
            salts = np.array([lang_hashes.setdefault(v, _lang_hash(v)) for v in langs.dictionary.to_pylist()], np.uint64)
            lang_of = langs.indices.to_numpy()
            for row, data, offsets in blocks(batch.column("text"), BLOCK):
                data = SMALL[data]
                starts, ends = runs(WORD[data], offsets)
                if not len(starts):
                    continue
                of = texts_of(offsets, starts)
                piece = np.cumsum(PIECE_END[data])[starts]
                joined = (piece[1:] == piece[:-1]) & (of[1:] == of[:-1])
                words = spans_hash(data, starts, ends)
                keys = _keys(words, salts[lang_of[row + of]], min(k + 1, mining.longest))
                fits = [np.ones(len(words), bool)]
                for size in range(1, len(keys)):
                    fits.append(fits[-1][:-1] & joined[size - 1 :])
                here = fits[k - 1]
                if k > 1:
                    shorter = passes(keys[k - 2], common)
                    here = here & shorter[:-1] & shorter[1:] & passes(keys[k - 1], hashed)
                at = np.flatnonzero(here)
                if len(at):
                    kinds, first, n = np.unique(keys[k - 1][at], return_index=True, return_counts=True)
                    first = at[first]
                    phrase = pc.binary_join_element_wise(*(_gather(data, starts[first + i], ends[first + i]) for i in range(k)), pa.scalar(" ", pa.large_string()))
                    yield from waiting.add(kinds, n, numbers[lang_of[row + of[first]]], phrase)
                if next_totals is not None:
                    longer = fits[k] & here[:-1] & here[1:]
                    buckets, n = np.unique((keys[k][longer] & mask).astype(np.int64), return_counts=True)
                    next_totals[buckets] = np.minimum(next_totals[buckets].astype(np.int64) + n, mining.support)
        yield from waiting.out()
        if next_totals is not None:
            yield from _sparse(next_totals)

    return count


def _full_buckets(mining: Mining):
    """Sums the counts of each run, which come in order, and puts out its bitmap."""
    kind = np.uint8 if mining.support < 256 else np.uint32

    def bitmap(run: int, totals: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"run": pa.array([run], pa.int32()), "bits": pa.array([np.packbits(totals >= mining.support, bitorder="little").tobytes()], pa.binary())})

    def add(batches):
        run, totals = None, None
        for batch in batches:
            for r, at, counts in zip(batch.column("run").to_pylist(), batch.column("at"), batch.column("counts")):
                if r != run:
                    if run is not None:
                        yield bitmap(run, totals)
                    run, totals = r, np.zeros(RUN, np.int64)
                totals[np.frombuffer(at.as_buffer(), np.uint16)] += np.frombuffer(counts.as_buffer(), kind)
        if run is not None:
            yield bitmap(run, totals)

    return add


def _hashed_bitmap(raw: DataFrame, mining: Mining) -> np.ndarray:
    """The bitmap of the buckets that reach the support."""
    counts = raw.where("run is not null").select("run", "at", "counts").repartition("run").sortWithinPartitions("run")
    bits = np.zeros(mining.buckets // 8, np.uint8)
    for r in counts.mapInArrow(_full_buckets(mining), "run int, bits binary").collect():  # buckets / 8 bytes in all
        bits[r["run"] * RUN // 8 : (r["run"] + 1) * RUN // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _bucket_of(k: int, mining: Mining):
    """The bucket of each (lang, phrase of k words), as a pass counts it."""

    def hashed(batches):
        for batch in batches:
            salts = np.array([_lang_hash(v) for v in batch.column("lang").to_pylist()], np.uint64)
            for row, data, offsets in blocks(batch.column("phrase")):
                starts, ends = runs(WORD[data], offsets)
                words, of = spans_hash(data, starts, ends), texts_of(offsets, starts)
                first = np.searchsorted(of, np.arange(len(offsets) - 1))
                buckets = _keys(words, salts[row + of], k)[k - 1][first] & np.uint64(mining.buckets - 1)
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(buckets.astype(np.int32))})

    return hashed


def _common_bitmap(frequent: DataFrame, k: int, mining: Mining) -> np.ndarray:
    """The bitmap of the buckets that hold a frequent phrase of k words."""
    cells = frequent.select("lang", "phrase").mapInArrow(_bucket_of(k, mining), "bucket int").groupBy(F.floor(F.col("bucket") / 64).cast("int").alias("cell")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bucket") % 64)).alias("bits"))
    found, bits = cells.toArrow(), np.zeros(mining.buckets // 64, np.int64)  # buckets / 64 cells at most
    bits[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return bits.view(np.uint8)


def frequent(docs: DataFrame, mining: Mining = Mining()) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, a) of every phrase of 1 to `longest` words with a >= support, and (lang, n) of all words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).where("text <> ''")
    out, words, filters = [], None, None
    for k in range(1, mining.longest + 1):
        raw, at = table(texts.mapInArrow(_counter(k, mining, filters), SCHEMA), f"phrases{k}")
        if filters is not None:
            filters.unpersist()
        counted = raw.where("run is null").groupBy("lang", "phrase").agg(F.sum("n").alias("a"))
        common, _ = table(counted.where(F.col("a") >= mining.support), f"frequent{k}")
        if k == 1:
            words, _ = table(raw.where("run is null").groupBy("lang").agg(F.sum("n").alias("n")), "words")
        if k < mining.longest:
            filters = spark.sparkContext.broadcast((_hashed_bitmap(raw, mining), _common_bitmap(common, k, mining)))
        drop_table(spark, at)
        out.append(common.select("lang", F.lit(k).alias("size"), "phrase", "a"))
    phrases = out[0]
    for more in out[1:]:
        phrases = phrases.union(more)
    return phrases, words


def mine(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """The first `top` collocations of each language: lang, rank, phrase, a, l, r, n and score."""
    phrases, words = frequent(docs, mining)
    candidates = phrases.where("size > 1")
    part = lambda first, n: F.array_join(F.slice(F.split("phrase", " "), first, n), " ")
    # Both parts of every cut, with their counts: a word may be a part of very many phrases, so its key has a salt.
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", part(F.lit(1), F.col("cut"))).withColumn("right", part(F.col("cut") + 1, F.col("size") - F.col("cut")))
    copies = F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(mining.salts - 1))).otherwise(F.array(F.lit(0)))
    parts = phrases.where(F.col("size") < mining.longest).withColumn("salt", F.explode(copies))
    for side, count, words_in in (("left", "l", F.col("cut")), ("right", "r", F.col("size") - F.col("cut"))):
        cuts = cuts.withColumn("salt", F.when(words_in == 1, F.pmod(F.xxhash64("phrase"), F.lit(mining.salts)).cast("int")).otherwise(0))
        cuts = cuts.join(parts.select("lang", "salt", F.col("phrase").alias(side), F.col("a").alias(count)), ["lang", "salt", side])
    # Products of two counts, times a million, are within 38 digits up to counts of 10^16; the quotient is a million at most.
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    cuts = cuts.withColumn("score", F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")).cast("decimal(31,0)"), wide("l") * wide("r")))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("least")).select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    # A phrase goes whose words lie inside a longer one that is nearly as frequent.
    spots = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: part(i, n))))
    inner = candidates.where("size > 2").select("lang", F.explode(spots).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = scored.join(inner, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < mining.inside * F.col("a"), F.lit(True)))
    # The first of a language are among the first of each of its salts.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    left = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(mining.rank_salts)))
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= mining.top)
    top = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= mining.top)
    return top.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: mine() with its default settings in DuckDB SQL.
MINE_SQL = r"""
WITH pieces_ AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words_ AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces_),
grams_ AS (SELECT lang, 1 AS size, unnest(w) AS phrase FROM words_
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words_ WHERE len(w) > 1
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words_ WHERE len(w) > 2),
counts_ AS (SELECT lang, size, phrase, count(*) AS a FROM grams_ GROUP BY ALL),
all_ AS (SELECT lang, sum(a)::BIGINT AS n FROM counts_ WHERE size = 1 GROUP BY lang),
cand_ AS (SELECT *, string_split(phrase, ' ') AS w FROM counts_ WHERE size > 1 AND a >= 10),
cuts_ AS (SELECT lang, phrase, a, 1 AS cut, w[1] AS lp, CASE WHEN size = 2 THEN w[2] ELSE w[2] || ' ' || w[3] END AS rp FROM cand_
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM cand_ WHERE size = 3),
valued_ AS (SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts_ c JOIN counts_ l ON l.lang = c.lang AND l.phrase = c.lp JOIN counts_ r ON r.lang = c.lang AND r.phrase = c.rp),
least_ AS (SELECT * FROM valued_ QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM cand_ WHERE size = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand_ WHERE size = 3),
longer_ AS (SELECT lang, phrase, max(a) AS longer FROM inner_ GROUP BY lang, phrase),
kept_ AS (SELECT s.* FROM least_ s LEFT JOIN longer_ i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a),
ranked_ AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept_)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked_ r JOIN all_ t ON t.lang = r.lang WHERE r.rank <= 2000
"""
