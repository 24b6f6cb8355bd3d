"""Benchmark decontamination in DataFrame operations only: item-sized windows, SimHash, Hamming blocks, exact similarity.

Texts are words in small letters without ASCII punctuation, and shingles are five words (a shorter item is one shingle). A window of a
document is as long as an item, or what is left of the document from there, and the similarity is the sum of the smaller over the sum
of the larger counts of all shingles. Every window counts; those that can't reach the similarity are ruled out first:

* A document's hits are the places whose shingle some item of that length has. A window that starts where there is no hit is never
  more similar to an item than the one that starts a place later, so windows start at hits.
* At a similarity s, a window of n shingles shares at least s (m + n) / (1 + s) with an item of m, so it has so many hits: of
  equal sizes and 0.8, 8 of 9. Which windows do is read off the sorted places of the hits.

What is left is mostly passages of items, and equal ones, from however many documents, are one window from then on. The window's SimHash
is made of its hits: other shingles can only take it away from an item. It meets the fingerprints of the items of its length by
blocks: of radius + 1 blocks of bits, two fingerprints within the radius have one equal. As so few bits select little, a block counts
together with one of the first shingles in the order of their hashes: two sets that share c of m and n have a shingle in common
among the first m - c + 1 and n - c + 1. So the join on (length, shingle, block, bits) finds every pair within the radius that can be
similar, and those are verified exactly. At 0.8 the distance of 64 bits is 10 to 12 on average with a deviation of 3; the radius is over
five deviations further.

The items' shingles are broadcast in blocks of at most block_shingles, each block against all documents; all that follows depends on
the hits. Null and empty texts and items match nothing. Rows repeated whole count once; a missing doc_id stays missing. Other columns
pass as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm.common import NO_ID, drop_table, table


@dataclass(frozen=True)
class Match:
    words: int = 5
    similarity: float = 0.8
    radius: int = 28
    block_shingles: int = 1_000_000


PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words(text: Column) -> Column:
    """Words in small letters without ASCII punctuation."""
    blank = " \t\n\x0b\f\r"
    return F.split(F.btrim(F.lower(F.translate(text, PUNCTUATION, "")), F.lit(blank)), "[ \\t\\n\\x0B\\f\\r]+")


def shingles(w: Column, k: int) -> Column:
    """XXH64 of each k words in a row."""
    return F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k)))


PLANES = 12


def simhash(hashes: Column) -> Column:
    """The 64 bits set in over half the hashes.

    The 64 counts are kept at once in binary, a long for each binary digit: adding a hash is a ripple of exclusive-or and and, and the
    comparison with half the number of hashes goes digit by digit from the highest. Arrays too long for the digits are counted bit by bit.
    """
    zero, ones = F.lit(0).cast("long"), F.lit(-1).cast("long")

    def add(acc: Column, h: Column) -> Column:
        carry, out = h, []
        for i in range(PLANES):
            out.append(acc[f"p{i}"].bitwiseXOR(carry).alias(f"p{i}"))
            carry = acc[f"p{i}"].bitwiseAND(carry)
        return F.struct(*out)

    def over_half(acc: Column) -> Column:
        more, same = zero, ones
        for i in reversed(range(PLANES)):
            half = F.when(F.floor(F.size(hashes) / 2).cast("long").bitwiseAND(F.lit(1 << i).cast("long")) != 0, ones).otherwise(zero)
            plane = acc[f"p{i}"]
            more, same = more.bitwiseOR(same.bitwiseAND(plane).bitwiseAND(F.bitwise_not(half))), same.bitwiseAND(F.bitwise_not(plane.bitwiseXOR(half)))
        return more

    planes = F.aggregate(hashes, F.struct(*[zero.alias(f"p{i}") for i in range(PLANES)]), add)
    # Bound to a lambda's variable, the digits are made once.
    short = F.transform(F.array(planes), over_half)[0]
    bit = lambda b: F.size(F.filter(hashes, lambda h: F.call_function("getbit", h, b) == 1)) * 2 > F.size(hashes)
    long = F.aggregate(F.sequence(F.lit(0), F.lit(63)), zero, lambda acc, b: F.when(bit(b), acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))).otherwise(acc))
    return F.when(F.size(hashes) < (1 << PLANES), short).otherwise(long)


def blocks(fp: Column, radius: int) -> Column:
    """(block, bits) of each of radius + 1 blocks of the fingerprint."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("bits")) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))])


def counted(hashes: Column) -> Column:
    """The array sorted, with the second and later occurrences of an element made elements of their own, so that none is twice.

    How many equal elements stand before one is found by halving steps, so a long array takes n log n.
    """
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(30))])

    def before(s: Column, x: Column, i: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda r, step: F.when(F.get(s, i - r - step) == x, r + step).otherwise(r))

    again = lambda s: F.transform(s, lambda x, i: F.transform(F.array(before(s, x, i)), lambda r: F.when(r == 0, x).otherwise(F.xxhash64(x, r.cast("long") + 1)))[0])
    ordered = F.transform(F.array(F.array_sort(hashes)), lambda s: F.array_sort(again(s)))[0]
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.array_sort(hashes)).otherwise(ordered)


def least_shared(m: Column, n: Column, m_: Match) -> Column:
    """Shingles that m and n must have in common for the similarity."""
    return F.ceil(m_.similarity * (m + n) / (1 + m_.similarity) - 1e-9).cast("int")


def _hits(docs: DataFrame, own: DataFrame, k: int, m: Match) -> DataFrame:
    """(id, text_hash, n: the document's shingles, size, hits: array of (i, h) by place) of documents with a shingle of items of a size."""
    vocabulary = own.select("size", F.explode("shingles").alias("h")).distinct()
    parts = max(1, -(-vocabulary.count() // m.block_shingles))
    at = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    at = at.select("id", "text_hash", "w", F.explode(F.when(F.size("w") >= k, F.sequence(F.lit(0), F.size("w") - k))).alias("i"))
    at = at.select("id", "text_hash", (F.size("w") - (k - 1)).alias("n"), "i", F.xxhash64(F.array(*[F.col("w")[F.col("i") + j] for j in range(k)])).alias("h"))
    seen = None
    for b in range(parts):
        part = vocabulary if parts == 1 else vocabulary.where(F.pmod(F.xxhash64("h"), F.lit(parts)) == b)
        part = part.groupBy("h").agg(F.collect_list("size").alias("sizes"))
        some = at.join(F.broadcast(part), "h").select("id", "text_hash", "n", F.explode("sizes").alias("size"), "i", "h")
        seen = some if seen is None else seen.union(some)
    return seen.groupBy("id", "text_hash", "n", "size").agg(F.array_sort(F.collect_set(F.struct("i", "h"))).alias("hits"))


def _windows(hits: DataFrame, k: int, m: Match) -> DataFrame:
    """(id, text_hash, size, n: the window's shingles, held: those that are hits, counted) of windows with enough hits."""
    of_item = F.col("size") - (k - 1)

    def start(x: Column, j: Column) -> Column:
        n = F.least(of_item, F.col("n") - x["i"])
        return F.struct(x["i"].alias("i"), j.alias("j"), n.alias("n"), least_shared(of_item, n, m).alias("least"))

    last = lambda x: F.get("hits", x["j"] + x["least"] - 1)["i"]
    starts = F.filter(F.transform("hits", start), lambda x: last(x) < x["i"] + x["n"])
    found = hits.select("id", "text_hash", "size", "hits", F.explode(starts).alias("s"))
    inside = F.filter(F.slice("hits", F.col("s.j") + 1, F.col("s.n")), lambda y: y["i"] < F.col("s.i") + F.col("s.n"))
    return found.select("id", "text_hash", "size", F.col("s.n").alias("n"), F.transform(inside, lambda y: y["h"]).alias("held"))


def matches(docs: DataFrame, benchmark: DataFrame, m: Match = Match()) -> DataFrame:
    """(id, text_hash, item_id, similarity) of each document and item that it has a window of, with the best window's similarity."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("item_id is not null and w[0] <> ''").withColumn("size", F.size("w"))
    items = items.withColumn("k", F.least("size", F.lit(m.words)))
    found = None
    for k in [x["k"] for x in items.select("k").distinct().sort("k").collect()]:
        own = items.where(F.col("k") == k).withColumn("shingles", shingles(F.col("w"), k)).withColumn("item", F.xxhash64("item_id", "w"))
        own, own_at = table(own.select("item", "item_id", "size", "shingles", counted(F.col("shingles")).alias("item_held"), simhash(F.col("shingles")).alias("item_fp")).dropDuplicates(["item"]), "items")
        of_item = F.size("item_held")
        each = _windows(_hits(docs, own, k, m), k, m)
        each = each.withColumn("window", F.xxhash64("size", "n", F.array_sort("held")))
        each, each_at = table(each, "windows")
        once = each.groupBy("window").agg(F.first("size").alias("size"), F.first("n").alias("n"), F.first("held").alias("held"))
        once, once_at = table(once.select("window", "size", "n", counted(F.col("held")).alias("held"), simhash(F.col("held")).alias("fp")), "distinct-windows")
        enough = least_shared(F.col("size") - (k - 1), F.col("n"), m)
        left = once.select("window", "size", "fp", F.explode(F.slice("held", F.lit(1), F.size("held") - enough + 1)).alias("first"))
        right = own.select("item", "size", "item_fp", F.explode(F.slice("item_held", F.lit(1), of_item - F.ceil(m.similarity * of_item - 1e-9).cast("int") + 1)).alias("first"))
        left, right = left.select("*", F.inline(blocks(F.col("fp"), m.radius))), right.select("*", F.inline(blocks(F.col("item_fp"), m.radius)))
        near = left.join(right, ["size", "first", "block", "bits"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= m.radius).select("window", "item").distinct()
        both = F.size(F.array_intersect("held", "item_held"))
        sure = near.join(once.select("window", "n", "held"), "window").join(own.select("item", "item_id", "item_held"), "item").select("window", "item_id", (both / (F.col("n") + of_item - both)).alias("similarity"))
        sure, sure_at = table(sure.where(F.col("similarity") >= m.similarity), "similar")  # so that the join below can split a window that very many documents have
        best, _ = table(each.select("id", "text_hash", "window").join(sure, "window").groupBy("id", "text_hash", "item_id").agg(F.max("similarity").alias("similarity")), "matches")
        found = best if found is None else found.union(best)
        for made in (own_at, each_at, once_at, sure_at):
            drop_table(spark, made)
    if found is None:
        return spark.createDataFrame([], "id long, text_hash long, item_id long, similarity double")
    return found.groupBy("id", "text_hash", "item_id").agg(F.max("similarity").alias("similarity"))


def report(docs: DataFrame, benchmark: DataFrame, m: Match = Match()) -> DataFrame:
    """(doc_id, item_id, similarity) of each contaminated document and item."""
    found = matches(docs, benchmark, m).groupBy("id", "item_id").agg(F.max("similarity").alias("similarity"))
    return found.select(F.nullif(F.col("id"), F.lit(NO_ID)).alias("doc_id"), "item_id", F.round("similarity", 6).alias("similarity"))


def keep(docs: DataFrame, benchmark: DataFrame, m: Match = Match()) -> DataFrame:
    """The rows of docs that hold no window of an item, with their own columns."""
    found, _ = table(matches(docs, benchmark, m).select("id", "text_hash").distinct(), "contaminated")
    keyed = docs.select(F.struct("*").alias("row")).select("row", F.coalesce("row.doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("row.text").alias("text_hash"))
    return keyed.join(found, ["id", "text_hash"], "left_anti").select("row.*")


#: report() in DuckDB SQL by brute force over every window of every document. A window with fewer places that hold a shingle of an item of
#: its size than the similarity takes is left out before its shingles are counted.
REPORT_SQL = r"""
WITH clean_ AS (SELECT 'd' AS side, doc_id AS id, text FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL UNION ALL SELECT 'b', item_id, text FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
words_ AS (SELECT side, id, regexp_split_to_array(trim(lower(regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g')), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[ \t\n\x0B\f\r]+') AS w FROM clean_),
items_ AS (SELECT id AS item_id, w, len(w) AS size, least(len(w), 5) AS k FROM words_ WHERE side = 'b' AND w[1] <> ''),
shingled_ AS (SELECT *, list_transform(range(1, size - k + 2), lambda i: list_aggregate(w[i:i + k - 1], 'string_agg', ' ')) AS shingles FROM items_),
vocabulary_ AS (SELECT DISTINCT k, size, unnest(shingles) AS s FROM shingled_),
docs_ AS (SELECT row_number() OVER () AS d, * FROM (SELECT DISTINCT id AS doc_id, w, k FROM words_, (SELECT DISTINCT k FROM items_) WHERE side = 'd' AND len(w) >= k)),
at_ AS (SELECT d, k, i, list_aggregate(w[i + 1:i + k], 'string_agg', ' ') AS s FROM (SELECT d, w, k, unnest(range(len(w) - k + 1)) AS i FROM docs_)),
hits_ AS (SELECT a.d, v.size, a.i FROM at_ a JOIN vocabulary_ v ON a.k = v.k AND a.s = v.s),
starts_ AS (SELECT h.d, h.size, x.k, x.w, least(h.size, len(x.w)) - x.k + 1 AS most, unnest(range(len(x.w) - x.k + 1)) AS i FROM (SELECT DISTINCT d, size FROM hits_) h JOIN docs_ x ON h.d = x.d),
seen_ AS (SELECT s.d, s.size, s.k, s.i, sum(CASE WHEN h.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY s.d, s.size ORDER BY s.i ROWS BETWEEN CURRENT ROW AND most - 1 FOLLOWING) AS hits FROM starts_ s LEFT JOIN hits_ h ON s.d = h.d AND s.size = h.size AND s.i = h.i),
windows_ AS (SELECT x.doc_id, s.k, s.size, x.w[s.i + 1:s.i + s.size] AS v FROM seen_ s JOIN docs_ x ON s.d = x.d WHERE 1.8 * s.hits >= 0.8 * ((s.size - s.k + 1) + least(s.size - s.k + 1, len(x.w) - s.k + 1 - s.i)) - 1e-6),
wide_ AS (SELECT *, list_transform(range(1, len(v) - k + 2), lambda i: list_aggregate(v[i:i + k - 1], 'string_agg', ' ')) AS shingles FROM windows_),
both_ AS (SELECT x.doc_id, y.item_id, len(x.shingles) + len(y.shingles) AS total, list_sum(list_transform(list_distinct(x.shingles), lambda s: least(len(list_filter(x.shingles, lambda q: q = s)), len(list_filter(y.shingles, lambda q: q = s))))) AS common FROM wide_ x JOIN shingled_ y ON x.size = y.size AND x.k = y.k)
SELECT doc_id, item_id, round(max(common / (total - common)), 6) AS similarity FROM both_ WHERE common >= 0.8 * (total - common) GROUP BY doc_id, item_id
"""
