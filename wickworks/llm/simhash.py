"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared tile against tile with numpy's exclusive-or and bit counts, every pair of two tiles that can hold a link.
Two fingerprints within the radius differ by at most the radius in their population counts, in total and summed over parts of their
bits; so a tile holds fingerprints with the same population counts of four parts, and tile pairs whose counts differ by more than
the radius are skipped. Equal fingerprints are one row before any comparison, tiles are of bounded size, and of the links between
two tiles only a spanning forest of the nearest is emitted, which loses no component. A tile meets each of its partners in a row of
its own, dealt by the partner, so a crowded count makes more rows and no larger task.

Rows meet their group's id in a join on fingerprint and a salt, so a fingerprint that a third of all rows have is no single task.

fingerprint query: three-word shingles, repeats included, 64 bits, radius 2. Null text is empty; texts without words have fingerprint
zero and link like any other. Each row returns a row, repeated rows included; rows without doc_id take the component of their
fingerprint's other rows, or null.

near_duplicates: the same comparison for a similarity of sets of five-word shingles. Four times as many bits let a radius hold every
pair at or over the similarity: at 0.8 the mean distance is 39 of 256 with a deviation of 6, up to 48 for sets of a few shingles, the
radius is 76, and unrelated texts are at 128 with a deviation of 8. All pairs of two tiles are compared on the first half of the bits
(mean 19 to 24, deviation 4; radius 44), and those that are left on the rest. Tiles are narrow bands of set sizes, of which only those
within the similarity's ratio can hold a pair. The forest only tells which texts hang together by candidates: of each such group all
pairs within the radius are then verified exactly on the shingle sets, again tile against tile, and a forest is made of the links that
passed. Texts with no words are copies of each other. The comparison of a band, and of a group, is quadratic in its distinct texts:
that is the method's price.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm import textbytes as tb
from wickworks.llm.common import NO_ID, connected_components, drop_table, table

SEED = 42
RADIUS = 2
TILE = 2048
#: Pairs compared at a time, and links held before they are cut down to a forest.
STEP_PAIRS, HELD_LINKS = 1 << 17, 1 << 17
#: Bytes of shingle sets in a tile: a share of the group's, within these bounds (a set that is longer is a tile by itself).
SET_BYTES, SET_SHARE = (1 << 17, 1 << 22), 16
#: Shingles whose bits are counted at a time, so that a very long text takes bounded memory.
COUNT_ROWS = 1 << 15

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Near:
    """What counts as a near-duplicate: sets of shingles of so many words, at this similarity or more."""

    words: int = 5
    similarity: float = 0.8
    radius: int = 76
    half_radius: int = 44
    bands: int = 3  # bands of sizes in a ratio of the similarity


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """XXH64 of the text's k-word shingles, in order, repeats included; of the whole sequence if it has fewer words."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([hash64(joined, SEED)], np.uint64)
    return np.array([hash64(joined[a : b - 1], SEED) for a, b in zip(starts, ends[k - 1 :], strict=False)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNT_ROWS):
        part = hashes[i : i + COUNT_ROWS]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little", signed=True)


def fingerprint(text: Column, k: int = 3) -> Column:
    """The 64-bit fingerprint of a text as a signed long."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([majority(shingle_hashes(t.as_py() or "", k)) for t in texts], pa.int64())

    return F.arrow_udf(run, "long")(text)


def sketch(text: Column, k: int) -> Column:
    """Of the set of a text's k-word shingles: digest key, size n, and four fingerprint words w0 to w3."""
    kinds = [("key", pa.int64()), ("n", pa.int64()), *((f"w{i}", pa.int64()) for i in range(4))]

    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            h = np.unique(shingle_hashes(t.as_py() or "", k))
            key = int.from_bytes(xxhash.xxh64_digest(h.tobytes(), SEED), "little", signed=True)
            rows.append((key, len(h), *(majority(tb.mix(h, i)) for i in range(4))))
        cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, kinds, strict=True)], [n for n, _ in kinds])

    return F.arrow_udf(run, "key long, n long, w0 long, w1 long, w2 long, w3 long")(text)


def forest(i: np.ndarray, j: np.ndarray, distance: np.ndarray, n: int) -> list[int]:
    """Places of the links that make a spanning forest of n nodes, nearest first."""
    left = np.argsort(distance, kind="stable")
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out, step = [], 4096
    while len(left):
        for p in left[:step].tolist():
            a, b = root(int(i[p])), root(int(j[p]))
            if a != b:
                up[max(a, b)] = min(a, b)
                out.append(p)
        left = left[step:]
        if len(left):
            roots = np.array([root(x) for x in range(n)])
            left = left[roots[i[left]] != roots[j[left]]]
    return out


def near_pairs(a: list[np.ndarray], b: list[np.ndarray], radius: int, dense: int = 1, dense_radius: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All (place in a, place in b, distance) within the radius, some rows of a at a time; a and b are lists of words of fingerprints.

    The first `dense` words of all pairs are compared, and the others' of the pairs within dense_radius on those.
    """
    step = max(1, STEP_PAIRS // max(1, len(b[0])))
    for at in range(0, len(a[0]), step):
        far = np.bitwise_count(a[0][at : at + step, None] ^ b[0][None, :])
        for x, y in zip(a[1:dense], b[1:dense], strict=True):
            far += np.bitwise_count(x[at : at + step, None] ^ y[None, :])
        i, j = np.divmod(np.flatnonzero(far.ravel() <= (radius if dense_radius is None else dense_radius)), len(b[0]))
        d = far[i, j].astype(np.int64)
        i = i + at
        for x, y in zip(a[dense:], b[dense:], strict=True):
            d = d + np.bitwise_count(x[i] ^ y[j])
        near = d <= radius
        yield i[near], j[near], d[near]


def alike(a: list[np.ndarray], b: list[np.ndarray], similarity: float):
    """A check of pairs (places in a, ascending, and in b) of sets of hashes: whether their similarity is so much or more."""
    vocabulary = np.unique(np.concatenate([*b, np.zeros(0, np.uint64)]))
    ids_b = [np.searchsorted(vocabulary, x) for x in b]
    na, nb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    mark = np.zeros(len(vocabulary), bool)

    def check(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.minimum(na[i], nb[j]) / np.maximum(1, np.maximum(na[i], nb[j])) >= similarity
        at = np.flatnonzero(out)
        for places in np.split(at, np.flatnonzero(np.diff(i[at])) + 1) if len(at) else ():
            x, others = i[places[0]], j[places]
            ids = np.searchsorted(vocabulary, a[x])
            ids = ids[ids < len(vocabulary)]
            ids = ids[np.isin(vocabulary[ids], a[x], assume_unique=True)]
            mark[ids] = True
            starts = np.cumsum(nb[others]) - nb[others]
            both = np.add.reduceat(mark[np.concatenate([ids_b[y] for y in others])], starts, dtype=np.int64)
            mark[ids] = False
            out[places] = both / (na[x] + nb[others] - both) >= similarity
        return out

    return check


def near_forest(a: list[np.ndarray], b: list[np.ndarray], same: bool, *limits, check=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A spanning forest of the nearest of near_pairs' links, of those that pass the check if there is one. Links are cut down to a
    forest whenever HELD_LINKS have gathered, which changes nothing in the end, so a crowd of copies takes no more memory than one
    step's links."""
    n = len(a[0]) + (0 if same else len(b[0]))
    none = np.zeros(0, np.int64)
    parts, size = [], 0

    def reduced() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j, d = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (none, none, none)
        picked = forest(i, j if same else j + len(a[0]), d, n)
        return i[picked], j[picked], d[picked]

    for i, j, d in near_pairs(a, b, *limits):
        if same:
            once = i < j
            i, j, d = i[once], j[once], d[once]
        if check:
            passed = check(i, j)
            i, j, d = i[passed], j[passed], d[passed]
        if len(i):
            parts.append((i, j, d))
            size += len(i)
            if size > HELD_LINKS:
                parts = [reduced()]
                size = len(parts[0][0])
    return reduced()


def _compare(words: int, radius: int, dense: int, dense_radius: int | None, similarity: float | None = None):
    """The tile comparison for mapInArrow: rows (same, a, b) of two tiles to links (src, dst, distance).

    With a similarity tiles have the rows' sets too, and links are those whose sets are as similar as that.
    """

    def lists(col: pa.Array) -> Iterator[tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]]:
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        for x in col:
            v = x.values
            yield np.asarray(v.field("node")), [np.asarray(v.field(f"w{k}")).view(np.uint64) for k in range(words)], [np.frombuffer(s.as_py(), np.uint64) for s in v.field("set")] if similarity else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, dst, far = [], [], []
            for same, (na, a, sets_a), (nb, b, sets_b) in zip(batch.column("same").to_pylist(), lists(batch.column("a")), lists(batch.column("b")), strict=True):
                i, j, d = near_forest(a, b, same, radius, dense, dense_radius, check=alike(sets_a, sets_b, similarity) if similarity else None)
                src.append(na[i])
                dst.append(nb[j])
                far.append(d)
            cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cat(x), pa.int64()) for x in (src, dst, far)], ["src", "dst", "distance"])

    return run


def _offsets(radius: int) -> list[int]:
    """Steps between codes of four counts, in base 64, whose differences sum to the radius or less; zero and those above it."""
    span = range(-radius, radius + 1)
    steps = ((a, b, c, d) for a in span for b in span for c in span for d in span if abs(a) + abs(b) + abs(c) + abs(d) <= radius)
    codes = sorted(((a * 64 + b) * 64 + c) * 64 + d for a, b, c, d in steps)
    return [x for x in codes if x >= 0]


def links(nodes: DataFrame, words: int, radius: int, cell: Column, offsets: list[int], dense: int = 1, dense_radius: int | None = None) -> DataFrame:
    """(src, dst, distance): a spanning forest of each tile pair's links between the distinct rows (node, w0, ...) of nodes.

    cell is an integer of a small range (its distinct values are broadcast: 17^4 counts or some dozens of bands), and a row can only
    link to rows whose cell is its own plus one of the offsets, or that less one of them.
    """
    nodes = nodes.withColumn("cell", cell.cast("long"))
    sizes, sizes_at = table(nodes.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("parts")), "cells")
    fields = F.struct("node", *[f"w{k}" for k in range(words)])
    tiles = nodes.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    tiles, tiles_at = table(tiles.groupBy("cell", "part").agg(F.collect_list(fields).alias("tile")), "tiles")
    left = tiles.select(F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), F.col("tile").alias("a"), F.explode(F.array(*[F.lit(x) for x in offsets]).cast("array<long>")).alias("step"))
    left = left.withColumn("cell", F.col("cell_a") + F.col("step")).join(F.broadcast(sizes), "cell")
    left = left.select("cell", "cell_a", "part_a", "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).where("cell > cell_a or part >= part_a")
    pairs = left.join(tiles.select("cell", "part", F.col("tile").alias("b")), ["cell", "part"]).select((F.col("cell") == F.col("cell_a")).__and__(F.col("part") == F.col("part_a")).alias("same"), "a", "b")
    out, _ = table(pairs.mapInArrow(_compare(words, radius, dense, dense_radius), "src long, dst long, distance long"), "forest")
    drop_table(nodes.sparkSession, tiles_at)
    drop_table(nodes.sparkSession, sizes_at)
    return out


#: Tasks that the rows of one fingerprint or set are dealt to.
SALTS = 64


def _attach(rows: DataFrame, to: DataFrame, key: str) -> DataFrame:
    """rows (key, salt) with their key's columns of to (key, salts: those that its rows have): a key with very many rows is dealt to SALTS tasks."""
    to, _ = table(to.withColumn("salt", F.explode("salts")).drop("salts"), "members")
    return rows.join(to, [key, "salt"])


def _salt() -> Column:
    return F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")


def components(docs: DataFrame, k: int = 3, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row."""
    prints, _ = table(docs.select("doc_id", fingerprint(F.col("text"), k).alias("fp"), _salt().alias("salt")), "prints")
    reps, reps_at = table(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.collect_set("salt").alias("salts")), "reps")
    nodes = reps.select(F.col("fp").alias("node"), F.col("fp").alias("w0"))
    quarter = lambda i: F.bit_count(F.shiftrightunsigned("w0", 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long")))
    cell = ((quarter(3) * 64 + quarter(2)) * 64 + quarter(1)) * 64 + quarter(0)
    linked = connected_components(links(nodes, 1, radius, cell, _offsets(radius)), "simhash")
    least = reps.join(linked, reps.fp == linked.node).groupBy("component").agg(F.min("least").alias("joint"))
    joint = linked.join(least, "component").select(F.col("node").alias("fp"), "joint")
    found = _attach(prints, reps.join(joint, "fp", "left").select("fp", "salts", F.coalesce("joint", "least").alias("component_id")), "fp")
    drop_table(docs.sparkSession, reps_at)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _sets(k: int):
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique(shingle_hashes(t.as_py() or "", k)).tobytes() for t in texts], pa.binary())

    return F.arrow_udf(run, "binary")


def verified(found: DataFrame, reps: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """(src, dst, distance): a forest of the links at or over the similarity between the reps (key, n, w0 to w3) that found's
    candidate links (src, dst) join, directly or by others. sets has the (key, set) of all ends of found's links."""
    words = [f"w{i}" for i in range(4)]
    groups = connected_components(found, "candidates").withColumnsRenamed({"node": "key", "component": "group"})
    members, members_at = table(groups.join(reps.select("key", "n", *words), "key"), "candidates")
    size = F.sum("n") * 8
    sizes, sizes_at = table(members.groupBy("group").agg(F.ceil(size / F.greatest(F.lit(SET_BYTES[0]), F.least(F.lit(SET_BYTES[1]), size / SET_SHARE))).cast("int").alias("parts")), "groups")
    dealt = members.join(sizes, "group").withColumn("part", F.pmod(F.xxhash64("key"), F.greatest(F.col("parts"), F.lit(1))).cast("int"))
    dealt, dealt_at = table(dealt, "dealt")  # so that the join above can split a large group
    rows = F.struct(F.col("key").alias("node"), *words, "set")
    tiles, tiles_at = table(dealt.join(sets, "key").groupBy("group", "part").agg(F.first("parts").alias("parts"), F.collect_list(rows).alias("tile")), "set-tiles")
    left = tiles.select("group", F.col("part").alias("part_a"), F.col("tile").alias("a"), F.explode(F.sequence(F.col("part"), F.greatest(F.col("parts") - 1, F.col("part")))).alias("part"))
    pairs = left.join(tiles.select("group", "part", F.col("tile").alias("b")), ["group", "part"]).select((F.col("part") == F.col("part_a")).alias("same"), "a", "b")
    out, _ = table(pairs.mapInArrow(_compare(4, near.radius, 2, near.half_radius, near.similarity), "src long, dst long, distance long"), "verified")
    for at in (members_at, sizes_at, dealt_at, tiles_at):
        drop_table(found.sparkSession, at)
    return out


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """Of every row its identity (id, a missing one as NO_ID, and text_hash) and the group's first row's (first_id, first_hash)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.col("text"))
    sketches, _ = table(rows.select("id", "text_hash", sketch(F.col("text"), near.words).alias("s"), _salt().alias("salt")).select("id", "text_hash", "s.*", "salt"), "sketches")
    words = [f"w{i}" for i in range(4)]
    reps, reps_at = table(sketches.groupBy("key").agg(F.min(F.struct("id", "text_hash")).alias("first"), F.first("n").alias("n"), F.collect_set("salt").alias("salts"), *[F.first(w).alias(w) for w in words]), "reps")
    band = F.floor(F.log(F.greatest("n", F.lit(1))) / -np.log(near.similarity) * near.bands)
    found, found_at = table(links(reps.select(F.col("key").alias("node"), "n", *words), 4, near.radius, band, list(range(near.bands + 1)), 2, near.half_radius).select("src", "dst").distinct(), "links")
    ends = found.select(F.col("src").alias("key")).union(found.select("dst")).distinct().join(reps, "key").select("key", "first.*")
    sets = rows.join(ends, ["id", "text_hash"]).groupBy("key").agg(F.min("text").alias("text")).select("key", _sets(near.words)(F.col("text")).alias("set"))
    sets, sets_at = table(sets, "sets")
    linked = connected_components(verified(found, reps, sets, near).select("src", "dst"), "near")
    drop_table(spark, sets_at)
    drop_table(spark, found_at)
    joined = reps.join(linked, reps.key == linked.node, "left").select("key", "first", "salts", F.coalesce("component", "key").alias("component"))
    firsts = joined.groupBy("component").agg(F.min("first").alias("group_first"))
    to = joined.join(firsts, "component").select("key", "salts", F.col("group_first.id").alias("first_id"), F.col("group_first.text_hash").alias("first_hash"))
    out = _attach(sketches.select("id", "text_hash", "key", "salt"), to, "key")
    drop_table(spark, reps_at)
    return out.select("id", "text_hash", "first_id", "first_hash")


def keep_one(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """The rows of docs that come first in their group of near-duplicates, with their own columns. Of rows that share id and text
    one stays, whatever their other columns (a missing id or text is one of its own kind)."""
    members, _ = table(near_duplicates(docs, near), "members")
    later = members.where("id <> first_id or text_hash <> first_hash").select("id", "text_hash").distinct()
    keyed = docs.select(F.struct("*").alias("row")).select("row", F.coalesce("row.doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("text_hash"))
    kept = keyed.join(later, ["id", "text_hash"], "left_anti")
    if not members.groupBy("id", "text_hash").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "text_hash"])
    return kept.select("row.*")
