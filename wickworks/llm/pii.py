"""Personal data: fixed base patterns, then bootstrapped contextual extraction, in DataFrame operations only.

Base kinds are email, ip, card and phone, leftmost and non-overlapping for each; matches that fail their check are dropped. The base
patterns are written with possessive repeats and start where a run starts or the last match ended, which finds the same matches in
linear time and without deep recursion on very long texts.

Bootstrapping: words with a digit or an at sign are instances, and so are runs of up to eight words of short digit groups, which may be
joined by hyphens or set in brackets and are parted by single blanks, as phones and cards are written. Their contexts are lexical
patterns: the two words before, and the word before with the word after, whole words of any length, where another instance counts as
the word 0. Instances in base spans are seeds. In each round a pattern's score is the mean score of its distinct instances, if enough of
them are good, and an instance's is the noisy-or of its patterns' damped scores; seeds stay at 1. Patterns with a high score in the end
find identifiers that no base pattern matched, of the kind that most of their seeds have (of equal scores the greater name). Scores come
from grouped sums over distinct (pattern, instance) edges of all documents, so copies of a document add nothing.

A text's matches are placed by running totals in as many passes as their number has binary digits, so the cost follows their number.
Null text is empty and has no spans. Offsets are code points, ends exclusive. Every row returns a row, repeated rows included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm.common import NO_ID, drop_table, table

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be worth a search.
_HINT = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){11}", "phone": "\\+[0-9]"}
_IP = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"
_S, _W = " \\t-\\r", "[^ \\t-\\r]"
_GROUP = r"[(+]{0,2}+[0-9]{1,6}+(?:[()-]{1,2}+[0-9]{1,6}+)*+\)?+"
_LAST = "[.,;:!?\"'\\]}>]*+"
#: A run of words of digit groups, or a word with a digit or an at sign.
INSTANCE = rf"(?<!{_W})(?:{_GROUP}(?: {_GROUP}(?={_LAST}(?:[{_S}]|$))){{1,7}}+{_LAST}|[^{_S}0-9@]*+[0-9@]{_W}*+)"
MARKS = ".,;:!?()[]{}\"'<>#*$%&|"


@dataclass(frozen=True)
class Bootstrap:
    rounds: int = 3
    least_seeds: int = 3  # distinct good instances that a pattern needs
    good: float = 0.5
    damping: float = 0.9
    confident: float = 0.8
    least_chars: int = 5


def _running(values: Column, add) -> Column:
    """Running totals of an array of numbers of 0 or more, by steps of 1, 2, 4 and so on."""
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int") - 1), lambda i: F.call_function("shiftleft", F.lit(1), i))
    moved = lambda acc, by: F.concat(F.array_repeat(F.lit(0), by), F.slice(acc, F.lit(1), F.size(acc) - by))
    return F.when(F.size(values) > 1, F.aggregate(steps, values, lambda acc, by: F.zip_with(acc, moved(acc, by), add))).otherwise(values)


def _bound(value: Column, use) -> Column:
    """use(value) with the value made once, however often it is read."""
    return F.transform(F.array(value), use)[0]


def _spans(text: Column, pattern: str) -> Column:
    """(start, end, value, left, right) of each match: left and right are the texts between it and the matches beside it."""
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern).alias("pieces"))

    def placed(p: Column) -> Column:
        def at(ends: Column) -> Column:
            return F.transform(p["hits"], lambda h, i: F.struct((F.get(ends, i) - F.length(h)).alias("start"), F.get(ends, i).alias("end"), h.alias("value"), F.get(p["pieces"], i).alias("left"), F.get(p["pieces"], i + 1).alias("right")))

        lengths = F.zip_with(p["hits"], p["pieces"], lambda h, x: F.coalesce(F.length(h), F.lit(0)) + F.length(x))
        return _bound(_running(lengths, lambda x, y: x + y), at)

    return _bound(parts, placed)


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _of_kind(order: int, kind: str):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("ord"), x["end"].alias("end"), F.lit(kind).alias("kind"))


def _is_kind(kind: str):
    return lambda x: x["kind"] == kind


def base_spans(text: Column) -> Column:
    """(start, ord, end, kind) of all base matches that pass their check, by start, then kind as listed."""
    kind_type = "array<struct<start:int,ord:int,end:int,kind:string>>"
    parts = []
    for order, kind in enumerate(KINDS):
        found = _spans(text, PATTERNS[kind])
        digits = F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), F.regexp_replace(x["value"], "[^0-9]", "").alias("digits")))
        if kind == "ip":
            found = F.filter(found, lambda x: x["value"].rlike(_IP))
        elif kind == "card":
            found = F.filter(digits, lambda x: F.when(F.length(x["digits"]).between(12, 19), _luhn(x["digits"])).otherwise(False))
        elif kind == "phone":
            found = F.filter(digits, lambda x: F.length(x["digits"]).between(9, 15))
        found = F.transform(found, _of_kind(order, kind))
        parts.append(F.when(text.rlike(_HINT[kind]), found).otherwise(F.array()).cast(kind_type))
    return F.array_sort(F.concat(*parts))


def _word(text: Column) -> Column:
    return F.lower(F.btrim(text, F.lit(MARKS)))


def _instances(text: Column, base: Column) -> Column:
    """struct(base, instances): each instance has start, end, value, kind (of a base span that it touches) and patterns."""
    found = F.when(text.rlike("[0-9@]"), _spans(text, INSTANCE)).otherwise(F.array()).cast("array<struct<start:int,end:int,value:string,left:string,right:string>>")

    def one(s: Column, x: Column, i: Column) -> Column:
        marks = F.when(x["value"].rlike(r"^\([0-9]+\)[ 0-9-]"), MARKS.replace("(", "")).otherwise(MARKS)
        bare = F.rtrim(F.ltrim(x["value"], marks), F.lit(MARKS))
        start = x["start"] + F.length(x["value"]) - F.length(F.ltrim(x["value"], marks))
        # Base spans are sorted by start: the first that starts at or after the instance, and whether one before it reaches into it.
        seed = F.get(s["base"], F.get(s["before"], i))
        seed = F.when(seed["start"] < x["end"], seed)
        into = F.coalesce(F.get(s["reach"], F.get(s["before"], i) - 1) > x["start"], F.lit(False))
        ahead = F.reverse(F.concat(F.when(i > 0, "0").otherwise(""), x["left"]))
        before = F.reverse(F.regexp_extract(ahead, rf"^[{_S}]++({_W}++)", 1))
        two = F.reverse(F.regexp_extract(ahead, rf"^[{_S}]++{_W}++[{_S}]++({_W}++)", 1))
        after = F.regexp_extract(F.concat(x["right"], F.when(i + 1 < F.size(s["found"]), "0").otherwise("")), rf"^[{_S}]++({_W}++)", 1)
        first = F.when((before != "") & (two != ""), F.concat(F.lit("2:"), _word(two), F.lit(" "), _word(before)))
        second = F.when((before != "") & (after != "") & F.coalesce(seed["end"] <= x["end"], F.lit(True)), F.concat(F.lit("1:"), _word(before), F.lit(" _ "), _word(after)))
        whole = F.substr(s["text"], seed["start"] + 1, seed["end"] - seed["start"])
        value = F.when(into, "").when(seed["start"].isNull(), bare).otherwise(whole)  # a span's later words are no instances
        kind = F.when(into, F.get(s["base"], F.get(s["before"], i) - 1)["kind"]).otherwise(seed["kind"])
        return F.struct(start.alias("start"), (start + F.length(bare)).alias("end"), F.lower(value).alias("value"), kind.alias("kind"), F.array_compact(F.array(first, second)).alias("patterns"))

    def placed(s: Column) -> Column:
        """With the number of base spans that start before each instance, and how far the spans up to each reach."""
        marks = F.concat(F.transform(s["base"], lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("span"))), F.transform(s["found"], lambda x: F.struct(x["start"].alias("at"), F.lit(0).alias("span"))))
        before = F.transform(F.filter(F.transform(F.array_sort(marks), lambda m, i: F.struct(m["span"].alias("span"), i.alias("i"))), lambda m: m["span"] == 0), lambda m, j: m["i"] - j)
        reach = _running(F.transform(s["base"], lambda b: b["end"]), lambda x, y: F.greatest(x, y))
        return F.struct(s["base"].alias("base"), s["found"].alias("found"), s["text"].alias("text"), before.alias("before"), reach.alias("reach"))

    both = _bound(F.struct(base.alias("base"), found.alias("found"), text.alias("text")), placed)
    return _bound(both, lambda s: F.struct(s["base"].alias("base"), F.transform(s["found"], lambda x, i: one(s, x, i)).alias("instances")))


def confident_patterns(instances: DataFrame, b: Bootstrap = Bootstrap()) -> DataFrame:
    """(pattern, score, kind) with a high score, from rows (value, kind, patterns) of all documents."""
    spark = instances.sparkSession
    edges = instances.select("value", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    edges, edges_at = table(edges, "edges")
    seeds = edges.groupBy("value").agg(F.max("kind").alias("kind")).where("kind is not null").select("value", F.lit(1.0).alias("score"), "kind")
    scores, old = seeds, []
    for i in range(b.rounds):
        by_kind = edges.select("pattern", "value").join(scores, "value", "left").groupBy("pattern", "kind").agg(F.count("*").alias("n"), F.sum(F.coalesce("score", F.lit(0.0))).alias("score"), F.count_if(F.col("score") >= b.good).alias("goods"))
        patterns = by_kind.groupBy("pattern").agg(F.sum("n").alias("n"), F.sum("score").alias("total"), F.sum("goods").alias("goods"), F.max(F.when(F.col("kind").isNotNull(), F.struct("score", "kind"))).alias("best"))
        patterns = patterns.where(F.col("goods") >= b.least_seeds).select("pattern", (F.col("total") / F.col("n")).alias("score"), F.col("best.kind").alias("kind"))
        patterns, at = table(patterns, "patterns")
        if i + 1 < b.rounds:
            miss = F.sum(F.log(1 - b.damping * F.col("score")))
            guessed = edges.select("pattern", "value").join(patterns, "pattern").groupBy("value").agg((1 - F.exp(miss)).alias("score"), F.max(F.struct("score", "kind")).alias("best"))
            guessed = guessed.select("value", "score", F.col("best.kind").alias("kind")).join(seeds.select("value"), "value", "left_anti")
            scores, scores_at = table(seeds.union(guessed), "scores")
            old.append(scores_at)
            old.append(at)
    for x in (*old, edges_at):
        drop_table(spark, x)
    return patterns.where(F.col("score") >= b.confident)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def find(docs: DataFrame, b: Bootstrap = Bootstrap()) -> DataFrame:
    """doc_id, the counts of base spans by kind, base_sha256 and all spans of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("text_hash"), _instances(text, base_spans(text)).alias("found"))
    rows, _ = table(rows.select("doc_id", "id", "text_hash", "found.*"), "spans")
    each = rows.where(F.size("instances") > 0).select("id", "text_hash", F.inline("instances")).where((F.length("value") >= b.least_chars) & F.col("value").rlike("[0-9@]"))
    patterns = confident_patterns(each.select("value", "kind", "patterns"), b)
    free = each.where("kind is null").select("id", "text_hash", "start", "end", F.explode("patterns").alias("pattern")).join(patterns, "pattern")
    free = free.groupBy("id", "text_hash", "start", "end").agg(F.max(F.struct("score", "kind")).alias("best"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("best.kind")).cast("int") - 1
    added = free.groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", order.alias("ord"), "end", F.col("best.kind").alias("kind"))).alias("added"))
    out = rows.select("doc_id", "id", "text_hash", "base").join(added, ["id", "text_hash"], "left")
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>"))))
    counts = [F.size(F.filter("base", _is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"))
