"""Line dedup by a log-template tree of fixed depth, in DataFrame operations only.

A line's tokens are its words; tokens with a digit count as <*>. The tree's levels are the number of tokens and the leading tokens;
a leaf's template has, at each further place, the token that most of the leaf's distinct lines have there (of equal counts the
greatest token), and generalises the rest. Lines that agree with it at enough of those places are one template. Lines of at least
`general` tokens take part in this; shorter ones generalise tokens with digits only.

A leaf can hold further templates. Its lines that the first one leaves are dealt by the blocks of places that they have in common:
two lines that agree at enough places share a block, as there are more blocks than places to differ at. Blocks that the same lines
share are one. Each block's lines have their own commonest tokens, a line that agrees with several blocks' goes where most lines
agree, and leaves where that found a template are looked through again until none is found; then lines are templates by themselves.
A line is in as many blocks as it shares, up to 0.3 x places + 1, which grows with the leaf until all are shared. In each of them only
`probe` of its places are compared, the same ones of all lines of a leaf. Lines with fewer places are compared whole that way. Longer
ones that agree there, or fall short by three deviations of such a sample at most, go to the block where most do, and are compared
whole with the lines that went there too. So what is compared grows with the length of a line, not with its square. Further templates
are made of 64-bit hashes of tokens, of equal counts the greatest hash, so what a task holds is bounded whatever the tokens' lengths.
A block's places are counted in one task, as arrays, and rows are made of lines and blocks only; a block of more than `together` places
is counted in rows of tokens, with the same result.
The SQL below knows only a leaf's first template, and gives the same where no leaf holds a second.

A template that recurs in enough documents is dropped, but for its first occurrence (the least doc_id, then line): Tree.first_stays
keeps that one, so that no content leaves the corpus altogether, and without it every occurrence goes. How many documents are enough
depends on the number of tokens, as short lines recur by chance.

Lines split at \\n. Lines of fewer tokens than the least band stay. Null text stays null, an empty one empty; a document that loses
every line stays with an empty text. Rows repeated whole count as one document and are all treated alike. A missing doc_id sorts
last. Other columns pass as they are, whatever their names. Only hashes of lines are shuffled, and texts where lines are fetched or
filtered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm.common import NO_ID, drop_table, table


@dataclass(frozen=True)
class Tree:
    """bands: (tokens at least, documents at least), ascending; lead: leading tokens that are levels of the tree."""

    bands: tuple[tuple[int, int], ...] = ((3, 5), (8, 2))
    lead: int = 4
    general: int = 8  # tokens that a line needs for fields other than digits to be generalised
    similarity: float = 0.7  # of the places after the lead
    first_stays: bool = True
    together: int = 1 << 17  # tokens (lines x places) of a block that one task counts at once; larger blocks are counted in rows
    probe: int = 64  # places of a line that are compared in each block that it shares


#: A word with a digit, where words are parted by blanks only.
FIELD = "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def _lines_of(text: Column) -> Column:
    """A text's lines, with blanks for other white space."""
    other = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\r")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\f"))
    return F.split(F.when(other, F.regexp_replace(text, "[\\t\\x0B\\f\\r]", " ")).otherwise(text), "\n")


def tokens(line: Column) -> Column:
    """The words of one of _lines_of's lines, those with a digit as <*>."""
    return F.array_remove(F.split(F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, "<*>")).otherwise(line), " "), "")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("text_hash"), F.col("text")).where("text <> ''")


def _hashed_lines(docs: DataFrame, tree: Tree) -> DataFrame:
    """(id, text_hash, no, n, leaf, whole) of the lines with enough tokens for the least band."""
    least = tree.bands[0][0]

    def one(line: Column, no: Column) -> Column:
        # As an element of an array the tokens are made once, whatever reads them.
        of = lambda t: F.struct(no.alias("no"), F.size(t).alias("n"), F.xxhash64(F.size(t), F.slice(t, 1, tree.lead)).alias("leaf"), F.xxhash64(t).alias("whole"))
        return F.transform(F.array(tokens(line)), of)[0]

    return _keyed(docs).select("id", "text_hash", F.inline(F.filter(F.transform(_lines_of(F.col("text")), one), lambda x: x["n"] >= least)))


def _least(tree: Tree, loose: bool) -> Column:
    """The share of places of rest that must agree; loose: lines of probed places may fall short by three deviations of a sample."""
    if not loose:
        return F.lit(tree.similarity)
    below = 3 * (tree.similarity * (1 - tree.similarity) / tree.probe) ** 0.5
    return F.when(F.size("rest") < tree.probe, tree.similarity).otherwise(tree.similarity - below)


def _agreeing(lines: DataFrame, group: str, tree: Tree, loose: bool = False) -> DataFrame:
    """lines (group, rest: array of tokens, and what else) that agree with their group's commonest tokens at enough places."""
    counts = lines.select(group, F.posexplode("rest").alias("place", "token")).groupBy(group, "place", "token").count()
    most = counts.groupBy(group, "place").agg(F.max(F.struct("count", "token")).alias("most"))
    modes = most.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "most.token"))), lambda x: x["token"]).alias("mode"))
    same = F.size(F.filter(F.zip_with("rest", "mode", lambda a, b: a == b), lambda x: x))
    return lines.join(modes, group).where(same / F.size("rest") >= _least(tree, loose)).drop("mode")


def _commonest(words: Column, some: Column) -> Column:
    """The commonest of an array's words, of equal counts the greatest; some is any value of their type."""
    start = F.struct(some.alias("word"), F.lit(0).alias("run"), some.alias("most"), F.lit(0).alias("count"))

    def step(seen: Column, word: Column) -> Column:
        run = F.when(word == seen["word"], seen["run"] + 1).otherwise(1)
        more = run >= seen["count"]
        return F.struct(word.alias("word"), run.alias("run"), F.when(more, word).otherwise(seen["most"]).alias("most"), F.when(more, run).otherwise(seen["count"]).alias("count"))

    return F.aggregate(F.sort_array(words), start, step, lambda seen: seen["most"])


def _agreeing_together(lines: DataFrame, group: str, tree: Tree, loose: bool = False) -> DataFrame:
    """(group, leaf, whole) of the rows that _agreeing gives, each group as one row of arrays."""
    held = lines.groupBy(group).agg(F.collect_list(F.struct("leaf", "whole", "rest", _least(tree, loose).alias("least"))).alias("held"))
    places = F.sequence(F.lit(0), F.size(F.col("held")[0]["rest"]) - 1)
    modes = F.transform(places, lambda place: _commonest(F.transform("held", lambda line: line["rest"][place]), F.col("held")[0]["rest"][0]))

    def agrees(line: Column, mode: Column) -> Column:
        return F.size(F.filter(F.zip_with(line["rest"], mode, lambda a, b: a == b), lambda x: x)) / F.size(line["rest"]) >= line["least"]

    # As an element of an array the modes are made once, whatever reads them.
    agree = F.transform(F.array(modes), lambda mode: F.filter("held", lambda line: agrees(line, mode)))[0]
    return held.select(group, F.explode(F.transform(agree, lambda line: F.struct(line["leaf"], line["whole"]))).alias("a")).select(group, "a.leaf", "a.whole")


def _agreeing_by_size(lines: DataFrame, tree: Tree, loose: bool) -> DataFrame:
    """(sub, leaf, whole) of the lines (sub, leaf, whole, rest, small: whether the block's rests are few enough for a task) that agree."""
    large = _agreeing(lines.where(~F.col("small")), "sub", tree, loose).select("sub", "leaf", "whole")
    return _agreeing_together(lines.where("small"), "sub", tree, loose).union(large)


def _blocks(rest: DataFrame, tree: Tree) -> DataFrame:
    """(leaf, whole, places, sub) of each block of places of the lines (leaf, whole, rest)."""
    n = F.floor(F.size("rest") * (1 - tree.similarity) + 1e-9).cast("int") + 1
    cut = lambda i, n: F.ceil(i * F.size("rest") / n).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.xxhash64(F.col("leaf"), b, F.slice("rest", cut(b, n) + 1, cut(b + 1, n) - cut(b, n))))
    return rest.select("leaf", "whole", F.size("rest").alias("places"), F.explode(blocks).alias("sub"))


def _probes(rest: DataFrame, tree: Tree) -> DataFrame:
    """(leaf, whole, rest) with `probe` of the places at most: those with the least hashes, which are the same for all lines of a leaf."""
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.size("rest") - 1), lambda i: F.struct(F.xxhash64(i).alias("h"), i.alias("i"))))
    some = F.transform(F.slice(order, 1, tree.probe), lambda x: F.col("rest")[x["i"]])
    return rest.select("leaf", "whole", F.when(F.size("rest") <= tree.probe, F.col("rest")).otherwise(some).alias("rest"))


def _shared(left: DataFrame, tree: Tree) -> DataFrame:
    """(sub, small, leaf, whole) of the lines of left (leaf, whole, places, sub) in blocks of several lines, those of the same lines once."""
    shared = left.groupBy("sub").agg(F.count("*").alias("n"), F.min("leaf").alias("leaf"), F.max("places").alias("most"), F.bit_xor(F.xxhash64("whole")).alias("which")).where("n > 1")
    shared = shared.groupBy("leaf", "n", "which").agg(F.min("sub").alias("sub"), F.max("most").alias("most"))
    small = F.col("n") * F.least("most", F.lit(tree.probe)) <= tree.together
    return left.join(shared.select("sub", small.alias("small")), "sub").select("sub", "small", "leaf", "whole")


def _further(lines: DataFrame, members: DataFrame, tree: Tree) -> tuple[DataFrame, list[str]]:
    """(leaf, whole, joint: the template) of the lines in the further templates of leaves, and the tables behind it.

    lines has (leaf, whole, rest); a leaf's only member counts as not admitted.
    """
    first = members.join(members.groupBy("leaf").count().where("count > 1").select("leaf"), "leaf")
    rest = lines.join(first, ["leaf", "whole"], "left_anti").where(F.size("rest") > 0).select("leaf", "whole", F.transform("rest", lambda t: F.xxhash64(t)).alias("rest"))
    rest, rest_at = table(rest, "rest")
    probes, probes_at = table(_probes(rest, tree), "probes")
    left, left_at = table(_blocks(rest, tree), "blocks")
    out, made = None, [rest_at, probes_at, left_at]
    while True:
        asked, asked_at = table(_shared(left, tree), "shared")
        agree, agree_at = table(_agreeing_by_size(asked.join(probes, ["leaf", "whole"]), tree, True), "agreeing")
        sizes = agree.groupBy("sub").count().where("count > 1")
        best = agree.join(sizes, "sub").groupBy("leaf", "whole").agg(F.max(F.struct("count", "sub")).alias("best")).select("leaf", "whole", F.col("best.sub").alias("sub"))
        best, best_at = table(best.join(rest.select("leaf", "whole", F.size("rest").alias("places")), ["leaf", "whole"]), "best")
        long = best.where(F.col("places") >= tree.probe)
        small = long.groupBy("sub").agg((F.count("*") * F.max("places") <= tree.together).alias("small"))
        whole = _agreeing_by_size(long.join(small, "sub").join(rest, ["leaf", "whole"]), tree, False)
        best, whole_at = table(best.where(F.col("places") < tree.probe).select("sub", "leaf", "whole").union(whole), "whole")
        several = best.groupBy("sub").count().where("count > 1").select("sub")
        found, found_at = table(best.join(several, "sub").select("leaf", "whole", F.xxhash64(F.lit("sub"), "sub").alias("joint")), "further")
        made += [asked_at, agree_at, best_at, whole_at, found_at]
        out = found if out is None else out.union(found)
        if found.isEmpty():
            return out, made
        again = left.join(found.select("leaf").distinct(), "leaf", "left_semi").join(found.select("leaf", "whole"), ["leaf", "whole"], "left_anti")
        left, left_at = table(again, "blocks")
        made.append(left_at)


def dropped_lines(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(id, text_hash, dropped: array of line numbers from 0) of the documents that lose lines."""
    spark = docs.sparkSession
    lines, lines_at = table(_hashed_lines(docs, tree), "lines")
    long = lines.where(F.col("n") >= tree.general)
    row = F.xxhash64("id", "text_hash")

    distinct, distinct_at = table(long.select("leaf", "whole", row.alias("row"), "no").groupBy("leaf", "whole").agg(F.min("row").alias("row"), F.min_by("no", "row").alias("no")), "distinct")
    many = distinct.groupBy("leaf").count().where("count > 1").select("leaf")
    wanted = distinct.join(many, "leaf").groupBy("row").agg(F.collect_list(F.struct("no", "leaf", "whole")).alias("asked"))
    texts = _keyed(docs).select(row.alias("row"), "text")
    found = texts.join(wanted, "row").dropDuplicates(["row"]).select(_lines_of(F.col("text")).alias("split"), F.explode("asked").alias("a"))
    asked, asked_at = table(found.select("a.leaf", "a.whole", F.slice(tokens(F.col("split")[F.col("a.no")]), tree.lead + 1, 1 << 30).alias("rest")), "asked")
    drop_table(spark, distinct_at)
    members, members_at = table(_agreeing(asked, "leaf", tree).select("leaf", "whole"), "members")
    more, more_at = _further(asked, members, tree)

    joined = members.select("leaf", "whole", F.xxhash64(F.lit("leaf"), "leaf").alias("joint")).join(more.select("leaf", "whole"), ["leaf", "whole"], "left_anti").union(more)
    joined, joined_at = table(joined, "joined")  # so that the join below can split a line that very many documents have
    named = long.join(joined, ["leaf", "whole"], "left").select("id", "text_hash", "no", "n", F.coalesce("joint", "whole").alias("template"))
    named, named_at = table(named.union(lines.where(F.col("n") < tree.general).select("id", "text_hash", "no", "n", "whole")), "named")
    once = named.groupBy("template", "n", "id", "text_hash").agg(F.min("no").alias("no"))
    enough = F.lit(tree.bands[0][1])
    for at_least, docs_needed in tree.bands[1:]:
        enough = F.when(F.col("n") >= at_least, docs_needed).otherwise(enough)
    recurring = once.groupBy("template", "n").agg(F.count("*").alias("documents"), F.min(F.struct("id", "text_hash", "no")).alias("first")).where(F.col("documents") >= enough)
    recurring, recurring_at = table(recurring, "recurring")  # so that the join below can split a template of very many lines
    gone = named.join(recurring, ["template", "n"])
    if tree.first_stays:
        gone = gone.where(F.struct("id", "text_hash", "no") != F.col("first"))
    out, _ = table(gone.groupBy("id", "text_hash").agg(F.collect_set("no").alias("dropped")), "dropped")
    for at in (lines_at, asked_at, members_at, *more_at, joined_at, named_at, recurring_at):
        drop_table(spark, at)
    return out


def _cleaned(docs: DataFrame, tree: Tree) -> DataFrame:
    """(row: a row of docs, text: what is left of it, lines, dropped: the numbers of lines before and dropped)."""
    keyed = docs.select(F.struct("*").alias("row")).select("row", F.coalesce("row.doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("row.text").alias("text_hash"))
    both = keyed.join(dropped_lines(docs, tree), ["id", "text_hash"], "left")
    split = F.split("row.text", "\n")
    kept = F.array_join(F.filter(split, lambda _, i: ~F.array_contains(F.col("dropped"), i)), "\n")
    return both.select(
        "row",
        F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(kept).alias("text"),
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size(split)).cast("long").alias("lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("dropped"),
    )


def clean(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """docs, with its own columns, the dropped lines taken out of text."""
    return _cleaned(docs, tree).select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")


def report(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """doc_id, the text left, and the numbers of lines before and dropped, of every row."""
    return _cleaned(docs, tree).select("row.doc_id", "text", F.col("lines").alias("n_lines"), F.col("dropped").alias("n_dropped"))


#: report() in DuckDB SQL, over a table named documents, for the default tree.
SQL = """
WITH rows_ AS (SELECT DISTINCT doc_id AS id, text FROM {documents} WHERE text <> ''),
split_ AS (SELECT id, string_split(text, chr(10)) AS parts FROM rows_),
lines_ AS (SELECT id, unnest(range(len(parts))) AS no, unnest(parts) AS line FROM split_),
words_ AS (SELECT id, no, list_transform(regexp_split_to_array(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[ \\t\\x0B\\f\\r]+'),
  lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS tokens FROM lines_ WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
tree_ AS (SELECT id, no, tokens, len(tokens) AS n, tokens[1:4] AS lead FROM words_ WHERE len(tokens) >= 3),
distinct_ AS (SELECT DISTINCT tokens, n, lead FROM tree_ WHERE n >= 8),
many_ AS (SELECT n, lead FROM distinct_ GROUP BY n, lead HAVING count(*) > 1),
asked_ AS (SELECT d.* FROM distinct_ d JOIN many_ m ON d.n = m.n AND d.lead = m.lead),
places_ AS (SELECT n, lead, tokens, unnest(range(5, n + 1)) AS place FROM asked_),
most_ AS (SELECT n, lead, place, arg_max(token, (c, token)) AS token FROM (SELECT n, lead, place, tokens[place] AS token, count(*) AS c FROM places_ GROUP BY ALL) GROUP BY n, lead, place),
members_ AS (SELECT p.tokens FROM places_ p JOIN most_ m ON p.n = m.n AND p.lead = m.lead AND p.place = m.place GROUP BY p.tokens HAVING avg(CASE WHEN p.tokens[p.place] = m.token THEN 1.0 ELSE 0.0 END) >= 0.7),
named_ AS (SELECT t.id, t.no, t.n, CASE WHEN m.tokens IS NULL THEN t.tokens ELSE list_concat(['leaf'], t.lead) END AS template FROM tree_ t LEFT JOIN members_ m ON t.tokens = m.tokens),
recurring_ AS (SELECT template, n, min((id, no)) AS first_ FROM named_ GROUP BY template, n HAVING count(DISTINCT id) >= CASE WHEN n >= 8 THEN 2 ELSE 5 END),
dropped_ AS (SELECT t.id, list(t.no) AS dropped FROM named_ t JOIN recurring_ r ON t.template = r.template AND t.n = r.n WHERE (t.id, t.no) <> r.first_ GROUP BY t.id),
cleaned_ AS (SELECT d.*, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines, coalesce(len(x.dropped), 0) AS n_dropped,
  CASE WHEN x.dropped IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda l, i: NOT list_contains(x.dropped, i - 1)), chr(10)) END AS cleaned
  FROM {documents} d LEFT JOIN dropped_ x ON d.doc_id = x.id)
"""
REPORT_SQL = SQL.format(documents="documents") + "SELECT doc_id, cleaned AS text, n_lines, n_dropped FROM cleaned_"
