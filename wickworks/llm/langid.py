"""Language identification by fusing evidence: text, declared markup language, address suffix and host.

The text's likelihood under each language comes from hashed byte trigrams of words, with add-one smoothing; as trigrams overlap, its
logarithm counts by effective words rather than by trigrams. How far a declared language can be trusted is counted over all pages:
the table of P(declared | language) comes from the pages' text posteriors. Priors are a chain of grouped sums of text posteriors:
all pages, the address's suffix, the registered name, the host; each level is smoothed by the one above with a fixed weight, and a
page's own posterior is taken out of its host's counts. The posterior is the product of text, declaration and host prior.

The trigram model is trained on a bounded sample, max_rows documents with a known lang, first by a hash of their ids. Null url, html
or text counts as empty; a page without text, declaration or host gets the overall prior. Host counts are joined by salted keys, so a host with
a third of all pages is spread over tasks. Of languages with equal posteriors the first by name is given.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm import textbytes as tb
from wickworks.llm import urlfilter
from wickworks.llm.common import bounded_sample, table


@dataclass(frozen=True)
class Settings:
    bits: int = 15
    max_rows: int = 4000
    weight: float = 0.35  # of a word's log-likelihood
    most_words: int = 400  # effective words at most
    prior_weight: float = 20.0
    salts: int = 16


_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


def _trigrams(texts: pa.Array, bits: int):
    """(first row, rows, text of each trigram, its place, words of each text) of each block."""
    for row, data, offsets in tb.blocks(texts):
        low = _LOW[data]
        starts, ends = tb.runs(_LETTER[low], offsets)
        n = len(offsets) - 1
        words = np.bincount(tb.texts_of(offsets, starts), minlength=n)[:n]
        b = np.where(_LETTER[low], low, 32).astype(np.uint64)
        grams = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]
        of = tb.texts_of(offsets, np.arange(len(grams)))
        whole = (of == tb.texts_of(offsets, np.arange(2, len(grams) + 2))) & (b[1:-1] != 32) if len(grams) else np.zeros(0, bool)
        yield row, n, of[whole], (tb.mix(grams[whole], 5) & np.uint64((1 << bits) - 1)).astype(np.int64), words


def train(texts: pa.Array, langs: list[str], s: Settings = Settings()) -> tuple[list[str], np.ndarray]:
    """The languages and the logarithms of P(trigram | language)."""
    names = sorted(set(langs))
    which = np.array([names.index(x) for x in langs], np.int64)
    counts = np.ones((len(names), 1 << s.bits))
    for row, _, of, place, _ in _trigrams(texts, s.bits):
        np.add.at(counts, (which[of + row], place), 1)
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def likelihoods(texts: pa.Array, model: np.ndarray, s: Settings = Settings()) -> np.ndarray:
    """Rows of log-likelihoods of the texts, less their highest."""
    out = np.zeros((len(texts), len(model)))
    for row, n, of, place, words in _trigrams(texts, s.bits):
        grams = np.maximum(1, np.bincount(of, minlength=n)[:n])
        for k, m in enumerate(model):
            out[row : row + n, k] = tb.sums(m[place], of, n) / grams * np.minimum(words, s.most_words) * s.weight
    return out - out.max(axis=1, keepdims=True)


def visible(html: Column) -> Column:
    """The text of a page: no scripts, styles, comments and tags."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(text, "&[a-zA-Z]+;|&#[0-9]+;", " ")


def declared(html: Column) -> Column:
    """The primary subtag of the html element's lang, in small letters; empty for none."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?is)<html\b[^>]*?\s(?:xml:)?lang\s*=\s*["']?\s*([a-z]+)""", 1))


def _of_pages(pages: DataFrame) -> DataFrame:
    host = urlfilter.host(F.col("url"))
    parts = F.split(F.regexp_replace(host, ":[0-9]*$", ""), "\\.")
    name = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), ".")
    return pages.select("page_id", F.lit(None).cast("long").alias("doc_id"), host.alias("host"), F.element_at(parts, -1).alias("suffix"), name.alias("name"), declared(F.col("html")).alias("declared"), visible(F.col("html")).alias("plain"))


def _of_documents(docs: DataFrame) -> DataFrame:
    """Documents have no address and no markup: their source stands for the host, under a suffix and a name of their own."""
    own = F.lit("(document)")
    return docs.select(F.lit(None).cast("long").alias("page_id"), "doc_id", F.coalesce("source", F.lit("")).alias("host"), own.alias("suffix"), own.alias("name"), F.lit("").alias("declared"), F.coalesce("text", F.lit("")).alias("plain"))


def identify(pages: DataFrame, labelled: DataFrame, docs: DataFrame | None = None, s: Settings = Settings()) -> DataFrame:
    """page_id, doc_id, lang, confidence, text_lang, declared and host of every row of pages and, if given, of docs.

    labelled has doc_id, text and lang and serves to train; lang is never evidence for a row.
    """
    names, model = train(*bounded_sample(labelled, labelled, "lang", s.max_rows), s)
    if not names:
        names, model = ["und"], np.zeros((1, 1 << s.bits), np.float32)
    score = F.arrow_udf(lambda texts: pa.array(list(likelihoods(texts, model, s)), pa.list_(pa.float64())), "array<double>")
    rows = _of_pages(pages) if docs is None else _of_pages(pages).unionByName(_of_documents(docs))
    read = rows.select("page_id", "doc_id", "host", "suffix", "name", "declared", score(F.col("plain")).alias("text_ll"))
    read, _ = table(read, "evidence")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    odds = F.transform("text_ll", lambda x: F.exp(x))
    read = read.withColumn("post", F.transform(odds, lambda x: x / total(odds)))

    ks = range(len(names))
    sums = [F.sum(F.col("post")[k]).alias(f"c{k}") for k in ks]
    hosts, _ = table(read.groupBy("host", "name", "suffix").agg(*sums), "hosts")
    again = [F.sum(f"c{k}").alias(f"c{k}") for k in ks]
    everything = hosts.agg(*again).first()
    mass = [everything[f"c{k}"] or 0.0 for k in ks]
    base = [(m + 1) / (sum(mass) + len(names)) for m in mass]

    def smoothed(counts: str, above: list[Column] | Column) -> Column:
        n = sum((F.col(f"{counts}.c{k}") for k in ks), F.lit(0.0))
        return F.array(*[(F.col(f"{counts}.c{k}") + s.prior_weight * above[k]) / (n + s.prior_weight) for k in ks])

    suffixes = hosts.groupBy("suffix").agg(*again).alias("x")
    suffixes = suffixes.select("suffix", smoothed("x", [F.lit(b) for b in base]).alias("suffix_prior"))
    registered = hosts.groupBy("name", "suffix").agg(*again).alias("x").join(suffixes, "suffix")
    registered = registered.select("name", "suffix", smoothed("x", F.col("suffix_prior")).alias("name_prior"))
    per_host = hosts.join(registered, ["name", "suffix"]).select("host", "name", "suffix", F.array(*[f"c{k}" for k in ks]).alias("counts"), "name_prior", F.explode(F.sequence(F.lit(0), F.lit(s.salts - 1))).alias("salt"))

    trust = {}
    for r in read.groupBy(F.when(F.col("declared").isin(names), F.col("declared")).when(F.col("declared") == "", "none").otherwise("other").alias("said")).agg(*sums).collect():
        trust[r["said"]] = [r[f"c{k}"] for k in ks]
    said = sorted({*names, "none", "other"})
    table_ = {w: [(trust.get(w, [0.0] * len(names))[k] + 0.5) / (mass[k] + 0.5 * len(said)) for k in ks] for w in said}
    claim = F.lit(None)
    for w in said:
        row = F.array(*[F.lit(float(np.log(x))) for x in table_[w]])
        claim = F.when(F.col("declared") == ("" if w == "none" else w), row).otherwise(claim) if w != "other" else claim
    claim = F.coalesce(claim, F.array(*[F.lit(float(np.log(x))) for x in table_["other"]]))

    both = read.withColumn("salt", F.pmod(F.xxhash64("page_id", "doc_id"), F.lit(s.salts)).cast("int")).join(per_host, ["host", "name", "suffix", "salt"])
    n = F.greatest(total(F.col("counts")) - 1, F.lit(0.0))
    prior = F.array(*[(F.greatest(F.col("counts")[k] - F.col("post")[k], F.lit(0.0)) + s.prior_weight * F.col("name_prior")[k]) / (n + s.prior_weight) for k in ks])
    both = both.select("page_id", "doc_id", "host", "declared", "text_ll", claim.alias("claim"), prior.alias("prior"))
    fused = both.select("page_id", "doc_id", "host", "declared", "text_ll", F.array(*[F.col("text_ll")[k] + F.col("claim")[k] + F.log(F.col("prior")[k]) for k in ks]).alias("sum"))
    top = F.array_max("sum")
    lang = F.array(*[F.lit(x) for x in names])
    best = lambda a: F.get(lang, (F.array_position(a, F.array_max(a)) - 1).cast("int"))
    confidence = 1 / F.aggregate("sum", F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return fused.select("page_id", "doc_id", best(F.col("sum")).alias("lang"), confidence.alias("confidence"), best(F.col("text_ll")).alias("text_lang"), "declared", "host")
