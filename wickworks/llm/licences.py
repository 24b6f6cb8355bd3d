"""License scans in DataFrame operations only: ordered signature rules, gated by keywords, with overlaps resolved.

A text is its words in small letters (A-Z only), so that punctuation, case and line ends play no part. The distinct words that are some
rule's keyword select the rules worth trying, and a text with none of them is done. Each tried rule finds its leftmost non-overlapping
places; a match is marked in the text, and the places are read off the marked words, so cost follows the length of the text.

Rules have a class (0 tags and notices, 1 names, 2 hints) and an order. A detection goes if another one's interval contains its own and is of
its class or a better one (of equal intervals the first by class and order stays), or if it contains one of a better class, as the hint
"under the license" would around a name. Detections that merely overlap both stay, and a detection that goes still counts against others.
Base rules are ordinary rules, and their labels stay even where another detection covers theirs.

The score is the weight of the best class among the detections kept: 1 for a tag or notice, 0.8 for a name, 0.4 for a hint, 0 for none.
Null and empty texts have no words, no places and score 0. Every row gives a row, repeated ones too. Other columns pass as they are where
a whole table is returned, whatever their names.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm.pii import _running

TAG, NAME, HINT = 0, 1, 2
WEIGHTS = (1.0, 0.8, 0.4)
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str  # a word that every match has
    pattern: str  # over words in small letters, one blank between words
    kind: int
    base: bool = False


#: Phrases and labels of the base rules.
BASE = (("cc-by", "cc", "cc by"), ("gpl", "general", "general public license"), ("reserved", "reserved", "all rights reserved"))

#: Names of licenses by label: keyword and pattern.
NAMES = (
    ("apache-1.1", "apache", "apache (?:software )?license (?:version |v)?1 1"),
    ("apache-2.0", "apache", "apache (?:software )?(?:license )?(?:version |v)?2(?: 0)?(?: license)?"),
    ("apache", "apache", "apache (?:software )?license"),
    ("mit", "mit", "(?:the )?mit(?: x11| expat)? licen[cs]e"),
    ("mit-0", "mit", "mit no attribution|mit 0 license"),
    ("expat", "expat", "expat licen[cs]e"),
    ("x11", "x11", "x11 licen[cs]e"),
    ("isc", "isc", "isc licen[cs]e|internet (?:systems|software) consortium isc license"),
    ("bsd-0-clause", "bsd", "(?:zero|0) clause bsd(?: licen[cs]e)?|0bsd licen[cs]e"),
    ("bsd-1-clause", "bsd", "bsd (?:1|one) clause(?: licen[cs]e)?"),
    ("bsd-2-clause", "bsd", "bsd (?:2|two) clause(?: licen[cs]e)?|(?:2|two) clause bsd(?: licen[cs]e)?|simplified bsd licen[cs]e|freebsd licen[cs]e"),
    ("bsd-3-clause", "bsd", "bsd (?:3|three) clause(?: licen[cs]e)?|(?:3|three) clause bsd(?: licen[cs]e)?|(?:new|modified|revised) bsd licen[cs]e"),
    ("bsd-4-clause", "bsd", "bsd (?:4|four) clause(?: licen[cs]e)?|(?:4|four) clause bsd(?: licen[cs]e)?|original bsd licen[cs]e"),
    ("bsd", "bsd", "bsd(?: style)? licen[cs]e"),
    ("mpl-1.0", "mozilla", "mozilla public licen[cs]e (?:version |v)?1 0"),
    ("mpl-1.1", "mozilla", "mozilla public licen[cs]e (?:version |v)?1 1"),
    ("mpl-2.0", "mozilla", "mozilla public licen[cs]e (?:version |v)?2(?: 0)?"),
    ("mpl", "mozilla", "mozilla public licen[cs]e"),
    ("mpl-1.1", "mpl", "mpl (?:version )?1 1"),
    ("mpl-2.0", "mpl", "mpl (?:version )?2 0"),
    ("epl-1.0", "eclipse", "eclipse public licen[cs]e (?:version |v)?1 0"),
    ("epl-2.0", "eclipse", "eclipse public licen[cs]e (?:version |v)?2 0"),
    ("epl", "eclipse", "eclipse public licen[cs]e"),
    ("edl-1.0", "eclipse", "eclipse distribution licen[cs]e(?: (?:version |v)?1 0)?"),
    ("cddl-1.0", "cddl", "cddl (?:version )?1 0"),
    ("cddl-1.1", "cddl", "cddl (?:version )?1 1"),
    ("cddl", "cddl", "cddl"),
    ("cddl", "distribution", "common development and distribution licen[cs]e"),
    ("cpl-1.0", "common", "common public licen[cs]e(?: (?:version |v)?1 0)?"),
    ("cpal-1.0", "common", "common public attribution licen[cs]e(?: (?:version |v)?1 0)?"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e"),
    ("eupl-1.1", "eupl", "eupl (?:version |v)?1 1"),
    ("eupl-1.2", "eupl", "eupl (?:version |v)?1 2"),
    ("eupl", "european", "european union public licen[cs]e"),
    ("artistic-1.0", "artistic", "artistic licen[cs]e (?:version |v)?1(?: 0)?"),
    ("artistic-2.0", "artistic", "artistic licen[cs]e (?:version |v)?2(?: 0)?"),
    ("artistic", "artistic", "artistic licen[cs]e"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e"),
    ("libpng", "libpng", "libpng licen[cs]e"),
    ("boost-1.0", "boost", "boost software licen[cs]e(?: (?:version |v)?1 0)?"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("wtfpl", "want", "do what the f[a-z]+ you want to public licen[cs]e"),
    ("beerware", "beerware", "beerware licen[cs]e|beerware"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "universal", "creative commons zero(?: v?1 0)? universal"),
    ("pddl-1.0", "pddl", "pddl(?: (?:version |v)?1 0)?"),
    ("pddl-1.0", "domain", "public domain dedication and licen[cs]e"),
    ("odbl-1.0", "odbl", "odbl(?: (?:version |v)?1 0)?"),
    ("odbl-1.0", "database", "open database licen[cs]e"),
    ("odc-by-1.0", "attribution", "open data commons attribution licen[cs]e"),
    ("ogl-uk", "government", "open government licen[cs]e(?: v?[123] 0)?"),
    ("cdla-permissive", "community", "community data licen[cs]e agreement permissive"),
    ("cdla-sharing", "community", "community data licen[cs]e agreement sharing"),
    ("gfdl-1.1", "documentation", "gnu free documentation licen[cs]e (?:version |v)?1 1"),
    ("gfdl-1.2", "documentation", "gnu free documentation licen[cs]e (?:version |v)?1 2"),
    ("gfdl-1.3", "documentation", "gnu free documentation licen[cs]e (?:version |v)?1 3"),
    ("gfdl", "documentation", "(?:gnu )?free documentation licen[cs]e"),
    ("psf-2.0", "python", "python software foundation licen[cs]e(?: (?:version |v)?2)?|psf licen[cs]e"),
    ("python", "python", "python licen[cs]e"),
    ("php-3.01", "php", "php licen[cs]e(?: (?:version |v)?3 01)?"),
    ("ruby", "ruby", "ruby (?:s )?licen[cs]e"),
    ("perl", "perl", "same terms as perl(?: itself)?"),
    ("openssl", "openssl", "openssl licen[cs]e"),
    ("ssleay", "ssleay", "ssleay licen[cs]e"),
    ("postgresql", "postgresql", "postgresql licen[cs]e"),
    ("openldap", "openldap", "openldap public licen[cs]e"),
    ("ofl-1.1", "font", "sil open font licen[cs]e(?: (?:version |v)?1 1)?"),
    ("ofl", "font", "open font licen[cs]e"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa (?:open source )?licen[cs]e"),
    ("sleepycat", "sleepycat", "sleepycat licen[cs]e"),
    ("sissl", "sissl", "sissl"),
    ("sspl-1.0", "side", "server side public licen[cs]e(?: (?:version |v)?1)?"),
    ("elastic-2.0", "elastic", "elastic licen[cs]e (?:version |v)?2(?: 0)?"),
    ("bsl-1.1", "business", "business source licen[cs]e(?: (?:version |v)?1 1)?"),
    ("commons-clause", "commons", "commons clause"),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict) licen[cs]e"),
    ("openrail-m", "openrail", "(?:bigscience |creativeml )?openrail m?(?: licen[cs]e)?"),
    ("rail-1.0", "rail", "bigscience rail licen[cs]e(?: (?:version |v)?1 0)?"),
    ("osl-3.0", "open", "open software licen[cs]e(?: (?:version |v)?3 0)?"),
    ("afl-3.0", "academic", "academic free licen[cs]e(?: (?:version |v)?3 0)?"),
    ("ecl-2.0", "educational", "educational community licen[cs]e(?: (?:version |v)?2 0)?"),
    ("lppl-1.3c", "latex", "latex project public licen[cs]e(?: (?:version |v)?1 3c?)?"),
    ("qpl-1.0", "q", "q public licen[cs]e(?: (?:version |v)?1 0)?"),
    ("nposl-3.0", "profit", "non profit open software licen[cs]e(?: 3 0)?"),
    ("upl-1.0", "permissive", "universal permissive licen[cs]e(?: (?:version |v)?1 0)?"),
    ("mulanpsl-2.0", "mulan", "mulan (?:psl|permissive software licen[cs]e)(?: v?2)?"),
    ("vim", "vim", "vim licen[cs]e"),
    ("w3c", "w3c", "w3c (?:software )?(?:notice and )?licen[cs]e"),
    ("icu", "icu", "icu licen[cs]e"),
    ("unicode", "unicode", "unicode licen[cs]e agreement"),
    ("curl", "curl", "curl licen[cs]e"),
    ("json", "evil", "shall be used for good not evil"),
    ("blueoak-1.0.0", "oak", "blue oak model licen[cs]e(?: 1 0 0)?"),
    ("hippocratic", "hippocratic", "hippocratic licen[cs]e(?: 2 1)?"),
    ("public-domain", "domain", "(?:released|placed|dedicated) (?:in)?to the public domain|in the public domain"),
)

#: Sentences out of licenses' own texts, and notices that name no license: keyword and pattern.
SENTENCES = (
    ("mit", "deal", "permission is hereby granted free of charge to any person obtaining a copy of this software .{0,80}deal in the software without restriction"),
    ("isc", "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl-2.0-or-later", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("boost-1.0", "boost", "distributed under the boost software license version 1 0"),
    ("ofl-1.1", "font", "this font software is licensed under the sil open font license version 1 1"),
    ("cc0-1.0", "waived", "has waived all copyright and related or neighboring rights"),
    ("warranty-disclaimer", "warranty", "provided as is (?:and )?without (?:any )?(?:express(?:ed)? or implied )?warrant(?:y|ies)"),
)
HINTS = (
    ("reserved", "rights", "(?:some|no) rights reserved"),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
    ("copyleft", "copyleft", "copyleft"),
    ("proprietary", "proprietary", "proprietary and confidential|proprietary licen[cs]e"),
    ("open-source", "source", "open source licen[cs]e"),
    ("non-commercial", "commercial", "for non commercial (?:use|purposes)(?: only)?"),
    ("licensed", "license", "(?:under|see) the license(?: file)?(?: for details)?"),
    ("licensed", "licensed", "(?:dual )?licensed under"),
)


def _creative_commons() -> list[Rule]:
    """Each mix of conditions with each version, short and long."""
    long = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s"}
    rules = []
    for parts in (["by", "nc", "sa"], ["by", "nc", "nd"], ["by", "nc"], ["by", "sa"], ["by", "nd"], ["by"]):
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0", ""):
            label, number = "-".join(["cc", *parts, *filter(None, [version])]), f" {version.replace('.', ' ')}" if version else ""
            rules.append(Rule(label, "cc", f"cc {' '.join(parts)}{number}", NAME))
            rules.append(Rule(label, "creative", f"creative commons {' '.join(long[p] for p in parts)}{number and f'(?: international| unported| generic)?{number}'}", NAME))
    return rules


def _gnu() -> list[Rule]:
    """Each member of the family with each version, short and long, only or any later."""
    rules = []
    for short, long, versions in (("gpl", "general", ("1", "2", "3")), ("lgpl", "(?:lesser|library) general", ("2", "2.1", "3")), ("agpl", "affero general", ("1", "3"))):
        for v in (*versions, ""):
            number = v.replace(".", " ") + ("" if "." in v else "(?: 0)?")
            for suffix, tail in ((("-or-later", "(?: or (?:any )?later(?: version)?| and later)"), ("-only", " only"), ("", "")) if v else (("", ""),)):
                label = f"{short}-{v if '.' in v else v + '.0'}{suffix}" if v else short
                rules.append(Rule(label, "general", f"(?:gnu )?{long} public licen[cs]e{f' (?:version |v ?)?{number}{tail}' if v else ''}", NAME))
                if v:
                    rules.append(Rule(label, short, f"(?:gnu )?{short} (?:version |v ?)?{number}{tail}", NAME))
                    rules.append(Rule(label, f"{short}v{v.split('.')[0]}", f"(?:gnu )?{short}v{number}{tail}", NAME))
                else:
                    rules.append(Rule(label, short, f"(?:gnu )?{short}(?: licen[cs]e)?", NAME))
    return rules


def rules() -> tuple[Rule, ...]:
    """All rules in order: base, sentences, tags and notices of each license, names, hints."""
    names = [Rule(label, key, pattern, NAME) for label, key, pattern in NAMES] + _creative_commons() + _gnu()
    ids = dict.fromkeys(r.label for r in names)
    tags = [Rule(i, "spdx", f"spdx license identifier {i.replace('.', ' ').replace('-', ' ')}", TAG) for i in sorted(ids, key=lambda i: (-len(i), i))]
    granted = "(?:licensed|released|distributed|available|provided|published|redistributed) under (?:the )?(?:terms (?:of|and conditions of) (?:the )?)?"
    notices = [Rule(r.label, r.keyword, f"{granted}(?:{r.pattern})", TAG) for r in names]
    base = [Rule(label, key, pattern, NAME, True) for label, key, pattern in BASE]
    return (*base, *(Rule(label, key, pattern, TAG) for label, key, pattern in SENTENCES), *tags, *notices, *names, *(Rule(label, key, pattern, HINT) for label, key, pattern in HINTS))


RULES = rules()


def _spaced(pattern: str) -> str:
    """The pattern over a text with a blank on either side of each word."""
    return f" ({pattern.replace(' ?', chr(0)).replace(' ', '  ').replace(chr(0), '(?:  )?')}) "


def words(text: Column) -> Column:
    """The words of a text in small letters."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_A_WORD), "")


_RULE = "struct<no:int,label:string,kind:int,base:boolean,rx:string>"
_FOUND = "array<struct<start:int,less:int,kind:int,no:int,label:string,base:boolean>>"


def _by_keyword(rules: tuple[Rule, ...]) -> Column:
    by: dict[str, list] = {}
    for no, r in enumerate(rules):
        by.setdefault(r.keyword, []).append({"no": no, "label": r.label, "kind": r.kind, "base": r.base, "rx": _spaced(r.pattern)})
    return F.from_json(F.lit(json.dumps(by)), f"map<string,array<{_RULE}>>")


def found(w: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All detections in an array of words by start, longest first, then class and order: (start, less = -end, kind, no, label, base)."""
    keys = F.array(*(F.lit(k) for k in sorted({r.keyword for r in rules})))
    spaced = F.concat(F.lit(" "), F.array_join(w, "  "), F.lit(" "))

    def places(text: Column, r: Column) -> Column:
        marked = F.split(F.btrim(F.regexp_replace(text, r["rx"], F.lit(" \x01$1\x02 "))), "  ")
        starts = F.array_compact(F.transform(marked, lambda x, i: F.when(F.startswith(x, F.lit("\x01")), i)))
        ends = F.array_compact(F.transform(marked, lambda x, i: F.when(F.endswith(x, F.lit("\x02")), i + 1)))
        return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (-e).alias("less"), r["kind"].alias("kind"), r["no"].alias("no"), r["label"].alias("label"), r["base"].alias("base")))

    def search(present: Column) -> Column:
        tried = F.flatten(F.transform(present, lambda k: F.element_at(_by_keyword(rules), k)))
        with_text = F.transform(F.array(spaced), lambda t: F.flatten(F.transform(F.filter(tried, lambda r: F.call_function("rlike", t, r["rx"])), lambda r: places(t, r))))
        return F.array_sort(F.element_at(with_text, 1))

    hit = F.element_at(F.transform(F.array(F.array_intersect(w, keys)), lambda p: F.when(F.size(p) > 0, search(p))), 1)
    return F.coalesce(hit, F.array().cast(_FOUND))


def kept(spans: Column) -> Column:
    """For each detection of found(), in its order, whether it stays."""

    def before(kind: int) -> Column:
        """The largest end of earlier detections of this class or a better one, at each place."""
        ends = F.transform(spans, lambda x: F.when(x["kind"] <= kind, -x["less"]).otherwise(0))
        return F.concat(F.array(F.lit(0)), _running(ends, lambda a, b: F.greatest(a, b)))

    top = 2147483647

    def after(kind: int) -> Column:
        """The least end of later detections of a better class, at each place counted from the end."""
        ends = F.transform(F.reverse(spans), lambda x: F.when(x["kind"] < kind, F.lit(top) + x["less"]).otherwise(0))
        return F.concat(F.array(F.lit(0)), _running(ends, lambda a, b: F.greatest(a, b)))

    made = F.struct(*(before(k).alias(f"b{k}") for k in range(3)), *(after(k).alias(f"a{k}") for k in (1, 2)))

    def stays(m: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            inside = F.element_at(F.array(*(F.get(m[f"b{k}"], i) for k in range(3))), x["kind"] + 1) >= -x["less"]
            last = F.size(spans) - 1 - i
            around = F.when(x["kind"] == 0, F.lit(False)).otherwise(F.element_at(F.array(F.lit(0), F.get(m["a1"], last), F.get(m["a2"], last)), x["kind"] + 1) >= F.lit(top) + x["less"])
            return ~inside & ~around

        return F.transform(spans, one)

    return F.when(F.size(spans) > 1, F.element_at(F.transform(F.array(made), stays), 1)).otherwise(F.transform(spans, lambda x: F.lit(True)))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with n_words and its detections: (start, end, kind, no, label, base, kept), by start, longest first."""
    # Made once per row: the words, what is found in them, and what stays.
    w = F.transform(F.array(words(F.col("text"))), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), found(w, rules).alias("spans")))
    w = F.transform(w, lambda x: F.struct(x["n_words"].alias("n_words"), x["spans"].alias("spans"), kept(x["spans"]).alias("stays")))
    full = F.transform(w, lambda x: F.struct(x["n_words"].alias("n_words"), F.zip_with(x["spans"], x["stays"], lambda s, k: F.struct(
        s["start"].alias("start"), (-s["less"]).alias("end"), s["kind"].alias("kind"), s["no"].alias("no"), s["label"].alias("label"), s["base"].alias("base"), k.alias("kept"))).alias("detections")))
    free = next(c for c in (f"__ww_scan{i}" for i in range(1000)) if c not in docs.columns)
    return docs.withColumn(free, F.element_at(full, 1)).select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "detections")), f"{free}.n_words", f"{free}.detections")


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    found = scan(docs.select("doc_id", "text"), rules)
    base = F.filter("detections", lambda d: d["base"])
    named = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda d: d["label"]))), ",")
    best = F.array_min(F.transform(F.filter("detections", lambda d: d["kept"]), lambda d: d["kind"]))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["start"])).cast("long").alias("first_word"), F.array_max(F.transform(base, lambda d: d["start"])).cast("long").alias("last_word"),
        named(base).alias("base_labels"), named(F.filter("detections", lambda d: d["base"] | d["kept"])).alias("labels"),
        F.when(best.isNull(), 0.0).otherwise(F.element_at(F.array(*(F.lit(x) for x in WEIGHTS)), best + 1)).alias("score"),
    )


def _sql() -> str:
    rows = ",\n".join(f"({no}, '{r.label}', '{r.keyword}', {r.kind}, {'true' if r.base else 'false'}, '{_spaced(r.pattern)}')" for no, r in enumerate(RULES))
    return rf"""
WITH rules_ (no, label, keyword, kind, base, rx) AS (VALUES {rows}),
split_ AS (SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
keyed_ AS (SELECT s.row, ' ' || array_to_string(s.w, '  ') || ' ' AS t, r.* FROM split_ s JOIN rules_ r ON list_contains(s.w, r.keyword)),
marked_ AS (SELECT row, no, label, kind, base, string_split(trim(regexp_replace(t, rx, ' ' || chr(1) || '\1' || chr(2) || ' ', 'g')), '  ') AS m FROM keyed_ WHERE regexp_matches(t, rx)),
spans_ AS (SELECT row, no, label, kind, base, unnest(list_filter(range(0, len(m)), lambda i: starts_with(m[i + 1], chr(1)))) AS start, unnest(list_filter(range(0, len(m)), lambda i: ends_with(m[i + 1], chr(2)))) + 1 AS stop FROM marked_),
gone_ AS (SELECT DISTINCT d.row, d.no, d.start FROM spans_ d JOIN spans_ e ON d.row = e.row AND (d.no <> e.no OR d.start <> e.start)
  AND ((e.start <= d.start AND e.stop >= d.stop AND e.kind <= d.kind AND (e.stop - e.start > d.stop - d.start OR e.kind < d.kind OR e.no < d.no))
    OR (e.start >= d.start AND e.stop <= d.stop AND e.kind < d.kind))),
all_ AS (SELECT s.*, g.row IS NULL AS kept FROM spans_ s LEFT JOIN gone_ g ON g.row = s.row AND g.no = s.no AND g.start = s.start),
docs_ AS (SELECT row, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
  array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base))), ',') AS base_labels, array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base OR kept))), ',') AS labels, min(kind) FILTER (WHERE kept) AS best FROM all_ GROUP BY row)
SELECT s.doc_id, len(s.w)::BIGINT AS n_words, coalesce(d.n_base, 0)::BIGINT AS n_base, d.first_word::BIGINT AS first_word, d.last_word::BIGINT AS last_word, coalesce(d.base_labels, '') AS base_labels, coalesce(d.labels, '') AS labels,
  CASE d.best WHEN 0 THEN 1.0 WHEN 1 THEN 0.8 WHEN 2 THEN 0.4 ELSE 0.0 END::DOUBLE AS score FROM split_ s LEFT JOIN docs_ d ON d.row = s.row
"""


REPORT_SQL = _sql()
