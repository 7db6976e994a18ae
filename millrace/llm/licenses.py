r"""License scans by ordered signature rules (DataFrame functions only).

Texts are read as lower-case words.  A cheap anchor expression decides which texts
can hold any signature at all; for these the words are joined by single spaces,
the keywords present are found in one pass, and only the rules with a present keyword
run.  A rule is a hand-written expression over words with a label and a priority (0
is the most specific kind).  Detections are intervals of words; one is suppressed
if another of the same or a more specific priority contains it.  Everything
happens inside the row: no shuffle, no explosion, linear in the detections.

Base phrases are rules as well, but they are counted as they stand and their
labels are never suppressed.

Defined cases: null or wordless texts have no words, no labels and score 0; equal
intervals of one label count once; rows are judged one by one; extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: A word of the text as it is (upper-case letters are lower-cased later).
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label, keywords, and the names it goes by, as word expressions.
#: Every alternative of the names holds one of the keywords as a whole word.
FAMILIES = [
    ("mit", "mit|expat", "mit|expat"),
    ("mit-0", "mit", "mit no attribution|mit 0"),
    ("apache-1.1", "apache", "apache(?: software)? license(?: version)? 1 1|apache 1 1"),
    ("apache-2", "apache|apache2|asl", "apache(?: software)? license(?: version)?(?: v)? ?2(?: 0)?|apache(?: v)? ?2(?: 0)?|apache v2(?: 0)?|asl 2 0"),
    ("bsd", "bsd|berkeley", "bsd|bsd style|berkeley software distribution"),
    ("bsd-2", "bsd", "bsd 2 clause|2 clause bsd|simplified bsd|freebsd bsd"),
    ("bsd-3", "bsd", "bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd"),
    ("bsd-4", "bsd", "bsd 4 clause|4 clause bsd|original bsd"),
    ("isc", "isc|consortium", "isc|internet systems consortium"),
    ("zlib", "zlib", "zlib|zlib libpng"),
    ("libpng", "libpng", "libpng"),
    ("boost", "boost|bsl", "boost software(?: license)?(?: version)?(?: 1 0)?|bsl 1 0"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("gpl", "gpl", "gpl|gnu gpl"),
    ("gpl-2", "gpl|gpl2|gplv2", "(?:gnu )?gpl(?: version)? ?2(?: 0)?|gplv2|(?:gnu )?gpl v2"),
    ("gpl-3", "gpl|gpl3|gplv3", "(?:gnu )?gpl(?: version)? ?3(?: 0)?|gplv3|(?:gnu )?gpl v3"),
    ("gpl", "gnu", "gnu general public"),
    ("gpl-2", "gnu", "gnu general public license(?: as published by the free software foundation)?(?: either)? version 2"),
    ("gpl-3", "gnu", "gnu general public license(?: as published by the free software foundation)?(?: either)? version 3"),
    ("lgpl", "lgpl", "lgpl|gnu lgpl"),
    ("lgpl-2.1", "lgpl|lgplv2", "(?:gnu )?lgpl(?: version)? 2 1|lgplv2 1"),
    ("lgpl-3", "lgpl|lgplv3", "(?:gnu )?lgpl(?: version)? 3(?: 0)?|lgplv3"),
    ("lgpl", "lesser", "gnu lesser general public"),
    ("lgpl", "library", "gnu library general public"),
    ("agpl", "agpl", "agpl|gnu agpl"),
    ("agpl-3", "agpl|agplv3", "(?:gnu )?agpl(?: version)? 3(?: 0)?|agplv3"),
    ("agpl", "affero", "gnu affero general public"),
    ("gfdl", "gfdl|fdl", "gfdl|gnu fdl"),
    ("gfdl", "documentation", "gnu free documentation"),
    ("mpl", "mpl", "mpl"),
    ("mpl-2", "mpl|mplv2", "mpl(?: version)? 2(?: 0)?|mplv2"),
    ("mpl", "mozilla", "mozilla public"),
    ("mpl-2", "mozilla", "mozilla public license(?: version)? 2(?: 0)?"),
    ("epl", "epl", "epl"),
    ("epl-2", "epl", "epl(?: version)? 2(?: 0)?"),
    ("epl", "eclipse", "eclipse public"),
    ("edl", "eclipse", "eclipse distribution"),
    ("cddl", "cddl", "cddl"),
    ("cddl", "development", "common development and distribution"),
    ("cpl", "common", "common public"),
    ("cpal", "cpal", "cpal"),
    ("eupl", "eupl", "eupl"),
    ("eupl", "union", "european union public"),
    ("artistic-2", "artistic", "artistic license 2 0|artistic 2 0"),
    ("artistic", "artistic", "artistic|perl artistic"),
    ("python", "python|psf", "python software foundation|psf"),
    ("php", "php", "php"),
    ("ruby", "ruby", "ruby"),
    ("openssl", "openssl", "openssl"),
    ("openldap", "openldap", "openldap public|openldap"),
    ("postgresql", "postgresql", "postgresql"),
    ("ncsa", "ncsa", "ncsa|university of illinois ncsa open source"),
    ("afl", "academic", "academic free"),
    ("osl", "open", "open software"),
    ("ms-pl", "microsoft", "microsoft public"),
    ("ms-rl", "microsoft", "microsoft reciprocal"),
    ("ofl", "ofl", "sil ofl|ofl"),
    ("ofl", "font", "sil open font|open font"),
    ("odbl", "odbl", "odbl"),
    ("odbl", "database", "open database"),
    ("odc-by", "odc", "odc by"),
    ("pddl", "pddl", "pddl"),
    ("sspl", "sspl", "sspl"),
    ("sspl", "server", "server side public"),
    ("busl", "business", "business source"),
    ("elastic", "elastic", "elastic"),
    ("commons-clause", "clause", "commons clause"),
    ("openrail", "openrail", "openrail(?: m)?|bigscience openrail m"),
    ("cc0", "cc0", "cc0(?: 1 0)?"),
    ("cc0", "zero", "creative commons zero"),
    ("beerware", "beerware|beer", "beerware|beer ware"),
    ("zpl", "zope", "zope public"),
    ("w3c", "w3c", "w3c software|w3c"),
    ("x11", "x11", "x11"),
]
#: How a name is used. {n} is the name; priority of the rule.
TEMPLATES = [
    (0, " spdx license identifier (?:{n})(?: only| or later)?"),
    (
        1,
        " (?:licensed|licenced|released|distributed|available|provided|published|covered|redistribute|offered)"
        "(?: it| them)?(?: to you)?(?: freely)? under(?: the)?(?: terms of)?(?: the)? (?:{n})(?: license| licence)?",
    ),
    (2, " under(?: the)?(?: terms of)?(?: the)? (?:{n}) licen[cs]e"),
    (3, " (?:{n}) licen[cs]e"),
]
#: Passages and tags with no such name: priority, label, keywords, expression.
PASSAGES = [
    (0, "mit", "hereby", " permission is hereby granted free of charge to any person obtaining a copy"),
    (1, "mit", "warranty", " the software is provided as is without warranty of any kind express or implied"),
    (0, "isc", "permission", " permission to use copy modify and or distribute this software for any purpose"),
    (0, "bsd", "redistribution", " redistribution and use in source and binary forms with or without modification"),
    (1, "bsd-3", "endorse", " neither the name of .{1,80}? may be used to endorse or promote products"),
    (0, "gpl", "redistribute", " this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    (0, "apache-2", "compliance", " you may not use this file except in compliance with the license"),
    (0, "mpl-2", "mozilla", " this source code form is subject to the terms of the mozilla public license v 2 0"),
    (0, "boost", "boost", " boost software license version 1 0"),
    (0, "unlicense", "unencumbered", " this is free and unencumbered software released into the public domain"),
    (0, "zlib", "misrepresented", " the origin of this software must not be misrepresented"),
    (1, "public-domain", "domain", " (?:in|into|to) the public domain"),
    (2, "public-domain", "domain", " public domain"),
    (1, "all-rights-reserved", "reserved", " all rights reserved"),
    (2, "proprietary", "proprietary", " proprietary and confidential"),
    (1, "proprietary", "prohibited", " unauthori[sz]ed (?:copying|use|distribution).{1,60}? strictly prohibited"),
]
#: The parts of Creative Commons terms, most specific first.
CC_TERMS = ["by nc nd", "by nc sa", "by nc", "by nd", "by sa", "by"]
_CC_WORDS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:atives|s)?(?: works)?", "sa": "share ?alike"}

#: A superset of all rules: a text without any of these holds nothing that a rule matches.
ANCHORS = (
    r"(?i)licen[cs]e|spdx|cc" + _GAP + r"by|creative" + _GAP + r"commons|cc0|public" + _GAP + r"domain|all" + _GAP
    + r"rights" + _GAP + r"reserved|hereby" + _GAP + r"granted|redistribution" + _GAP + r"and|proprietary" + _GAP
    + r"and|unauthori[sz]ed" + _GAP + r"|misrepresented|unencumbered|endorse" + _GAP
    + r"|permission" + _GAP + r"to|provided" + _GAP + r"as|redistribute" + _GAP + r"|under" + _GAP
)
#: How sure a detection of each priority is.
CONFIDENCE = [1.0, 0.95, 0.85, 0.7]


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keywords: str
    pattern: str
    base: bool = False


def rules() -> list[Rule]:
    """The ordered rule set: base phrases, passages, then every family in every template."""
    out = [Rule(0, label, words.split()[0] if words.startswith("cc") else words.split()[-2], f" {words}(?= )", True) for words, label in BASE.items()]
    out += [Rule(p, label, keywords, f"{x}(?= )") for p, label, keywords, x in PASSAGES]
    for terms in CC_TERMS:
        label = "cc-" + terms.replace(" ", "-")
        spelled = " ".join(_CC_WORDS[t] for t in terms.split())
        version = "(?: [1-4] [05])?"
        out.append(Rule(0, label, "spdx", f" spdx license identifier cc {terms}{version}(?= )"))
        out.append(Rule(1, label, "cc", f" cc {terms}{version}(?: licen[cs]e)?(?= )"))
        out.append(Rule(1, label, "creative", f" creative commons(?: licen[cs]e)? {spelled}{version}(?: international| unported)?(?: licen[cs]e)?(?= )"))
    for priority, template in TEMPLATES:
        for label, keywords, names in FAMILIES:
            out.append(Rule(priority, label, "spdx" if priority == 0 else keywords, template.format(n=names.replace(" ?", "(?: )?")) + "(?= )"))
    return out


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _places(words: Column, rule: Column) -> Column:
    """Detections of one rule: the words before a match and in it are counted by their spaces."""
    hits = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    before = F.split(words, rule["pattern"], -1)
    lengths = F.zip_with(before, hits, lambda b, h: F.struct(_spaces(b).alias("gap"), _spaces(h).alias("n")))
    detection = "struct<start:int,stop:int,priority:int,label:string,base:boolean>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{detection}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        here = acc["at"] + x["gap"]
        found = F.struct(
            here.alias("start"),
            (here + x["n"]).alias("stop"),
            rule["priority"].alias("priority"),
            rule["label"].alias("label"),
            rule["base"].alias("base"),
        ).cast(detection)
        return F.when(x["n"].isNull(), acc).otherwise(
            F.struct((here + x["n"]).alias("at"), F.concat(acc["out"], F.array(found)).alias("out"))
        )

    return F.aggregate(lengths, start, step, lambda acc: acc["out"])


def _survivors(found: Column) -> Column:
    """Drops detections that one of the same or a more specific priority contains.

    In the order (start, longest, priority) a container comes before what it
    contains, so one stop per priority is enough to know.
    """
    keyed = F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["stop"]).alias("back"), d["priority"].alias("priority"), d["label"].alias("label")))
    ordered = F.sort_array(F.array_distinct(keyed))
    kind = "array<struct<start:int,back:int,priority:int,label:string>>"
    zero = F.struct(F.array(*[F.lit(-1)] * len(CONFIDENCE)).alias("reach"), F.array().cast(kind).alias("out"))

    def step(acc: Column, d: Column) -> Column:
        stop = -d["back"]
        reach = acc["reach"]
        inside = F.exists(F.slice(reach, F.lit(1), d["priority"] + 1), lambda s: s >= stop)
        grown = F.transform(reach, lambda s, p: F.when(p == d["priority"], F.greatest(s, stop)).otherwise(s))
        return F.when(inside, acc).otherwise(
            F.struct(grown.alias("reach"), F.concat(acc["out"], F.array(d)).alias("out"))
        )

    return F.aggregate(ordered, zero, step, lambda acc: acc["out"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words`` and ``found`` (base places), ``spans`` (surviving detections, words from 0)."""
    table = rules()
    literal = F.array(
        *[F.struct(F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.array(*map(F.lit, r.keywords.split("|"))).alias("keywords"), F.lit(r.pattern).alias("pattern"), F.lit(r.base).alias("base")) for r in table]
    )
    keywords = sorted({k for r in table for k in r.keywords.split("|")})
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.col("_text")
    low = F.translate(text, upper, upper.lower())
    joined = F.concat(F.lit(" "), F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))
    step = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    step = step.select(
        "doc_id",
        F.regexp_count(text, F.lit(RAW_WORD)).cast("long").alias("n_words"),
        F.when(text.rlike(ANCHORS), joined).alias("_words"),
    )
    words = F.col("_words")
    step = step.select(
        "doc_id",
        "n_words",
        "_words",
        F.when(words.isNotNull(), F.array_distinct(F.regexp_extract_all(words, F.lit(f" ({'|'.join(keywords)})(?= )"), F.lit(1)))).alias("_keys"),
    )
    keys = F.col("_keys")
    candidates = F.filter(literal, lambda r: F.arrays_overlap(keys, r["keywords"]))
    step = step.select(
        "doc_id",
        "n_words",
        F.when(F.size(keys) > 0, F.flatten(F.transform(candidates, lambda r: _places(words, r)))).alias("_found"),
    )
    found = F.coalesce(F.col("_found"), F.array().cast("array<struct<start:int,stop:int,priority:int,label:string,base:boolean>>"))
    step = step.select("doc_id", "n_words", found.alias("_found"))
    found = F.col("_found")
    return step.select(
        "doc_id",
        "n_words",
        F.filter(found, lambda d: d["base"]).alias("found"),
        F.when(F.size(found) > 0, _survivors(found)).alias("spans"),
    )


def summarise(scanned: DataFrame) -> DataFrame:
    """The digest: counts, labels and a score for each row of ``scan``."""
    found, spans = F.col("found"), F.coalesce(F.col("spans"), F.array().cast("array<struct<start:int,back:int,priority:int,label:string>>"))
    listed = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    sure = F.array(*[F.lit(x) for x in CONFIDENCE])
    return scanned.select("doc_id", "n_words", "found", spans.alias("spans")).select(
        "doc_id",
        "n_words",
        F.size(found).cast("long").alias("n_base"),
        F.array_min(F.transform(found, lambda d: d["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(found, lambda d: d["start"])).cast("long").alias("last_word"),
        listed(F.transform(found, lambda d: d["label"])).alias("base_labels"),
        listed(F.concat(F.transform(found, lambda d: d["label"]), F.transform("spans", lambda d: d["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda d: F.get(sure, d["priority"]))), F.lit(0.0)).alias("score"),
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return summarise(scan(docs, id_col, text_col))
