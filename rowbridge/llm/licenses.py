"""License scan: ordered signature rules, keyword prefilter, containment suppression.

Rules are regular expressions written out of families of licences and the ways
a text refers to them; every rule has a priority, a label and a confidence.
A text is first searched for one keyword per family, and only the rules of the
keywords it holds are applied, so that a text without any costs one search. A
detection that lies inside another of the same or a better priority is dropped.
All of it is column arithmetic in one narrow projection; no row moves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowbridge.common import column
from rowbridge.llm.common import put, text_or_empty, unused

# A word is a run of ASCII letters and digits and of anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

# Phrases the scan must always report, with their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Rule:
    priority: int  # smaller is better
    label: str
    pattern: str
    keyword: str
    confidence: float


def phrase(words: str) -> str:
    """Pattern of words standing consecutively; a word may be a group in brackets."""
    return rf"(?<!{WORD})" + (GAP + "+").join(words.split()) + rf"(?!{WORD})"


# Families: a word that any reference holds, names, label, versions, whether "license" must follow.
FAMILIES: tuple[tuple[str, tuple[str, ...], str, tuple[str, ...], bool], ...] = (
    ("affero", ("gnu affero general public", "affero general public"), "agpl", ("1", "3"), True),
    ("agpl", ("gnu agpl", "agpl"), "agpl", ("3",), False),
    ("lesser", ("gnu lesser general public", "lesser general public"), "lgpl", ("2.1", "3"), True),
    ("library", ("gnu library general public", "library general public"), "lgpl", ("2",), True),
    ("lgpl", ("gnu lgpl", "lgpl"), "lgpl", ("2.1", "3"), False),
    ("general", ("gnu general public", "general public"), "gpl", ("1", "2", "3"), True),
    ("gpl", ("gnu gpl", "gpl"), "gpl", ("2", "3"), False),
    ("documentation", ("gnu free documentation",), "gfdl", ("1.1", "1.2", "1.3"), True),
    ("apache", ("apache", "apache software"), "apache", ("1.0", "1.1", "2.0"), True),
    ("mozilla", ("mozilla public",), "mpl", ("1.0", "1.1", "2.0"), True),
    ("eclipse", ("eclipse public",), "epl", ("1.0", "2.0"), True),
    ("development", ("common development and distribution",), "cddl", ("1.0", "1.1"), True),
    ("common", ("common public",), "cpl", ("1.0",), True),
    ("european", ("european union public",), "eupl", ("1.0", "1.1", "1.2"), True),
    ("academic", ("academic free",), "afl", ("1.1", "2.0", "3.0"), True),
    ("open", ("open software",), "osl", ("1.0", "2.0", "3.0"), True),
    ("artistic", ("artistic", "perl artistic"), "artistic", ("1.0", "2.0"), True),
    ("boost", ("boost software",), "bsl", ("1.0",), True),
    ("font", ("sil open font", "open font"), "ofl", ("1.0", "1.1"), True),
    ("database", ("open database",), "odbl", ("1.0",), True),
    ("microsoft", ("microsoft public",), "ms-pl", (), True),
    ("reciprocal", ("microsoft reciprocal",), "ms-rl", (), True),
    ("python", ("python software foundation",), "psf", ("2",), True),
    ("zlib", ("zlib",), "zlib", (), True),
    ("isc", ("isc",), "isc", (), True),
    ("consortium", ("internet systems consortium",), "isc", (), True),
    ("mit", ("mit",), "mit", (), True),
    ("expat", ("expat",), "mit", (), True),
    ("bsd", ("bsd", "[234] clause bsd", "bsd [234] clause"), "bsd", (), True),
    ("berkeley", ("berkeley software distribution",), "bsd", (), True),
    ("zope", ("zope public",), "zpl", ("2.0", "2.1"), True),
    ("php", ("php",), "php", ("3.0", "3.01"), True),
    ("ruby", ("ruby",), "ruby", (), True),
    ("cecill", ("cecill", "cecill free software"), "cecill", ("1.0", "2.0", "2.1"), False),
    ("beerware", ("beerware",), "beerware", (), False),
    ("unlicense", ("unlicense",), "unlicense", (), False),
    ("fuck", ("do what the fuck you want to public",), "wtfpl", ("2",), True),
)

# Every rule holds one of these, or a reference like "CC BY".
GATE = (
    "licen", "gpl", "cecill", "beerware", "spdx", "creative", "cc0", "domain", "permission", "warranty",
    "redistribution", "endorse", "altered", "reserved", "confidential", "terms", "commercial",
)
GATE_CC = rf"(?i)c(?<!{WORD}c)c{GAP}+by"

# Clauses of the Creative Commons, longest first: they decide the label.
CLAUSES: tuple[tuple[str, str], ...] = (
    ("by nc sa", "attribution noncommercial sharealike"),
    ("by nc nd", "attribution noncommercial noderivatives"),
    ("by nc", "attribution noncommercial"),
    ("by sa", "attribution sharealike"),
    ("by nd", "attribution noderivatives"),
    ("by", "attribution"),
)
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Ways to say that something stands under a license, and their confidence.
GRANTS = (
    (r"(?:licen[sc]ed|released|distributed|available|published) (?:under|by) (?:the )?(?:terms of the )?", 0.95),
    (r"under (?:the )?terms of the ", 0.9),
    (r"subject to the ", 0.85),
)

# Signatures of whole licence texts and tags, each by hand: keyword, words, label, confidence.
SENTENCES: tuple[tuple[str, str, str, float], ...] = (
    ("charge", "permission is hereby granted free of charge to any person obtaining a copy", "mit", 0.9),
    ("warranty", "the software is provided as is without warranty of any kind", "mit", 0.6),
    ("redistribution", "redistribution and use in source and binary forms with or without modification", "bsd", 0.9),
    ("endorse", "may be used to endorse or promote products derived from this software", "bsd-3-clause", 0.8),
    ("permission", "permission to use copy modify and (?:or )?distribute this software for any purpose", "isc", 0.9),
    ("unencumbered", "free and unencumbered software released into the public domain", "unlicense", 0.9),
    ("domain", "(?:dedicated to|released into|placed in|in) the public domain", "public-domain", 0.7),
    ("altered", "altered source versions must be plainly marked as such", "zlib", 0.9),
    ("reserved", "all rights reserved", "all-rights-reserved", 0.5),
    ("creativecommons", "creativecommons org publicdomain zero 1 0", "cc0-1.0", 1.0),
    ("cc0", "cc0(?: 1 0)?", "cc0", 0.8),
    ("confidential", "proprietary (?:and )?confidential", "proprietary", 0.7),
    ("terms", "(?:see|subject to) (?:our|the) terms of use", "terms-of-use", 0.5),
    ("commercial", "(?:for )?non commercial use only", "non-commercial", 0.7),
    ("noncommercial", "(?:for )?noncommercial use only", "non-commercial", 0.7),
)


def _spelled(version: str) -> str:
    """Words of a version: 2.0 may stand as 2 or as 2 0."""
    whole, _, part = version.partition(".")
    if not part:
        return f"{whole}(?:{GAP}+0)?"
    return f"{whole}(?:{GAP}+0)?" if part == "0" else f"{whole}{GAP}+{part}"


def _gapped(words: str) -> str:
    return words.replace(" ", GAP + "+")


def rules() -> list[Rule]:
    """All rules in order: tags, grants, names with version, names, then sentences."""
    made: list[Rule] = []

    def add(priority: int, label: str, words: str, keyword: str, confidence: float) -> None:
        made.append(Rule(priority, label, rf"(?<!{WORD}){_gapped(words)}(?!{WORD})", keyword, confidence))

    for keyword, names, family, versions, named in FAMILIES:
        either = "(?:" + "|".join(names) + ")"
        licence = "(?: public)? licen[sc]e" if named else "(?:(?: public)? licen[sc]e)?"
        for version in versions:
            written = f"(?: version| v)? v?{_spelled(version)}"
            for grant, confidence in GRANTS:
                add(1, f"{family}-{version}", f"{grant}{either}{licence}{written}", keyword, confidence)
            add(2, f"{family}-{version}", f"{either}{licence}{written}", keyword, 0.8)
            add(0, f"{family}-{version}", f"spdx license identifier {family} {_spelled(version)}(?: only| or later)?", "spdx", 1.0)
        for grant, confidence in GRANTS:
            add(1, family, f"{grant}{either}{licence}", keyword, confidence - 0.1)
        add(3, family, f"{either}{licence}", keyword, 0.6)
        add(4, family, f"spdx license identifier {family}", "spdx", 0.9)
    for clause, spelled in CLAUSES:
        label = "cc-" + clause.replace(" ", "-")
        for version in CC_VERSIONS:
            add(1, f"{label}-{version}", f"cc {clause} {_spelled(version)}", "cc", 0.95)
            add(1, f"{label}-{version}", f"creative commons {spelled}(?: international| unported)? {_spelled(version)}", "creative", 0.95)
            add(0, f"{label}-{version}", f"creativecommons org licenses {clause} {_spelled(version)}", "creativecommons", 1.0)
        add(2, label, f"cc {clause}", "cc", 0.7)
        add(2, label, f"creative commons {spelled}", "creative", 0.8)
    for keyword, words, label, confidence in SENTENCES:
        add(2, label, words, keyword, confidence)
    return made


PRIORITIES = 5


def _spans(text: Column, pattern: Column) -> Column:
    """[start, end) of every match in code points, from the lengths of what is between."""
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    matched = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.length(m))
    start = F.lit(0).cast("int")
    first = F.struct(start.alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    walked = F.aggregate(
        F.arrays_zip(between.alias("gap"), matched.alias("len")),
        first,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.coalesce(x["len"], F.lit(0))).alias("at"),
            F.when(
                x["len"].isNotNull(),
                F.concat(
                    acc["spans"],
                    F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["len"]).alias("end"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return walked


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``detections``: spans with label, priority and confidence that no other contains.

    Sorted by start, then the longer, then the better priority. A null text has
    no detections. Equal detections are reported once.
    """
    ordered = rules()
    keywords = sorted({r.keyword for r in ordered})
    names = list(docs.columns)
    t, held, found = unused(names, "__text"), unused(names, "__held"), unused(names, "__found")
    lowered = unused(names, "__lowered")
    # Lower case of all letters holds the ASCII keywords wherever the patterns, which ignore ASCII case, can match.
    searched = docs.withColumn(t, text_or_empty(text)).withColumn(lowered, F.lower(t))
    gate = F.col(t).rlike(GATE_CC)
    for word in reversed(GATE):
        gate = F.col(lowered).contains(word) | gate
    table = F.array(*[F.lit(k) for k in keywords])
    searched = searched.withColumn(
        held,
        F.when(gate, F.filter(table, lambda k: F.col(lowered).contains(k))).otherwise(F.array().cast("array<string>")),
    )
    signatures = F.array(
        *[
            F.struct(
                F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit("(?i)" + r.pattern).alias("pattern"),
                F.lit(r.keyword).alias("keyword"), F.lit(r.confidence).alias("confidence"),
            )
            for r in ordered
        ]
    )
    applied = F.when(
        F.size(held) > 0,
        F.array_sort(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.filter(signatures, lambda r: F.array_contains(F.col(held), r["keyword"])),
                        lambda r: F.transform(
                            _spans(F.col(t), r["pattern"]),
                            lambda s: F.struct(
                                s["start"].alias("start"), (-s["end"]).alias("back"), r["priority"].alias("priority"),
                                r["label"].alias("label"), r["confidence"].alias("confidence"),
                            ),
                        ),
                    )
                )
            )
        ),
    )
    searched = searched.withColumn(found, applied)
    return put(searched, detections=_outermost(F.col(found))).drop(t, lowered, held, found)


def _outermost(found: Column) -> Column:
    """Drop what lies inside an earlier detection of the same or a better priority."""
    kind = "array<struct<start:int,end:int,priority:int,label:string,confidence:double>>"
    state = F.struct(
        F.array(*[F.lit(-1)] * PRIORITIES).alias("reach"), F.array().cast(kind).alias("kept")
    )

    def step(acc: Column, d: Column) -> Column:
        end = -d["back"]
        inside = F.exists(F.slice(acc["reach"], 1, d["priority"] + 1), lambda r: r >= end)
        kept = F.struct(
            d["start"].alias("start"), end.alias("end"), d["priority"].alias("priority"), d["label"].alias("label"),
            d["confidence"].alias("confidence"),
        )
        return F.struct(
            F.when(inside, acc["reach"])
            .otherwise(F.transform(acc["reach"], lambda r, i: F.when(i == d["priority"], F.greatest(r, end)).otherwise(r)))
            .alias("reach"),
            F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(kept))).alias("kept"),
        )

    return F.coalesce(F.aggregate(found, state, step, lambda acc: acc["kept"]), F.array().cast(kind))


def base_places(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``n_base``, ``first_word``, ``last_word`` and ``base_found`` (labels).

    A null text is an empty one; columns of these names give way.

    The phrases cannot overlap one another, so one alternation finds all places.
    """
    pattern = "(?i)" + "|".join(phrase(p) for p, _ in BASE)
    gate = "(?i)licen|cc"
    names = list(docs.columns)
    t, gaps, hits, counted = (unused(names, n) for n in ("__text", "__gaps", "__hits", "__n_words"))
    df = docs.withColumn(t, text_or_empty(text))
    near = F.col(t).rlike(gate)
    empty = F.array().cast("array<string>")
    df = df.withColumn(hits, F.when(near, F.regexp_extract_all(F.col(t), F.lit(pattern), F.lit(0))).otherwise(empty))
    some = F.size(hits) > 0
    df = df.withColumn(gaps, F.when(some, F.split(F.col(t), pattern, -1)))
    n_words = F.regexp_count(F.col(t), F.lit(WORD + "+"))

    def words(x: Column) -> Column:
        return F.regexp_count(x, F.lit(WORD + "+"))

    last = words(F.element_at(gaps, -1)) + words(F.element_at(hits, -1))
    df = df.withColumn(counted, n_words.cast("long"))

    def hit(words_of_phrase: str) -> Column:
        whole = "(?i)^" + phrase(words_of_phrase) + "$"
        return F.exists(F.col(hits), lambda h: h.rlike(whole))

    found = F.array_compact(F.array(*[F.when(hit(p), F.lit(label)) for p, label in BASE]))
    return put(
        df,
        n_words=F.col(counted),
        n_base=F.size(hits).cast("long"),
        first_word=F.when(some, words(F.element_at(gaps, 1))).cast("long"),
        last_word=F.when(some, F.col(counted) - last).cast("long"),
        base_found=F.when(some, found).otherwise(empty),
    ).drop(t, gaps, hits, counted)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add base places, ``detections`` and ``score``; a null text is an empty one: no words, labels or score.

    ``score`` is the confidence of the surest detection, 0 without any; a base
    phrase alone counts 0.6.
    """
    both = detect(base_places(docs, text), text)
    surest = F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))
    base = F.when(F.col("n_base") > 0, F.lit(0.6)).otherwise(F.lit(0.0))
    return put(both, score=F.greatest(surest, base))
