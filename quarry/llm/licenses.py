"""License scans by ordered signature rules, in DataFrame expressions only.

A text is lower-cased (A-Z) and cut to words; its words joined by single blanks are the
canonical text that the rules read. The rules are regular expressions with a label, a
keyword and a priority. A rule runs on a text only if its keyword occurs there; the rules
are split by their keyword's anchor word, and a text without any anchor word is left after
one test per anchor. Each match is an interval of words. A match is suppressed if a match
of equal or higher priority holds its whole interval (of equal intervals the rule first in
order stays). What is left gives the labels; all work on a text is inside its row, so no
group of texts can be hot and nothing is shuffled.

Base phrases are rules of their own whose places are all counted. Nulls: a null text is
empty, gives 0 words, null first and last word, and empty labels. Repeated rows are scanned
each by itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The phrases counted in every text, with their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Rule(NamedTuple):
    rank: int  # place in the order of the rules
    label: str
    anchor: str  # a word without which no rule of its part runs
    keyword: str  # a string without which the rule does not run
    pattern: str  # over the canonical text, word bounds included
    priority: int  # higher wins


# name in canonical words, label, versions ("" for none named)
_FAMILIES = [
    ("apache", "apache", ["1 0", "1 1", "2 0"]),
    ("mozilla public", "mpl", ["1 0", "1 1", "2 0"]),
    ("eclipse public", "epl", ["1 0", "2 0"]),
    ("common development and distribution", "cddl", ["1 0", "1 1"]),
    ("gnu general public", "gpl", ["1", "2", "3"]),
    ("gnu lesser general public", "lgpl", ["2", "2 1", "3"]),
    ("gnu library general public", "lgpl", ["2"]),
    ("gnu affero general public", "agpl", ["1", "3"]),
    ("gnu free documentation", "gfdl", ["1 1", "1 2", "1 3"]),
    ("mit", "mit", []),
    ("isc", "isc", []),
    ("bsd", "bsd", []),
    ("zlib", "zlib", []),
    ("boost software", "bsl", ["1 0"]),
    ("artistic", "artistic", ["1 0", "2 0"]),
    ("european union public", "eupl", ["1 0", "1 1", "1 2"]),
    ("open software", "osl", ["1 0", "2 0", "2 1", "3 0"]),
    ("academic free", "afl", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("microsoft public", "ms-pl", []),
    ("microsoft reciprocal", "ms-rl", []),
    ("python software foundation", "psf", ["2"]),
    ("ruby", "ruby", []),
    ("php", "php", ["3 0", "3 01"]),
    ("perl", "perl", []),
    ("sil open font", "ofl", ["1 0", "1 1"]),
    ("open data commons open database", "odbl", ["1 0"]),
    ("open data commons attribution", "odc-by", ["1 0"]),
    ("open government", "ogl", ["1 0", "2 0", "3 0"]),
    ("creative ml openrail m", "openrail", []),
    ("common public", "cpl", ["1 0"]),
    ("ibm public", "ipl", ["1 0"]),
    ("lucent public", "lpl", ["1 0", "1 02"]),
    ("q public", "qpl", ["1 0"]),
    ("sun public", "spl", ["1 0"]),
    ("nokia open source", "nokos", ["1 0"]),
    ("reciprocal public", "rpl", ["1 1", "1 5"]),
    ("server side public", "sspl", ["1"]),
    ("business source", "busl", ["1 1"]),
    ("elastic", "elastic", ["2 0"]),
    ("unicode", "unicode", []),
    ("w3c software", "w3c", []),
    ("x11", "x11", []),
    ("latex project public", "lppl", ["1 0", "1 1", "1 2", "1 3"]),
    ("educational community", "ecl", ["1 0", "2 0"]),
    ("universal permissive", "upl", ["1 0"]),
    ("mulan permissive software", "mulanpsl", ["1", "2"]),
    ("do what the fuck you want to public", "wtfpl", ["2"]),
    ("blue oak model", "blueoak", ["1 0 0"]),
]
_CC_PARTS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
_CC_NAMES = ["attribution", "attribution sharealike", "attribution noderivatives", "attribution noncommercial",
             "attribution noncommercial sharealike", "attribution noncommercial noderivatives"]
_CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
_PHRASES = [  # label, anchor, keyword, pattern, priority
    ("cc0", "cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 3),
    ("public-domain", "domain", "public domain", r"(?:released |dedicated )?(?:in(?:to)? |to )?the public domain", 2),
    ("unlicense", "unlicense", "unlicense", r"(?:the )?unlicense", 2),
    ("proprietary", "confidential", "confidential", r"(?:proprietary and confidential|confidential and proprietary)", 3),
    ("proprietary", "rights", "rights reserved", r"(?:all|some|no) rights reserved", 1),
    ("copyright", "copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", 2),
    ("copyright", "copyright", "copyright", r"copyright notice", 1),
    ("mit", "permission", "permission is hereby granted",
     r"permission is hereby granted free of charge to any person obtaining a copy", 4),
    ("isc", "permission", "permission to use copy", r"permission to use copy modify and or distribute this software", 4),
    ("bsd", "redistribution", "redistribution and use", r"redistribution and use in source and binary forms", 4),
    ("bsd-2-clause", "bsd", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[sc]e)?", 4),
    ("bsd-3-clause", "bsd", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: licen[sc]e)?", 4),
    ("bsd-4-clause", "bsd", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", 4),
    ("warranty", "warranty", "without warranty", r"without warranty of any kind", 1),
    ("warranty", "warranties", "warranties", r"without warranties or conditions of any kind", 1),
    ("gpl", "gpl", "gpl", r"gpl(?: ?v?[123](?: 0)?)?(?: (?:only|or later))?", 3),
    ("lgpl", "lgpl", "lgpl", r"lgpl(?: ?v?[23](?: [01])?)?(?: (?:only|or later))?", 3),
    ("agpl", "agpl", "agpl", r"agpl(?: ?v?[13](?: 0)?)?(?: (?:only|or later))?", 3),
]
_ANY_LICENSE = "licen[sc]e"


def _id(*parts: str) -> str:
    return "-".join(p.replace(" 0", ".0").replace(" ", ".") if p[:1].isdigit() else p.replace(" ", "-") for p in parts if p)


def rules() -> list[Rule]:
    """The rules in order. Named families are written out for each version and way of naming them."""
    found: list[tuple] = []
    for parts, name in zip(_CC_PARTS, _CC_NAMES):
        for v in _CC_VERSIONS:
            found.append((_id(f"cc {parts}", v), "cc", f"cc {parts} {v}", f"cc {parts} {v}", 5))
            found.append((_id(f"cc {parts}", v), "commons", "creative commons", f"creative commons {name} {v}(?: international| unported)?", 5))
        found.append((_id(f"cc {parts}"), "cc", f"cc {parts}", f"cc {parts}", 3))
        found.append((_id(f"cc {parts}"), "commons", "creative commons", f"creative commons {name}(?: {_ANY_LICENSE})?", 3))
    for name, label, versions in _FAMILIES:
        kind = "licen"
        for v in versions:
            found.append((_id(label, v), kind, name, f"(?:the )?{name} {_ANY_LICENSE} (?:version |v)?{v}(?: or later)?", 5))
            if " 0" in v and v.endswith(" 0"):
                found.append((_id(label, v), kind, name, f"(?:the )?{name} {_ANY_LICENSE} (?:version |v){v[:-2]}", 4))
            found.append((_id(label, v), "spdx", label.replace("-", " "), f"spdx license identifier {label.replace('-', ' ')} {v}(?: only| or later)?", 6))
        found.append((_id(label), kind, name, f"(?:under |with )(?:the )?(?:terms of )?(?:the )?{name} {_ANY_LICENSE}", 4))
        found.append((_id(label), kind, name, f"{name} {_ANY_LICENSE}", 3))
        found.append((_id(label), "spdx", label.replace("-", " "), f"spdx license identifier {label.replace('-', ' ')}", 4))
    found += _PHRASES
    found.append(("license", "licen", "licensed under", "licensed under", 1))
    bound = lambda p: f"(?<![^ ])(?:{p})(?![^ ])"
    return [Rule(i, label, anchor, key, bound(p), level) for i, (label, anchor, key, p, level) in enumerate(found)]


def canonical(text: Column) -> Column:
    """Words in lower case, joined by single blanks."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(lower, NOT_WORD, " "))


def _n_words(s: Column) -> Column:
    """Words in a piece of canonical text (blanks at its ends do not count)."""
    t = F.trim(s)
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1)


def _intervals(canon: Column, rule: Column) -> Column:
    """``struct(first, last, rank, priority, label)`` of each match, in words, last included."""
    pieces = F.split(canon, rule["pattern"], -1)
    found = F.regexp_extract_all(canon, rule["pattern"], F.lit(0))
    start = F.struct(F.lit(0).alias("words"), F.array().cast("array<struct<first:int,last:int>>").alias("got"))

    def step(acc: Column, pair: Column) -> Column:
        first = acc["words"] + _n_words(pair["before"])
        n = _n_words(pair["match"])
        return F.struct(
            (first + n).alias("words"),
            F.concat(acc["got"], F.array(F.struct(first.alias("first"), (first + n - 1).alias("last")))).alias("got"),
        )

    pairs = F.transform(found, lambda m, i: F.struct(F.get(pieces, i).alias("before"), m.alias("match")))
    return F.transform(
        F.aggregate(pairs, start, step, lambda acc: acc["got"]),
        lambda x: F.struct(
            x["first"].alias("first"), (-x["last"]).alias("minus_last"), (-rule["priority"]).alias("minus_priority"),
            rule["rank"].alias("rank"), rule["label"].alias("label"),
        ),
    )


_MATCH = "array<struct<first:int,minus_last:int,minus_priority:int,rank:int,label:string>>"


def _kept(matches: Column, levels: int) -> Column:
    """Matches that no match of equal or higher priority holds, by one sweep over sorted matches.

    Sorted by start, then longest, then highest priority: whatever holds a match comes before
    it, and holds it if it reaches as far. The sweep carries how far each priority has reached.
    """
    start = F.struct(
        F.array_repeat(F.lit(-1), levels + 1).alias("reach"), F.array().cast(_MATCH).alias("kept")
    )

    def step(acc: Column, m: Column) -> Column:
        level, last = -m["minus_priority"], -m["minus_last"]
        held = F.get(acc["reach"], level) >= last
        reach = F.transform(acc["reach"], lambda r, i: F.when(i <= level, F.greatest(r, last)).otherwise(r))
        return F.struct(
            reach.alias("reach"), F.when(held, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(m))).alias("kept")
        )

    return F.aggregate(F.array_sort(matches), start, step, lambda acc: acc["kept"])


def detections(canon: Column, rule_list: list[Rule] | None = None) -> Column:
    """Kept matches of all rules in a canonical text."""
    rule_list = rules() if rule_list is None else rule_list
    by_anchor: dict[str, list[Rule]] = {}
    for r in rule_list:
        by_anchor.setdefault(r.anchor, []).append(r)
    parts = []
    for anchor, some in by_anchor.items():
        table = F.array(*[
            F.struct(F.lit(r.rank).alias("rank"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
                     F.lit(r.pattern).alias("pattern"), F.lit(r.priority).alias("priority"))
            for r in some
        ])
        run = F.flatten(
            F.transform(F.filter(table, lambda r: F.contains(canon, r["keyword"])), lambda r: _intervals(canon, r))
        )
        parts.append(F.when(F.contains(canon, F.lit(anchor)), run).otherwise(F.array().cast(_MATCH)))
    return _kept(F.concat(*parts), max(r.priority for r in rule_list))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator, so that Catalyst computes them once instead of in every use."""
    kept = [F.col(c) for c in df.columns]
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*kept, F.explode(F.array(made)).alias("_made")).select(*kept, *[F.col(f"_made.{n}").alias(n) for n in columns])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts and places of the base phrases, labels, score and the detections.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches``;
    ``score`` is the share of words that kept matches hold, each match counted, 1 at most.
    """
    one = docs.select(F.col(id_col).alias("doc_id"), canonical(F.col(text_col)).alias("canon"))
    # A text without any anchor word is left after this one search.
    anchors = "|".join(sorted({r.anchor for r in rules()} | set(BASE_PHRASES)))
    one = _once(one.select("doc_id", F.col("canon")), n_words=_n_words(F.col("canon")).cast("bigint"))
    base_pattern = f"(?<![^ ])(?:{'|'.join(BASE_PHRASES)})(?![^ ])"
    has_base = F.lit(False)
    for phrase in BASE_PHRASES:
        has_base = has_base | F.contains(F.col("canon"), F.lit(phrase))
    nothing = F.array().cast("array<string>")
    two = _once(
        one,
        hits=F.when(has_base, F.regexp_extract_all("canon", F.lit(base_pattern), F.lit(0))).otherwise(nothing),
        pieces=F.when(has_base, F.split("canon", base_pattern, -1)).otherwise(nothing),
        matches=F.when(F.col("canon").rlike(anchors), detections(F.col("canon"))).otherwise(F.array().cast(_MATCH)),
    )
    last_piece, last_hit = F.element_at("pieces", -1), F.element_at("hits", -1)
    some = F.size("hits") > 0
    name = F.create_map(*[F.lit(x) for pair in BASE_PHRASES.items() for x in pair])
    base = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.element_at(name, h))))
    held = F.aggregate("matches", F.lit(0), lambda a, m: a - m["minus_last"] - m["first"] + 1)
    return two.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_base"),
        F.when(some, _n_words(F.get("pieces", F.lit(0)))).cast("bigint").alias("first_word"),
        F.when(some, F.col("n_words") - _n_words(last_piece) - _n_words(last_hit)).cast("bigint").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_distinct(F.concat(base, F.transform("matches", lambda m: m["label"])))), ","
        ).alias("labels"),
        F.when(F.col("n_words") > 0, F.least(F.lit(1.0), held / F.col("n_words"))).otherwise(0.0).alias("score"),
        F.transform(
            "matches",
            lambda m: F.struct(m["first"].alias("first"), (-m["minus_last"]).alias("last"), m["label"].alias("label")),
        ).alias("matches"),
    )
