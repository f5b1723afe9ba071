"""License scanning with ordered signature rules, in DataFrame functions only.

A rule is a regular expression on the text with A-Z lower-cased, with groups of keywords of each of which one must occur before
it is tried, a label, a priority (1 is best) and a confidence. The rules come from a hand-written list of licenses, each with the names it
goes by, set into the phrases that licenses are granted with, and from hand-written single rules.

1. A text is looked at only if it holds one of a few stems. Which of all keywords it holds is found once, as bits; the rules that
   these bits allow are tried one by one.
2. Every match is a span. Spans of one document are put in order of start, end and priority; a span that lies inside one of the
   same or a better priority is dropped. That takes running maxima over the spans of a document, no comparison of all pairs.
3. What remains gives the labels; the best confidence is the score.

Word counts and base phrases are computed in the row itself. Only the spans are shuffled, never the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.arrow_text import ID, id_and_text

# What stands between words, before and after A-Z were lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

CC_BY = ("cc-by", "cc by", "cc+by", "creative commons attribution")

# label: (keywords, one of which the name holds, with single blanks; expression for the name)
NAMES = {
    "mit": (("mit",), r"(?:the )?(?:mit|expat|x11)"),
    "mit-0": (("mit",), r"(?:the )?mit(?:-| )(?:0|no attribution)"),
    "apache-2": (("apache",), r"(?:the )?apache(?: software)?(?:-| )(?:licen[cs]e,? ?)?(?:version |v)?2(?:\.0)?"),
    "apache-1.1": (("apache",), r"(?:the )?apache(?: software)?(?:-| )(?:licen[cs]e,? ?)?(?:version |v)?1\.1"),
    "gpl-2": (("gpl", "general public"), r"(?:the )?(?:gnu )?(?:gpl|general public licen[cs]e)(?:,)?(?:-| )?(?:version |v)?2(?:\.0)?(?:-only|-or-later)?"),
    "gpl-3": (("gpl", "general public"), r"(?:the )?(?:gnu )?(?:gpl|general public licen[cs]e)(?:,)?(?:-| )?(?:version |v)?3(?:\.0)?(?:-only|-or-later)?"),
    "lgpl-2.1": (("lgpl", "lesser general public"), r"(?:the )?(?:gnu )?(?:lgpl|lesser general public licen[cs]e)(?:,)?(?:-| )?(?:version |v)?2\.1(?:-only|-or-later)?"),
    "lgpl-3": (("lgpl", "lesser general public"), r"(?:the )?(?:gnu )?(?:lgpl|lesser general public licen[cs]e)(?:,)?(?:-| )?(?:version |v)?3(?:\.0)?(?:-only|-or-later)?"),
    "agpl-3": (("agpl", "affero general public"), r"(?:the )?(?:gnu )?(?:agpl|affero general public licen[cs]e)(?:,)?(?:-| )?(?:version |v)?3(?:\.0)?(?:-only|-or-later)?"),
    "bsd-2-clause": (("bsd",), r"(?:the )?(?:bsd[- ]2[- ]clause|2[- ]clause bsd|simplified bsd|freebsd)"),
    "bsd-3-clause": (("bsd",), r"(?:the )?(?:bsd[- ]3[- ]clause|3[- ]clause bsd|new bsd|modified bsd)"),
    "bsd-4-clause": (("bsd",), r"(?:the )?(?:bsd[- ]4[- ]clause|4[- ]clause bsd|original bsd)"),
    "0bsd": (("bsd",), r"(?:the )?(?:0bsd|zero[- ]clause bsd)"),
    "isc": (("isc",), r"(?:the )?isc"),
    "mpl-1.1": (("mpl", "mozilla public"), r"(?:the )?(?:mozilla public licen[cs]e|mpl)(?:,)?(?:-| )?(?:version |v)?1\.1"),
    "mpl-2": (("mpl", "mozilla public"), r"(?:the )?(?:mozilla public licen[cs]e|mpl)(?:,)?(?:-| )?(?:version |v)?2(?:\.0)?"),
    "epl-1": (("epl", "eclipse public"), r"(?:the )?(?:eclipse public licen[cs]e|epl)(?:,)?(?:-| )?(?:version |v)?1(?:\.0)?"),
    "epl-2": (("epl", "eclipse public"), r"(?:the )?(?:eclipse public licen[cs]e|epl)(?:,)?(?:-| )?(?:version |v)?2(?:\.0)?"),
    "eupl-1.2": (("eupl", "european union public"), r"(?:the )?(?:european union public licen[cs]e|eupl)(?:,)?(?:-| )?(?:version |v)?1\.2"),
    "cddl-1": (("cddl", "common development"), r"(?:the )?(?:common development and distribution licen[cs]e|cddl)(?:,)?(?:-| )?(?:version |v)?1\.[01]"),
    "cpl-1": (("common public",), r"(?:the )?common public licen[cs]e(?:,)?(?:-| )?(?:version |v)?1(?:\.0)?"),
    "artistic-2": (("artistic",), r"(?:the )?artistic licen[cs]e(?:,)?(?:-| )?(?:version |v)?2(?:\.0)?"),
    "bsl-1": (("boost",), r"(?:the )?boost software licen[cs]e(?:,)?(?:-| )?(?:version |v)?1(?:\.0)?"),
    "zlib": (("zlib",), r"(?:the )?zlib(?:/libpng)?"),
    "unlicense": (("unlicense",), r"(?:the )?unlicense"),
    "wtfpl": (("wtfpl",), r"(?:the )?wtfpl(?:v2)?"),
    "ofl-1.1": (("ofl", "open font"), r"(?:the )?(?:sil )?(?:open font licen[cs]e|ofl)(?:,)?(?:-| )?(?:version |v)?1\.1"),
    "psf-2": (("psf", "python software"), r"(?:the )?(?:python software foundation licen[cs]e|psf)(?:,)?(?:-| )?(?:version |v)?2(?:\.0)?"),
    "postgresql": (("postgresql",), r"(?:the )?postgresql"),
    "cc0": (("cc0", "creative commons zero"), r"(?:the )?(?:cc0|creative commons zero)(?:[- ]1\.0)?"),
    "cc-by": (CC_BY, r"(?:the )?(?:cc[- ]by|creative commons attribution)(?:[- ][1-4]\.[05])?"),
    "cc-by-sa": (CC_BY, r"(?:the )?(?:cc[- ]by[- ]sa|creative commons attribution[- ]share[- ]?alike)(?:[- ][1-4]\.[05])?"),
    "cc-by-nc": (CC_BY, r"(?:the )?(?:cc[- ]by[- ]nc|creative commons attribution[- ]non[- ]?commercial)(?:[- ][1-4]\.[05])?"),
    "cc-by-nd": (CC_BY, r"(?:the )?(?:cc[- ]by[- ]nd|creative commons attribution[- ]no[- ]?deriv(?:ative)?s)(?:[- ][1-4]\.[05])?"),
    "cc-by-nc-sa": (CC_BY, r"(?:the )?cc[- ]by[- ]nc[- ]sa(?:[- ][1-4]\.[05])?"),
    "cc-by-nc-nd": (CC_BY, r"(?:the )?cc[- ]by[- ]nc[- ]nd(?:[- ][1-4]\.[05])?"),
    "odbl": (("odbl", "open database"), r"(?:the )?(?:open database licen[cs]e|odbl)(?:[- ](?:v)?1\.0)?"),
    "ms-pl": (("ms-pl", "microsoft public"), r"(?:the )?(?:microsoft public licen[cs]e|ms-pl)"),
    "ncsa": (("ncsa",), r"(?:the )?(?:university of illinois/)?ncsa(?: open source)?"),
    "upl-1": (("upl", "universal permissive"), r"(?:the )?(?:universal permissive licen[cs]e|upl)(?:,)?(?:-| )?(?:version |v)?1(?:\.0)?"),
    "sspl-1": (("sspl", "server side public"), r"(?:the )?(?:server side public licen[cs]e|sspl)(?:,)?(?:-| )?(?:version |v)?1"),
    "busl-1.1": (("busl", "business source"), r"(?:the )?(?:business source licen[cs]e|busl)(?:,)?(?:-| )?(?:version |v)?1\.1"),
}

# (priority, confidence, keyword, phrase around a name); blanks stand for any separators.
GRANTS = [
    (1, 1.0, "spdx", r"spdx-license-identifier: ?{name}"),
    (1, 0.95, "licen", r"licen[cs]ed under(?: the terms of)? {name}(?:[ ,]*licen[cs]e)?"),
    (1, 0.95, "releas", r"released under(?: the terms of)? {name}(?:[ ,]*licen[cs]e)?"),
    (1, 0.9, "under", r"(?:distributed|available|published|provided|used|made available) under(?: the terms of)? {name}(?:[ ,]*licen[cs]e)?"),
    (2, 0.8, "licen", r"{name} licen[cs]e"),
    (2, 0.8, "licen", r"licen[cs]e ?: ?{name}"),
]

# label, priority, confidence, keywords, expression
SINGLE = [
    ("mit", 1, 1.0, ["permission is hereby granted"], r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", 1, 1.0, ["permission to use"], r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose"),
    ("bsd", 1, 0.9, ["redistribution and use"], r"redistribution and use in source and binary forms, with or without modification"),
    ("gpl", 1, 0.9, ["free software"], r"this program is free software[:;] you can redistribute it"),
    ("unlicense", 1, 1.0, ["public domain"], r"this is free and unencumbered software released into the public domain"),
    ("public-domain", 2, 0.7, ["public domain"], r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("zlib", 1, 0.9, ["as-is"], r"this software is provided 'as-is', without any express or implied warranty"),
    ("apache-2", 1, 1.0, ["apache.org"], r"https?://www\.apache\.org/licenses/license-2\.0"),
    ("cc-by", 1, 0.9, ["creativecommons.org"], r"https?://creativecommons\.org/licenses/by/[1-4]\.[05]"),
    ("cc-by-sa", 1, 0.9, ["creativecommons.org"], r"https?://creativecommons\.org/licenses/by-sa/[1-4]\.[05]"),
    ("cc-by-nc", 1, 0.9, ["creativecommons.org"], r"https?://creativecommons\.org/licenses/by-nc/[1-4]\.[05]"),
    ("cc0", 1, 0.9, ["creativecommons.org"], r"https?://creativecommons\.org/publicdomain/zero/1\.0"),
    ("gpl", 1, 0.8, ["gnu.org"], r"https?://www\.gnu\.org/licenses/"),
    ("proprietary", 2, 0.6, ["all rights reserved"], r"all rights reserved"),
    ("proprietary", 2, 0.8, ["proprietary"], r"(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", 2, 0.8, ["without permission"], r"may not be (?:reproduced|copied|distributed)[^.]{0,60} without permission"),
    ("copyright-notice", 3, 0.4, ["copyright"], r"copyright (?:\(c\) |© )?(?:19|20)[0-9]{2}"),
    ("unknown-license", 3, 0.3, ["licen"], r"licen[cs]ed under [^.\n]{1,60}"),
]

# A text with none of these is passed over: every keyword and base phrase holds one.
STEMS = r"(?i)licen[cs]|spdx|releas|under|cc[^a-z0-9]+by|permission|redistribution|free software|public domain|as-is|apache\.org|creativecommons|gnu\.org|rights reserved|proprietary|copyright"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keywords: tuple[tuple[str, ...], ...]
    pattern: str


_EDGE = r"(?<![a-z0-9\x80-\x{10FFFF}])(?:%s)(?![a-z0-9\x80-\x{10FFFF}])"


def rules() -> list[Rule]:
    """All rules in order. A blank in an expression stands for white space of any length."""
    made = [Rule(label, p, c, tuple((one,) for one in k), x) for label, p, c, k, x in SINGLE]
    for label, (keyword, name) in NAMES.items():
        made += [Rule(label, p, c, ((k,), keyword), x.replace("{name}", f"(?:{name})")) for p, c, k, x in GRANTS]
    wide = [Rule(r.label, r.priority, r.confidence, r.keywords, _EDGE % r.pattern.replace(" ", r"\s+").replace(r"\s+?", r"\s*")) for r in made]
    return sorted(wide, key=lambda r: r.priority)


WORD_BITS = 62


def _gates(every: list[Rule]) -> tuple[list[list[str]], list[Column]]:
    """The different keywords, in words of at most WORD_BITS, and of each rule its groups as (word, bits)."""
    words: list[list[str]] = [[]]
    place: dict[tuple[str, ...], tuple[int, int]] = {}
    for group in dict.fromkeys(g for r in every for g in r.keywords):
        if len({*words[-1], *group}) > WORD_BITS:
            words.append([])
        words[-1] += [k for k in group if k not in words[-1]]
        place[group] = len(words) - 1, sum(1 << words[-1].index(k) for k in group)
    gates = [F.array(*[F.struct(F.lit(w).alias("word"), F.lit(bits).cast("long").alias("bits")) for w, bits in map(place.get, r.keywords)]) for r in every]
    return words, gates


def _held(flat: Column, words: list[list[str]]) -> Column:
    """For each word of keywords the bits of those that a text holds."""
    return F.array(*[
        sum((F.when(F.contains(flat, F.lit(k)), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, k in enumerate(word)), F.lit(0).cast("long"))
        for word in words
    ])


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _phrases(spaced: Column, n_words: Column) -> dict[str, Column]:
    """Places of the base phrases in a text whose words stand between two blanks each."""
    found, counts, firsts, lasts, labels = {}, [], [], [], []
    for phrase, label in BASE.items():
        words = phrase.split(" ")
        parts = F.split(spaced, "".join(f" {w} " for w in words), -1)
        blanks = [F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit(""))) for p in (F.element_at(parts, 1), F.element_at(parts, -1))]
        n = (F.size(parts) - 1).cast("long")
        counts.append(n)
        firsts.append(F.when(n > 0, (blanks[0] / 2).cast("long")))
        lasts.append(F.when(n > 0, n_words - (blanks[1] / 2).cast("long") - len(words)))
        labels.append(F.when(n > 0, F.lit(label)))
    found["n_base"] = sum(counts[1:], counts[0])
    found["first_word"], found["last_word"] = F.least(*firsts), F.greatest(*lasts)
    found["base_list"] = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    return found


def _counted(docs: DataFrame, **names: str) -> DataFrame:
    """doc_id, a hash of the text, n_words, n_base, first_word, last_word, base_list."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Words are one more than the blanks between them; a list of the words would cost twice as much.
    words = F.trim(F.regexp_replace(text, BETWEEN_ANY_CASE, " "))
    n_words = F.when(F.length(words) > 0, F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1).otherwise(0)
    rows = id_and_text(docs, **names).withColumn("n_words", n_words.cast("long"))
    looked = rows.withColumn("looked", F.when(text.rlike(r"(?i)licen|cc[^a-z0-9]+by"), F.regexp_replace(_lowered(text), BETWEEN, " ")))
    one = F.trim("looked")
    spaced = F.when(F.length(one) > 0, F.concat(F.lit(" "), F.replace(one, F.lit(" "), F.lit("  ")), F.lit(" ")))
    told = looked.withColumns(_phrases(F.coalesce(spaced, F.lit("")), F.col("n_words")))
    return told.select(ID, F.xxhash64("text").alias("at"), "n_words", "n_base", "first_word", "last_word", "base_list")


def detections(docs: DataFrame, **names: str) -> DataFrame:
    """Every span that a rule matched: doc_id, at (hash of the text), start, stop (characters from 0), rule (its place in
    the order), label, priority, confidence, and kept (not inside a span of the same or a better priority).

    Rows that repeat a document give its spans once. Null and empty texts have none.
    """
    made = rules()
    words, gates = _gates(made)
    every = F.array(*[
        F.struct(
            F.lit(i).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
            F.lit(r.confidence).alias("confidence"), gate.alias("gate"), F.lit(r.pattern).alias("pattern"),
        )
        for i, (r, gate) in enumerate(zip(made, gates, strict=True))
    ])
    looked = id_and_text(docs, **names).filter(F.col("text").rlike(STEMS)).select(ID, F.xxhash64("text").alias("at"), _lowered(F.col("text")).alias("low"))
    looked = looked.withColumn("held", _held(F.regexp_replace("low", r"\s+", " "), words))
    allowed = lambda gate: (F.get("held", gate["word"]).bitwiseAND(gate["bits"])) != 0
    tried = F.filter(every, lambda r: F.forall(r["gate"], allowed))
    pairs = looked.select(ID, "at", "low", F.explode(tried).alias("r"))
    matched = pairs.withColumn("found", F.regexp_extract_all("low", F.col("r.pattern"), F.lit(0))).filter(F.size("found") > 0)
    gaps = F.split("low", F.col("r.pattern"), -1)
    lengths = F.transform("found", lambda x, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(x).alias("size")))
    placed = matched.select(ID, "at", *[f"r.{c}" for c in ("rule", "label", "priority", "confidence")], F.posexplode(lengths).alias("k", "l"))
    placed = placed.select(ID, "at", "rule", "label", "priority", "confidence", "k", "l.gap", "l.size").distinct()
    along = W.partitionBy(ID, "at", "rule").orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)
    spans = placed.withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(along)).withColumn("start", F.col("stop") - F.col("size"))
    before = W.partitionBy(ID, "at").orderBy("start", F.desc("stop"), "priority", "rule").rowsBetween(W.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("priority") <= p, F.col("stop"))).over(before) for p in (1, 2, 3)]
    mine = F.when(F.col("priority") == 1, F.col("reach_1")).when(F.col("priority") == 2, F.col("reach_2")).otherwise(F.col("reach_3"))
    judged = spans.withColumns({f"reach_{p + 1}": r for p, r in enumerate(reach)}).withColumn("kept", F.coalesce(mine < F.col("stop"), F.lit(True)))
    return judged.select(ID, "at", "start", "stop", "rule", "label", "priority", "confidence", "kept")


def scan(docs: DataFrame, **names: str) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score (0 to 1).

    A null text counts as empty: no words, no labels (empty strings), score 0. Repeated rows each have their row.
    """
    found = detections(docs, **names).filter("kept").groupBy(ID, "at").agg(F.collect_set("label").alias("own"), F.max("confidence").alias("best"))
    found = found.select(F.col(ID).alias("found_id"), F.col("at").alias("found_at"), "own", "best")
    counted = _counted(docs, **names)
    both = counted.join(found, F.col(ID).eqNullSafe(F.col("found_id")) & (F.col("at") == F.col("found_at")), "left")
    own = F.coalesce("own", F.array().cast("array<string>"))
    score = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(0.9)).otherwise(F.lit(0.0)))
    return both.select(
        ID, "n_words", "n_base", "first_word", "last_word", F.array_join("base_list", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_list", own)), ",").alias("labels"), score.alias("score"),
    )
