import re

from millrace.llm import licenses as l
from tests.conftest import rows
from tests.llm.helpers import ALNUM, ODD, documents, lowered, table


def base(text):
    """n_words, n_base, first_word, last_word, base_labels of one text, word by word."""
    words = ALNUM.findall(lowered(text))
    places, labels = [], set()
    for phrase, label in l.BASE.items():
        parts = phrase.split(" ")
        found = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def checked(docs):
    got = rows(l.scan(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted(((r.doc_id, *base(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)


def test_base_phrases_as_by_brute_force(spark):
    checked(table(spark, "documents"))


def test_odd_texts_overlapping_places_and_clashing_columns(spark):
    texts = [
        *ODD, "Under the MIT license under the mit license", "CC-BY--NC cc by nc, cc\nby\tnc", "apache license, version 2", "under the mit licenses",
        "cc by ncé", "cc_by_nc", "xcc by nc", "Apache License Version 2.0 cc by nc under the mit license",
    ]
    docs = documents(spark, texts, extra=["at", "low", "rule", "label", "found", "looked"])
    checked(docs)
    for r in l.scan(docs).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_rules_name_licenses_and_inner_spans_go(spark):
    texts = {
        "SPDX-License-Identifier: Apache-2.0": "apache-2",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of": "mit",
        "Released under the BSD 3-clause license": "bsd-3-clause",
        "nothing of the kind, all in all": "",
        "it is LICENSED under a house rule of ours": "unknown-license",
        "licensed under cc by-nc-sa 4.0": "cc-by-nc,cc-by-nc-sa",  # the base phrase keeps its label
        "licensed under cc-by-nd 4.0": "cc-by-nd",
    }
    docs = documents(spark, list(texts))
    got = {r.doc_id: r.labels for r in l.scan(docs).collect()}
    assert {t: got[i] for i, t in enumerate(texts)} == texts


def test_spans_are_where_the_rules_match_and_suppression_as_by_pairs(spark):
    texts = [
        "licensed under the mit license. licensed under the mit license or the apache license 2.0; all rights reserved",
        "copyright (c) 2020 x. all rights reserved. released under the terms of the gpl v2 license. license: mpl 2.0",
        "License : MIT  license\nspdx-license-identifier: MIT",
    ]
    docs, every = documents(spark, texts), l.rules()
    wanted = []
    for i, text in enumerate(texts):
        low, spans = lowered(text), []
        flat = re.sub(r"\s+", " ", low)
        for k, rule in enumerate(every):
            if all(any(w in flat for w in group) for group in rule.keywords):
                pattern = re.compile(rule.pattern.replace(r"\x{10FFFF}", "\U0010ffff"), re.ASCII)
                spans += [(m.start(), m.end(), rule.priority, k) for m in pattern.finditer(low)]
        for s, e, p, k in spans:
            inside = any(
                (s2 <= s and e <= e2 and p2 <= p) and ((s2, -e2, p2, k2) < (s, -e, p, k)) for s2, e2, p2, k2 in spans
            )
            wanted.append((i, s, e, k, not inside))
    assert rows(l.detections(docs), "doc_id", "start", "stop", "rule", "kept") == sorted(wanted, key=repr) and len(wanted) > 8


def test_keywords_leave_out_no_match_and_few_rules_are_tried(spark):
    """Keywords are words of the name itself; without them every rule is tried on every text, with the same spans."""
    every = l.rules()
    assert len(every) > 200 and all(len(k) >= 3 for r in every for group in r.keywords for k in group)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    names = ["the gnu gpl version 2", "CC BY-NC 4.0", "mozilla public\nlicense 2.0", "the isc", "zlib", "creative  commons zero 1.0", "psf 2.0", "epl-2.0"]
    more = documents(spark, [(10**6 + i, f"licensed under {n}") for i, n in enumerate(names)]).select("doc_id", "text")
    tried = {}
    for r in docs.unionAll(more).collect():
        low = lowered(r.text or "")
        flat = re.sub(r"\s+", " ", low)
        for k, rule in enumerate(every):
            pattern = re.compile(rule.pattern.replace(r"\x{10FFFF}", "\U0010ffff"), re.ASCII)
            allowed = all(any(w in flat for w in group) for group in rule.keywords)
            assert allowed or rule.label not in l.NAMES or len(rule.keywords) < 2 or "mit" in flat or not pattern.search(low), (rule, r.text)
            tried[r.doc_id] = tried.get(r.doc_id, 0) + allowed
    some = [n for n in tried.values() if n]
    assert sum(some) / len(some) < 20


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = documents(spark, [(None, "under the mit license"), (2, "cc by nc"), (2, "cc by nc"), (2, "plain"), (4, None)])
    got = rows(l.scan(docs), "doc_id", "n_base", "labels")
    mit = got[-1][2] if got[-1][0] is None else [r for r in got if r[0] is None][0][2]
    assert "mit" in mit.split(",") and sorted(r[:2] for r in got if r[0] is not None) == [(2, 0), (2, 1), (2, 1), (4, 0)]
    assert l.scan(docs.limit(0)).count() == 0
