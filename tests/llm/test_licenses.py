"""Diagonal votes against brute force, and licences whose notices differ in a few words."""

import re

import pytest

from tidemark.llm import licenses

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GPL = "This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation{2} either version {3} of the License, or (at your option) any later version."
NOTICES = [
    (GPL.format(";", "", ";", "2"), "gpl-2"),
    (GPL.format(":", "", ",", "3"), "gpl-3"),
    (GPL.format(":", "Affero ", ",", "3"), "agpl-3"),
    (GPL.format(";", "Lesser ", ";", "2.1").replace("program", "library"), "lgpl-2.1"),
    (GPL.format(":", "Lesser ", ",", "3").replace("program", "library"), "lgpl-3"),
    (GPL.format(":", "Lesser ", ",", "3"), "lgpl-3"),
    ("This work is under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("Attribution-ShareAlike 4.0 International", "cc-by-sa"),
    ("Attribution-NonCommercial 4.0 International", "cc-by-nc"),
    ("Attribution-NoDerivatives 4.0 International", "cc-by-nd"),
    ("Attribution-NonCommercial-ShareAlike 4.0 International", "cc-by-nc-sa"),
    ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "cc-by-nc-nd"),
    ("Creative Commons Attribution-ShareAlike 3.0 Unported", "cc-by-sa"),
    ("see https://creativecommons.org/licenses/by-nc-sa/4.0/legalcode", "cc-by-nc-sa"),
    ("see https://creativecommons.org/licenses/by/4.0/", "cc-by"),
    ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("The Apache Software License, Version 1.1", "apache-1.1"),
    ("made available under the terms of the Eclipse Public License v2.0", ""),
    ("made available under the terms of the Eclipse Public License 2.0", "epl-2"),
    ("made available under the terms of the Eclipse Public License v1.0", "epl-1"),
    ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License", "mpl-1.1"),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
]


def low(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(words):
    return [tuple(words[i : i + licenses.GRAM]) for i in range(len(words) - licenses.GRAM + 1)]


def voted(text, templates):
    """Labels and score by comparing every gram of the text with every gram of every template."""
    words = grams(low(text))
    labels, score = set(), 0.0
    for label, base, own in templates:
        on: dict[int, set[int]] = {}
        for at, gram in enumerate(words):
            for offset, other in enumerate(own):
                if gram == other:
                    on.setdefault(at - offset, set()).add(offset)
        spans, last = [], None
        for diagonal in sorted(on):
            if last is not None and not base and diagonal - last <= licenses.DRIFT:
                spans[-1] |= on[diagonal]
            else:
                spans.append(set(on[diagonal]))
            last = diagonal
        for held in spans:
            share = len(held) / len(own)
            good = share == 1 if base else share >= licenses.ACCEPT
            for rival, _, theirs in templates:
                if good and not base and rival != label and set(own) & set(theirs):
                    telling = {i for i, gram in enumerate(own) if gram not in theirs}
                    good = len(telling & held) >= licenses.TELLING * len(telling)
            if good:
                labels.add(label)
                score = max(score, share)
    return ",".join(sorted(labels)), score


@pytest.fixture(scope="module")
def templates():
    return [(label, base, grams(low(text))) for _, label, base, text in licenses.templates()]


def test_every_licence_gets_its_own_label_only(spark):
    rows = [(i, f"Some words before. {text} And words behind it.") for i, (text, _) in enumerate(NOTICES)]
    found = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(NOTICES[i][0], found[i]) for i in found] == [(NOTICES[i][0], NOTICES[i][1]) for i in found] and len(found) == len(NOTICES)


def test_several_licences_in_one_text(spark):
    text = "\n\n".join([*(text for text, _ in NOTICES), "under the MIT license"])
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert set(row.labels.split(",")) == {label for _, label in NOTICES if label} | {"mit"} and row.base_labels == "apache-2,mit"


def test_votes_equal_brute_force(spark, templates):
    """Whole documents, and notices of which words are lost, doubled or replaced."""
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for text, _ in NOTICES:
        words = text.split()
        texts += [" ".join(w for i, w in enumerate(words) if i % step != step - 1) for step in (4, 7, 11)]
        texts += [" ".join(w for i, w in enumerate(words) for _ in range(1 + (i % 9 == 5))), " ".join("other" if i % 8 == 3 else w for i, w in enumerate(words))]
    texts += [None, "", "all rights", "all rights reserved " * 3]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        labels, score = voted(texts[r.doc_id], templates)
        assert (r.labels, round(r.score, 12)) == (labels, round(score, 12)), texts[r.doc_id]


def test_every_template_is_told_from_the_others(spark):
    """No template lies whole within one of another label, or it could not be verified beside it."""
    for template, telling in licenses.telling_grams(licenses.template_grams(spark).collect()):
        if template >= len(licenses.PHRASES):
            assert all(telling), licenses.templates()[template]
