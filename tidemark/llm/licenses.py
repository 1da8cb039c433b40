"""License notices by diagonal voting, in DataFrame operations only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. All rolling ``GRAM``-word hashes of a text
are joined with the positions of the same words in the templates (a fixed table, broadcast); the words themselves are
compared as well, so a hash alone decides nothing. A hit votes for the diagonal ``document position - template
position``. Neighbouring diagonals, ``DRIFT`` words apart at most, are merged, since an inserted or lost word moves the
rest of a notice by one. A merged span is verified twice: it holds ``ACCEPT`` of its template's grams, and, for every
template of another label, ``TELLING`` of the grams that this one has and the other lacks. Notices of two licences that
differ in a few words are so told apart by those words. The base phrases are templates that must be whole on one
diagonal.

Texts without any template gram send one row to the aggregation, others one row for each hit.

Defined cases: a null or empty text has n_words 0, no labels (empty strings), score 0 and null places. Rows are told
apart by their place in the input, so repeated rows and null ids get a row each. Ties do not arise: labels are sets.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import metadata_frame

GRAM, DRIFT = 3, 2
ACCEPT, TELLING = 0.7, 0.5

# Phrases that give a label wherever their words stand consecutively.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Opening statements of well-known licences and customary notices.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-1.1", "The Apache Software License, Version 1.1"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("lgpl-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("lgpl-3", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("lgpl-3", "licensed under the GNU Lesser General Public License, version 3"),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    ("mpl-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl-1", "made available under the terms of the Eclipse Public License v1.0"),
    ("epl-2", "made available under the terms of the Eclipse Public License 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("all-rights-reserved", "all rights reserved"),
)
# The Creative Commons licences, by the elements of their names.
ELEMENTS = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
COMMONS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
VERSIONS = ("4.0", "3.0")


def templates() -> list[tuple[int, str, bool, str]]:
    """``(template, label, base, text)``: phrases, notices, and the full, short and linked names of Creative Commons."""
    commons = []
    for name in COMMONS:
        full = "-".join(ELEMENTS[e] for e in name.split("-"))
        for version in VERSIONS:
            kind = "International" if version == "4.0" else "Unported"
            commons += [(f"cc-{name}", f"{full} {version} {kind}"), (f"cc-{name}", f"licensed under CC {name.upper()} {version}")]
            commons += [(f"cc-{name}", f"creativecommons.org/licenses/{name}/{version}")]
    return [(i, label, i < len(PHRASES), text) for i, (label, text) in enumerate((*PHRASES, *NOTICES, *commons))]


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, lower-cased in A-Z; none for a null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()), _BETWEEN), "")


def _gram(words: Column, at: Column) -> Column:
    return F.xxhash64(*(F.get(words, at + i) for i in range(GRAM)))


def template_grams(spark: SparkSession) -> DataFrame:
    """``template, label, base, n_grams, hash, offset, gram``: every position of every template."""
    frame = metadata_frame(spark, templates(), "template int, label string, base boolean, text string").withColumn("words", words_of(F.col("text")))
    frame = frame.withColumn("n_grams", F.size("words") - GRAM + 1)
    frame = frame.select("*", F.explode(F.sequence(F.lit(0), F.col("n_grams") - 1)).alias("offset"))
    gram = F.slice("words", F.col("offset") + 1, F.lit(GRAM))
    return frame.select("template", "label", "base", "n_grams", "offset", gram.alias("gram"), _gram(F.col("words"), F.col("offset")).alias("hash"))


def telling_grams(grams: list[Row]) -> list[tuple[int, list[list[int]]]]:
    """``(template, offsets)``: for each template of another label, the offsets of the grams that it lacks.

    Only templates with a gram in common are rivals. ``grams`` are the rows of :func:`template_grams`.
    """
    held: dict[int, dict[int, tuple[str, ...]]] = {}
    labels = {r["template"]: r["label"] for r in grams}
    for r in grams:
        held.setdefault(r["template"], {})[r["offset"]] = tuple(r["gram"])
    out = []
    for one, own in held.items():
        rivals = [set(held[other].values()) for other in held if labels[other] != labels[one]]
        out.append((one, [[at for at, gram in own.items() if gram not in rival] for rival in rivals if rival & set(own.values())]))
    return out


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row."""
    spark = docs.sparkSession
    grams = template_grams(spark)
    listed_grams = grams.collect()  # fixed by the lists above
    known = F.array(*(F.lit(h) for h in sorted({r["hash"] for r in listed_grams})))
    telling = metadata_frame(spark, telling_grams(listed_grams), "template int, telling array<array<int>>")

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("doc_id"), words_of(F.col(text)).alias("words"))
    rows = rows.withColumn("hashes", F.transform("words", lambda _, i: _gram(F.col("words"), i)))
    rows = rows.withColumn("hashes", F.when(F.arrays_overlap("hashes", known), F.col("hashes")))
    rows = rows.select("row", "doc_id", "words", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("hashes").alias("at", "hash"))
    hits = rows.join(F.broadcast(grams), (rows["hash"] == grams["hash"]) & (F.slice("words", F.col("at") + 1, F.lit(GRAM)) == F.col("gram")), "left")
    hits = hits.filter("template is not null or at is null or at = 0")
    hits = hits.select("row", "doc_id", "n_words", "template", "label", "base", "n_grams", "offset", (F.col("at") - F.col("offset")).alias("diagonal"))

    document = ["row", "doc_id", "n_words"]
    template = [*document, "template", "label", "base", "n_grams"]
    votes = hits.repartition("row").groupBy(*template, "diagonal").agg(F.collect_set("offset").alias("offsets"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT)
    votes = votes.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int")).withColumn("span", F.sum("apart").over(order))
    held = F.array_distinct(F.flatten(F.collect_list("offsets")))
    spans = votes.groupBy(*template, "span").agg(held.alias("held"), F.min("diagonal").cast("long").alias("start"))
    spans = spans.join(F.broadcast(telling), "template", "left").withColumn("share", F.size("held") / F.col("n_grams"))
    told = F.forall("telling", lambda at: F.size(F.array_intersect("held", at)) >= TELLING * F.size(at))

    whole = F.col("base") & (F.col("share") == 1)
    found = F.when(F.col("base"), whole).otherwise((F.col("share") >= ACCEPT) & told)
    listed = lambda taken: F.array_join(F.array_sort(F.collect_set(F.when(taken, F.col("label")))), ",")
    place = F.when(whole, F.col("start"))
    return spans.groupBy(*document).agg(
        F.count(place).alias("n_base"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        listed(whole).alias("base_labels"), listed(found).alias("labels"),
        F.coalesce(F.max(F.when(found, F.col("share"))), F.lit(0.0)).alias("score"),
    ).drop("row")
