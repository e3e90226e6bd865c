"""License scan by diagonal voting.

Every template (a license phrase or a longer notice) is a list of words; its rolling k-grams are
joined with those of the documents. A hit at word d of a document and word t of a template votes for
the diagonal d - t: an unchanged quotation is one diagonal with every vote, an edited one falls into
neighbouring diagonals, which are merged. Spans are then verified on the words themselves, by a
second independent hash of every voted gram and the share of the template that the grams cover.

Phrases are templates of one gram as long as they are, so each of their places is one full vote.

The templates are a parameter of known size. Tasks drop grams that no template has by a table of
65,536 bits before the join, so the rows joined follow the hits; lists per document are bounded by
its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from starmill.llm import kernel as K
from starmill.llm.tables import ROW, staged

GRAM = 5
GAP = 12  # words inserted or left out between two parts of one quotation, at most
VERIFIED = 0.6  # share of a notice's words that a span must cover

# Phrases and the labels they stand for.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Opening or characteristic sentences of widely used licenses.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
)


def templates(phrases=PHRASES, notices=NOTICES) -> list[dict]:
    """Grams of every template, hashed as those of documents are."""
    out = []
    for number, (base, (label, text)) in enumerate([*((True, p) for p in phrases), *((False, n) for n in notices)]):
        piece = next(K.texts(pa.array([text])))
        found = K.words(piece, K.ALNUM)
        size = len(found.starts)
        k = size if base else min(GRAM, size)
        hashes = [K.word_hashes(piece, found, lane) for lane in (0, 1)]
        grams = [K.signed(K.grams(h, k, lane)).tolist() for lane, h in enumerate(hashes)]
        out += [
            {"template": number, "label": label, "base": base, "size": size, "k": k, "at": t, "gram": a, "check": b}
            for t, (a, b) in enumerate(zip(*grams, strict=True))
        ]
    return out


SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("k", pa.int32()), ("gram", pa.int64()), ("check", pa.int64()), ("place", pa.int64())]))),
    ]
)


def _scan(grams: list[dict]):
    sizes = sorted({g["k"] for g in grams})
    present = {k: np.zeros(1 << 16, bool) for k in sizes}
    for g in grams:
        present[g["k"]][(g["gram"] & (1 << 64) - 1) >> 48] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in K.texts(batch.column(1)):
                found = K.words(piece, K.ALNUM)
                hashes, left, text = K.word_hashes(piece, found), found.remaining(), found.text_of()
                second = None
                parts = []
                for k in sizes:
                    gram = K.grams(hashes, k)
                    at = np.flatnonzero(present[k][(gram >> K.U(48)).astype(np.int64)] & (left[: len(gram)] >= k))
                    if len(at):
                        second = K.word_hashes(piece, found, 1) if second is None else second
                        parts.append((np.full(len(at), k, np.int32), K.signed(gram[at]), K.signed(K.grams(second, k, 1)[at]), at))
                k, gram, check, at = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 4
                own = text[at]
                order = np.argsort(own, kind="stable")
                k, gram, check, at, own = k[order], gram[order], check[order], at[order], own[order]
                place = at - found.bounds[own]
                hits = pa.StructArray.from_arrays([pa.array(k, pa.int32()), pa.array(gram), pa.array(check), pa.array(place)], names=["k", "gram", "check", "place"])
                offsets = np.searchsorted(own, np.arange(len(piece) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)), pa.array(found.counts()), pa.ListArray.from_arrays(pa.array(offsets), hits)],
                    schema=SCANNED,
                )

    return run


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases=PHRASES, notices=NOTICES) -> tuple[DataFrame, DataFrame]:
    """Words of every document, and verified license spans.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased; null has none. A
    phrase counts at every place where its words stand in a row, overlapping ones too. A notice
    counts where merged diagonals cover at least ``VERIFIED`` of its words. Repeated rows are
    scanned one by one.

    Returns (row_id, doc_id, n_words) and (row_id, label, base, first_word, last_word, places,
    coverage): for phrases one row per template with its places, for notices one row per span.
    """
    spark = docs.sparkSession
    grams = templates(phrases, notices)
    schema = "doc_id long, n_words long, hits array<struct<k:int,gram:bigint,check:bigint,place:bigint>>"
    scanned = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")).mapInArrow(_scan(grams), schema)
    scanned = staged(scanned.withColumn(ROW, F.monotonically_increasing_id()), "scanned")
    table = spark.createDataFrame(
        [tuple(g.values()) for g in grams], "template int, label string, base boolean, size int, k int, at int, gram long, check long"
    )
    hits = scanned.filter(F.size("hits") > 0).select(ROW, F.explode("hits").alias("hit")).select(ROW, "hit.*")
    joined = hits.join(table, ["k", "gram"]).filter(hits["check"] == table["check"])
    voted = joined.select(ROW, "template", "label", "base", "size", "k", "place", "at", (F.col("place") - F.col("at")).alias("diagonal"))
    phrase = voted.filter("base").groupBy(ROW, "label").agg(
        F.min("place").alias("first_word"), F.max("place").alias("last_word"), F.count("*").alias("places")
    )
    lines = voted.filter("NOT base").groupBy(ROW, "template", "label", "size", "k", "diagonal").agg(
        F.count("*").alias("votes"), F.min("place").alias("begin"), (F.max("place") + F.first("k")).alias("end"), F.collect_set("at").alias("ats")
    )
    # neighbouring diagonals of one template merge while their stretches of the document touch
    order = Window.partitionBy(ROW, "template").orderBy("begin", "diagonal")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    shift = F.abs(F.col("diagonal") - F.lag("diagonal").over(order))
    fresh = F.when(reach.isNull() | (F.col("begin") > reach + GAP) | (shift > GAP), 1).otherwise(0)
    merged = lines.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = merged.groupBy(ROW, "template", "label", "size", "k", "span").agg(
        F.min("begin").alias("first_word"), F.max("end").alias("end"), F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats")
    )
    covered = "size(array_distinct(flatten(transform(ats, a -> sequence(a, a + k - 1)))))"
    notice = spans.withColumn("coverage", F.expr(covered) / F.col("size")).filter(F.col("coverage") >= VERIFIED)
    found = phrase.select(ROW, "label", F.lit(True).alias("base"), "first_word", "last_word", "places", F.lit(1.0).alias("coverage")).union(
        notice.select(ROW, "label", F.lit(False), "first_word", F.col("end") - 1, F.lit(1), "coverage")
    )
    return scanned.select(ROW, "doc_id", "n_words"), found


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: words, places of the base phrases, labels, and the best coverage."""
    documents, found = scan(docs)

    def listed(condition):
        names = F.array_sort(F.collect_set(F.when(condition, F.col("label"))))
        return F.array_join(names, ",")

    by_doc = found.groupBy(ROW).agg(
        F.sum(F.when(F.col("base"), F.col("places"))).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("last_word"))).alias("last_word"),
        listed(F.col("base")).alias("base_labels"),
        listed(F.lit(True)).alias("labels"),
        F.max("coverage").alias("score"),
    )
    return documents.join(by_doc, ROW, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
