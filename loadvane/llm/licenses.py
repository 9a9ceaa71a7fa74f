"""License scans by diagonal voting over word pairs.

Every pair of neighbouring words of a text is joined by its hash to the positions of the same
pair in the templates; a hit at text position p and template position t votes for the diagonal
p - t, the place where the template would begin. Votes are counted per text, template and
diagonal. A diagonal with a vote for each pair is the whole template, word for word. For
templates that may be edited, neighbouring diagonals are merged (an inserted or lost word moves
the rest of a passage to the next diagonal) and the span is verified: it must hold most of the
template's pairs and not be much longer than the template.

Texts are split into words in one Arrow step, as are their pair hashes; the join against the
template positions, whose size the templates fix, and all counting are Spark's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadvane.llm.hashing import in_steps, word_hashes
from loadvane.session import ship_package

#: Template positions whose votes one 64-bit mask holds.
MASK = 60
#: Diagonals apart at which two still belong together, share of pairs a span must hold, and
#: span length over template length.
DRIFT, COVERAGE, STRETCH = 4, 0.7, 1.5
#: Bytes of text that one step holds.
_BYTES = 2_000_000


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    #: exact templates count only where all words stand consecutively
    exact: bool


# The phrases and labels that every scan reports.
PHRASES = (
    Template("cc-by", ("cc", "by"), True),
    Template("gpl", ("general", "public", "license"), True),
    Template("reserved", ("all", "rights", "reserved"), True),
)

# Opening or standard sentences of public licenses and notices, one or several a label.
NOTICES: dict[str, str | tuple[str, ...]] = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
        "Released under the MIT License",
    ),
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "public-domain": "This is free and unencumbered software released into the public domain",
}


def _word_bytes() -> np.ndarray:
    """Which bytes of lower-cased UTF-8 belong to a word: 0-9, a-z and all beyond ASCII."""
    kind = np.zeros(256, bool)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        kind[low : high + 1] = True
    return kind


_KIND = _word_bytes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = np.uint64(0x100000001B3)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def pair_hashes(words: np.ndarray) -> np.ndarray:
    mixed = words[:-1] * _PAIR + words[1:]
    return (mixed ^ (mixed >> np.uint64(29))) * _BASE


def _pairs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row, n_words and the pair hashes of every text."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_steps(whole, "size", _BYTES):
                words, counts = word_hashes([x or b"" for x in batch.column("raw").to_pylist()], _KIND, _LOWER)
                # a pair within each text, none across two
                grams = pair_hashes(words).view(np.int64) if len(words) > 1 else np.zeros(0, np.int64)
                last = np.cumsum(counts)[counts > 0] - 1
                keep = np.ones(len(grams), bool)
                keep[last[last < len(grams)]] = False
                offsets = np.r_[0, np.cumsum(np.maximum(counts - 1, 0))].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("row"),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams[keep])),
                    ],
                    names=["id", "row", "n_words", "pairs"],
                )

    # row tells rows of equal id apart; it is used only within the stage that makes it
    source = df.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.encode(text_col, "UTF-8").alias("raw"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("size"),
    )
    kind = df.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, row long, n_words long, pairs array<long>")


def scan(
    df: DataFrame,
    phrases: Sequence[Template],
    notices: dict[str, str | tuple[str, ...]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels and score per row.

    n_base counts the places of the exact phrases, first_word and last_word are the smallest and
    largest of them (null if none). labels adds those of notices whose span is verified. score
    is 1 with an exact phrase, else the best verified coverage of a notice, else 0. Null and
    empty texts have no words and no labels. Rows of equal id are kept apart.
    """
    spark = df.sparkSession
    templates = [*phrases]
    listed = [(label, text) for label, texts in notices.items() for text in ((texts,) if isinstance(texts, str) else texts)]
    for label, text in listed:
        raw = bytes(_LOWER[np.frombuffer(text.encode(), np.uint8)])
        words = bytes(b if _KIND[b] else 32 for b in raw).decode().split()
        templates.append(Template(label, tuple(words), False))
    positions = []
    for number, template in enumerate(templates):
        hashes, _ = word_hashes([" ".join(template.words).encode()], _KIND, _LOWER)
        positions += [(h, number, at) for at, h in enumerate(pair_hashes(hashes).view(np.int64).tolist())]
    # one row per word pair and one per template; the templates are arguments of fixed size
    index = F.broadcast(spark.createDataFrame(positions, "pair long, template int, at int"))
    about = F.broadcast(
        spark.createDataFrame(
            [(n, len(t.words) - 1, t.label, t.exact) for n, t in enumerate(templates)],
            "template int, pairs_in_all int, label string, exact boolean",
        )
    )
    rows = ["id", "row", "n_words"]
    hits = (
        _pairs(df, id_col, text_col)
        .select(*rows, F.posexplode_outer("pairs").alias("pos", "pair"))
        .join(index, "pair", "left")
        .groupBy(*rows, "template", (F.col("pos") - F.col("at")).alias("diagonal"), (F.col("at") / MASK).cast("int").alias("part"))
        .agg(
            F.bit_or(F.expr(f"shiftleft(1L, at % {MASK})")).alias("mask"),
            F.min("pos").alias("low"),
            F.max("pos").alias("high"),
        )
        .withColumn("votes", F.when(F.col("template").isNotNull(), F.bit_count("mask")).otherwise(0))
        .join(about, "template", "left")
    )
    # all that follows has a row per hit diagonal and stays within a text and template
    line = Window.partitionBy(*rows, "template").orderBy("diagonal", "part")
    gap = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > DRIFT, F.lit(False)) | F.coalesce(
        F.col("low") > F.lag("high").over(line) + F.col("pairs_in_all"), F.lit(False)
    )
    merged = (
        hits.withColumn("group", F.sum(F.when(gap, 1).otherwise(0)).over(line))
        .withColumn("whole", F.sum("votes").over(Window.partitionBy(*rows, "template", "diagonal")) == F.col("pairs_in_all"))
        # the exact place is the diagonal; a template in several parts counts once
        .withColumn("place", F.when(F.col("exact") & F.col("whole") & (F.col("part") == 0), F.col("diagonal")))
        .groupBy(*rows, "template", "pairs_in_all", "label", "exact", "group", "part")
        .agg(
            F.bit_or("mask").alias("mask"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.count("place").alias("n"),
            F.min("place").alias("first"),
            F.max("place").alias("last"),
        )
        .groupBy(*rows, "template", "pairs_in_all", "label", "exact", "group")
        .agg(
            F.sum(F.bit_count("mask")).alias("held"),
            (F.max("high") - F.min("low") + 1).alias("span"),
            F.sum("n").alias("n"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .withColumn("coverage", F.col("held") / F.col("pairs_in_all"))
    )
    base = F.col("exact") & (F.col("n") > 0)
    verified = ~F.col("exact") & (F.col("coverage") >= COVERAGE) & (F.col("span") <= F.col("pairs_in_all") * STRETCH)

    def joined(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    return (
        merged.groupBy(*rows)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_base"),
            F.min("first").cast("long").alias("first_word"),
            F.max("last").cast("long").alias("last_word"),
            joined(base).alias("base_labels"),
            joined(base | verified).alias("labels"),
            F.coalesce(F.max(F.when(base, 1.0).when(verified, F.col("coverage"))), F.lit(0.0)).alias("score"),
        )
        .select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )
