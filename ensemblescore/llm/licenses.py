"""License scans: phrases at their places, and whole notices found by an exact set-similarity join.

A block of words holds a template if at least ``THRESHOLD`` of the template's distinct words are in
it. Words are ordered by how many documents hold them, rarest first, counted over the whole table. A
block that meets the threshold holds one of the first words of the template's order, its prefix: blocks
and templates are joined on those words. Of a pair met, the number of the block's template words
(length) and what can still follow on either side of the first shared word (position) bound the
overlap before it is counted.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ensemblescore.llm.text import named, slices, words
from ensemblescore.sources.scratch import ensure_checkpoint_dir

#: Fixed phrases and the labels they stand for.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Labels and fixed template texts: the notices that licences ask for, whole.
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
    associated documentation files (the "Software"), to deal in the Software without restriction, including without
    limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
    and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
    copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
    hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
    the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
    list of conditions and the following disclaimer in the documentation and/or other materials provided with the
    distribution."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
    compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless
    required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
    BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
    Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
    later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
    the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("cc-by-nc", """This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To
    view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
    held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
    for any purpose, including commercial applications, and to alter it and redistribute it freely."""),
)

THRESHOLD = 0.8

#: Words from one block to the next, at least; a block is two of them.
STRIDE = 20

#: Prefix words and templates are sent to every executor up to so many rows, and joined by a shuffle beyond.
MOST_BROADCAST = 200_000

_LOWER_OR_SPACE = bytes(c if chr(c).isdigit() and c < 0x80 or 0x61 <= c <= 0x7A or c >= 0x80 else
                        c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))

KIND = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:array<string>,"
        "blocks:array<struct<block:int,words:array<int>>>>")


def plain_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of A-Z lower-cased texts, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, and each row's number of them."""
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    raw = b"" if data is None else memoryview(data)[int(offsets[0]):int(offsets[-1])].tobytes()
    # The table maps every byte to one byte and leaves those of longer characters alone.
    spaced = pa.Array.from_buffers(pa.large_string(), len(text), [
        None, pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(raw.translate(_LOWER_OR_SPACE))])
    return words(spaced)


def template_words(text: str) -> list[str]:
    """The words of a template, as those of a document are taken."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def stride(templates) -> int:
    """Words from block to block, so that any text as long as a template lies in one block."""
    return max([STRIDE, *(len(template_words(text)) - 1 for _, text in templates)])


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[int, ...]
    need: int


class Templates:
    """Templates over numbered words, the rarest word first."""

    def __init__(self, texts, threshold: float, frequency: dict[str, int]):
        sets = [(label, set(template_words(text))) for label, text in texts]
        vocabulary = sorted(set().union(*(s for _, s in sets)), key=lambda w: (frequency.get(w, 0), w))
        self.numbers = {w: i for i, w in enumerate(vocabulary)}
        self.templates = [Template(label, tuple(sorted(self.numbers[w] for w in s)),
                                   max(1, math.ceil(threshold * len(s) - 1e-9)))
                          for label, s in sets if s]
        self.stride = stride(texts)
        #: (word, template, place in its order): a block without any of a template's has too few of its words.
        self.prefixes = [(w, k, at) for k, t in enumerate(self.templates)
                         for at, w in enumerate(t.words[:len(t.words) - t.need + 1])]
        self.prefix = sorted({w for w, _, _ in self.prefixes})
        self.least = min((t.need for t in self.templates), default=1)


def document_frequency(df: DataFrame, text: Column, vocabulary: list[str]) -> dict[str, int]:
    """How many documents hold each word of a vocabulary; sums per batch come to the driver's few rows."""
    values = pa.array(vocabulary, pa.large_string())

    def counted(batches):
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for _, rows in slices(batch.column(0)):
                flat, n = plain_words(rows)
                at = pc.index_in(flat, value_set=values).to_numpy(zero_copy_only=False)
                known = np.flatnonzero(~np.isnan(at)) if at.dtype.kind == "f" else np.arange(len(at))
                pair = np.unique(np.repeat(np.arange(len(rows)), n)[known] * len(vocabulary) + at[known].astype(np.int64))
                total += np.bincount(pair % len(vocabulary), minlength=len(vocabulary))
        yield pa.record_batch([pa.array(np.arange(len(vocabulary)), pa.int32()), pa.array(total)], names=["word", "n"])

    if not vocabulary:
        return {}
    counts = df.select(text.cast("string").alias("text")).mapInArrow(counted, "word int, n bigint")
    return {vocabulary[r["word"]]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _scan(phrases: dict[str, str], templates: Templates):
    values = pa.array(list(templates.numbers), pa.large_string())
    in_prefix = np.zeros(len(templates.numbers) + 1, bool)
    in_prefix[templates.prefix] = True
    spoken = [(f" {p} ", label) for p, label in phrases.items()]
    any_phrase = "|".join(re.escape(p) for p in phrases) or "\\x00never"

    def places(joined: str) -> tuple[list[int], list[str]]:
        at, labels = [], set()
        for phrase, label in spoken:
            i, before, counted = joined.find(phrase), 0, 0
            while i >= 0:
                before += joined.count(" ", counted, i)
                counted = i
                at.append(before)
                labels.add(label)
                i = joined.find(phrase, i + 1)
        return at, sorted(labels)

    def scanned(rows: pa.Array) -> list[dict]:
        flat, n_words = plain_words(rows)
        first = np.cumsum(n_words) - n_words
        out = [{"n_words": int(n), "n_base": 0, "base_labels": [], "blocks": []} for n in n_words]
        lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_words)]), pa.int64()), flat)
        joined = pc.binary_join(lists, pa.scalar(" ", pa.large_string()))
        for i in np.flatnonzero(pc.match_substring_regex(joined, any_phrase).to_numpy(zero_copy_only=False)).tolist():
            at, labels = places(f" {joined[i].as_py()} ")
            if at:
                out[i] |= {"n_base": len(at), "first_word": min(at), "last_word": max(at), "base_labels": labels}
        number = pc.fill_null(pc.index_in(flat, value_set=values), len(values)).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(rows)), n_words)
        hits = np.flatnonzero(in_prefix[number])
        block = (hits - first[row[hits]]) // templates.stride
        near = np.stack([np.tile(row[hits], 2), np.concatenate([block, block - 1])], 1)
        for i, b in np.unique(near[near[:, 1] >= 0], axis=0).tolist() if len(near) else []:
            lo = first[i] + b * templates.stride
            held = np.unique(number[lo:min(lo + 2 * templates.stride, first[i] + n_words[i])])
            held = held[held < len(values)].tolist()
            if len(held) >= templates.least:
                out[i]["blocks"].append({"block": b, "words": held})
        return out

    kind = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                      ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
                      ("blocks", pa.list_(pa.struct([("block", pa.int32()), ("words", pa.list_(pa.int32()))])))])

    def run(text: pa.Array) -> pa.Array:
        return pa.array([r for _, rows in slices(text) for r in scanned(rows)], kind)
    return run


def _matches(rows: DataFrame, templates: Templates) -> DataFrame:
    """``id`` and ``matches``, (label, block, score) of every block and template that meet the threshold.

    Block and template words are both in order of rarity, so the first prefix word of a pair is the first
    word it shares, and what can still be shared is bounded by what follows it on either side."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(k, t.label, list(t.words), t.need) for k, t in enumerate(templates.templates)],
                                  "template int, label string, own array<int>, need int")
    prefixes = spark.createDataFrame(templates.prefixes, "word int, template int, place int").join(
        table.select("template", "need", F.size("own").alias("n_own")), "template")
    few = len(templates.prefixes) + len(templates.templates) <= MOST_BROADCAST
    hint = F.broadcast if few else lambda df: df
    blocks = rows.where(F.size("blocks") > 0).select("id", F.explode("blocks").alias("b")).select("id", "b.block", "b.words")
    met = blocks.select("id", "block", F.size("words").alias("n"), F.posexplode("words").alias("at", "word")).join(
        hint(prefixes), "word").where("n >= need")
    first = met.groupBy("id", "block", "template").agg(F.min(F.struct("at", "place", "n", "need", "n_own")).alias("m"))
    open_ = first.where("least(m.n - m.at, m.n_own - m.place) >= m.need").select("id", "block", "template")
    shared = open_.join(blocks, ["id", "block"]).join(hint(table), "template").select(
        "id", "block", "label", "need", F.size("own").alias("n_own"), F.size(F.array_intersect("words", "own")).alias("n"))
    return shared.where("n >= need").groupBy("id").agg(F.array_sort(F.collect_list(F.struct(
        "label", "block", (F.col("n") / F.col("n_own")).alias("score")))).alias("matches"))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES,
         templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels`` and ``labels`` (arrays), ``matches`` (label, block, score) and ``score``.

    ``n_base`` counts the places where a phrase's words stand consecutively, from word
    ``first_word`` to ``last_word`` (starts, null without a place). ``matches`` are all blocks
    that hold a template. ``labels`` joins both kinds. ``score`` is 1 with a phrase, else the
    largest share of a template held, else 0. ``templates`` are labels and texts of any number and
    length; blocks follow the longest. Null and empty texts have no words; null keys
    and repeated rows are kept; an empty table gives no rows; other columns are not read. Two scans and no
    shuffle of texts: only words of templates in blocks that hold a rare one are joined. What reaches the driver is
    one count per word of the templates.
    """
    ensure_checkpoint_dir(df.sparkSession)
    content = named(text).cast("string")
    vocabulary = sorted({w for _, t in templates for w in template_words(t)})
    ordered = Templates(templates, threshold, document_frequency(df, content, vocabulary))
    found = F.arrow_udf(_scan(phrases, ordered), KIND)(content)
    # Numbered over stored rows, which a task that runs again finds in their places.
    rows = df.select(named(key).alias("doc_id"), found.alias("f")).select("doc_id", "f.*").checkpoint().withColumn(
        "id", F.monotonically_increasing_id())
    none = F.array().cast("array<struct<label:string,block:int,score:double>>")
    rows = rows.join(_matches(rows, ordered), "id", "left").withColumn("matches", F.coalesce("matches", none))
    labels = F.array_sort(F.array_union("base_labels", F.transform("matches", lambda m: m["label"])))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                       labels.alias("labels"), "matches", F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"))
