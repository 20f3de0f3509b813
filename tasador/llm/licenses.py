"""License scan by diagonal voting.

Hashes of all word pairs of all documents are joined to the word pairs of license templates. A match at document place p and template place t votes for the diagonal
p - t: the template would begin there. Neighbouring diagonals, as missing or added words make them, are chained. A chain of bounded length is one span; in a longer one, the
best bounded stretches are spans. A span is kept if enough of the template's pairs are in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.scratch import columns, ship, stored
from tasador.llm.text import LOWER, M1, M2, NOT_WORD, hash_spans, mix, pieces, spans, utf8

#: Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Beginnings of license texts and notices, and their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("free and unencumbered software released into the public domain", "unlicense"),
)
#: Whole license texts, and their labels.
WHOLE = (
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.", "mit",
    ),
    (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.", "isc",
    ),
    (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED.", "bsd",
    ),
)
#: Diagonals this far apart belong to one span; the part of a template's pairs that a span must have; its most words against the template's.
NEAR, ENOUGH, STRETCH = 3, 0.7, 1.5
#: Characters of phrases and templates at most: their pairs are broadcast.
MOST = 8 << 20


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, rows = spans(~NOT_WORD[data[: bounds[-1]]], bounds)
    return hash_spans(LOWER[data], starts, ends), rows


def _pairs(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * M1 + words[1:] * M2).view(np.int64)


def template_pairs(spark, templates) -> DataFrame:
    """template, label, place, pair, pairs, words, exact: the pairs of the templates, all of which vote; phrases are exact."""
    rows = []
    for number, (text, label, exact) in enumerate(templates):
        pairs = _pairs(_words(*utf8(pa.array([text])))[0])
        rows += [(number, label, t, p, len(pairs), len(pairs) + 1, exact) for t, p in enumerate(pairs.tolist())]
    return spark.createDataFrame(rows, "template int, label string, place int, pair long, pairs int, words int, exact boolean")


def _rolling(batches):
    """A row for each pair of neighbouring words of each document, and one without a pair that has the number of words."""
    task, number = TaskContext.get().partitionId() << 40, 0
    for piece in pieces(batches):
        words, rows = _words(*utf8(piece.column("text")))
        n = piece.num_rows
        counts = np.bincount(rows, minlength=n)
        inner = np.flatnonzero(rows[1:] == rows[:-1])
        place = inner - np.searchsorted(rows, rows[inner])
        ids = piece.column("doc_id").cast(pa.int64())
        row = task + number + np.concatenate([rows[inner], np.arange(n)])
        yield pa.RecordBatch.from_arrays([
            pa.array(row), pa.concat_arrays([ids.take(pa.array(rows[inner])), ids]), pa.array(np.concatenate([place, counts]), pa.int32()),
            pa.concat_arrays([pa.array(_pairs(words)[inner] if len(words) else np.zeros(0, np.int64)), pa.nulls(n, pa.int64())]),
        ], names=["row", "doc_id", "at", "pair"])
        number += n


def stretches(votes: list[tuple[int, int]], pairs: int, words: int):
    """(first place, last place, pairs in it) of the spans among the (diagonal, place in the document) of one document and template, in time linear in the sorted votes."""
    longest, chains = STRETCH * words + NEAR - 2, []
    for diagonal, at in sorted(votes):
        if not chains or diagonal - chains[-1][-1][1] > NEAR:
            chains.append([])
        chains[-1].append((at, diagonal))
    for chain in chains:
        chain.sort()
        if chain[-1][0] - chain[0][0] <= longest:
            places = len({at - d for at, d in chain})
            if places >= ENOUGH * pairs:
                yield chain[0][0], chain[-1][0], places
            continue
        i = j = 0
        inside, best, limit, after = {}, None, 0, 0
        while j < len(chain) or best:
            if best and (j == len(chain) or chain[j][0] > limit):
                yield best
                inside, best, i, j = {}, None, after, after
                continue
            at, d = chain[j]
            j += 1
            inside[at - d] = inside.get(at - d, 0) + 1
            # what is too far back goes, and what stands again further on
            while at - chain[i][0] > longest or inside[chain[i][0] - chain[i][1]] > 1:
                inside[chain[i][0] - chain[i][1]] -= 1
                if not inside[chain[i][0] - chain[i][1]]:
                    del inside[chain[i][0] - chain[i][1]]
                i += 1
            if len(inside) >= ENOUGH * pairs and (not best or len(inside) > best[2]):
                limit = limit if best else chain[i][0] + longest
                best, after = (chain[i][0], at, len(inside)), j


def _verify(batches):
    """row, label, exact, first_word, last_word, score of each span."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            for lo, hi, n in stretches([(v["diagonal"], v["at"]) for v in r["votes"]], r["pairs"], r["words"]):
                out.append({"row": r["row"], "label": r["label"], "exact": False, "first_word": lo, "last_word": hi + 1, "score": n / r["pairs"]})
        yield pa.RecordBatch.from_pylist(out, _FOUND)


_FOUND = pa.schema([("row", pa.int64()), ("label", pa.string()), ("exact", pa.bool_()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64())])


def scan(documents: DataFrame, phrases=PHRASES, templates=TEMPLATES + WHOLE) -> tuple[DataFrame, DataFrame]:
    """(rows, found). rows: row, doc_id, n_words of each document. found: row, label, exact, first_word, last_word, score of each span, where score is
    the part of the template's pairs in the span, and exact spans are the phrases' places. Words are numbered from 0.

    More than ``MOST`` characters of templates are refused. A null text is empty. Repeated rows are scanned each; a null doc_id stays null; other columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    size = sum(len(text) for text, _ in (*phrases, *templates))
    if size > MOST:
        raise ValueError(f"{size} characters of phrases and templates, more than {MOST}: scan with parts of them, one after another")
    known = template_pairs(spark, [(*p, True) for p in phrases] + [(*t, False) for t in templates])
    rolling = columns(documents, "doc_id", "text").mapInArrow(_rolling, "row long, doc_id long, at int, pair long")
    met = rolling.join(F.broadcast(known), "pair", "left").where("template IS NOT NULL OR pair IS NULL")  # as many rows as the templates have pairs
    met = stored(met.select("row", "doc_id", "at", "template", "label", "place", "pairs", "words", "exact"), "votes")
    rows = met.where("template IS NULL").select("row", "doc_id", F.col("at").cast("long").alias("n_words"))
    votes = met.where("template IS NOT NULL").withColumn("diagonal", F.col("at") - F.col("place"))
    # a diagonal has each place of a template once at most
    exact = votes.where("exact").groupBy("row", "template", "label", "pairs", "diagonal").agg(F.count("*").alias("places"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    exact = exact.where("places = pairs")
    exact = exact.select("row", "label", F.lit(True).alias("exact"), F.col("lo").cast("long").alias("first_word"), (F.col("hi") + 1).cast("long").alias("last_word"), F.lit(1.0).alias("score"))
    loose = votes.where(~F.col("exact")).groupBy("row", "label", "template", "pairs", "words").agg(F.collect_list(F.struct("diagonal", "at")).alias("votes"))
    loose = loose.where(F.size("votes") >= ENOUGH * F.col("pairs"))
    merged = loose.mapInArrow(_verify, "row long, label string, exact boolean, first_word long, last_word long, score double")
    return rows, exact.union(merged)


def license_summary(documents: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_words, n_base, first_word and last_word (where the first and last phrase begin), base_labels, labels, score."""
    rows, found = scan(documents)
    base = F.when(F.col("exact"), F.col("first_word"))
    label = F.when(F.col("exact"), F.col("label"))
    by = found.groupBy("row").agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(label)), ",").alias("base_labels"), F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"))
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return rows.join(by, "row", "left").select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", text("base_labels"), text("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
