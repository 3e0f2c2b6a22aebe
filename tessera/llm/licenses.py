"""License scans by diagonal voting.

Every rolling hash of three words of every document is joined, in Spark, to the positions of the same three words in the
templates (a small fixed table, broadcast). A match votes for a diagonal, the document's position less the template's. Votes
are summed by diagonal, and neighbouring diagonals, a few words inserted or lost apart, are merged to spans. A base phrase is found
where its diagonal has all its votes. Spans of passages are candidates by the part of the passage that their votes cover, and are verified on
the document's own words: an alignment tells how many words of the passage stand there in order. Where spans of different passages share
words, those that agree best stay, which tells versions of one licence apart.
Only matches are shuffled, with one row for each document, and the texts of documents with candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import ALNUM, LOWER, Rolling, blocks, utf8, word_codes, words
from .common import id_of, little, shared_folder, texts, written

K = 3
#: Base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Passages of public licences, as words. Versions differ in a word or two.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 you may not use this file except in compliance with the license": "apache-2",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "creative commons attribution 4 0 international license": "cc-by",
    "creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license": "gpl-2",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license": "gpl-3",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: Diagonals at most so far apart belong to one span.
SLACK = 3
#: A span is a candidate if its votes cover so much of its passage, and counts if so many of the passage's words stand there in order.
VOTED, COVERED = 0.3, 0.75
_HEADER = 0


def _codes(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words in lower case, and each row's first."""
    flat = LOWER[flat]
    start, end, first = words(flat, at, ALNUM)
    return word_codes(flat, start, end), first


def _hashes(flat: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each row: the hashes of its runs of K words, and the number of its words."""
    codes, first = _codes(flat, at)
    grams = Rolling(codes).grams(K).view(np.int64)
    return [grams[a : max(a, b - K + 1)] for a, b in zip(first[:-1].tolist(), first[1:].tolist())], np.diff(first)


def _rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, at = utf8(batch.column("text"))
        for i, j in blocks(at):
            grams, n = _hashes(flat[at[i] : at[j]], at[i : j + 1] - at[i])
            sizes = np.zeros(len(grams) + 1, np.int64)
            np.cumsum([len(g) + 1 for g in grams], out=sizes[1:])
            values = np.concatenate([x for g in grams for x in (np.zeros(1, np.int64), g)])
            lists = pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("rid").slice(i, j - i), batch.column("th").slice(i, j - i), pa.array(n.astype(np.int64)), lists], ["rid", "th", "n_words", "grams"])


def _table(spark, phrases: list[str]) -> tuple[DataFrame, list[int]]:
    """(gram, template, tpos) with the header's row, and each template's number of runs of K words."""
    flat, at = utf8(pa.array(phrases))
    grams, _ = _hashes(flat, at)
    rows = [(_HEADER, -1, 0)] + [(int(g), t, p) for t, x in enumerate(grams) for p, g in enumerate(x)]
    return spark.createDataFrame(rows, "gram long, template int, tpos int"), [len(x) for x in grams]


def aligned(passage: np.ndarray, words_: np.ndarray) -> tuple[int, int, int]:
    """Of an alignment of a passage's words with a document's: how many agree in order, and the first and last place of those in the document."""
    n = len(words_)
    best = np.zeros((len(passage) + 1, n + 1), np.int32)
    for i, w in enumerate(passage, 1):
        best[i, 1:] = np.maximum(best[i - 1, 1:], best[i - 1, :-1] + (words_ == w))
        best[i] = np.maximum.accumulate(best[i])
    i, j, first, last = len(passage), n, n, -1
    while i and j:
        if passage[i - 1] == words_[j - 1] and best[i, j] == best[i - 1, j - 1] + 1:
            i, j = i - 1, j - 1
            first, last = j, max(last, j)
        elif best[i, j] == best[i - 1, j]:
            i -= 1
        else:
            j -= 1
    return int(best[-1, -1]), first, last


def verified(codes: np.ndarray, spans: list[tuple[int, int, int]], passages: list[np.ndarray], covered: float, slack: int = SLACK) -> list[tuple[int, float]]:
    """(template, share) of the spans (template, least and greatest diagonal) that count: the share of the passage's words that stand there, in order.

    Of spans that share words the one with the largest share stays, with those that equal it.
    """
    found = []
    for template, low, high in spans:
        passage = passages[template]
        begin = max(0, low - slack)
        n, first, last = aligned(passage, codes[begin : high + len(passage) + slack])
        if n >= covered * len(passage):
            found.append((n / len(passage), len(passage), begin + first, begin + last, template))
    kept: list[tuple] = []
    for x in sorted(found, key=lambda x: (-x[0], -x[1], x[2:])):
        if not any(x[2] <= y[3] and y[2] <= x[3] and x[:2] != y[:2] for y in kept):
            kept.append(x)
    return [(x[4], x[0]) for x in kept]


def _verify(passages: list[np.ndarray], covered: float, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = utf8(batch.column("text"))
            out: list[list] = [[], []]
            for i, j in blocks(at):
                codes, first = _codes(flat[at[i] : at[j]], at[i : j + 1] - at[i])
                for k, spans in enumerate(batch.column("spans").slice(i, j - i).to_pylist()):
                    kept = verified(codes[first[k] : first[k + 1]], [(s["template"], s["low"], s["high"]) for s in spans], passages, covered, slack)
                    out[0].append(sorted({t for t, _ in kept}))
                    out[1].append(max((s for _, s in kept), default=0.0))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("th"), pa.array(out[0], pa.list_(pa.int32())), pa.array(out[1], pa.float64())], ["rid", "th", "kept", "share"])

    return run


def scan(docs: DataFrame, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES, slack: int = SLACK, covered: float = COVERED) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row for each row.

    n_base counts all places where a base phrase stands, first_word and last_word are the smallest and largest start
    (null without any). labels adds those of the verified spans. score is the largest share of a passage's words in a
    span that counts, 1 for a base phrase, 0 without labels. A null or text without words has zeros and empty labels. Repeated rows give
    equal rows; a null id is kept.
    """
    phrases = [*base, *templates]
    if any(len(p.split()) < K for p in phrases):
        raise ValueError(f"phrases have {K} words at least")
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    known, votes_of = _table(spark, phrases)
    rows = texts(docs).mapInArrow(_rolling, "rid long, th long, n_words long, grams array<long>")
    hits = rows.select("rid", "th", "n_words", F.posexplode("grams").alias("pos", "gram")).join(F.broadcast(known), "gram")
    hits = hits.select("rid", "th", "n_words", "template", "tpos", (F.col("pos") - 1 - F.col("tpos")).cast("long").alias("diagonal")).repartition("rid", "th")
    key = ["rid", "th", "n_words", "template"]
    lines = hits.groupBy(*key, "diagonal").agg(F.collect_set("tpos").alias("at"), F.count("*").alias("rows"))
    along = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > slack, F.lit(True))
    lines = lines.withColumn("span", F.sum(apart.cast("int")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    need = F.element_at(F.array(*map(F.lit, votes_of)), F.greatest(F.col("template"), F.lit(0)) + 1)
    names = [*base.values(), *templates.values()]
    label = F.element_at(F.array(*map(F.lit, names)), F.greatest(F.col("template"), F.lit(0)) + 1)
    place = (F.col("template") >= 0) & (F.col("template") < len(base)) & (F.size("at") == need)
    spans = lines.groupBy(*key, "span").agg(
        F.count(F.when(place, 1)).alias("places"), F.min(F.when(place, F.col("diagonal"))).alias("first"), F.max(F.when(place, F.col("diagonal"))).alias("last"),
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.max("rows").alias("rows"),
        (F.size(F.array_distinct(F.flatten(F.collect_list("at")))) / F.first(need)).alias("voted"),
    )
    candidate = (F.col("template") >= len(base)) & (F.col("voted") >= VOTED)
    docs_ = spans.groupBy("rid", "th", "n_words").agg(
        F.sum("places").alias("n_base"), F.min("first").alias("first_word"), F.max("last").alias("last_word"), F.max(F.when(F.col("template") < 0, F.col("rows"))).alias("copies"),
        F.sort_array(F.collect_set(F.when(F.col("places") > 0, label))).alias("base"),
        F.sort_array(F.collect_list(F.when(candidate, F.struct((F.col("template") - len(base)).alias("template"), "low", "high")))).alias("spans"),
    )
    docs_ = written(docs_, f"{folder}/documents")
    wanted = docs_.where(F.size("spans") > 0).select("rid", "th", "spans")
    if wanted.isEmpty():
        out = docs_.withColumn("kept", F.array().cast("array<int>")).withColumn("share", F.lit(0.0))
    else:
        codes, first = _codes(*utf8(pa.array([*templates])))
        passages = [codes[a:b] for a, b in zip(first[:-1], first[1:])]
        some = texts(docs).join(little(wanted.select("rid", "th")), ["rid", "th"]).dropDuplicates(["rid", "th"]).join(wanted, ["rid", "th"])
        checked = written(some.mapInArrow(_verify(passages, covered, slack), "rid long, th long, kept array<int>, share double"), f"{folder}/verified")
        out = docs_.join(little(checked), ["rid", "th"], "left")
    more = F.transform(F.coalesce("kept", F.array().cast("array<int>")), lambda t: F.element_at(F.array(*map(F.lit, templates.values())), t + 1))
    labels = F.sort_array(F.array_distinct(F.concat("base", more)))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(id_of(F.col("rid")), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))
