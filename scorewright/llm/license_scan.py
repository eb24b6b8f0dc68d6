"""License scans by diagonal voting.

All rolling 3-word hashes of every document are joined with the template positions that have the
same hash (a broadcast table: the templates are a fixed short list). A match votes for the diagonal
``document position - template position``. Votes are summed by (document, template, diagonal);
diagonals at most ``GAP`` apart (words inserted or left out) are merged. A merged run with enough of the template's grams is
a candidate, and a span of the license if enough of them also stand in the template's order in one stretch of the text that
is little longer than the template's. A phrase needs every vote on one diagonal."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm import common as C
from scorewright.llm.decontaminate import text_mark

K = 3
GAP = 3
COVER = 0.6
#: A stretch of text may be so many times the stretch of template that it matches, and so many words, longer.
STRETCH, SLACK = 1.25, 8
#: A shorter template (in grams) must be there in full: licenses differ in a word or two.
SHORT = 12

#: Phrases that must stand word by word (fixed by the contract), and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Short notices of well-known licenses, for the labels of the method itself.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
           "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
           "distribute sublicense and or sell copies of the software",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
           "copyright notice and this permission notice appear in all copies",
    "apache-2": "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl-3": "licensed under the gnu general public license version 3",
    "gpl-2": "licensed under the gnu general public license version 2",
    "lgpl": "licensed under the gnu lesser general public license",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def template_grams() -> list[tuple[int, int, int]]:
    """(template, position, hash) of every gram; phrases first, then notices."""
    out = []
    for t, text in enumerate([*PHRASES, *NOTICES.values()]):
        words, _ = C.word_hashes([text.encode()], C.ALNUM)
        out += [(t, p, int(h)) for p, h in enumerate(C.gram_hashes(words, K).view(np.int64))]
    return out


def _grams(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("pos", pa.int64()), ("gram", pa.int64())])
    for batch in batches:
        for rows, texts in C.slices(batch, "text"):
            words, counts = C.word_hashes(texts, C.ALNUM)
            grams = C.gram_hashes(words, K).view(np.int64)
            ends = np.cumsum(counts)
            pos = np.arange(len(grams)) - np.repeat(ends - counts, counts)[:len(grams)]
            inside = np.arange(len(grams)) + K <= np.repeat(ends, counts)[:len(grams)]
            owner = np.repeat(np.arange(len(counts)), counts)[:len(grams)][inside]
            ids = rows.column(rows.schema.get_field_index("doc_id")).cast(pa.int64())
            yield pa.record_batch([ids.take(pa.array(owner)), text_mark(texts).take(pa.array(owner)), pa.array(pos[inside]), pa.array(grams[inside])], schema=schema)


def _counts(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64())])
    for batch in batches:
        for rows, texts in C.slices(batch, "text"):
            yield pa.record_batch([rows.column(rows.schema.get_field_index("doc_id")).cast(pa.int64()), text_mark(texts),
                                   pa.array([len(t.translate(C.ALNUM).split()) if t else 0 for t in texts], pa.int64())], schema=schema)


def spans(docs: DataFrame, cover: float = COVER) -> DataFrame:
    """``doc_id, mark, label, start, end, score, base``: licenses found (words from 0, end exclusive).
    ``score`` is the part of the template's grams that stand there in order; phrases have ``base`` set and score 1."""
    docs = C.narrow(docs, "doc_id", "text")
    spark = docs.sparkSession
    labels = [*PHRASES.values(), *NOTICES]
    grams = template_grams()
    size = {t: sum(g[0] == t for g in grams) for t in range(len(labels))}
    table = F.broadcast(spark.createDataFrame(grams, "template int, at long, gram long"))
    facts = F.broadcast(spark.createDataFrame([(t, labels[t], size[t], t < len(PHRASES)) for t in size], "template int, label string, grams int, base boolean"))
    votes = (docs.mapInArrow(_grams, "doc_id long, mark long, pos long, gram long").join(table, "gram")
             .groupBy("doc_id", "mark", "template", (F.col("pos") - F.col("at")).alias("diagonal"))
             .agg(F.collect_set("at").alias("ats")).join(facts, "template"))
    line = Window.partitionBy("doc_id", "mark", "template").orderBy("diagonal")
    begins = F.when(F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(line) > GAP), 1).otherwise(0)
    merged = (votes.withColumn("begins", begins).withColumn("run", F.sum("begins").over(line))
              .groupBy("doc_id", "mark", "template", "label", "grams", "base", "run")
              .agg(F.collect_list(F.struct("diagonal", "ats")).alias("votes"), F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("voted"))
              .withColumn("least", F.when(F.col("base") | (F.col("grams") < SHORT), F.col("grams")).otherwise(F.ceil(F.col("grams") * F.lit(cover))))
              .filter("voted >= least").select("doc_id", "mark", "label", "base", "grams", "least", "votes"))
    return merged.mapInArrow(_verified, "doc_id long, mark long, label string, start long, end long, score double, base boolean")


def best_chain(votes: list[tuple[int, int]]) -> tuple[int, int, int]:
    """The longest chain of (diagonal, place in the template) votes in which text and template go on together, as (grams,
    first word, end): places rise in both, neighbours' diagonals differ by at most ``GAP``, and the chain's stretch of
    text is at most ``STRETCH`` times its stretch of template, and ``SLACK`` words. Work is bounded by the votes times the
    words that one chain may span."""
    at = sorted((d + p, p) for d, p in votes)
    length, first = [1] * len(at), [i for i in range(len(at))]
    low = 0
    longest = max(p for _, p in at) - min(p for _, p in at) + 1
    for i, (x, p) in enumerate(at):
        while x - at[low][0] > STRETCH * longest + SLACK:
            low += 1
        for j in range(i - 1, low - 1, -1):
            y, q = at[j]
            if y < x and q < p and abs((x - y) - (p - q)) <= GAP and length[j] >= length[i]:
                begin = at[first[j]]
                if x - begin[0] <= STRETCH * (p - begin[1]) + SLACK:
                    length[i], first[i] = length[j] + 1, first[j]
    best = max(range(len(at)), key=lambda i: (length[i], -at[i][0]))
    return length[best], at[first[best]][0], at[best][0] + K


def _verified(batches):
    """Candidate runs whose grams stand in the template's order in one bounded stretch of the text."""
    kinds = [("doc_id", pa.int64()), ("mark", pa.int64()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            n, start, end = best_chain([(v["diagonal"], p) for v in r["votes"] for p in v["ats"]])
            if n >= r["least"]:
                out.append((r["doc_id"], r["mark"], r["label"], start, end, n / r["grams"], r["base"]))
        yield pa.record_batch([pa.array([x[i] for x in out], k) for i, (_, k) in enumerate(kinds)], names=[n for n, _ in kinds])


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id, text``; others ignored): ``doc_id, n_words, n_base,
    first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word`` are the smallest and largest of
    their starts (else null); labels are distinct, sorted and comma-joined (empty if there are none). ``score``
    is the best span's, 0 without one. Null and empty texts have no words and no label. Repeated rows give a
    row each; a null doc_id is a value like others; an empty table gives no rows."""
    text = C.narrow(docs, "doc_id", "text")
    found = (spans(text).groupBy("doc_id", "mark")
             .agg(F.count(F.when(F.col("base"), 1)).alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
                  F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
                  F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
                  F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"))
             .withColumnsRenamed({"doc_id": "d", "mark": "m"}))
    rows = text.mapInArrow(_counts, "doc_id long, mark long, n_words long")
    return (rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"),
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")))
