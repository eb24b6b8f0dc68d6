"""Substring deduplication by content-defined chunking with a gear rolling hash.

The gear hash ``h = (h << 1) + gear[byte]`` (32 bits, so it depends on the last 32 bytes) ends a chunk where
its top bits are zero; boundaries move with the content, so an insertion changes only the chunks around it. Chunks
are deduplicated by digest: the smallest doc_id that holds a chunk keeps it. Runs of neighbouring repeated
chunks with enough words are repeated passages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm import common as C

#: Bytes of a chunk: least, most, and the bits of the hash that are zero at a boundary (32 bytes on average after the least).
LEAST, MOST, MASK_BITS = 16, 256, 5
#: Words that neighbouring repeated chunks have together at least. A repeated passage of 50 words loses up to a
#: chunk at either end.
MIN_WORDS = 25

_rng = np.random.RandomState(20)
GEAR = _rng.randint(0, 2 ** 32, 256, dtype=np.uint64).astype(np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: windows of 1, 2, 4 ... 32 bytes, each from two of the last."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        older = np.zeros_like(h)
        older[step:] = h[:-step] if step < len(h) else older[step:]
        h = h + (older << np.uint32(step))
    return h


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks of a text; never inside a character."""
    if not text:
        return []
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    starts_next = np.r_[(data[1:] & 0xC0) != 0x80, True]
    marks = np.flatnonzero((gear_hashes(data) >> np.uint32(32 - MASK_BITS) == 0) & starts_next) + 1
    out, last = [], 0
    for m in marks.tolist():
        while m - last > MOST:
            last = last + MOST
            while last < n and data[last] & 0xC0 == 0x80:
                last += 1
            out.append(last)
        if m - last >= LEAST:
            out.append(m)
            last = m
    while n - last > MOST:
        last = last + MOST
        while last < n and data[last] & 0xC0 == 0x80:
            last += 1
        out.append(last)
    if last < n:
        out.append(n)
    return out


CHUNKS = "doc_id long, mark long, start int, end int, chars int, words int, d1 long, d2 int"


def _chunks(batches):
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
    schema = pa.schema(list(zip(["doc_id", "mark", "start", "end", "chars", "words", "d1", "d2"], kinds, strict=True)))
    digest = xxhash.xxh3_128_intdigest
    for batch in batches:
        for rows, texts in C.slices(batch, "text"):
            owner, cols = [], [[], [], [], []]
            d1, d2 = [], []
            for i, text in enumerate(texts):
                ends = cuts(text or b"")
                if not ends:
                    continue
                e = np.array(ends)
                s = np.r_[0, e[:-1]]
                data = np.frombuffer(text, np.uint8)
                chars = np.add.reduceat((data & 0xC0) != 0x80, s)
                space = _SPACE[data]
                words = np.add.reduceat(~space & np.r_[True, space[:-1]], s)
                upto = np.cumsum(chars)
                for c, v in zip(cols, (upto - chars, upto, chars, words), strict=True):
                    c.append(v)
                owner += [i] * len(ends)
                for a, b in zip(s.tolist(), ends, strict=True):
                    h = digest(text[a:b])
                    d1.append((h & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                    d2.append((h >> 64 & 0xFFFFFFFF) - (1 << 31))
            own = pa.array(owner, pa.int64())
            yield pa.record_batch([rows.column(0).cast(pa.int64()).take(own), rows.column(2).take(own),
                                   *[pa.array(np.concatenate(c) if c else [], pa.int32()) for c in cols], pa.array(d1, pa.int64()), pa.array(d2, pa.int32())], schema=schema)


def _runs(min_words: int):
    names = ("doc_id", "start", "end", "n_words", "n_chunks", "keep_doc_id", "removed", "mark")
    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches):
        for batch in batches:
            out = []
            for doc, mark, chunks in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                chunks = sorted({(c["start"], c["end"], c["words"], c["low"]) for c in chunks})
                held = []
                for c in [*chunks, (-1, -1, 0, 0)]:
                    if held and (c[0] != held[-1][1] or (c[3] != doc) != (held[-1][3] != doc)):
                        if sum(h[2] for h in held) >= min_words:
                            out.append((doc, held[0][0], held[-1][1], sum(h[2] for h in held), len(held), min(h[3] for h in held), held[0][3] != doc, mark))
                        held = []
                    held.append(c)
            yield pa.record_batch([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], schema=schema)

    return run


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of ``docs`` (``doc_id, text``; others ignored) that also stand in another document: ``doc_id, start, end``
    (characters, end exclusive)``, n_words, n_chunks, keep_doc_id`` (smallest doc_id that has a chunk of it)``, removed``
    (false in the document that keeps it)``, mark`` (the key of the text it stands in).

    A chunk repeats if two different doc_ids hold it; repeats inside one document, and rows that repeat a doc_id, are no
    repeats. Null and empty texts have no chunks; rows with a null doc_id are left out, as they cannot be
    named. A text without repeated passage gives no row; an empty table gives no rows."""
    docs = C.narrow(docs, "doc_id", "text").filter("doc_id is not null and text is not null").withColumn("mark", C.text_key())
    chunks = C.materialize(docs.mapInArrow(_chunks, CHUNKS))
    key = ["d1", "d2"]
    # Counts and least and largest document of each digest, summed up in each task before the shuffle.
    shared = (chunks.groupBy(*key).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("copies"))
              .filter("low <> high").select(*key, "low", "copies"))
    shared = C.materialize(shared)
    limit = max(1, chunks.count() // C.HEAVY_KEYS)
    heavy, light = F.broadcast(shared.filter(F.col("copies") > limit)), shared.filter(F.col("copies") <= limit)
    slim = chunks.select("doc_id", "mark", "start", "end", "words", *key)
    found = slim.join(heavy, key).unionByName(slim.join(F.broadcast(heavy.select(*key)), key, "left_anti").join(light, key))
    by_doc = (found.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "end", "words", "low")).alias("chunks"))
              .select("doc_id", "mark", "chunks"))
    return by_doc.mapInArrow(_runs(min_words), "doc_id long, start long, end long, n_words long, n_chunks long, keep_doc_id long, removed boolean, mark long")


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text``) with the passages marked ``removed`` cut out of the texts. A passage is cut from the text
    that it was found in alone, not from other texts of the same id; rows with a null id are as they were."""
    cut = (passages.filter("removed").groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
           .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")))
    docs = C.narrow(docs, "doc_id", "text").join(cut, (F.col("doc_id") == F.col("_id")) & (C.text_key() == F.col("_mark")), "left")
    kept = F.aggregate(
        "spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.struct(F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))).alias("out"),
                                F.greatest(acc["at"], s["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.lit(2 ** 31 - 1))))
    return docs.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept).alias("text"))
