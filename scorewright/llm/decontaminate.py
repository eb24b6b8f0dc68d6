"""Benchmark decontamination with suffix arrays over the training documents.

Every shard (some megabytes of whole documents, as a task reads them) gets a suffix array over its
words. Only suffixes that begin with a lead (first words) of some test window are in it, as no other
suffix can match. Test windows are binary-searched in it: their range is all places where
they occur, and places that follow each other on one diagonal are one longer match. Words are numbered by
the vocabulary of the test items; a word that no item has, and a document's end, match nothing.

The test items are sent to the tasks in blocks of bounded size, one pass over the documents for
each block; documents are never shuffled."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm import common as C

WINDOW = 10
#: Text bytes of the test items that are sent to tasks at a time.
BLOCK_BYTES = 16 << 20
LEAD = 4


class TestBlock:
    """Windows of some test items, sorted, with the (item, start) pairs of each."""

    __test__ = False

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        found: dict[tuple[int, ...], list[tuple[int | None, int]]] = {}
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in (text or "").encode().translate(C.ALNUM).split()]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[i:i + window]), []).append((item, i))
        self.windows = list(found)
        self.places = list(found.values())
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.lead = min([LEAD, *self.lengths.tolist()])
        ids = np.zeros((len(self.windows), window), np.uint64)
        for i, w in enumerate(self.windows):
            ids[i, :len(w)] = w
        self.low = self.keys(ids)
        padded = ids.copy()
        for i, n in enumerate(self.lengths):
            padded[i, n:] = 0xFFFFFFFF
        self.high = self.keys(padded)
        self.leads = self.lead_hash(ids.T[:self.lead]) if len(ids) else np.zeros(0, np.uint64)
        self.known = np.unique(self.leads)

    def keys(self, ids: np.ndarray) -> np.ndarray:
        """Word numbers as byte strings that sort in the same order."""
        return np.ascontiguousarray(ids.astype(">u4")).view(f"S{4 * self.window}").ravel() if len(ids) else np.zeros(0, f"S{4 * self.window}")

    @staticmethod
    def lead_hash(columns) -> np.ndarray:
        h = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            h = h * np.uint64(0x9E3779B97F4A7C15) + c
        return h

    def search(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text, and the places (word of the shard, window) where windows occur."""
        lists = [t.translate(C.ALNUM).split() if t else [] for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        none = np.zeros(0, np.int64)
        flat = pa.array([w for x in lists for w in x], pa.binary())
        if not len(flat) or not self.windows:
            return counts, none, none
        coded = flat.dictionary_encode()
        number = np.array([self.vocabulary.get(w, 0) for w in coded.dictionary.to_pylist()], np.uint64)
        ids = number[coded.indices.to_numpy()]
        end = np.repeat(np.cumsum(counts), counts)
        at = np.flatnonzero((ids > 0) & (np.arange(len(ids)) + self.lead <= end))
        if not len(at):
            return counts, none, none
        lead = self.lead_hash([ids[at + j] for j in range(self.lead)])
        pos = np.minimum(np.searchsorted(self.known, lead), len(self.known) - 1)
        hit = self.known[pos] == lead
        at, lead = at[hit], np.unique(lead[hit])
        if not len(at):
            return counts, none, none
        # The suffix array: word positions in the order of the words that follow.
        matrix = np.zeros((len(at), self.window), np.uint64)
        for j in range(self.window):
            inside = at + j < end[at]
            matrix[inside, j] = ids[at[inside] + j]
        suffixes = self.keys(matrix)
        order = np.argsort(suffixes, kind="stable")
        suffixes, at = suffixes[order], at[order]
        ask = np.flatnonzero(np.isin(self.leads, lead))
        lo, hi = np.searchsorted(suffixes, self.low[ask], "left"), np.searchsorted(suffixes, self.high[ask], "right")
        n = np.maximum(hi - lo, 0)
        place = at[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        return counts, place, np.repeat(ask, n)


HITS = "doc_id long, mark long, n_words long, spans array<long>, items array<long>"
HITS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()),
                         ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.int64()))])
MATCHES = pa.schema([(c, pa.int64()) for c in ("doc_id", "item_id", "doc_start", "item_start", "n_words")])


def _column(rows: pa.RecordBatch, name: str):
    return rows.column(rows.schema.get_field_index(name)).cast(pa.int64())


def text_mark(texts: list) -> pa.Array:
    """A hash of each text, to tell rows with the same id but other texts apart."""
    return pa.array([xxhash.xxh3_64_intdigest(t or b"") - (1 << 63) for t in texts], pa.int64())


def _scan(sent):
    def run(batches):
        block = sent.value
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                counts, place, which = block.search(texts)
                starts = np.cumsum(counts) - counts
                doc = np.searchsorted(starts, place, "right") - 1
                spans, items = [None] * len(texts), [None] * len(texts)
                for i in np.unique(doc):
                    mine = doc == i
                    a = place[mine] - starts[i]
                    spans[i] = _merged(np.stack([a, a + block.lengths[which[mine]]], 1)).ravel().tolist()
                    items[i] = sorted({item for w in set(which[mine].tolist()) for item, _ in block.places[w] if item is not None})
                yield pa.record_batch([_column(rows, "doc_id"), _column(rows, "mark"), pa.array(counts), pa.array(spans, pa.list_(pa.int64())),
                                       pa.array(items, pa.list_(pa.int64()))], schema=HITS_SCHEMA)

    return run


def _merged(spans: np.ndarray) -> np.ndarray:
    """Union of half-open spans as disjoint spans in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.r_[True, spans[1:, 0] > reach[:-1]]
    return np.stack([spans[first, 0], reach[np.r_[np.flatnonzero(first)[1:] - 1, len(spans) - 1]]], 1)


def _finish(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                        ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
    nothing = hashlib.sha256(b"").hexdigest()
    for rows in batches:
        hit, number, digest = [], [], []
        for spans, items in zip(rows.column(3).to_pylist(), rows.column(4).to_pylist(), strict=True):
            merged = _merged(np.array(spans, np.int64).reshape(-1, 2)) if spans else np.zeros((0, 2), np.int64)
            names = sorted({str(x) for x in items or ()})
            hit.append(int((merged[:, 1] - merged[:, 0]).sum()))
            number.append(len(names))
            digest.append(hashlib.sha256(",".join(names).encode()).hexdigest() if names else nothing)
        yield pa.record_batch([rows.column(0), rows.column(1), rows.column(2), pa.array(hit, pa.int64()), pa.array(number, pa.int64()),
                               pa.array(digest), pa.array([h > 0 for h in hit])], schema=schema)


def _blocks(benchmark: DataFrame, window: int):
    """Test items in blocks of bounded size, sent to the tasks one after the other."""
    items = C.narrow(benchmark, "item_id", "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // BLOCK_BYTES))
    for b in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield items.sparkSession.sparkContext.broadcast(TestBlock([(r[0], r[1]) for r in part.toLocalIterator()], window))


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``contamination``, with ``mark``, the key of the row's text."""
    docs = C.narrow(docs, "doc_id", "text").withColumn("mark", C.text_key())
    passes = [docs.mapInArrow(_scan(block), HITS) for block in _blocks(benchmark, window)]
    found = passes[0]
    if len(passes) > 1:
        hits = passes[1].filter("spans is not null")
        for p in passes[2:]:
            hits = hits.unionByName(p.filter("spans is not null"))
        more = (hits.groupBy("doc_id", "mark").agg(F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i"))
                .withColumnsRenamed({"doc_id": "d", "mark": "m"}))
        found = (found.join(more, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")
                 .select("doc_id", "mark", "n_words", F.concat(F.coalesce("spans", F.array().cast("array<long>")), F.coalesce("s", F.array().cast("array<long>"))).alias("spans"),
                         F.concat(F.coalesce("items", F.array().cast("array<long>")), F.coalesce("i", F.array().cast("array<long>"))).alias("items")))
    return found.mapInArrow(_finish, "doc_id long, mark long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each row of ``docs`` (``doc_id, text``; others ignored): ``doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated``, against ``benchmark`` (``item_id, text``).

    A window is ``window`` consecutive words of an item (all words of a shorter one; items without words
    have none). A word inside any occurrence of a window is hit. Null and empty texts have no words.
    An item with a null id marks words but is not counted or listed; equal ids count
    once. Repeated rows give a row each. An empty benchmark hits nothing; an empty table gives no rows."""
    return judged(docs, benchmark, window).drop("mark")


def _longest(sent):
    def run(batches):
        block = sent.value
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                counts, place, which = block.search(texts)
                starts = np.cumsum(counts) - counts
                doc = np.searchsorted(starts, place, "right") - 1
                ids = _column(rows, "doc_id").to_pylist()
                where: dict[tuple, list[int]] = {}
                for d, p, w in zip(doc.tolist(), place.tolist(), which.tolist(), strict=True):
                    for item, q in block.places[w]:
                        where.setdefault((d, item, p - int(starts[d]) - q, len(block.windows[w])), []).append(q)
                out = []
                for (d, item, diagonal, n), qs in where.items():
                    qs = np.unique(qs)
                    first = np.flatnonzero(np.r_[True, np.diff(qs) > 1])
                    last = np.r_[first[1:] - 1, len(qs) - 1]
                    out += [(ids[d], item, int(qs[a]) + diagonal, int(qs[a]), int(qs[b] - qs[a]) + n) for a, b in zip(first, last, strict=True)]
                yield pa.record_batch([pa.array([x[i] for x in out], pa.int64()) for i in range(5)], schema=MATCHES)

    return run


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Longest verbatim matches: ``doc_id, item_id, doc_start, item_start, n_words`` (words from 0)."""
    docs = C.narrow(docs, "doc_id", "text")
    out = None
    for block in _blocks(benchmark, window):
        part = docs.mapInArrow(_longest(block), "doc_id long, item_id long, doc_start long, item_start long, n_words long")
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, without those that hold a test window. A row is named by its id and text: a null id
    is a value like others, and a clean text that shares an id with a contaminated one stays."""
    return C.drop_rows(docs, C.materialize(judged(docs, benchmark, window).filter("contaminated").select("doc_id", "mark")))
