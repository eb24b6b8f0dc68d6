"""Ranked lexical search for many items at once, by common-subexpression evaluation.

A document's score for an item is a sum over the item's terms, so items that share terms share part of the sum.

1. *Shared term sets.* Terms that stand in exactly the same items are one *atom*. From there the pair of nodes that most
   items have in common becomes a new node, which replaces the pair in these items, until no pair is shared. The result
   is a query-sharing DAG: a node is the sum of two others, and an item is the sum of the few nodes that are left to it.
   It is mined per block of items; a block's size is bounded, whatever the number of items.
2. *Counts.* One pass over the documents counts the block's terms (a written table of term ids and counts a document),
   from which Spark takes N, L and each term's df.
3. *Accumulators.* A second pass adds up each document's atoms, and then each node of the DAG once, level by level, for a
   batch of documents at a time; an item's score is the sum of its nodes. A task keeps each item's ``top`` documents.
4. *Ranks.* The tasks' winners are ranked per item in two steps, so no item's candidates meet unbounded in one task.

All arithmetic is in 64-bit integers, but for the term weights, which come from the natural logarithm in doubles."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm import common as C

#: Most (item, term) pairs of one block of items; an item with more is a block of its own.
BLOCK_TERMS = 200_000
#: Cells (documents by DAG nodes) of one accumulator matrix in a task.
CELLS = 2_000_000
#: Groups that an item's candidates are dealt to before the last ranking, and candidates in one of them.
DEALT_ROWS = 100_000


@dataclass
class Plan:
    """The DAG of one block. Nodes below ``atoms`` are atoms; node ``atoms + i`` is the sum of ``pairs[i]``; an item is the
    sum of its ``items`` nodes.
    ``levels`` cuts the pairs into runs whose members do not depend on each other."""

    atom_of: np.ndarray
    atoms: int
    pairs: np.ndarray
    levels: list[tuple[int, int]]
    items: list[np.ndarray]


def mine(items: list[set[int]], n_terms: int) -> Plan:
    """Share term sets among items (sets of term ids): atoms first, then the most shared pair again and again."""
    of_term: list[list[int]] = [[] for _ in range(n_terms)]
    for i, terms in enumerate(items):
        for t in terms:
            of_term[t].append(i)
    atom_of, ids = np.zeros(n_terms, np.int64), {}
    for t, held in enumerate(of_term):
        atom_of[t] = ids.setdefault(tuple(held), len(ids))
    nodes: list[set[int]] = [{int(atom_of[t]) for t in terms} for terms in items]
    holders: dict[int, set[int]] = defaultdict(set)
    for i, held in enumerate(nodes):
        for x in held:
            holders[x].add(i)
    pairs: list[tuple[int, int]] = []
    level = [0] * len(ids)
    shared = {x for x, held in holders.items() if len(held) > 1}
    count: dict[tuple[int, int], int] = defaultdict(int)
    for held in nodes:
        mine_ = sorted(held & shared)
        for a, x in enumerate(mine_):
            for y in mine_[a + 1:]:
                count[x, y] += 1
    heap = [(-n, p) for p, n in count.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (x, y) = heapq.heappop(heap)
        both = holders[x] & holders[y]
        if len(both) < 2:
            continue
        if len(both) != -n:
            heapq.heappush(heap, (-len(both), (x, y)))
            continue
        new = len(level)
        pairs.append((x, y))
        level.append(1 + max(level[x], level[y]))
        near: dict[int, int] = defaultdict(int)
        for i in both:
            nodes[i] -= {x, y}
            holders[x].discard(i)
            holders[y].discard(i)
            for z in nodes[i]:
                near[z] += 1
            nodes[i].add(new)
        holders[new] = both
        for z, m in near.items():
            if m > 1:
                heapq.heappush(heap, (-m, (z, new)))
    # nodes in the order of their level, so that a level is one vectorised addition
    atoms, of_level = len(ids), np.array(level[len(ids):], np.int64)
    order = np.argsort(of_level, kind="stable")
    place = np.concatenate([np.arange(atoms), np.empty(len(order), np.int64)]).astype(np.int64)
    place[atoms + order] = atoms + np.arange(len(order))
    ordered = place[np.array(pairs, np.int64).reshape(-1, 2)][order]
    cuts = np.flatnonzero(np.diff(of_level[order])) + 1
    edges = [0, *cuts.tolist(), len(order)] if len(order) else []
    return Plan(atom_of, atoms, ordered, list(zip(edges[:-1], edges[1:])), [place[np.array(sorted(held), np.int64)] for held in nodes])


def combine(partial: np.ndarray, plan: Plan) -> np.ndarray:
    """Scores (items by documents) from the sums of each document's atoms (atoms by documents): every node once."""
    sums = np.empty((plan.atoms + len(plan.pairs), partial.shape[1]), np.int64)
    sums[: plan.atoms] = partial
    for lo, hi in plan.levels:
        x, y = plan.pairs[lo:hi].T
        np.add(sums[x], sums[y], out=sums[plan.atoms + lo:plan.atoms + hi])
    return np.stack([sums[held].sum(0) for held in plan.items])


def _count(vocabulary):
    """Per document with a term: its doc_id, its number of terms, and the ids and counts of the block's terms in it."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        known = vocabulary.value
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                keep, n, terms, counts = [], [], [], []
                for i, t in enumerate(texts):
                    words = t.translate(C.ALNUM).split() if t else []
                    if not words:
                        continue
                    ids = np.fromiter((x for x in map(known.get, words) if x is not None), np.int32)
                    ids, times = np.unique(ids, return_counts=True)
                    keep.append(i)
                    n.append(len(words))
                    terms.append(ids.tobytes())
                    counts.append(times.astype(np.int64).tobytes())
                yield pa.record_batch([rows.column(rows.schema.get_field_index("doc_id")).cast(pa.int64()).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                                       pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], schema=schema)

    return run


def _frequencies(size: int):
    """Documents that hold each term, summed within a task."""
    schema = pa.schema([("term", pa.int32()), ("df", pa.int64())])

    def run(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                held[np.frombuffer(blob, np.int32)] += 1
        some = np.flatnonzero(held)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(held[some])], schema=schema)

    return run


def term_scores(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class _Winners:
    """The best documents of one item so far: by score, then by the smaller doc_id (null last)."""

    def __init__(self, top: int):
        self.top, self.score, self.doc, self.floor = top, np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.r_[self.score, score], np.r_[self.doc, doc]
        best = np.lexsort((doc, -score))[: self.top]
        self.score, self.doc = score[best], doc[best]
        self.floor = int(self.score[-1]) if len(best) == self.top else 0


#: Stands for a null doc_id in a task's ranking, where it comes last among equal scores.
_NULL_ID = np.int64(2 ** 63 - 1)


def _search(shared, top: int):
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        plan, weights, n_docs, n_terms = shared.value
        step = max(1, CELLS // (plan.atoms + len(plan.pairs) + len(plan.items) + 1))
        winners = [_Winners(top) for _ in plan.items]
        for batch in batches:
            doc = batch.column(0).fill_null(int(_NULL_ID)).to_numpy(zero_copy_only=False)
            length = batch.column(1).to_numpy(zero_copy_only=False)
            terms, counts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for at in range(0, len(doc), step):
                ids = [np.frombuffer(b, np.int32) for b in terms[at:at + step]]
                row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
                if not len(row):
                    continue
                flat = np.concatenate(ids)
                tf = np.concatenate([np.frombuffer(b, np.int64) for b in counts[at:at + step]])
                m = 100 - 50 + (50 * length[at:at + step] * n_docs) // n_terms
                partial = np.zeros((plan.atoms, len(ids)), np.int64)
                np.add.at(partial, (plan.atom_of[flat], row), term_scores(weights[flat], tf, m[row]))
                scores, docs = combine(partial, plan), doc[at:at + step]
                floors = np.array([max(w.floor, 1) for w in winners])
                for i in np.flatnonzero((scores >= floors[:, None]).any(1)):
                    hit = scores[i] >= floors[i]
                    winners[i].add(scores[i, hit], docs[hit])
        for i, w in enumerate(winners):
            if len(w.doc):
                yield pa.record_batch([pa.array(np.full(len(w.doc), i), pa.int32()), pa.array(w.doc, mask=w.doc == _NULL_ID), pa.array(w.score)], schema=schema)

    return run


def item_blocks(items: DataFrame) -> Iterator[list[tuple[object, set[bytes]]]]:
    """Blocks of (item_id, terms) of at most ``BLOCK_TERMS`` pairs, read one partition after the other."""
    rows = (items.groupBy("item_id").agg(F.collect_list(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("texts")).orderBy("item_id"))
    held, size = [], 0
    for r in rows.toLocalIterator():
        terms = {w for t in r.texts for w in bytes(t).translate(C.ALNUM).split()}
        if held and size + len(terms) > BLOCK_TERMS:
            yield held
            held, size = [], 0
        held.append((r.item_id, terms))
        size += len(terms)
    if held:
        yield held


def search_block(docs: DataFrame, block: list[tuple[object, set[bytes]]], top: int) -> DataFrame | None:
    """``item`` (place in the block), ``doc_id``, ``score``: the best documents of each task."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(terms for _, terms in block))))}
    if not vocabulary:
        return None
    known = spark.sparkContext.broadcast(vocabulary)
    counted = C.materialize(docs.mapInArrow(_count(known), "doc_id long, n long, terms binary, counts binary"))
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for r in counted.select("terms").mapInArrow(_frequencies(len(vocabulary)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    plan = mine([{vocabulary[t] for t in terms} for _, terms in block], len(vocabulary))
    shared = spark.sparkContext.broadcast((plan, weights, n_docs, n_terms))
    return C.materialize(counted.mapInArrow(_search(shared, top), "item int, doc_id long, score long"))


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 50) -> DataFrame:
    """``docs``: ``doc_id, text``; ``items``: ``item_id, text`` (other columns are ignored). Returns ``item_id, rank, doc_id,
    score``: the ``top`` documents of each item with a score above 0, equal scores by ascending doc_id.

    Rows that repeat an item_id are one item with the terms of all of them, null item_ids too. Every row of ``docs`` is a
    document of its own; a null doc_id comes last among equal scores. Null and empty texts have no terms: such documents
    are found by nothing and are not counted, such items find nothing. Empty tables give no rows."""
    docs, items = C.narrow(docs, "doc_id", "text"), C.narrow(items, "item_id", "text")
    kind = items.schema["item_id"].dataType.simpleString()
    found = None
    for block in item_blocks(items):
        part = search_block(docs, block, top)
        if part is None:
            continue
        names = docs.sparkSession.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item int, item_id {kind}")
        part = part.join(F.broadcast(names), "item").drop("item")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    deal = max(1, found.count() // DEALT_ROWS)
    first = (found.withColumn("deal", F.pmod(F.xxhash64("doc_id", "score"), F.lit(deal)))
             .withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "deal").orderBy(*order))).filter(F.col("rank") <= top))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))
