"""MinHash near-duplicates by an inverted join on signature coordinates.

Every document is the set of its distinct word n-grams (64-bit hashes); two documents link when
``100 * |intersection| >= percent * |union|``, which is confirmed on the full sets.

1. *Signatures.* Coordinate ``c`` of a set's signature is the smallest value of its hashes under the ``c``-th mixing.
   Two sets agree in a coordinate with probability equal to their Jaccard similarity. Documents with equal sets are one
   class with one signature.
2. *Match threshold.* Sets that link agree in at least ``t`` of the ``COORDINATES``, but for a chance of ``MISS`` a pair: ``t`` is
   the largest number for which the binomial tail below it stays within ``MISS``. The tail is what this method can lose.
3. *Postings.* Each class is posted under each of its (coordinate, value) pairs. A pair that only one class has cannot
   collide, so only values with at least two classes are kept, and only classes with at least ``t`` of them.
4. *Prefix and skip merging.* The lists of a class are put in one order of all lists, shortest first. Two classes that
   agree in ``t`` coordinates share a list among the first ``s - t + 1`` of each (``s``: its lists). Only these are merged;
   the ``t - 1`` longest lists of every class, those of common passages above all, are skipped. Collisions of a candidate
   pair are then counted over all coordinates, skipped ones too, on the two signatures; pairs below ``t`` end there.
5. *Full sets.* What is left is confirmed on the sorted arrays of hashes.

Lists of up to ``SHORT`` classes give their pairs. Longer ones are first checked as a star around their smallest class;
lists whose classes are not one component by then are compared in blocks by tasks that return fewer links than members.
No list is turned into all its pairs and nothing is capped."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm import common as C
from scorewright.llm.components import components
from scorewright.llm.links import confirm, gram_sets, label, open_links, set_digest

COORDINATES = 32
#: Most chance that a pair exactly at the similarity threshold agrees in fewer coordinates than asked for.
MISS = 1e-7
#: Lists of up to so many classes give all their pairs.
SHORT = 8
SIGNATURE = [f"h{c}" for c in range(COORDINATES)]
#: Odd multipliers of the coordinates, from one rule.
_MIX = C.mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)


def match_threshold(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The largest number of matches that linked pairs fall short of with a chance of at most ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(coordinates):
        below += math.comb(coordinates, t) * p ** t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` values a set (zeros for an empty one)."""
    out = np.zeros((len(sets), COORDINATES), np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        grams = np.concatenate([sets[i] for i in full])
        sizes = np.array([len(sets[i]) for i in full])
        starts = np.cumsum(sizes) - sizes
        for c in range(COORDINATES):
            h = grams * _MIX[c]
            h ^= h >> np.uint64(29)
            h *= _MIX[c]
            out[full, c] = np.minimum.reduceat(h, starts)
    return out


def _sign(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), *[(c, pa.int64()) for c in SIGNATURE]])

    def run(batches):
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                sets = gram_sets(texts, k)
                yield pa.record_batch([rows.column(rows.schema.get_field_index("doc_id")).cast(pa.int64()),
                                       pa.array([len(s) for s in sets], pa.int64()),
                                       pa.array([set_digest(s) if len(s) else None for s in sets], pa.int64()),
                                       *[pa.array(h) for h in signatures(sets).view(np.int64).T.copy()]], schema=schema)

    return run


def postings(classes: DataFrame, t: int) -> DataFrame:
    """``node, key, center, m``: the lists (of ``m`` classes, the smallest is ``center``) that each class has in its prefix."""
    pairs = F.explode(F.array(*[F.xxhash64(F.lit(c), F.col(h)) for c, h in enumerate(SIGNATURE)]))
    posts = C.materialize(classes.select("node", pairs.alias("key")))
    lists = C.materialize(posts.groupBy("key").agg(F.count("*").alias("length")).filter("length > 1"))
    shared = C.join_by_key(posts, lists, "key", "length", posts.count()).filter("length is not null")
    own = Window.partitionBy("node")
    prefix = C.materialize(shared.withColumns({"place": F.row_number().over(own.orderBy("length", "key")), "s": F.count("*").over(own)})
                           .filter(F.col("place") <= F.col("s") - t + 1).select("node", "key"))
    merged = C.materialize(prefix.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("m")).filter("m > 1"))
    return C.join_by_key(prefix, merged, "key", "m", prefix.count()).filter("m is not null")


def colliding(pairs: DataFrame, classes: DataFrame, t: int) -> DataFrame:
    """The pairs (u, v) that agree in ``t`` coordinates, with a document of each class and the share that agrees."""
    same = sum((F.when(F.col(f"x.{h}") == F.col(f"y.{h}"), 1).otherwise(0) for h in SIGNATURE), F.lit(0))
    return (pairs.join(classes.alias("x"), F.col("u") == F.col("x.node")).join(classes.alias("y"), F.col("v") == F.col("y.node"))
            .withColumn("matches", same).filter(F.col("matches") >= t)
            .select("u", "v", F.col("x.low").alias("u_doc"), F.col("y.low").alias("v_doc"), (F.col("matches") / COORDINATES).alias("near")))


def _agree(t: int):
    def near(signature, n, a, r):
        return (signature[r] == signature[a]).sum(1) >= t

    return near


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs``: columns ``doc_id, text`` (others are ignored). Returns for each row ``doc_id``, ``n_shingles``,
    ``component_id`` (the smallest doc_id that it reaches by links) and ``kept`` (it is that document).

    Null and empty texts, and texts of white space, have no n-grams, link with nothing and are their own component.
    Repeated rows and equal texts are one class and give a row each; rows that repeat the component's doc_id are all
    kept. A null doc_id takes part and gets the smallest other doc_id of its component; alone it has a null component,
    and is kept. An empty table gives no rows."""
    docs = C.narrow(docs, "doc_id", "text")
    meta = C.materialize(docs.mapInArrow(_sign(k), "doc_id long, n long, node long, " + ", ".join(f"{h} long" for h in SIGNATURE)))
    classes = C.materialize(meta.filter("node is not null").groupBy("node")
                            .agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"), F.first("n").alias("n"), *[F.first(h).alias(h) for h in SIGNATURE]))
    t = match_threshold(percent)
    found = C.materialize(postings(classes, t))
    short = (found.filter(F.col("m") <= SHORT).groupBy("key").agg(F.sort_array(F.collect_set("node")).alias("nodes")).select("nodes").distinct()
             .select(F.expr("posexplode(nodes) as (i, u)"), "nodes")
             .select("u", F.expr("explode(slice(nodes, i + 2, size(nodes))) as v")))
    big = C.materialize(found.filter(F.col("m") > SHORT).select(F.col("key").alias("sig"), "node", F.col("center").alias("u")))
    pairs = C.materialize(short.unionByName(big.filter("node <> u").select("u", F.col("node").alias("v"))).distinct())

    links, linked = confirm(docs, C.materialize(colliding(pairs, classes, t)), k, percent)
    if big.limit(1).count():
        more = open_links(docs, big.select("sig", "node"), linked, classes, k, percent, SIGNATURE, _agree(t))
        if more is not None:
            linked = components(links.unionByName(more))
    return label(meta, classes, linked, meta.count()).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
