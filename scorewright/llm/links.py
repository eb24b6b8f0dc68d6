"""Exact links between sets of word n-grams, for the joins that find candidates by sketches.

A *class* is all documents with the same set (a 64-bit digest). Candidates come as pairs of classes (``confirm``) or as
large groups of classes (``open_links``); both are decided on the full sorted arrays of hashes. What they return joins
the classes as all links do, without a row for each pair: ``confirm`` checks a class's best partner first, then only pairs
between different components; ``open_links`` compares blocks of a group in tasks that hold a union-find, so that a task
returns fewer pairs than it has members."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm import common as C
from scorewright.llm.components import components

#: Most classes and bytes of sorted arrays in one block of a large group.
BLOCK = 1024
BLOCK_BYTES = 24 << 20
#: Bytes of a block from which its task gives memory back at its end.
LARGE_BLOCK = 2 << 20
#: Groups (the first ones in order) that a member carries, to tell that a pair has met in an earlier group.
LEAST = 16
#: Rounds of checking forests by fine bitmaps, and refuted pairs that may be broadcast to the next one.
ROUNDS, REFUTED = 3, 200_000
#: Bytes of sorted arrays, over all rows of members, up to which the undecided members of large groups need no forests.
EXACT_BYTES = 32 << 20
#: Bits of the smallest fine bitmap.
FINE_BITS = 512


def gram_sets(texts: list, k: int) -> list[np.ndarray]:
    """The sorted distinct k-gram hashes of each text (fewer than k words: all words as one gram)."""
    words, counts = C.word_hashes(texts, C.LOWER)
    grams = C.gram_hashes(words, k)
    out, at = [], 0
    for n in counts:
        if n == 0:
            out.append(np.zeros(0, np.uint64))
        elif n < k:
            out.append(C.gram_hashes(words[at:at + n], int(n)))
        else:
            out.append(np.unique(grams[at:at + n - k + 1]))
        at += int(n)
    return out


def set_digest(s: np.ndarray) -> int:
    """Signed 64-bit digest of a set."""
    total = C.mix64(s).sum(dtype=np.uint64) if len(s) else np.uint64(0)
    return int(C.mix64(np.array([total + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def fine_bitmap(s: np.ndarray) -> bytes:
    """As ``bitmap``, of a power of two of at least four bits a gram; memory is that of the set."""
    m = max(FINE_BITS, 1 << (4 * len(s) - 1).bit_length()) if len(s) else FINE_BITS
    bucket, count = np.unique((s >> np.uint64(20)) & np.uint64(m - 1), return_counts=True)
    odd = bucket[count % 2 == 1].astype(np.int64)
    out = np.zeros(m // 8, np.uint8)
    np.bitwise_or.at(out, odd >> 3, (128 >> (odd & 7)).astype(np.uint8))
    return out.tobytes()


def fine_differ(x: bytes, y: bytes) -> int:
    """Bits in which two fine bitmaps differ, at the length of the shorter one."""
    m = min(len(x), len(y))
    a, b = (np.bitwise_xor.reduce(np.frombuffer(z, np.uint64).reshape(-1, m // 8), axis=0) for z in (x, y))
    return int(np.bitwise_count(a ^ b).sum(dtype=np.int64))


def _grams(k: int, fine: bool):
    """Of each document with words its class, its size, and its fine bitmap or its sorted array."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("grams", pa.binary())])

    def run(batches):
        for batch in batches:
            for _, texts in C.slices(batch, "text"):
                sets = [s for s in gram_sets(texts, k) if len(s)]
                yield pa.record_batch([pa.array([set_digest(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                                       pa.array([fine_bitmap(s) if fine else s.tobytes() for s in sets], pa.binary())], schema=schema)

    return run


def _overlap(x: bytes, y: bytes) -> int:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    at = np.searchsorted(x, y)
    return int((x[np.minimum(at, len(x) - 1)] == y).sum())


def _check(percent: int, fine: bool):
    """The pairs whose overlap is large enough: by its upper bound from fine bitmaps, or as it is from sorted arrays."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("u_doc", pa.int64()), ("v_doc", pa.int64())])

    def run(batches):
        for batch in batches:
            total, x, y = (batch.column(i).to_pylist() for i in range(4, 7))
            both = [(t - fine_differ(a, b)) // 2 if fine else _overlap(a, b) for t, a, b in zip(total, x, y, strict=True)]
            keep = pa.array([100 * o >= percent * (t - o) for t, o in zip(total, both, strict=True)], pa.bool_())
            yield pa.record_batch([batch.column(i).filter(keep) for i in range(4)], schema=schema)
            del x, y
        C.release()

    return run


def compare(docs: DataFrame, pairs: DataFrame, k: int, percent: int, fine: bool) -> DataFrame:
    """Of the pairs (u, v, u_doc, v_doc) those that pass one check, made from the texts of only these documents."""
    wanted = C.materialize(pairs.select(F.col("u_doc").alias("wanted")).union(pairs.select("v_doc")).distinct())
    few = wanted.limit(C.BROADCAST_IDS + 1).count() <= C.BROADCAST_IDS
    grams = C.materialize(docs.join(F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
                          .mapInArrow(_grams(k, fine), "node long, n long, grams binary"))
    out = C.materialize(pairs.join(grams.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("grams").alias("x")), "u")
                        .join(grams.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("grams").alias("y")), "v")
                        .select("u", "v", "u_doc", "v_doc", F.col("n_u") + F.col("n_v"), "x", "y")
                        .mapInArrow(_check(percent, fine), "u long, v long, u_doc long, v_doc long"))
    C.forget(wanted, grams)
    return out


def intersect(docs: DataFrame, near: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the pairs those that link: by fine bitmaps first, then by the sorted arrays of those that are left."""
    left = compare(docs, near.select("u", "v", "u_doc", "v_doc"), k, percent, True)
    return compare(docs, left, k, percent, False).select("u", "v")


def confirm(docs: DataFrame, near: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links among the pairs ``u, v, u_doc, v_doc, near`` (``near``: how promising) that join them as all links do, and the
    components. Each class is checked with its most promising partner first; pairs inside a component add nothing, so of
    the others only those between different components are checked: arrays move about once a class, not once a pair."""
    best = near.groupBy("v").agg(F.max(F.struct("near", "u", "u_doc", "v_doc")).alias("b")).select("b.u", "v", "b.u_doc", "b.v_doc")
    links = intersect(docs, C.materialize(best), k, percent)
    linked = components(links)
    of = lambda c: linked.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in"))
    rest = C.materialize(near.join(of("u"), "u", "left").join(of("v"), "v", "left")
                         .filter(F.coalesce("u_in", "u") != F.coalesce("v_in", "v")).select("u", "v", "u_doc", "v_doc"))
    if rest.limit(1).count():
        links = links.unionByName(intersect(docs, rest, k, percent))
        linked = components(links)
    return links, linked


class _Block:
    """Members of one block pair: each class once, with its size, component and sketch."""

    def __init__(self, key, rows, sketch: list[str], percent: int):
        self.rows, self.percent, self.same = rows, percent, key[1].as_py() == key[2].as_py()
        node, first = np.unique(rows.column("node").to_numpy(), return_index=True)
        self.node, self.first, self.n = node, first, rows.column("n").to_numpy()[first]
        self.component = np.unique(rows.column("component").to_numpy()[first], return_inverse=True)[1]
        self.sketch = np.stack([rows.column(c).to_numpy()[first] for c in sketch], 1).view(np.uint64)
        self.shared = self._earlier(rows, first, key[0].as_py())
        block = rows.column("block").to_numpy()[first]
        self.left, self.right = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())

    @staticmethod
    def _earlier(rows, first: np.ndarray, sig: int) -> np.ndarray:
        """One bit a member for each group before this one that its ``least`` list names."""
        lists = rows.column("least").combine_chunks().take(pa.array(first))
        owner = np.repeat(np.arange(len(first)), lists.value_lengths().to_numpy())
        groups = lists.flatten().to_numpy()
        owner, groups = owner[groups < sig], groups[groups < sig]
        names, at = np.unique(groups, return_inverse=True)
        bits = np.zeros((len(first), len(names) // 64 + 1), np.uint64)
        np.bitwise_or.at(bits, (owner, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
        return bits

    def partners(self, a: int, near: Callable) -> np.ndarray:
        """Members of the other block (or later ones of the same) in another component that the sketch lets pass, without
        pairs that an earlier group has, too."""
        r = self.right[self.right > a] if self.same else self.right
        r = r[self.component[r] != self.component[a]]
        r = r[~(self.shared[r] & self.shared[a]).any(1)]
        n = self.n[r]
        r = r[100 * np.minimum(n, self.n[a]) >= self.percent * np.maximum(n, self.n[a])]
        return r[near(self.sketch, self.n, a, r)] if len(r) else r


def _tidy(rows) -> None:
    """Give memory back after a large block; small ones are not worth the call."""
    if rows.nbytes > LARGE_BLOCK:
        C.release()


def _kept(rows, b: _Block, members: np.ndarray):
    """One row of each of these members."""
    kept = rows.take(pa.array(b.first[members]))
    _tidy(rows)
    at, kind = kept.column_names.index("least"), pa.list_(pa.int64())
    return kept.set_column(at, pa.field("least", kind), kept.column(at).cast(kind))


def _flag(sketch: list[str], near: Callable, percent: int):
    """Members of a block pair that have a partner by the sketch: at most one row a member."""

    def run(key, rows):
        b = _Block(key, rows, sketch, percent)
        open_ = np.zeros(len(b.node), bool)
        for a in b.left:
            r = b.partners(a, near)
            if len(r):
                open_[a] = True
                open_[r] = True
        return _kept(rows, b, open_)

    return run


class _Fine:
    """Fine bitmaps of a block's members, folded to every length that occurs: a pair is compared at the shorter one's."""

    def __init__(self, blobs: list[bytes]):
        self.length = np.array([len(b) for b in blobs], np.int64)
        self.at: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for m in np.unique(self.length):
            held = np.flatnonzero(self.length >= m)
            place = np.full(len(blobs), -1, np.int64)
            place[held] = np.arange(len(held))
            folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(blobs[i], np.uint64).reshape(-1, m // 8), axis=0) for i in held])
            self.at[int(m)] = (place, folded)

    def differ(self, a: int, r: np.ndarray) -> np.ndarray:
        """Bits in which member ``a`` differs from each of the others."""
        out = np.empty(len(r), np.int64)
        short = np.minimum(self.length[r], self.length[a])
        for m in np.unique(short):
            place, bits = self.at[int(m)]
            mine = short == m
            out[mine] = np.bitwise_count(bits[place[r[mine]]] ^ bits[place[a]]).sum(1, dtype=np.int64)
        return out


def _fine_partners(b: _Block, rows, near: Callable, percent: int, refuted: set):
    """Of each left member the partners that the fine bitmaps let pass, without refuted pairs. Components that the caller
    joins meanwhile count at once."""
    blobs = rows.column("grams").combine_chunks()
    fine = _Fine([blobs[int(i)].as_py() for i in b.first])
    for a in b.left:
        r = b.partners(a, near)
        if not len(r):
            continue
        total = b.n[r] + b.n[a]
        most = (total - fine.differ(a, r)) // 2
        r = r[100 * most >= percent * (total - most)]
        if refuted and len(r):
            low, high = np.minimum(b.node[r], b.node[a]).tolist(), np.maximum(b.node[r], b.node[a]).tolist()
            r = r[[pair not in refuted for pair in zip(low, high, strict=True)]]
        if len(r):
            yield a, r


def _forest(sketch: list[str], near: Callable, percent: int, refuted):
    """Pairs that the fine bitmaps let pass and that join the components of a block pair's members: fewer than the members.
    A pair whose ends were joined by others is not returned; ``refuted`` pairs join nothing."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(key, rows):
        b, u, v = _Block(key, rows, sketch, percent), [], []
        for a, r in _fine_partners(b, rows, near, percent, refuted.value):
            for x in r:
                if b.component[x] != b.component[a]:
                    u.append(int(min(b.node[a], b.node[x])))
                    v.append(int(max(b.node[a], b.node[x])))
                    b.component[b.component == b.component[x]] = b.component[a]
        _tidy(rows)
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=schema)

    return run


def _undecided(sketch: list[str], near: Callable, percent: int, refuted, columns: list[str]):
    """Members of a block pair with a partner in another component that the fine bitmaps let pass and no check refuted."""

    def run(key, rows):
        b = _Block(key, rows, sketch, percent)
        open_ = np.zeros(len(b.node), bool)
        for a, r in _fine_partners(b, rows, near, percent, refuted.value):
            open_[a] = True
            open_[r] = True
        return _kept(rows.select(columns), b, open_)

    return run


def _exact(sketch: list[str], near: Callable, percent: int):
    """Links that join the components of a block pair's members, found on the sorted arrays: fewer than the members."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(key, rows):
        b = _Block(key, rows, sketch, percent)
        blobs = rows.column("grams").combine_chunks()
        arrays = [np.frombuffer(blobs[int(i)].as_py(), np.uint64) for i in b.first]
        sizes = np.array([len(x) for x in arrays], np.int64)
        vocabulary, ids = np.unique(np.concatenate(arrays), return_inverse=True)
        at = np.cumsum(sizes) - sizes
        inside = np.zeros(len(vocabulary), bool)
        u, v = [], []
        for a in b.left:
            r = b.partners(a, near)
            if not len(r):
                continue
            mine = ids[at[a]:at[a] + sizes[a]]
            inside[mine] = True
            for part in np.array_split(r, -(-len(r) // 256)):
                part = part[b.component[part] != b.component[a]]
                if not len(part):
                    continue
                length = sizes[part]
                place = np.arange(length.sum()) + np.repeat(at[part] - (np.cumsum(length) - length), length)
                both = np.add.reduceat(inside[ids[place]], np.cumsum(length) - length, dtype=np.int64)
                for x in part[100 * both >= percent * (length + sizes[a] - both)]:
                    if b.component[x] != b.component[a]:
                        u.append(min(b.node[a], b.node[x]))
                        v.append(max(b.node[a], b.node[x]))
                        b.component[b.component == b.component[x]] = b.component[a]
            inside[mine] = False
        del vocabulary, ids, inside, arrays, blobs
        _tidy(rows)
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=schema)

    return run


def open_links(docs: DataFrame, groups: DataFrame, linked: DataFrame, classes: DataFrame, k: int, percent: int,
               sketch: list[str], near: Callable, block: int = BLOCK, exact_bytes: int | None = None) -> DataFrame | None:
    """Links across components inside large groups; None if there are none.

    ``groups``: ``sig, node``, one row a member. ``linked``: ``node, component`` so far. ``classes``: ``node, low`` (a
    document of the class), ``n`` and the ``sketch`` columns. ``near(sketches, sizes, a, others)`` says which of the
    others may link with member ``a``; it must let every link pass. Groups that are one component by now are done.

    The others are cut into blocks; for each pair of blocks one task compares sketches and returns the members that are
    still open. Two members often meet in many groups: each carries its first ``LEAST`` groups, and a pair that has one of
    these in common is left to the first of them. These get fine bitmaps, and members without a partner by them end there.
    If the others' sorted arrays are at most ``exact_bytes`` (``EXACT_BYTES``) in all, they are decided at once, block pair by block pair: a
    round below costs dozens of small jobs, whatever the rows. Else a task returns a forest of pairs that join its members if they are
    links; the forest's pairs are checked on the sorted arrays. If all are links, nothing that they hid is missing. Else
    the next round leaves the refuted pairs out; after ``ROUNDS`` of them, or with too many refuted pairs to broadcast, the
    members that still have an undecided partner by then are decided on their sorted arrays, too."""
    exact_bytes = EXACT_BYTES if exact_bytes is None else exact_bytes
    known = classes.select("node", "n").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    member = groups.join(known, "node")
    tile = (member.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("grams"),
                                      F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark"))
            .filter("lo <> hi").groupBy("mark", "m", "grams").agg(F.min("sig").alias("sig")))
    blocks = F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("grams") * 8 / BLOCK_BYTES)).cast("int")
    tile = C.materialize(tile.select("sig", "m", blocks.alias("nb")))
    if not tile.limit(1).count():
        return None
    types = ("sig long, i int, j int, node long, n long, component long, block int, least array<long>, " + ", ".join(f"{c} long" for c in sketch))
    held = C.materialize(C.join_by_key(member, tile, "sig", "m", groups.count()).filter("nb is not null").select("sig", "node", "n", "component", "nb"))
    least = held.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("sig")), 1, LEAST).alias("least"))
    rows = (held.join(least.join(classes.select("node", *sketch), "node"), "node")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("nb").cast("long")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .select("sig", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "n", "component", "block", "least", *sketch))
    left = C.materialize(rows.groupBy("sig", "i", "j").applyInArrow(_flag(sketch, near, percent), types))
    if not left.limit(1).count():
        return None
    low = classes.select("node", "low")

    def made(nodes: DataFrame, fine: bool) -> DataFrame:
        """Fine bitmaps or sorted arrays of the classes of ``nodes``, from one document of each."""
        wanted = C.materialize(nodes.distinct().join(low, "node").select(F.col("low").alias("wanted")).distinct())
        few = wanted.limit(C.BROADCAST_IDS + 1).count() <= C.BROADCAST_IDS
        return C.materialize(docs.join(F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
                             .mapInArrow(_grams(k, fine), "node long, n long, grams binary").select("node", "grams"))

    bitmaps, links, refuted = made(left.select("node"), True), None, set()

    def undecided(rows: DataFrame) -> DataFrame:
        """The members that still have a partner by the fine bitmaps, without the refuted pairs."""
        no = docs.sparkSession.sparkContext.broadcast(refuted)
        out = C.materialize(rows.join(bitmaps, "node").groupBy("sig", "i", "j").applyInArrow(_undecided(sketch, near, percent, no, left.columns), types))
        C.forget(left)
        return out

    left = undecided(left)
    for _ in range(ROUNDS):
        grams = left.agg(F.sum("n")).first()[0]
        if grams is None:
            return links
        if grams * 8 <= exact_bytes:
            break
        no = docs.sparkSession.sparkContext.broadcast(refuted)
        pairs = C.materialize(left.join(bitmaps, "node").groupBy("sig", "i", "j").applyInArrow(_forest(sketch, near, percent, no), "u long, v long").distinct()
                              .join(low.select(F.col("node").alias("u"), F.col("low").alias("u_doc")), "u")
                              .join(low.select(F.col("node").alias("v"), F.col("low").alias("v_doc")), "v").select("u", "v", "u_doc", "v_doc"))
        good = compare(docs, pairs, k, percent, False).select("u", "v").distinct()
        links = good if links is None else links.unionByName(good)
        wrong = pairs.join(good, ["u", "v"], "left_anti").select("u", "v")
        n_wrong = wrong.count()
        if not n_wrong:
            return links
        found = components(links.unionByName(linked.filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))))
        many = n_wrong + len(refuted) > REFUTED
        if not many:
            refuted |= {(r.u, r.v) for r in wrong.collect()}
        left = undecided(left.drop("component").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).select(*left.columns))
        if many:
            break
    if not left.limit(1).count():
        return links
    arrays = made(left.select("node"), False)
    more = C.materialize(left.join(arrays, "node").groupBy("sig", "i", "j").applyInArrow(_exact(sketch, near, percent), "u long, v long").distinct())
    C.forget(left, bitmaps, arrays)
    return more if links is None else links.unionByName(more)


def label(meta: DataFrame, classes: DataFrame, linked: DataFrame, rows: int) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``meta`` (``doc_id, n, node``). Only classes with copies or links
    have a component other than the document itself."""
    of_class = classes.select("node", "low", "copies").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = of_class.groupBy("component").agg(F.min("low").alias("component_id"), F.sum("copies").alias("size")).filter("size > 1")
    shared = C.materialize(of_class.join(lowest, "component").select("node", "copies", "component_id"))
    return (C.join_by_key(meta.select("doc_id", "n", "node"), shared, "node", "copies", rows)
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
