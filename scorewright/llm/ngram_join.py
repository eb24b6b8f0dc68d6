"""Exact n-gram Jaccard join: size-banded tiles, parity bitmaps, sorted-array intersection.

Every document is the set of its distinct word n-grams (64-bit hashes, kept sorted). Two
documents link when ``100 * |intersection| >= percent * |union|``.

1. *Classes.* Documents with the same set are one class (a 64-bit digest of the set); all that
   follows works on classes, so a hot group of copies counts once.
2. *Size-banded tiles.* Set sizes are cut into bands with ratio 100/percent; a *family* is two
   neighbouring bands, so two sets that link are together in at least one family. Sets that
   link differ by at most ``d`` grams, where ``d`` follows from the family's sizes. The range
   of hashes is cut into ``p > d`` parts: at least ``p - d`` parts of the two sets are equal, and
   as ``p`` leaves room for the empty parts that a set of this size usually has, a non-empty
   part is among them. A tile is (family, part, digest of the grams in it). A set with more
   empty parts than there is room for also enters tiles of its smallest grams (prefix
   filter); two such sets with a link share one of these.
3. *Bitmaps.* A set's bitmap holds, for each of 512 buckets, the parity of its grams there.
   Each bit in which two bitmaps differ needs another gram in only one of the sets, so the bit
   count of their XOR bounds the overlap from above; pairs whose bound is too low end here.
4. *Fine bitmaps.* 512 bits say little about long sets, so the pairs that are left meet the same bound once more, with
   bitmaps of 4 to 8 bits a gram, made for their documents only. Their length is a power of two: XOR of its
   parts folds a longer bitmap to the length of a shorter one. They are a tenth of the arrays' size.
5. *Exact check.* The sorted arrays of the remaining pairs are intersected.

Tiles of up to ``SMALL_TILE`` classes give all their pairs (the same pair from many tiles is
one). Larger ones are first checked as a star around their smallest class; a tile whose members
are then one component is done, and the members of the others are compared in blocks, by bitmap and
then by array, in tasks that return fewer links than members. No link between different sets is lost and no
group is turned into all its pairs. Two different sets have the same digest with probability
2^-64 a pair."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm import common as C
from scorewright.llm.components import components
from scorewright.llm.links import confirm, fine_bitmap, fine_differ, gram_sets, label, open_links, set_digest  # noqa: F401

BITS = 512
SMALL_TILE = 8
BLOCK = 1024
#: Tile entries that a task gathers before it sends them on, and that one bucket should get.
FLUSH = 250_000
BUCKET_ENTRIES = 200_000
#: Members of one tile in one flush that take the usual way; more are passed on as they are.
HOT_TILE = 32


def bitmap(s: np.ndarray) -> np.ndarray:
    bits = np.bincount((s >> np.uint64(20)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


class Families:
    """Parts of the families of set sizes for one similarity threshold."""

    def __init__(self, percent: int):
        self.percent, self.ratio = percent, 100 / percent
        self.plans: dict[int, tuple[int, int]] = {}

    def band(self, n: np.ndarray) -> np.ndarray:
        return np.floor(np.log(n + 1e-9) / math.log(self.ratio)).astype(np.int64)

    def differ(self, a: float, b: float) -> int:
        """The most grams in which two sets of these sizes can differ and still link."""
        return int(math.floor((100 - self.percent) * (a + b) / (100 + self.percent) + 1e-9))

    def plan(self, family: int) -> tuple[int, int]:
        """(parts, empty parts a set may have); (0, 0) if only equal sets link."""
        if family not in self.plans:
            low = max(1.0, self.ratio ** family)
            high = math.ceil(self.ratio ** (family + 2) + 1e-6)
            d = self.differ(high, high)
            if d == 0:
                self.plans[family] = (0, 0)
            else:
                room, p = 0, d + 1
                for _ in range(20):
                    empty = p * math.exp(-low / p)
                    room = min(math.ceil(empty + 3 * math.sqrt(empty)), 2 * d + 2)
                    p = d + 1 + room
                self.plans[family] = (p, room)
        return self.plans[family]

    def entries(self, sets: list[np.ndarray], digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tile signatures of the sets, and the digest of the set for each."""
        sizes = np.array([len(s) for s in sets], np.int64)
        if not sizes.sum():
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        grams = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        mixed = C.mix64(grams)
        bands = np.where(sizes > 0, self.band(np.maximum(sizes, 1)), -9)
        sparse = np.zeros(len(sets), bool)
        sigs, nodes = [], []
        for shift in (0, 1):
            family = bands - shift
            kinds = {f: self.plan(int(f)) for f in np.unique(family[sizes > 0])}
            parts = np.array([kinds.get(f, (0, 0))[0] for f in family], np.int64)
            room = np.array([kinds.get(f, (0, 0))[1] for f in family], np.int64)
            use = parts[owner] > 0
            if not use.any():
                continue
            o = owner[use]
            part = ((grams[use] >> np.uint64(32)) * parts[o].astype(np.uint64)) >> np.uint64(32)
            first = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (part[1:] != part[:-1])])
            total = np.add.reduceat(mixed[use], first)
            tag = (family[o[first]] + 16).astype(np.uint64) << np.uint64(40) | part[first]
            sigs.append(C.mix64(total + C.mix64(tag + np.uint64(1))))
            nodes.append(digests[o[first]])
            full = np.bincount(o[first], minlength=len(sets))
            sparse |= (parts > 0) & (parts - full > room)
        for i in np.flatnonzero(sparse):
            n = int(sizes[i])
            prefix = sets[i][: n - (n * self.percent + 99) // 100 + 1]
            sigs.append(C.mix64(prefix ^ np.uint64(0x5851F42D4C957F2D)))
            nodes.append(np.full(len(prefix), digests[i]))
        if not sigs:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(sigs), np.concatenate(nodes)


BIT_COLUMNS = [f"b{i}" for i in range(BITS // 64)]


def _meta(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), *[(b, pa.int64()) for b in BIT_COLUMNS]])

    def run(batches):
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                sets = gram_sets(texts, k)
                yield pa.record_batch([rows.column(rows.schema.get_field_index("doc_id")).cast(pa.int64()),
                                       rows.column(rows.schema.get_field_index("mark")), pa.array([len(s) for s in sets], pa.int64()),
                                       pa.array([set_digest(s) if len(s) else None for s in sets], pa.int64()),
                                       *[pa.array(b) for b in np.stack([bitmap(s) for s in sets]).T.copy()]], schema=schema)

    return run


def _runs(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (sig, node) in order, and where each sig starts."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    keep = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
    sig, node = sig[keep], node[keep]
    return sig, node, np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])


def _entries(k: int, percent: int, buckets: int):
    """Blobs of tile entries by bucket. A signature with more than HOT_TILE sets in one flush sends
    only so many to its bucket; all of its sets go to a bucket past the last as they are."""
    schema = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])

    def flush(sig, node):
        sig, node, starts = _runs(sig, node)
        length = np.diff(np.r_[starts, len(sig)])
        rank = np.arange(len(sig)) - np.repeat(starts, length)
        many = np.repeat(length > HOT_TILE, length)
        keys, blobs = [], []
        if many.any():
            hot = np.stack([sig[many], node[many].view(np.uint64)], 1)
            for part in np.array_split(hot, -(-len(hot) // 50_000)):
                keys.append(buckets + int(part[0, 0] ^ part[0, 1]) % buckets)
                blobs.append(part.tobytes())
        keep = rank < HOT_TILE
        sig, node = sig[keep], node[keep]
        bucket = (C.mix64(sig) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, pairs = bucket[order], np.stack([sig[order], node[order].view(np.uint64)], 1)
        cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for a, b in zip(cut, np.r_[cut[1:], len(bucket)], strict=True):
            keys.append(int(bucket[a]))
            blobs.append(pairs[a:b].tobytes())
        return pa.record_batch([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], schema=schema)

    def run(batches):
        plan, held, n = Families(percent), [], 0
        for batch in batches:
            for _, texts in C.slices(batch, "text"):
                sets = [s for s in gram_sets(texts, k) if len(s)]
                got = plan.entries(sets, np.array([set_digest(s) for s in sets], np.int64))
                held.append(got)
                n += len(got[0])
                if n >= FLUSH:
                    yield flush(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                    held, n = [], 0
        if n:
            yield flush(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

    return run


def _tiles(buckets: int):
    """Of one bucket: the sets of each tile with at least two; ``sig`` is null for small tiles."""
    schema = pa.schema([("sig", pa.int64()), ("nodes", pa.list_(pa.int64()))])

    def run(key, found):
        blob = np.concatenate([np.frombuffer(b, np.uint64) for b in found.column("blob").to_pylist()]).reshape(-1, 2)
        sig, node, starts = _runs(blob[:, 0].copy(), blob[:, 1].copy().view(np.int64))
        length = np.diff(np.r_[starts, len(sig)])
        passed = key[0].as_py() >= buckets
        small, sigs, nodes = set(), [], []
        for at, m in zip(starts[length > 1 - passed], length[length > 1 - passed], strict=True):
            if m <= SMALL_TILE and not passed:
                small.add(tuple(node[at:at + m].tolist()))
            else:
                sigs.append(int(sig[at:at + 1].view(np.int64)[0]))
                nodes.append(node[at:at + m].tolist())
        del blob
        C.release()
        return pa.table([pa.array([None] * len(small) + sigs, pa.int64()), pa.array([*small, *nodes], pa.list_(pa.int64()))], schema=schema)

    return run


def bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that the bitmaps' bound lets pass, with a document of each class and the bound."""
    differ = sum((F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in BIT_COLUMNS), F.lit(0))
    return (pairs.join(classes.alias("x"), F.col("u") == F.col("x.node")).join(classes.alias("y"), F.col("v") == F.col("y.node"))
            .withColumn("most", F.floor((F.col("x.n") + F.col("y.n") - differ) / 2))
            .filter(F.expr(f"100 * most >= {percent} * (x.n + y.n - most)"))
            .select("u", "v", F.col("x.low").alias("u_doc"), F.col("y.low").alias("v_doc"), F.expr("most / (x.n + y.n - most)").alias("near")))


def _may_link(percent: int):
    """The bitmaps' bound as a test between one member of a block and others."""

    def near(bits, n, a, r):
        most = (n[r] + n[a] - np.bitwise_count(bits[r] ^ bits[a]).sum(1, dtype=np.int64)) // 2
        return 100 * most >= percent * (n[r] + n[a] - most)

    return near


def _linked(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The rows with their class, the classes, the components of classes with links, and the number of rows."""
    docs = C.narrow(docs, "doc_id", "text")
    meta = C.materialize(docs.withColumn("mark", C.text_key()).mapInArrow(_meta(k), "doc_id long, mark long, n long, node long, " + ", ".join(f"{b} long" for b in BIT_COLUMNS)))
    grams, rows = meta.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    classes = C.materialize(meta.filter("node is not null").groupBy("node")
                            .agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"), F.first("n").alias("n"), *[F.first(b).alias(b) for b in BIT_COLUMNS]))

    share = 2 * 2 * (100 - percent) / (100 + percent) * 100 / percent
    buckets = max(8, int(grams * share / BUCKET_ENTRIES))
    tiles = C.materialize(docs.filter("text is not null").mapInArrow(_entries(k, percent, buckets), "bucket long, blob binary")
                          .groupBy("bucket").applyInArrow(_tiles(buckets), "sig long, nodes array<long>"))
    small = (tiles.filter("sig is null").select("nodes").distinct()
             .select(F.expr("posexplode(nodes) as (i, u)"), "nodes")
             .select("u", F.expr("explode(slice(nodes, i + 2, size(nodes))) as v")))
    big = C.materialize(tiles.filter("sig is not null").select("sig", F.explode("nodes").alias("node")).distinct())
    centers = C.materialize(big.groupBy("sig").agg(F.min("node").alias("u"), F.count("*").alias("m")))
    stars = C.join_by_key(big, centers, "sig", "m", big.count()).filter("node <> u").select("u", F.col("node").alias("v"))
    pairs = C.materialize(small.unionByName(stars).distinct())

    links, linked = confirm(docs, C.materialize(bounded(pairs, classes, percent)), k, percent)
    if big.limit(1).count():
        more = open_links(docs, big, linked, classes, k, percent, BIT_COLUMNS, _may_link(percent), BLOCK)
        if more is not None:
            linked = components(links.unionByName(more))
    return meta, classes, linked, rows


def link_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs``: columns ``doc_id, text`` (others are ignored). Returns for each row ``doc_id``,
    ``n_shingles`` and ``component_id``, the smallest doc_id that it reaches by links.

    Null and empty texts, and texts of white space, have no grams, link with nothing and are their own
    component. Repeated rows and equal texts are one class and give a row each. A null
    doc_id takes part and gets the smallest other doc_id of its component (null if there is none).
    An empty table gives no rows."""
    return label(*_linked(docs, k, percent))


def near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, mark`` (the key of the text) of the documents that go so that one of each group of linked ones stays: the
    one with the smallest doc_id (null last), of equal ids the one with the smallest mark. Documents without words stay."""
    meta, classes, linked, rows = _linked(docs, k, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "mark"))
    of_class = (meta.filter("node is not null").groupBy("node").agg(first.alias("first"), F.count("*").alias("copies"))
                .join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")))
    stays = of_class.groupBy("component").agg(F.min("first").alias("stays"), F.sum("copies").alias("size")).filter("size > 1")
    shared = C.materialize(of_class.join(stays, "component").select("node", "copies", "stays"))
    found = C.join_by_key(meta.filter("node is not null").select("doc_id", "mark", "node"), shared, "node", "copies", rows)
    return (found.filter(F.col("stays").isNotNull() & ~(F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("mark") == F.col("stays.mark"))))
            .select("doc_id", "mark"))
