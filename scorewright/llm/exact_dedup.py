"""Exact deduplication with a minimal perfect hash over the digests seen before.

``build_index`` turns the distinct SHA-256 digests of a history into shards. Each shard has a
minimal perfect hash (levels of bit arrays: a digest stays at the first level where it meets no
other, and its slot is the rank of its bit) and, slot by slot, the full digest, the winner's
doc_id and the number of copies. ``look_up`` sends the distinct digests of new documents to their
shard; the 32 bytes in the slot decide, as a perfect hash maps strangers to some slot too. Members
are repeats of the history; nonmembers are grouped among themselves.

Digests are aggregated before every shuffle, so a text with a third of all rows is one row a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm import common as C

#: Digests of one shard on average (about 50 bytes each in a task).
SHARD_DIGESTS = 50_000
#: Bits of a level for each digest that is left.
GAMMA = 2.0

INDEX = "shard long, levels array<binary>, slots binary, winners array<long>, copies array<long>"


def _position(keys: np.ndarray, level: int, width: int) -> np.ndarray:
    """Bit of each digest (as four 64-bit words) at a level."""
    h = C.mix64(keys[:, level % 4] + C.mix64(keys[:, (level + 1) % 4] + np.uint64(level + 1)))
    return (h % np.uint64(width)).astype(np.int64)


def build_hash(keys: np.ndarray) -> list[np.ndarray]:
    """Levels (boolean arrays) of a minimal perfect hash of distinct digests, shape (n, 4)."""
    levels, left = [], keys
    while len(left):
        width = max(8, int(GAMMA * len(left)))
        at = _position(left, len(levels), width)
        alone = np.bincount(at, minlength=width) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Slot of each key (any slot, or -1, for a key that was not in the set)."""
    out, before = np.full(len(keys), -1, np.int64), 0
    for i, level in enumerate(levels):
        open_ = np.flatnonzero(out < 0)
        if not len(open_):
            break
        at = _position(keys[open_], i, len(level))
        hit = level[at]
        out[open_[hit]] = before + (np.cumsum(level) - 1)[at[hit]]
        before += int(level.sum())
    return out


def _as_keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 4)


def _build(key, rows):
    keys = _as_keys(rows.column("digest"))
    levels = build_hash(keys)
    at = slots(levels, keys)
    order = np.argsort(at)
    pack = [len(v).to_bytes(8, "little") + np.packbits(v).tobytes() for v in levels]
    return pa.table({"shard": [key[0].as_py()], "levels": [pack], "slots": [keys[order].tobytes()],
                     "winners": [rows.column("winner").to_numpy()[order].tolist()], "copies": [rows.column("copies").to_numpy()[order].tolist()]},
                    schema=pa.schema([("shard", pa.int64()), ("levels", pa.list_(pa.binary())), ("slots", pa.binary()),
                                      ("winners", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64()))]))


def _unpack(pack: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(pack[8:], np.uint8), count=int.from_bytes(pack[:8], "little")).astype(bool)


GROUPS = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("seen_before", pa.bool_())])


def _look_up(index, rows):
    """All digests of a shard: those of the index with what the new rows add, and the nonmembers."""
    new = _as_keys(rows.column("digest")) if len(rows) else np.zeros((0, 4), np.uint64)
    winner, copies = (rows.column(c).to_numpy().copy() if len(rows) else np.zeros(0, np.int64) for c in ("winner", "copies"))
    parts = []
    member = np.zeros(len(new), bool)
    if len(index):
        one = index.slice(0, 1).to_pylist()[0]
        held = np.frombuffer(one["slots"], np.uint64).reshape(-1, 4)
        best, total = np.array(one["winners"], np.int64), np.array(one["copies"], np.int64)
        at = slots([_unpack(p) for p in one["levels"]], new)
        member = at >= 0
        member[member] = (held[at[member]] == new[member]).all(1)
        np.maximum.at(best, at[member], winner[member])
        np.add.at(total, at[member], copies[member])
        parts.append((held, best, total, True))
    parts.append((new[~member], winner[~member], copies[~member], False))
    return pa.concat_tables([pa.table([pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(w, pa.int64()), pa.array(c, pa.int64()),
                                       pa.array([seen] * len(keys), pa.bool_())], schema=GROUPS) for keys, w, c, seen in parts])


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.coalesce(F.max("doc_id"), F.lit(-(2 ** 63) + 1)).alias("winner"), F.count("*").alias("copies"))


def _shard(shards: int):
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long"), F.lit(shards)).alias("shard")


def shard_count(digests: DataFrame) -> int:
    """Shards for a table of digests; index and look-ups must use the same number."""
    return max(4, digests.count() // SHARD_DIGESTS)


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """Index of ``history`` (columns ``doc_id, digest``): one row a shard."""
    return (_distinct(history).select(_shard(shards), "digest", "winner", "copies")
            .groupBy("shard").applyInArrow(_build, INDEX))


def look_up(index: DataFrame, fresh: DataFrame, shards: int) -> DataFrame:
    """Groups of equal texts in the index and ``fresh`` (columns ``doc_id, digest``) together:
    ``digest, keep_id`` (largest doc_id)``, group_size, seen_before``."""
    new = _distinct(fresh).select(_shard(shards), "digest", "winner", "copies")
    return (index.groupBy("shard").cogroup(new.groupBy("shard"))
            .applyInArrow(_look_up, "digest binary, keep_id long, group_size long, seen_before boolean"))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, mark``: SHA-256 of the whole text (null is empty) in UTF-8, and the key of the row's text."""
    return C.narrow(docs, "doc_id", "text").select("doc_id", C.text_key().alias("mark"), F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"))


def exact_dedup(history: DataFrame, fresh: DataFrame) -> DataFrame:
    """Deduplicate ``fresh`` and ``history`` together; both have ``doc_id, text`` (others ignored).

    One row for each input row: ``doc_id, keep_id, group_size, kept, text_sha256, seen_before, mark``
    (``mark``: the key of the row's text, which tells null from empty). The
    largest doc_id of equal texts stays; rows that repeat that doc_id with the same text are the same
    document and all count as kept. A null doc_id loses to any other, and stays (keep_id null) only
    where no row of the group has one. Null and empty texts are equal. No rows give no rows."""
    old, new = digests(history), digests(fresh)
    rows = C.materialize(old.withColumn("fresh", F.lit(False)).unionByName(new.withColumn("fresh", F.lit(True))))
    shards = shard_count(rows)
    index = C.materialize(build_index(rows.filter("not fresh"), shards))
    groups = C.materialize(look_up(index, rows.filter("fresh"), shards))
    none = F.lit(-(2 ** 63) + 1)
    repeats = groups.filter("group_size > 1").withColumn("copies", F.col("group_size")).withColumn("known", F.lit(True))
    out = C.join_by_key(rows, repeats, "digest", "copies", rows.count())
    keep = F.when(F.col("known"), F.when(F.col("keep_id") != none, F.col("keep_id"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                      keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
                      F.coalesce("seen_before", ~F.col("fresh")).alias("seen_before"), "mark")
