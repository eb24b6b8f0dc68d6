"""Helpers that the operators share: word splitting on bytes, hashing, bounded batches and
joins that survive a key with a large part of the rows."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import scorewright
from scorewright.session import cut_lineage, drop_tables

#: Text bytes that one step of a task holds as Python words at a time.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch to a Python worker, where the session has Spark's default (64 MB, which long texts fill).
BATCH_KEY, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", str(4 << 20)
#: Ids that may be broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Keys with more than a ``1 / HEAVY_KEYS`` part of all rows; there are at most so many of them.
HEAVY_KEYS = 1000

#: A-Z in lower case, all other bytes as they are; words are then what ASCII space separates.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: As ``LOWER``, with every ASCII byte but letters and digits as a space.
ALNUM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
#: The same two word classes as SQL patterns, for lower-cased text.
SPACE_WORDS = r"[^\x20\x09-\x0D]+"
ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, so that they need no installation."""
    sc = spark.sparkContext
    if getattr(sc, "_scorewright_shipped", False):
        return
    root = Path(scorewright.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="scorewright-")) / "scorewright_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._scorewright_shipped = True


def prepare(spark: SparkSession) -> None:
    ship(spark)
    if spark.conf.get(BATCH_KEY, None) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns of the input never clash or travel. Every
    operator starts here, which also sends the package to the workers and bounds Arrow batches."""
    prepare(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def materialize(df: DataFrame) -> DataFrame:
    """A written table in the shared folder: cuts the lineage and survives lost executors."""
    return cut_lineage(df)


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    drop_tables(*tables)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batch of about ``SLICE_BYTES`` of text, with the texts as bytes (or None)."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = min(max(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), start + 1), len(texts))
        yield batch.slice(start, stop - start), texts.slice(start, stop - start).to_pylist()
        start = stop
    release()


def release() -> None:
    """Give freed memory back to the system; Python workers live on, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of MurmurHash3)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hashes(texts: list, classes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and words per text."""
    lists = [t.translate(classes).split() if t else [] for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = pa.array(list(itertools.chain.from_iterable(lists)), pa.binary())
    if not len(flat):
        return np.zeros(0, np.uint64), counts
    coded = flat.dictionary_encode()
    vocabulary = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return vocabulary[coded.indices.to_numpy()], counts


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (those that end past the array are left out)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    return mix64(h)


def text_key():
    """A hash of the row's text: with doc_id it names a row, also where an id is null or stands on several texts."""
    return F.xxhash64("text")


def _in_rows(docs: DataFrame, named: DataFrame, how: str) -> DataFrame:
    named = named.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    small = named.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_mark"))
    return docs.join(F.broadcast(named) if small else named, same, how)


def drop_rows(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The documents without the rows that ``named`` (``doc_id, mark``; materialized) names by id and text. A null id is a
    value like others. The list is broadcast when it is small; otherwise both sides are shuffled."""
    return _in_rows(docs, named, "left_anti")


def only_rows(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The documents that ``named`` names, see ``drop_rows``."""
    return _in_rows(docs, named, "left_semi")


def join_by_key(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``keyed`` (one row a key, ``count`` = rows of that key).

    A key with more than ``total / HEAVY_KEYS`` rows would overload one task; there can be at
    most ``HEAVY_KEYS`` of them, so their rows are broadcast, and the others are shuffled."""
    limit = max(total // HEAVY_KEYS, 1)
    heavy = F.broadcast(keyed.filter(F.col(count) > limit))
    light = keyed.filter(F.col(count) <= limit)
    of_heavy = rows.join(heavy, key, "inner")
    others = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key, "left")
    return of_heavy.unionByName(others)
