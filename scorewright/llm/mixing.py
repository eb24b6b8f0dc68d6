"""Mixing sources to target weights with a low-discrepancy schedule.

The schedule is a sequence of slots. Slot ``i`` is the point ``i * golden ratio mod 1`` (as 32-bit
integers), mapped through the cumulative target shares of the sources; so every stretch of the
schedule holds each source very nearly in proportion. The rank of a slot among the slots of its
source names the block of that source that it takes: a source's documents are shuffled by a
hash of their id, laid end to end and cut into blocks of the same number of words. Ranks past the last block begin a
second epoch. The slot that would pass the target is cut at it. A source that the schedule left short of the blocks up to its target
(as small ones are: each epoch may end in a part of a block) gets its missing ranks after the last slot.

What the mix takes of a source follows from its target; where in the mix it comes follows from the schedule. Each document carries
the first slot that takes words of it, so documents in the order of ``first_slot`` are the mix, every stretch of it in proportion.

DataFrame operations only. Running sums and ranks are taken in two levels (bucket totals, then within a
bucket; n rows have about sqrt(n) buckets, so both levels stay small), so neither a source with a third of all documents nor its slots meet in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm import common as C

#: Weights of the sources in order of code point (null last), repeating.
WEIGHTS = (3, 1, 2)
#: Words of a block.
BLOCK_WORDS = 64
#: Cells of the unit interval by which points find their source.
CELLS = 4096
#: Missing ranks that one row of a source is spread to at a time.
RANKS = 1024
POINTS = 1 << 32
GOLDEN = 2654435769


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from ``source, size``: ``share`` of all words dealt by
    weight; a target stops at ``most`` times its source's words and the excess goes to the others by
    weight. With the sources in order of size / weight the first ones are full; the shares of
    the rest follow from one division. The table has one row a source."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_point = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_point) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sums.withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size") * F.lit(float(most)))
    by_room = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    all_rows = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(all_rows) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    return (ranked.withColumn("level", level).withColumn("open", (F.col("level") * F.col("weight") <= F.col("most")).cast("int"))
            .withColumn("flat", F.first(F.when(F.col("open") == 1, F.col("level")), ignorenulls=True).over(all_rows))
            .withColumn("full", F.max("open").over(by_room.rowsBetween(Window.unboundedPreceding, 0)) == 0)
            .select("source", "source_size", F.when(F.col("full") | F.col("flat").isNull(), F.col("most"))
                    .otherwise(F.col("flat") * F.col("weight")).alias("target")))


def _running(rows: DataFrame, group: str, bucket: str, order: list[str], amount: str, name: str) -> DataFrame:
    """Exclusive running sum of ``amount`` by group in (bucket, order); buckets bound a task's rows."""
    totals = rows.groupBy(group, bucket).agg(F.sum(amount).alias("_t"))
    first = totals.withColumn("_before", F.coalesce(F.sum("_t").over(Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")).drop("_t")
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("_own", F.coalesce(F.sum(amount).over(inside), F.lit(0)).cast("long"))
    return own.join(first, [group, bucket]).withColumn(name, F.col("_own") + F.col("_before")).drop("_own", "_before")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs``: ``doc_id, text, source`` (others ignored). One row for each input row: ``doc_id, size,
    source_size, target, taken, first_slot`` (the slot at which its first words come; -1 if none are taken).

    Size is the number of words (null and empty texts: 0, taken 0). A null source is a source of its
    own, the last one. ``taken`` is at most ``most`` (up to 2) times the size. The order of documents depends
    only on doc_id and text, so reruns agree; repeated rows are dealt one after the other, each with its own words.
    Null ids are dealt like others. An empty table gives no rows."""
    docs = C.narrow(docs, "doc_id", "text", "source")
    size = F.coalesce(F.regexp_count("text", F.lit(C.SPACE_WORDS)), F.lit(0)).cast("long")
    place = F.coalesce(F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(0))
    sized = C.materialize(docs.select("doc_id", "source", size.alias("size"), place.alias("h"), F.xxhash64("text").alias("th")))
    targets = C.materialize(source_targets(sized, weights, share, most)
                            .withColumn("s", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int")))
    rows, = sized.agg(F.count("*")).first()
    goal, sources = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0)), F.count("*")).first()

    # Documents on their source's line of words: [at, at + size).
    buckets = max(1, math.isqrt(rows))
    on = sized.alias("d").join(F.broadcast(targets.alias("t")) if sources <= C.HEAVY_KEYS * 100 else targets.alias("t"),
                               F.col("d.source").eqNullSafe(F.col("t.source"))).select("doc_id", "size", "h", "th", "s", "source_size", "target")
    laid = C.materialize(_running(on.withColumn("bucket", F.floor(F.col("h") * F.lit(buckets / 2.0 ** 60))), "s", "bucket", ["h", "doc_id", "th"], "size", "at"))

    # The schedule: slots by golden-ratio points; some more than needed, so that few sources lag.
    slots = int(goal / block_words) + 1
    slots += slots // 16 + 1024
    shares = targets.filter("target > 0").withColumn("_all", F.lit(float(goal) or 1.0))
    upto = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    edges = (shares.withColumn("hi", F.round(F.sum("target").over(upto) / F.col("_all") * POINTS).cast("long"))
             .withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("s")), F.lit(0)).cast("long"))
             .filter("hi > lo").select("s", "source_size", "target", "lo", "hi",
                                       F.explode(F.sequence(F.floor(F.col("lo") * CELLS / POINTS), F.floor((F.col("hi") - 1) * CELLS / POINTS))).alias("cell")))
    points = (docs.sparkSession.range(slots).withColumn("point", F.pmod(F.pmod("id", F.lit(1 << 31)) * F.lit(GOLDEN), F.lit(POINTS)))
              .withColumn("cell", F.floor(F.col("point") * CELLS / POINTS)))
    dealt = (points.join(F.broadcast(edges) if sources <= C.HEAVY_KEYS * 100 else edges, "cell").filter("point >= lo and point < hi")
             .withColumn("bucket", F.floor(F.col("id") / math.isqrt(slots))).withColumn("one", F.lit(1)))
    ranked = _running(dealt, "s", "bucket", ["id"], "one", "rank").select("s", "source_size", "target", "rank", F.col("id").alias("slot"))
    n = F.ceil(F.col("source_size") / block_words)
    # Ranks up to the target that no slot was dealt for.
    whole = F.floor("target")
    needed = F.when(whole <= F.col("source_size"), F.ceil(whole / block_words)).otherwise(n + F.ceil((whole - F.col("source_size")) / block_words))
    short = (shares.select("s", "source_size", "target", needed.alias("needed")).join(dealt.groupBy("s").agg(F.count("*").alias("got")), "s", "left")
             .withColumn("got", F.coalesce("got", F.lit(0)).cast("long")).filter("got < needed"))
    missing = (short.withColumn("part", F.explode(F.sequence(F.floor(F.col("got") / RANKS), F.floor((F.col("needed") - 1) / RANKS)))).repartition("s", "part")
               .select("s", "source_size", "target", F.explode(F.sequence(F.greatest(F.col("got"), F.col("part") * RANKS),
                                                                        F.least(F.col("needed") - 1, F.col("part") * RANKS + (RANKS - 1)))).alias("rank"))
               .withColumn("slot", F.lit(slots) + F.col("rank")))
    ranked = ranked.unionByName(missing)
    room = F.floor("target") - F.col("epoch") * F.col("source_size") - F.col("block") * block_words
    taken_blocks = (ranked.withColumn("epoch", F.floor(F.col("rank") / n)).withColumn("block", F.pmod(F.col("rank"), n))
                    .withColumn("words", F.least(F.lit(block_words), room)).filter("epoch < 2 and words > 0")
                    .groupBy("s", "block").agg(*[F.max(F.when(F.col("epoch") == e, F.col(c))).alias(f"{c[0]}{e}") for e in (0, 1) for c in ("words", "slot")]))

    # Pieces of documents by block; a block's first words are taken.
    start, end = F.col("at") - F.col("block") * block_words, F.col("at") + F.col("size") - F.col("block") * block_words
    pieces = (laid.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words))))
              .join(taken_blocks, ["s", "block"]))
    of = lambda w: F.greatest(F.least(end, F.coalesce(F.col(w), F.lit(0))) - F.greatest(start, F.lit(0)), F.lit(0))
    first = F.least(F.when(of("w0") > 0, F.col("s0")), F.when(of("w1") > 0, F.col("s1")))
    taken = pieces.groupBy("s", "at").agg(F.sum(of("w0") + of("w1")).alias("taken"), F.min(first).alias("first_slot"))
    return (laid.filter("size > 0").join(taken, ["s", "at"], "left")
            .unionByName(laid.filter("size = 0").withColumns({"taken": F.lit(0).cast("long"), "first_slot": F.lit(-1).cast("long")}))
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("first_slot", F.lit(-1)).cast("long").alias("first_slot")))
