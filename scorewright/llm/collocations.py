"""Phrase collocations from n-gram counts that HAT-tries gather.

*Text.* Only A-Z is lower-cased; texts are cut into pieces at ``.,;:!?`` and line breaks, and these into words at spaces and
tabs. Everything is counted per language (null: ``und``).

*Counting.* A task gives its words ids and counts n-grams in a trie per language. Its shallow top is the prefix partition
of an n-gram (a hash of its first word, and of its second for first words that are common everywhere). Below, hash
containers hold the n-grams of a range of word-id prefixes; one that grows past ``BURST`` entries bursts into two, at a word id
of the path. Past ``TRIE_ENTRIES`` in all, the largest subtrees are spilled whole, each as one run sorted by the words' 64-bit
hashes. Spark groups the runs by (language, prefix partition), where they are merged; n-grams that occur less than
``least`` times end there.

*Levels.* An n-gram that occurs ``least`` times has only words and shorter phrases that do so, too. Words are counted first, then
word pairs of frequent words, then triples of frequent pairs. What is frequent is told to the tasks by a bitmap of hashes of
at most ``MAP_BITS`` bits, whatever the corpus; a false positive is counted in vain and changes no result.

*Scores.* Frequent words, pairs and triples are tables; cuts, scores and ranks are joins on them, in exact decimals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm import common as C

#: Entries of a container, and of all containers of a task.
BURST = 8_192
TRIE_ENTRIES = 500_000
#: Distinct words to which a task gives ids before all is spilled; three ids are one 63-bit code.
TASK_WORDS = 1 << 20
WORD_BITS = 21
#: Tokens that a task codes at a time; far fewer than the ids that are left past ``TASK_WORDS``.
STEP_TOKENS = 400_000
#: N-grams that one prefix partition should get at most, if no two were equal.
PARTITION_GRAMS = 2_000_000
#: Words with more than this part of all words are common: their n-grams are dealt by the second word, too.
COMMON = 1000
#: Most bits of a bitmap, bits an entry, and segments in which it is made.
MAP_BITS = 1 << 27
ENTRY_BITS = 16
SEGMENTS = 64
#: Candidates that one task ranks at a time.
RANKED_ROWS = 500_000

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: A-Z in lower case, every separator as a full stop (which therefore is no word), tabs as spaces.
PIECES = bytes(0x2E if b in _SEPARATORS else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


class Words:
    """The ids that a task gives its words, with their hashes."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.hashes = np.zeros(1024, np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        ids, out = self.ids, np.empty(len(words), np.int64)
        for i, w in enumerate(words):
            n = ids.get(w)
            if n is None:
                n = ids[w] = len(self.words)
                if n == len(self.hashes):
                    self.hashes = np.r_[self.hashes, np.zeros(n, np.uint64)]
                self.hashes[n] = xxhash.xxh3_64_intdigest(w)
                self.words.append(w)
            out[i] = n
        return out


class Subtree:
    """Hash containers of one prefix partition. Container ``i`` holds the codes from ``bounds[i]`` up to the next bound."""

    def __init__(self):
        self.bounds, self.boxes = np.zeros(1, np.int64), [{}]

    def add(self, codes: np.ndarray, counts: np.ndarray) -> int:
        """Add sorted distinct codes; returns the number of new entries."""
        new, cuts = 0, np.searchsorted(codes, self.bounds)
        edges = np.r_[cuts, len(codes)]
        full = []
        for i in np.flatnonzero(np.diff(edges)):
            box = self.boxes[i]
            before, get = len(box), box.get
            for c, n in zip(codes[edges[i]:edges[i + 1]].tolist(), counts[edges[i]:edges[i + 1]].tolist()):
                box[c] = get(c, 0) + n
            new += len(box) - before
            if len(box) > BURST:
                full.append(i)
        for i in reversed(full):
            self.burst(i)
        return new

    def burst(self, i: int) -> None:
        """Cut a container in two at the word-id prefix next to its middle: by the first word, else by a longer path."""
        codes = np.sort(np.fromiter(self.boxes[i], np.int64, len(self.boxes[i])))
        middle = codes[len(codes) // 2]
        for shift in (2 * WORD_BITS, WORD_BITS, 0):
            at = (middle >> shift) << shift
            if at > codes[0]:
                break
        low = {c: n for c, n in self.boxes[i].items() if c < at}
        high = {c: n for c, n in self.boxes[i].items() if c >= at}
        self.boxes[i:i + 1] = [low, high]
        self.bounds = np.insert(self.bounds, i + 1, at)

    def entries(self) -> int:
        return sum(map(len, self.boxes))

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """All codes in order, and their counts."""
        runs = []
        for box in self.boxes:
            codes, counts = np.fromiter(box.keys(), np.int64, len(box)), np.fromiter(box.values(), np.int64, len(box))
            order = np.argsort(codes)
            runs.append((codes[order], counts[order]))
        return np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])


class Trie:
    """N-gram counts of a task: a subtree for each (language, prefix partition)."""

    def __init__(self, order: int, parts: int, common: np.ndarray):
        self.order, self.parts, self.common = order, parts, common
        self.words, self.trees, self.size = Words(), {}, 0

    def partition(self, ids: list[np.ndarray]) -> np.ndarray:
        """Prefix partitions of n-grams, given the ids of their first words and of their second ones."""
        first = self.words.hashes[ids[0]]
        h = C.mix64(first)
        if self.order > 1 and len(self.common):
            hot = np.isin(first, self.common)
            h[hot] ^= C.mix64(C.mix64(self.words.hashes[ids[1][hot]]))
        return (h % np.uint64(self.parts)).astype(np.int64)

    def add(self, lang: str, ids: np.ndarray) -> None:
        """Count n-grams of one language, given as rows of word ids."""
        code = ids[:, 0] << 2 * WORD_BITS
        for j in range(1, self.order):
            code = code | ids[:, j] << (2 - j) * WORD_BITS
        code, counts = np.unique(code, return_counts=True)
        part = self.partition([(code >> (2 - j) * WORD_BITS) & ((1 << WORD_BITS) - 1) for j in range(min(self.order, 2))])
        order = np.argsort(part.astype(np.uint16) if self.parts <= 1 << 16 else part, kind="stable")
        part, code, counts = part[order], code[order], counts[order]
        cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for a, b in zip(cut, np.r_[cut[1:], len(part)]):
            key = (lang, int(part[a]))
            tree = self.trees.get(key)
            if tree is None:
                tree = self.trees[key] = Subtree()
            self.size += tree.add(code[a:b], counts[a:b])

    def spill(self, keep: int) -> Iterator[tuple[str, int, list[np.ndarray], np.ndarray, np.ndarray]]:
        """Take the largest subtrees out until at most ``keep`` entries are left: the words' hashes in sorted order, the first
        words' ids and the counts."""
        sizes = {k: t.entries() for k, t in self.trees.items()}
        for key in sorted(sizes, key=lambda k: -sizes[k]):
            if self.size <= keep:
                break
            code, counts = self.trees.pop(key).items()
            self.size -= sizes[key]
            ids = [(code >> (2 - j) * WORD_BITS) & ((1 << WORD_BITS) - 1) for j in range(self.order)]
            hashes = [self.words.hashes[x] for x in ids]
            by = np.lexsort(hashes[::-1])
            yield (*key, [h[by] for h in hashes], ids[0][by], counts[by])


class Bitmap:
    """A fixed-size set of hashes with false positives only."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def mark(seed: np.uint64, hashes: list[np.ndarray]) -> np.ndarray:
    """One hash of a language and a phrase (given as its words' hashes)."""
    h = np.full(len(hashes[0]), seed, np.uint64)
    for x in hashes:
        h = C.mix64(h * np.uint64(0x9E3779B97F4A7C15) + x)
    return h


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Tokens of about a slice of texts (words, and a full stop between pieces and after each text), the language of
    each token, and the languages."""
    for rows, texts in C.slices(batch, "text"):
        langs = ["und" if x is None else x for x in rows.column(rows.schema.get_field_index("lang")).to_pylist()]
        flat, counts = [], []
        for t in texts:
            held = t.translate(PIECES).replace(b".", b" . ").split() if t else []
            flat += held
            flat.append(b".")
            counts.append(len(held) + 1)
        names, lang_of = np.unique(np.array(langs, object), return_inverse=True)
        yield flat, np.repeat(lang_of, counts), names


def _coded(tokens: list[bytes], words: Words) -> np.ndarray:
    """Word ids of tokens, -1 for a full stop."""
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    ids = words.of(vocabulary)
    ids[[i for i, w in enumerate(vocabulary) if w == b"."]] = -1
    return ids[coded.indices.to_numpy()]


def _places(ids: np.ndarray, order: int, words: Words, seed: np.uint64, known: Bitmap | None) -> np.ndarray:
    """Where n-grams start whose words stand in one piece and whose parts may be frequent."""
    good = ids >= 0
    if order == 1:
        return np.flatnonzero(good)
    hashes = words.hashes[np.maximum(ids, 0)]
    if order == 2:
        good &= known.has(mark(seed, [hashes]))
        return np.flatnonzero(good[:-1] & good[1:])
    pair = good[:-1] & good[1:]
    pair[pair] = known.has(mark(seed, [hashes[:-1][pair], hashes[1:][pair]]))
    return np.flatnonzero(pair[:-1] & pair[1:])


def _runs(order: int, parts: int, common, frequent):
    """Sorted runs of n-gram counts. Of words, a run holds the words themselves, too."""
    schema = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("run", pa.binary()), ("words", pa.list_(pa.binary()))])

    def out(trie, keep):
        found = [[], [], [], []]
        for lang, part, hashes, first, counts in trie.spill(keep):
            row = (lang, part, np.stack([*hashes, counts.view(np.uint64)]).tobytes(), [trie.words.words[i] for i in first] if order == 1 else None)
            for column, x in zip(found, row):
                column.append(x)
        return pa.record_batch([pa.array(x, f.type) for x, f in zip(found, schema)], schema=schema)

    def run(batches):
        trie = Trie(order, parts, common.value if common else np.zeros(0, np.uint64))
        known = Bitmap(frequent.value) if frequent else None
        for batch in batches:
            for flat, token_lang, names in _tokens(batch):
                # a long text in bounded steps; the n-grams that start in a step may end in the next one
                for at in range(0, len(flat), STEP_TOKENS):
                    ids = _coded(flat[at:at + STEP_TOKENS + order - 1], trie.words)
                    of_lang = token_lang[at:at + len(ids)]
                    starts = np.arange(len(ids)) < STEP_TOKENS
                    for x in np.unique(of_lang):
                        mine = of_lang == x
                        held, first = ids[mine], starts[mine]
                        place = _places(held, order, trie.words, lang_seed(names[x]), known)
                        place = place[first[place]]
                        if len(place):
                            trie.add(names[x], np.stack([held[place + j] for j in range(order)], 1))
                    if len(trie.words.words) > TASK_WORDS:
                        yield out(trie, 0)
                        trie.words = Words()
                    elif trie.size > TRIE_ENTRIES:
                        yield out(trie, TRIE_ENTRIES // 2)
        yield out(trie, 0)

    return run


def _merge(order: int, least: int):
    """Of one (language, prefix partition): the n-grams that occur often enough; of words the number of all occurrences, too."""
    fields = [("lang", pa.string()), *[(f"h{j + 1}", pa.int64()) for j in range(order)], ("f", pa.int64())]
    schema = pa.schema([*fields, ("word", pa.binary())] if order == 1 else fields)

    def run(key, rows):
        lang = key[0].as_py()
        runs = [np.frombuffer(b, np.uint64).reshape(order + 1, -1) for b in rows.column("run").to_pylist()]
        table = np.concatenate(runs, 1)
        by = np.lexsort(table[order - 1::-1]) if order > 1 else np.argsort(table[0], kind="stable")
        table = table[:, by]
        start = np.flatnonzero(np.r_[True, (table[:order, 1:] != table[:order, :-1]).any(0)])
        total = np.add.reduceat(table[order].view(np.int64), start)
        often = total >= least
        out = [table[j][start[often]].view(np.int64) for j in range(order)]
        found = [pa.array([lang] * int(often.sum()), pa.string()), *map(pa.array, out), pa.array(total[often])]
        if order > 1:
            return pa.table(found, schema=schema)
        words = rows.column("words").combine_chunks().flatten()
        found.append(words.take(pa.array(by[start[often]])))
        named = pa.table(found, schema=schema)
        whole = pa.table([[lang], pa.array([None], pa.int64()), [int(total.sum())], pa.array([None], pa.binary())], schema=schema)
        return pa.concat_tables([named, whole])

    return run


def _segment(bits: int):
    """The bits of one segment of the bitmap."""
    schema = pa.schema([("segment", pa.int64()), ("bits", pa.binary())])

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for s in np.unique(segment):
                if s not in held:
                    held[s] = np.zeros(bits // 8 // SEGMENTS, np.uint8)
                mine = at[segment == s]
                np.bitwise_or.at(held[s], mine >> 3, (1 << (mine & 7)).astype(np.uint8))
        for s, b in held.items():
            yield pa.record_batch([pa.array([s], pa.int64()), pa.array([b.tobytes()], pa.binary())], schema=schema)

    return run


def _marks(order: int, bits: int):
    schema = pa.schema([("segment", pa.int64()), ("at", pa.int64())])

    def run(batches):
        for batch in batches:
            hashes = [batch.column(1 + j).to_numpy().view(np.uint64) for j in range(order)]
            langs = np.array(batch.column(0).to_pylist(), object)
            at = np.zeros(len(langs), np.uint64)
            for lang in np.unique(langs):
                mine = langs == lang
                at[mine] = mark(lang_seed(lang), [h[mine] for h in hashes])
            at = (at & np.uint64(bits - 1)).astype(np.int64)
            size = bits // SEGMENTS
            yield pa.record_batch([pa.array(at // size), pa.array(at % size)], schema=schema)

    return run


def bitmap(found: DataFrame, order: int) -> np.ndarray:
    """A bitmap of the table's phrases: made in segments by tasks; of a fixed size at most."""
    size = 1 << 16
    entries = found.count()
    while size < MAP_BITS and size < ENTRY_BITS * entries:
        size *= 2
    names = [f"h{j + 1}" for j in range(order)]
    parts = (found.select("lang", *names).mapInArrow(_marks(order, size), "segment long, at long").repartition(SEGMENTS, "segment")
             .mapInArrow(_segment(size), "segment long, bits binary"))
    bits = np.zeros((SEGMENTS, size // 8 // SEGMENTS), np.uint8)
    for r in parts.collect():
        bits[r.segment] = np.frombuffer(r.bits, np.uint8)
    return bits.ravel()


def count_grams(docs: DataFrame, order: int, least: int, parts: int, common=None, frequent=None) -> DataFrame:
    """``lang, h1.., f`` of the n-grams that occur ``least`` times (of words with ``word``, and a row with a null hash for the sum)."""
    runs = docs.mapInArrow(_runs(order, parts, common, frequent), "lang string, part long, run binary, words array<binary>")
    names = ", ".join(f"h{j + 1} long" for j in range(order)) + ", f long" + (", word binary" if order == 1 else "")
    return C.materialize(runs.groupBy("lang", "part").applyInArrow(_merge(order, least), f"lang string, {names}"))


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exactly."""
    wide = [x.cast("decimal(15,0)") for x in (a, l, r)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide[0] * wide[0]), wide[1] * wide[2])


def _fraction(a: Column, b: Column, percent: int) -> Column:
    return F.lit(100) * a >= F.lit(percent) * b


def collocations(docs: DataFrame, least: int = 10, cover: int = 50, top: int = 2000) -> DataFrame:
    """``docs``: ``text, lang`` (other columns are ignored). Returns ``lang, rank, phrase, a, l, r, n, score``: of each language the
    ``top`` phrases of two and three words that occur ``least`` times, by score, then ``a``, then the phrase. ``l`` and ``r`` are the
    counts of the two parts of the cut that scores lowest. A pair inside a triple that occurs ``cover`` percent as often is
    left out.

    Null and empty texts have no words. Rows count as often as they are repeated. A null language is ``und``, together with rows
    that say so; an empty language is one of its own. An empty table gives no rows."""
    docs = C.narrow(docs, "text", "lang")
    spark = docs.sparkSession
    scan = max(1, docs.rdd.getNumPartitions())
    words = count_grams(docs, 1, least, 4 * scan)
    sums = C.materialize(words.filter("h1 is null").groupBy("lang").agg(F.sum("f").alias("n")))
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = words.filter("h1 is not null")
    broadcast = spark.sparkContext.broadcast
    hot = words.groupBy("h1").agg(F.sum("f").alias("f")).filter(F.col("f") * COMMON > total).collect()
    common = broadcast(np.array([r.h1 for r in hot], np.int64).view(np.uint64))
    parts = max(8, scan, total // PARTITION_GRAMS)
    pairs = count_grams(docs, 2, least, parts, common, broadcast(bitmap(words, 1)))
    triples = count_grams(docs, 3, least, parts, common, broadcast(bitmap(pairs, 2)))

    def word(h: str, name: str) -> DataFrame:
        return words.select("lang", F.col("h1").alias(h), F.col("word").cast("string").alias(f"{name}_word"), F.col("f").alias(name))

    inside = triples.select("lang", F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("p"), "f")
    covered = inside.groupBy("lang", "p.h1", "p.h2").agg(F.max("f").alias("longest"))
    two = (pairs.withColumnRenamed("f", "a").join(covered, ["lang", "h1", "h2"], "left")
           .filter(F.col("longest").isNull() | ~_fraction(F.col("longest"), F.col("a"), cover))
           .join(word("h1", "l"), ["lang", "h1"]).join(word("h2", "r"), ["lang", "h2"])
           .select("lang", F.concat_ws(" ", "l_word", "r_word").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score")))
    pair = lambda x, y, name: pairs.select("lang", F.col("h1").alias(x), F.col("h2").alias(y), F.col("f").alias(name))
    a = F.col("a")
    three = (triples.withColumnRenamed("f", "a").join(pair("h1", "h2", "l2"), ["lang", "h1", "h2"]).join(pair("h2", "h3", "r1"), ["lang", "h2", "h3"])
             .join(word("h1", "l1"), ["lang", "h1"]).join(word("h2", "m"), ["lang", "h2"]).join(word("h3", "r2"), ["lang", "h3"])
             .withColumns({"one": _score(a, F.col("l1"), F.col("r1")), "two": _score(a, F.col("l2"), F.col("r2"))})
             .withColumn("first", F.col("one") <= F.col("two"))
             .select("lang", F.concat_ws(" ", "l1_word", "m_word", "r2_word").alias("phrase"), "a",
                     F.when(F.col("first"), F.col("l1")).otherwise(F.col("l2")).alias("l"),
                     F.when(F.col("first"), F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("one", "two").alias("score")))
    found = C.materialize(two.unionByName(three))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    deal = max(1, found.count() // RANKED_ROWS)
    best = (found.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(deal)))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).filter(F.col("rank") <= top))
    return (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
            .join(F.broadcast(sums) if sums.limit(C.BROADCAST_IDS + 1).count() <= C.BROADCAST_IDS else sums, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
