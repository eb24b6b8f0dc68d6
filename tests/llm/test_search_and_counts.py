"""MinHash join, lexical search and collocations against brute force, on small tables with every odd case."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scorewright.llm import collocations, common, lexical_search, links, minhash_join, ngram_join

from tests.llm.test_operators import DOCS, brute_components, empty, odd_docs, words


def near_copies(seed=1):
    """Near copies in one large group, chained edits and a shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, " ".join(w)))
    chain = list(base)
    for i in range(60, 90):
        chain[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(chain)))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    return rows + [(i, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(90, 130)]


def found(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


# --- MinHash join ----------------------------------------------------------------------------------

@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_minhash_odd_rows(spark, k, percent):
    docs, rows = odd_docs(spark)
    got = minhash_join.near_duplicates(docs, k, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert found(got) == brute_components(rows, k, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())
    assert minhash_join.near_duplicates(empty(spark), k, percent).count() == 0


@pytest.mark.parametrize("rounds,refuted", [(3, 1000), (1, -1), (0, 0)])
def test_large_groups_by_every_way(spark, monkeypatch, rounds, refuted):
    """Forests by fine bitmaps, rounds without refuted pairs, and sorted arrays give the same links."""
    for module, name, value in ((minhash_join, "SHORT", 2), (links, "BLOCK", 8), (ngram_join, "SMALL_TILE", 3), (ngram_join, "BLOCK", 8),
                                (links, "ROUNDS", rounds), (links, "REFUTED", refuted)):
        monkeypatch.setattr(module, name, value)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(minhash_join.near_duplicates(docs, 3, 85)) == brute_components(rows, 3, 85)
    if rounds == 0:
        assert found(ngram_join.link_components(docs, 3, 90)) == brute_components(rows, 3, 90)


def test_match_threshold_is_a_binomial_tail():
    for percent in (80, 85, 90):
        p, t = percent / 100, minhash_join.match_threshold(percent)
        tail = [sum(math.comb(32, i) * p ** i * (1 - p) ** (32 - i) for i in range(n)) for n in (t, t + 1)]
        assert tail[0] <= minhash_join.MISS < tail[1]


def test_signatures_agree_as_often_as_sets_overlap():
    rng = np.random.RandomState(0)
    agree = []
    for _ in range(300):
        both, a, b = (rng.randint(0, 2 ** 62, n).astype(np.uint64) for n in (170, 15, 15))
        x, y = minhash_join.signatures([np.unique(np.r_[both, a]), np.unique(np.r_[both, b])])
        agree.append((x == y).mean())
    assert abs(np.mean(agree) - 0.85) < 0.01


def test_a_block_returns_fewer_pairs_than_members():
    texts = [t.encode() for _, t in near_copies()[:90]]
    sets = links.gram_sets(texts, 3)
    n = len(sets)
    table = pa.table({"sig": [1] * n, "i": pa.array([0] * n, pa.int32()), "j": pa.array([0] * n, pa.int32()), "node": list(range(n)),
                      "n": [len(s) for s in sets], "component": list(range(n)), "block": pa.array([0] * n, pa.int32()), "s0": [0] * n, "least": pa.array([[1]] * n, pa.list_(pa.int64())),
                      "grams": pa.array([links.fine_bitmap(s) for s in sets], pa.binary())})
    arrays = table.set_column(table.column_names.index("grams"), "grams", pa.array([s.tobytes() for s in sets], pa.binary()))
    everything = lambda sketch, size, a, r: np.ones(len(r), bool)

    class No:
        value = frozenset()

    key = (pa.scalar(1), pa.scalar(0), pa.scalar(0))
    forest = links._forest(["s0"], everything, 85, No)(key, table)
    exact = links._exact(["s0"], everything, 85)(key, arrays)
    assert 0 < exact.num_rows <= forest.num_rows < n
    # pairs that met in an earlier group are left to it
    met = table.set_column(table.column_names.index("least"), "least", pa.array([[0, 1]] * 50 + [[1]] * (n - 50), pa.list_(pa.int64())))
    flagged = links._flag(["s0"], everything, 85)(key, met)
    assert flagged.num_rows == n and links._flag(["s0"], everything, 85)(key, met.slice(0, 50)).num_rows == 0


# --- lexical search ------------------------------------------------------------------------------

def brute_search(docs, items, top):
    texts = [(r[0], words(r[1])) for r in docs]
    texts = [(d, w) for d, w in texts if w]
    n_docs, n_terms = len(texts), sum(len(w) for _, w in texts)
    df = Counter(t for _, w in texts for t in set(w))
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(words(text))
    out = Counter()
    for item, held in terms.items():
        scored = []
        for doc, w in texts:
            tf, m = Counter(w), 100 - 50 + (50 * len(w) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in held if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1):
            out[item, rank, doc, -score] += 1
    return out


def test_search_against_brute_force(spark, monkeypatch):
    docs, rows = odd_docs(spark)
    rng = random.Random(2)
    texts = [r[1] for r in rows if r[1]]
    items = [(i, " ".join(rng.sample(texts[rng.randrange(5, len(texts) - 3)].split() or ["one"], 12) if len(texts[i % len(texts)].split()) > 12 else ["one", "TWO", "é"]))
             for i in range(12)]
    items += [(3, "one extra"), (None, "two alpha1"), (None, None), (50, None), (51, ""), (52, "nowhere")]
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, doc_id long, score string")
    for top, block, dealt in ((50, 200_000, 100_000), (3, 20, 5)):
        monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
        monkeypatch.setattr(lexical_search, "DEALT_ROWS", dealt)
        got = lexical_search.ranked_search(docs, asked, top)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(map(tuple, got.collect())) == brute_search(rows, items, top)
    assert lexical_search.ranked_search(empty(spark), asked).count() == 0
    assert lexical_search.ranked_search(docs, asked.limit(0)).count() == 0


def test_shared_sets_add_up():
    """The DAG gives every item the sum of its terms, with fewer additions than item by item."""
    rng = np.random.RandomState(3)
    base = [set(rng.choice(60, 20, replace=False).tolist()) for _ in range(3)]
    items = [set(base[i % 3]) | set(rng.choice(60, 4).tolist()) for i in range(40)] + [set()]
    plan = lexical_search.mine(items, 60)
    scores = rng.randint(0, 10 ** 12, (60, 7))
    partial = np.zeros((plan.atoms, 7), np.int64)
    np.add.at(partial, plan.atom_of, scores)
    assert (lexical_search.combine(partial, plan) == np.stack([scores[sorted(i)].sum(0) if i else np.zeros(7, np.int64) for i in items])).all()
    assert len(plan.pairs) + sum(map(len, plan.items)) < sum(map(len, items)) / 2


# --- collocations ----------------------------------------------------------------------------------

def brute_collocations(rows, least, cover, top):
    count, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for mark in ".,;:!?\n\x0b\x0c\r":
            lower = lower.replace(mark, "\n")
        for piece in lower.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            total[lang] += len(w)
            for n in (1, 2, 3):
                for i in range(len(w) - n + 1):
                    count.setdefault(lang, Counter())[tuple(w[i:i + n])] += 1
    out = []
    for lang, f in count.items():
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        covered = {}
        for p in candidates:
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    covered[q] = max(covered.get(q, 0), f[p])
        found = []
        for p in candidates:
            if len(p) == 2 and 100 * covered.get(p, 0) >= cover * f[p]:
                continue
            score, _, l, r = min((10 ** 6 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            found.append((-score, -f[p], " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return Counter(out)


def phrase_rows(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(30)] + ["é", "ß-x", "New", "york", "(a", "b)"]
    rows = []
    for i in range(150):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        at = rng.randrange(len(w) + 1)
        w[at:at] = rng.choice((["New", "York", "city"], ["in", "spite", "of"], ["the"] * 4))
        text = "".join(x + rng.choice((" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! ", "\r\n", " ;")) for x in w)
        rows.append((text, rng.choice(("en", "en", "fr", "", None, "und"))))
    return rows + [(None, "en"), ("", "en"), (" \t\n", None), (None, None), ("one two " * 30_000, "de"), rows[0], rows[0], ("a.b.c " * 20, "de")]


@pytest.mark.parametrize("small", [False, True])
def test_collocations_against_brute_force(spark, monkeypatch, small):
    if small:  # bursts, spills, new word ids, steps inside a text, common first words, several ranking tasks
        for name, value in (("BURST", 8), ("TRIE_ENTRIES", 200), ("TASK_WORDS", 30), ("STEP_TOKENS", 50), ("COMMON", 20), ("RANKED_ROWS", 20)):
            monkeypatch.setattr(collocations, name, value)
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, x, 1, 2) for t, x in rows], "text string, lang string, h1 long, f long").repartition(3)
    # the package that workers import is the shipped one: small sizes hold where the functions run in this process
    got = collocations.collocations(docs, 10, 50, 2000)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(map(tuple, got.collect())) == brute_collocations(rows, 10, 50, 2000)
    if small:
        assert Counter(map(tuple, collocations.collocations(docs, 4, 90, 5).collect())) == brute_collocations(rows, 4, 90, 5)
    else:
        assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_trie_runs_and_merge(monkeypatch, order):
    """Counts of a task's trie with bursts, spills and new ids, merged per prefix partition, in this process."""
    for name, value in (("BURST", 8), ("TRIE_ENTRIES", 100), ("TASK_WORDS", 25), ("STEP_TOKENS", 40)):
        monkeypatch.setattr(collocations, name, value)
    rows = [r for r in phrase_rows() if not r[0] or len(r[0]) < 5000]

    class Sent:
        def __init__(self, value):
            self.value = value

    everything = Sent(np.full(1 << 13, 255, np.uint8))
    batch = pa.record_batch({"text": pa.array([t for t, _ in rows]), "lang": pa.array([x for _, x in rows])})
    common = np.array([__import__("xxhash").xxh3_64_intdigest(b"the")], np.uint64)
    runs = pa.Table.from_batches(list(collocations._runs(order, 5, Sent(common), everything)([batch])))
    got = Counter()
    for lang, part in {(r["lang"], r["part"]) for r in runs.select(["lang", "part"]).to_pylist()}:
        mine = runs.filter(pa.compute.and_(pa.compute.equal(runs["lang"], lang), pa.compute.equal(runs["part"], part)))
        for r in collocations._merge(order, 1)((pa.scalar(lang), pa.scalar(part)), mine).to_pylist():
            if r["h1"] is not None:
                got[(lang, *(r[f"h{j + 1}"] for j in range(order)))] += r["f"]
    want = Counter()
    code = lambda w: int(np.array([__import__("xxhash").xxh3_64_intdigest(w)], np.uint64).view(np.int64)[0])
    for text, lang in rows:
        for piece in (text or "").encode().translate(collocations.PIECES).split(b"."):
            w = piece.split()
            for i in range(len(w) - order + 1):
                want[("und" if lang is None else lang, *map(code, w[i:i + order]))] += 1
    assert got == want


def test_bitmap_has_no_false_negatives():
    rng = np.random.RandomState(0)
    held = rng.randint(0, 2 ** 62, 1000).astype(np.uint64)
    bits = np.zeros(1 << 10, np.uint8)
    at = held & np.uint64(8 * len(bits) - 1)
    np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
    assert collocations.Bitmap(bits).has(held).all()


def test_words_are_bytes_between_spaces():
    assert "Über ÀB".encode().translate(common.LOWER) == "Über Àb".encode()
