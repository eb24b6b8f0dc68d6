"""Operators of the llm subpackage against brute force, on small tables with every odd case."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from scorewright.llm import (common, components, decontaminate, exact_dedup, license_scan, mixing, ngram_join, pii, substring_dedup, token_counts, toxicity, url_filter)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, u long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def odd_docs(spark):
    """Null, empty, blank, repeated and very long texts, null ids and columns with clashing names."""
    rng = random.Random(4)
    base = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(40)) for _ in range(200)) for _ in range(3)]
    texts = [None, "", " \t\n", "one", "one two", base[0], base[0], base[0] + " extra", base[1], base[1].replace(" ", "  "), base[2] * 300, "é" * 50, "ONE two"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, None, 5, 6) for i, t in enumerate(texts)]
    rows += [rows[5], (None, base[2], None, None, None, 1, 1), (None, None, None, None, None, 1, 1)]
    return spark.createDataFrame(rows, DOCS), rows


def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(rows, k, percent):
    sets = []
    for r in rows:
        w = (r[1] or "").encode().translate(common.LOWER).split()
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), low.get(find(i), r[0])) for i, r in enumerate(rows))


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_ngram_join_odd_rows(spark, k, percent):
    docs, rows = odd_docs(spark)
    assert Counter(map(tuple, ngram_join.link_components(docs, k, percent).collect())) == brute_components(rows, k, percent)
    assert ngram_join.link_components(empty(spark), k, percent).count() == 0


def test_ngram_join_large_groups(spark, monkeypatch):
    """Near copies in one large group, chained edits and a shared passage; tiles and blocks are made small."""
    monkeypatch.setattr(ngram_join, "SMALL_TILE", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, " ".join(w)))
    chain = list(base)
    for i in range(60, 90):
        chain[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(chain)))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows += [(i, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(90, 130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((3, 90), (5, 80)):
        assert Counter(map(tuple, ngram_join.link_components(docs, k, percent).collect())) == brute_components(rows, k, percent)


def test_bitmap_bounds_overlap():
    rng = np.random.RandomState(0)
    for _ in range(50):
        a, b = (np.unique(rng.randint(0, 2 ** 62, rng.randint(1, 900)).astype(np.uint64)) for _ in range(2))
        b = np.unique(np.r_[b, a[: len(a) // 2]])
        differ = int(np.bitwise_count((ngram_join.bitmap(a) ^ ngram_join.bitmap(b)).view(np.uint64)).sum())
        assert (len(a) + len(b) - differ) // 2 >= len(np.intersect1d(a, b))


def test_exact_dedup(spark):
    docs, rows = odd_docs(spark)
    halves = [spark.createDataFrame(rows[:7], DOCS), spark.createDataFrame(rows[7:], DOCS)]
    got = Counter(tuple(r)[:5] for r in exact_dedup.exact_dedup(*halves).collect())
    want = Counter()
    for r in rows:
        same = [x for x in rows if (x[1] or "") == (r[1] or "")]
        keep = max((x[0] for x in same if x[0] is not None), default=None)
        want[r[0], keep, len(same), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    assert got == want
    assert exact_dedup.exact_dedup(empty(spark), empty(spark)).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint64).reshape(-1, 4)
    assert sorted(exact_dedup.slots(exact_dedup.build_hash(keys), keys).tolist()) == list(range(5000))


@pytest.mark.parametrize("block", [16 << 20, 40])
def test_decontaminate(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, rows = odd_docs(spark)
    items = [(1, " ".join(rows[5][1].split()[20:45])), (2, "two"), (3, None), (4, ""), (5, "gamma delta"), (5, "one"), (None, "two"), (12, rows[8][1])]
    found = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            found.setdefault(tuple(w[i:i + 10]), set()).add(item)
    want = Counter()
    for r in rows:
        w, hit, which = words(r[1]), set(), set()
        for n in {len(x) for x in found}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in found:
                    hit.update(range(i, i + n))
                    which |= found[tuple(w[i:i + n])] - {None}
        want[r[0], len(w), len(hit), len(which), hashlib.sha256(",".join(sorted(map(str, which))).encode()).hexdigest(), bool(hit)] += 1
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert Counter(map(tuple, decontaminate.contamination(docs, benchmark).collect())) == want
    assert not decontaminate.contamination(docs, benchmark.limit(0)).filter("contaminated").count()
    assert decontaminate.contamination(empty(spark), benchmark).count() == 0
    assert decontaminate.decontaminate(docs, benchmark).columns == docs.columns


def test_longest_matches(spark):
    text = " ".join(f"a{i}" for i in range(50))
    docs = spark.createDataFrame([(1, "x y " + text + " z")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, "q " + " ".join(text.split()[5:40]) + " r")], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.longest_matches(docs, benchmark).collect()] == [(1, 9, 7, 1, 35)]


def test_license_scan(spark):
    rows = [(1, "Released under the MIT License."), (2, "Under the MIT license, under the mit license; Apache License, Version 2.0"), (3, None), (4, ""),
            (5, "CC BY-NC 4.0"), (6, "Licensed under the GNU General Public License, version 3"), (7, "x " + license_scan.NOTICES["mit"].replace("without restriction", "with no restriction")), (1, "plain")]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, label string")
    got = Counter(tuple(r)[:7] for r in license_scan.scan(docs).collect())
    want = Counter()
    for i, (d, text) in enumerate(rows):
        w, starts, labels = words(text), [], set()
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            at = [j for j in range(len(w)) if w[j:j + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        every = labels | {5: {"gpl-3"}, 6: {"mit"}}.get(i, set())
        want[d, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(every))] += 1
    assert got == want
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_pii_base_and_additions(spark):
    texts = ["mail a.b@c.example.com, x@@y.z or 1.2.3.4 and 1.2.3.999 5.6.7.8.9.10.11.12", "card 4532015112830366 or 4532 0151 1283 0367", "+1 (555) 123-4567 +12 3",
             None, "", 'token = "' + "a1b2c3d4" * 5 + '"', "@" * 300 + "9" * 3000, "é a@b.c"]
    rows = [(i, t) for i, t in enumerate(texts)] * 2
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    got = {r.doc_id: r for r in pii.redactions(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in email.finditer(t)] + [(m.start(), 1, m.end()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
        for m in pii.CARD.finditer(t):
            d = re.sub("[^0-9]", "", m[0])
            if 12 <= len(d) <= 19 and sum(int(c) if j % 2 == 0 else sum(divmod(2 * int(c), 10)) for j, c in enumerate(d[::-1])) % 10 == 0:
                spans.append((m.start(), 2, m.end()))
        spans += [(m.start(), 3, m.end()) for m in pii.PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans)]
        assert got[i].base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(got[i].spans.split(",")) | {""}
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
    assert pii.redactions(empty(spark)).count() == 0


def test_pii_rare_kinds_keep_their_spans(spark):
    """A few contacts beside very many numbers, with a sample far smaller than the candidates."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"item {rng.randrange(10 ** 7, 10 ** 8)} x" for _ in range(100))) for i in range(200)]
    rows += [(1000 + i, f"write to user{i} (at) host{i}.example.org soon") for i in range(40)]
    got = {r.doc_id: r.spans for r in pii.redactions(spark.createDataFrame(rows, "doc_id long, text string"), sample=100).collect()}
    assert all("contact:" in got[1000 + i] for i in range(40)) and not any(got[i] for i in range(200))


def test_chunks_cover_and_resist_shifts():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(3000)).encode()
    ends = substring_dedup.cuts(text)
    assert ends[-1] == len(text) and ends == sorted(set(ends))
    parts = [text[a:b] for a, b in zip([0, *ends], ends)]
    assert all(p.decode() for p in parts) and b"".join(parts) == text
    moved = b"inserted words " + text
    others = {moved[a:b] for a, b in zip([0, *substring_dedup.cuts(moved)], substring_dedup.cuts(moved))}
    assert sum(p in others for p in parts) > 0.97 * len(parts)


def test_gear_hash_is_rolling():
    data = np.random.RandomState(0).randint(0, 256, 200).astype(np.uint8)
    h = 0
    for i, b in enumerate(data.tolist()):
        h = ((h << 1) + int(substring_dedup.GEAR[b])) & 0xFFFFFFFF
        assert h == int(substring_dedup.gear_hashes(data[: i + 1])[-1])


def test_repeated_passages(spark):
    rng = random.Random(3)
    own = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    passage = own(60)
    rows = [(1, own(80) + " " + passage + " " + own(30)), (2, passage + " " + own(90)), (3, own(100)), (4, None), (5, ""), (6, own(20) + " " + passage), (None, passage), (3, own(5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.repeated_passages(docs)
    by = {r.doc_id: r for r in got.collect()}
    assert set(by) == {1, 2, 6} and all(r.keep_doc_id == 1 and r.removed == (d != 1) for d, r in by.items())
    texts = dict(rows[:3] + rows[5:6])
    assert all(texts[d][r.start:r.end] in " " + passage + " " for d, r in by.items())
    left = {r.doc_id: r.text for r in substring_dedup.remove_passages(docs.filter("doc_id < 3"), got).collect()}
    assert left[1] == texts[1] and left[2] == texts[2][: by[2].start] + texts[2][by[2].end:]
    assert substring_dedup.repeated_passages(empty(spark)).count() == 0


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    held = toxicity.score(docs, model).filter("held_out").join(labels, "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in held.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.02 * n[0, 0]
    small, rows = odd_docs(spark)
    assert toxicity.score(small, model).count() == len(rows) and toxicity.keep_clean(small, model).columns == small.columns
    assert toxicity.learn(empty(spark), labels).weights == {} and toxicity.score(empty(spark), model).count() == 0


def test_folding_and_exceptions():
    assert toxicity.fold("Іdiot 1D10T l0ser in 2024!") == ["idiot", "idiot", "loser", "in"]
    model = toxicity.Model({" trash ": 3.0, " idio": 4.0})
    assert model.features("the trash can") == (0.0, 0.0, 0.0) and model.features("trash idiots")[0] == 4.0 and model.features(None) == (0.0, 0.0, 0.0)


def test_mixing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert (got.taken <= 2 * got["size"]).all() and len(got) == docs.count()
    sums = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"))
    assert ((sums.taken - sums.target).abs() <= 1).all() and (sums.target <= 2 * sums["size"]).all()
    assert abs(sums.target.sum() - 1.5 * sums["size"].sum()) < 1e-6
    again = mixing.mix(docs.repartition(7)).toPandas()
    assert sorted(map(tuple, again.values.tolist())) == sorted(map(tuple, got[again.columns].values.tolist()))
    small, rows = odd_docs(spark)
    assert mixing.mix(small).count() == len(rows) and mixing.mix(empty(spark)).count() == 0


def test_mixing_small_sources_reach_their_target(spark):
    """Many sources of 5 to 300 words beside one of three million."""
    large = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', 1000) AS text", "'large' AS source")
    small = spark.range(5, 301).selectExpr("id + 10000 AS doc_id", "repeat('w ', int(id)) AS text", "concat('s', id) AS source")
    docs = large.unionByName(small)
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    sums = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"))
    assert len(sums) == 297 and (sums.taken == np.floor(sums.target)).all() and (got.taken <= 2 * got["size"]).all()


def test_token_histogram(spark):
    docs, rows = odd_docs(spark)
    encode = token_counts._encoder(token_counts.vocabulary()).encode_ordinary
    n = [len(encode(r[1] or "")) for r in rows]
    hist = token_counts.histogram(token_counts.encoded_lengths(docs))
    want = {(x, n.count(x), sum(y > x for y in n), sum(y for y in n if y > x), sum(y <= x for y in n), sum(min(x, y) for y in n)) for x in n}
    assert {tuple(r) for r in hist.collect()} == want
    assert token_counts.total(hist) == sum(n) and token_counts.truncated_total(hist, 100) == sum(min(x, 100) for x in n)
    assert token_counts.quantile(hist, 0.5) == sorted(n)[(len(n) - 1) // 2]
    assert token_counts.histogram(token_counts.encoded_lengths(empty(spark))).count() == 0


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://WWW.Example.com/en/1?x", "https://example.com/en/", "https://a.net/es/x#y", "http://x.org", "http://casino-win.example.net/a",
            "http://casinos.example.net/a", "https://example.com", "a://b.com/?c://d", "http://x.free--bets.org/q"]
    docs = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] * 2, "page_id long, url string, rule string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge_urls(docs).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and got[4][2:] == ("example.com/en/", "block")
    assert got[5] == ("a.net", "/es/x", "net/es/", "block") and got[6] == ("x.org", "", None, "allow") and got[7][3] == "block"
    assert got[8][3] == "allow" and got[9] == ("example.com", "", None, "allow") and got[10][:3] == ("b.com", "/", "com/") and got[11][3] == "block"
    assert url_filter.judge_urls(docs.limit(0)).count() == 0


def test_fine_bitmaps_bound_the_overlap_from_above():
    """Sets of very different lengths fold to one length; the bound never falls below the true overlap."""
    rng = np.random.default_rng(5)
    for a, b, shared in ((1, 1, 1), (1, 900, 1), (40, 50, 30), (300, 310, 290), (4000, 500, 450), (3000, 3100, 2900)):
        pool = np.unique(rng.integers(0, 1 << 63, 2 * (a + b), np.int64).astype(np.uint64))
        pool = rng.permutation(pool)[:a + b - shared]
        x, y = np.sort(pool[:a]), np.sort(np.r_[pool[:shared], pool[a:]])
        most = (len(x) + len(y) - ngram_join.fine_differ(ngram_join.fine_bitmap(x), ngram_join.fine_bitmap(y))) // 2
        assert most >= shared
        if shared == 2900:
            assert most <= 2920  # 512 bits would not tell these sets from equal ones
    assert ngram_join.fine_differ(ngram_join.fine_bitmap(np.zeros(0, np.uint64)), ngram_join.fine_bitmap(np.zeros(0, np.uint64))) == 0
