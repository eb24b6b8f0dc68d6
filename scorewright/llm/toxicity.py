"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding.

Folding: lower case, look-alike letters of other scripts to Latin, digits and signs that stand for
letters inside words back to letters, then words of letters only. The lexicon holds words and word beginnings;
their weights are smoothed log-odds from labelled training rows. All entries and the exception phrases are one
automaton; a hit inside an exception phrase does not count. The hits' weights, in all, at most and
normalised by length, give the score by a logistic fit on the training rows."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm import common as C

#: Labelled rows from which the lexicon and the fit are learned at most (about so many, by a hash).
TRAIN_ROWS = 20_000
#: Rows in which an entry must be seen as if the usual share of them were toxic, and the least share.
PRIOR_ROWS, LEAST_SHARE = 5.0, 0.5
PREFIXES = range(4, 9)
#: In these, a word of the lexicon is harmless.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "pond scum", "good loser")

#: Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("абвгеіјкорсухԁһмнтѕαεικνορτυχ", "abbreijkopcyxdhmhtsaeikvoptux")
LOOKALIKE = re.compile("[Ͱ-ϿЀ-ԯ！-～]")
WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
SUBSTITUTES = str.maketrans("013457@$!", "oieastasi")
#: A run of word characters and signs that may stand for letters, and a letter in it.
RUN = re.compile(r"[\w@$!]+")
LETTER = re.compile(r"[^\W\d_]")
SUBSTITUTED = re.compile("[0-9@$!]")
WORD = re.compile(r"[^\W\d_]+")


def _unmask(run: re.Match) -> str:
    """A run with a letter and a sign or digit has these back as letters; exclamation marks at its end are none."""
    held = run[0].rstrip("!")
    if SUBSTITUTED.search(held) and LETTER.search(held):
        return held.translate(SUBSTITUTES) + run[0][len(held):]
    return run[0]


def fold(text: str | None) -> list[str]:
    """Folded words of a text."""
    t = (text or "").lower()
    if not t.isascii() and LOOKALIKE.search(t):
        t = t.translate(WIDE).lower().translate(LOOKALIKES)
    if SUBSTITUTED.search(t):
        t = RUN.sub(_unmask, t)
    return WORD.findall(t)


@dataclass
class Model:
    """A lexicon (entries begin with a space; those of whole words also end with one) and a fit."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    fit: tuple[float, ...] = (-4.0, 1.0, 0.0, 0.0)
    _automaton: object = field(default=None, repr=False)

    def automaton(self):
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                a.add_word(term, (len(term), weight))
            for phrase in self.exceptions:
                a.add_word(f" {phrase} ", (len(phrase) + 2, None))
            if len(a):
                a.make_automaton()
            self._automaton = a
        return self._automaton

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Largest weight, sum of each word's largest weight (log), and that sum by length."""
        words = fold(text)
        a = self.automaton()
        if not words or not len(a):
            return 0.0, 0.0, 0.0
        best: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        for end, (n, weight) in a.iter(" " + " ".join(words) + " "):
            at = end - n + 1
            if weight is None:
                excepted.append((at, end))
            elif weight > best.get(at, 0.0):
                best[at] = weight
        if excepted:
            best = {at: w for at, w in best.items() if not any(x <= at < y for x, y in excepted)}
        total = sum(best.values())
        return max(best.values(), default=0.0), math.log1p(total), total / math.sqrt(len(words) + 1)

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = self.fit[0] + features @ np.array(self.fit[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _terms(batches):
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    toxic, clean = Counter(), Counter()

    def flush():
        terms = list({**toxic, **clean})
        out = pa.record_batch([pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())], schema=schema)
        toxic.clear()
        clean.clear()
        return out

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = set(fold(text))
            terms = {f" {w} " for w in words}
            for n in PREFIXES:
                terms.update(" " + w[:n] for w in words if len(w) >= n)
            (toxic if label else clean).update(terms)
            if len(toxic) + len(clean) > 100_000:
                yield flush()
    yield flush()


def _feature_rows(model):
    schema = pa.schema([("x0", pa.float64()), ("x1", pa.float64()), ("x2", pa.float64()), ("toxic", pa.int64())])

    def run(batches):
        for batch in batches:
            x = [model.features(t) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([f[i] for f in x], pa.float64()) for i in range(3)] + [batch.column(1).cast(pa.int64())], schema=schema)

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (y - p) - ridge * b
        b = b + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), grad)
    return tuple(b.tolist())


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Lexicon and fit from ``labels`` (``doc_id, toxic``) of ``docs`` (``doc_id, text``). Held-out rows
    (crc32 of the doc_id as text, mod 5, is 0) and null labels are never read. At most about ``rows``
    labelled rows, chosen by a hash of doc_id, are used; equal texts count once, and an id or a text with labels of
    both kinds is toxic, whatever the order of rows. Without labels of both
    kinds the lexicon is empty and every score is the same."""
    docs = C.narrow(docs, "doc_id", "text")
    train = (C.narrow(labels, "doc_id", "toxic").filter("doc_id is not null and toxic is not null").filter(~held_out("doc_id"))
             .select("doc_id", (F.col("toxic") > 0).cast("long").alias("toxic"))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = train.count()
    if n > rows:
        train = train.filter(F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000)) < int(1_000_000 * rows / n))
    sample = C.materialize(docs.join(F.broadcast(train), "doc_id").select("text", "toxic", F.xxhash64("text").alias("h"))
                           .groupBy("h").agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"))
    n1, n0 = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    if not n1 or not n0:
        return Model({}, exceptions, (math.log((n1 + 0.5) / (n0 + 0.5)), 0.0, 0.0, 0.0))
    prior = n1 / (n1 + n0)
    share = (F.col("toxic") + PRIOR_ROWS * prior) / (F.col("toxic") + F.col("clean") + PRIOR_ROWS)
    terms = (sample.mapInArrow(_terms, "term string, toxic long, clean long").groupBy("term")
             .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).withColumn("share", share)
             .filter(F.col("share") >= LEAST_SHARE).withColumn("weight", F.log(F.col("share") / (1 - F.col("share"))) - math.log(prior / (1 - prior)))
             .filter("weight > 0").select("term", "weight").collect())
    model = Model({r[0]: r[1] for r in sorted(terms)}, exceptions)
    got = sample.mapInArrow(_feature_rows(model), "x0 double, x1 double, x2 double, toxic long").collect()
    got.sort(key=tuple)
    x = np.array([tuple(r)[:3] for r in got], float)
    model.fit = _logistic(x, np.array([r[3] for r in got], float))
    return model


def held_out(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def _scored(model):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                x = np.array([model.features(t.decode() if t else None) for t in texts], float).reshape(-1, 3)
                yield pa.record_batch([rows.column(0).cast(pa.int64()), pa.array(model.scores(x))], schema=schema)

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id, text``; others ignored): ``doc_id, held_out, score,
    predicted``. Null and empty texts have no hits and get the fit's constant. ``held_out`` of a null
    doc_id is false. An empty table gives no rows."""
    rows = C.narrow(docs, "doc_id", "text").mapInArrow(_scored(model), "doc_id long, score double")
    return rows.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _clean(model):
    def run(batches):
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                x = np.array([model.features(t.decode() if t else None) for t in texts], float).reshape(-1, 3)
                yield rows.filter(pa.array(model.scores(x) < 0.5))

    return run


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, that the model does not call toxic."""
    C.prepare(docs.sparkSession)
    return docs.mapInArrow(_clean(model), docs.schema)
