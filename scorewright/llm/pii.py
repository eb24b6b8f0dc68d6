"""Personal data: fixed base rules, and candidates that boosted trees decide on.

Generators with high recall propose overlapping spans (anything like an address with written-out signs, a run of
digits, a long mixed token). Each has features of its format and its context, but not the base rules' verdict. Gradient-boosted trees are fitted on a
bounded sample of the corpus's own candidates, stratified by kind and label, with weak labels: a candidate that a base rule confirms, or that
is assigned to a name of secrets, is personal. Candidates are in two halves (by a hash) and each half is scored by trees fitted on the other one.
A threshold for each kind is calibrated on these scores of all candidates. Spans that pass are added to the base spans, which always stay."""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm import common as C
from scorewright.llm.decontaminate import text_mark

#: Kinds in the order in which they are listed; the base rules cover the first four.
KINDS = ("email", "ip", "card", "phone", "contact", "number", "secret")
#: Different candidates that the trees of both halves are fitted on at most (about so many, by a hash). Each kind and label has an
#: equal part of it; what one does not fill goes to the others. Thresholds come from all candidates.
SAMPLE = 20_000
#: Share of true candidates that a kind's threshold must reach on all candidates.
PRECISION = 0.98
#: Steps of a score in the histograms that thresholds are read from.
STEPS = 10_000
#: Values of the hash by which candidates are drawn.
DRAWS = 1 << 40
TREES, DEPTH = 8, 4

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: As the contract has it; a match can only begin where a run of digits does, and takes whole runs.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

CONTACT = re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?(?:\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[A-Za-z0-9-]{2,63}){1,4}", re.I)
NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,29}")
SECRET = re.compile(r"(?<![A-Za-z0-9_\-])[A-Za-z0-9_\-]{20,128}(?![A-Za-z0-9_\-])")
SECRET_NAME = re.compile(r"(?i)(?:token|secret|api[_-]?key|passw(?:or)?d|access[_-]?key)\s*[=:]\s*[\"']?$")
CONTEXT = ("mail", "phone", "tel", "call", "card", "visa", "ip", "addr", "token", "key", "secret", "pass", "id", "iban", "ssn")
FEATURES = 22 + len(CONTEXT)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches of the e-mail rule, found from their @ in linear time."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base rules, in order."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0]) if m.end() - m.start() <= 60 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _features(text: str, kind: int, start: int, end: int) -> list[float]:
    s, before, after = text[start:end], text[max(0, start - 24):start], text[end:end + 1]
    digits = "".join(c for c in s if "0" <= c <= "9")
    groups = [len(g) for g in re.findall("[0-9]+", s)]
    octets = s.split(".")
    n = len(s)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(s).values())
    low = before.lower()
    return [
        float(kind == 4), float(kind == 5), float(kind == 6), n, len(digits), sum(c.isalpha() for c in s), s.count("."), s.count("-"), s.count(" "),
        s.count("(") + s.count(")"), float(s[0] == "+"), len(groups), max(groups, default=0), min(groups, default=0), float(bool(digits) and luhn(digits)), entropy,
        sum(c in "0123456789abcdefABCDEF" for c in s) / n, float(len(octets) == 4 and all(o.isdigit() and len(o) <= 3 and int(o) <= 255 for o in octets)),
        float(before[-1:].isalnum()), float(after.isalnum()), float(before[-1:] in "\"'=:"), float(after in "\"'" and bool(after)), *[float(w in low) for w in CONTEXT]]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Proposed spans with features, a weak label and whether a base span overlaps."""
    out = []
    for kind, pattern, sign in ((4, CONTACT, "at"), (5, NUMBER, ""), (6, SECRET, "")):
        if sign and sign not in text and "AT" not in text:
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            if kind == 6 and not (re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])):
                continue
            over = [x for x in base if x[0] < b and a < x[2]]
            sure = any(min(b, x[2]) - max(a, x[0]) >= 0.8 * (max(b, x[2]) - min(a, x[0])) for x in over)
            named = kind == 6 and bool(SECRET_NAME.search(text[max(0, a - 24):a]))
            out.append({"kind": kind, "start": a, "end": b, "label": int(sure or named or kind == 4), "over": bool(over), "x": [float(v) for v in _features(text, kind, a, b)]})
    return out


SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("label", pa.int32()), ("over", pa.bool_()), ("x", pa.list_(pa.float64()))])
FOUND = "doc_id long, mark long, base array<struct<start long, kind int, end long>>, found array<struct<kind int, start long, end long, label int, over boolean, x array<double>>>"


def _propose(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("base", pa.list_(SPAN)), ("found", pa.list_(CANDIDATE))])
    for batch in batches:
        for rows, texts in C.slices(batch, "text"):
            base, found = [], []
            for t in texts:
                text = t.decode() if t else ""
                spans = base_spans(text)
                base.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans])
                found.append(candidates(text, spans))
            yield pa.record_batch([rows.column(0).cast(pa.int64()), text_mark(texts), pa.array(base, pa.list_(SPAN)), pa.array(found, pa.list_(CANDIDATE))], schema=schema)


def _finish(batches):
    counts = [f"n_{k}" for k in KINDS[:4]]
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in counts], ("base_sha256", pa.string()), ("spans", pa.string())])
    listed = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    for batch in batches:
        n, sha, every = [[], [], [], []], [], []
        for base, added in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            spans = [(s["start"], s["kind"], s["end"]) for s in base]
            for k in range(4):
                n[k].append(sum(s[1] == k for s in spans))
            sha.append(hashlib.sha256(listed(spans).encode()).hexdigest())
            # Of overlapping additions the surest one stays.
            taken = []
            for s in sorted(added or (), key=lambda s: (-s["p"], s["start"], s["kind"])):
                if all(s["end"] <= a or b <= s["start"] for a, _, b in taken):
                    taken.append((s["start"], s["kind"], s["end"]))
            every.append(listed(spans + taken))
        yield pa.record_batch([batch.column(0), *[pa.array(x, pa.int64()) for x in n], pa.array(sha), pa.array(every)], schema=schema)


def _calibrate(bins: list, precision: float) -> dict[int, int]:
    """The lowest step of each kind from which on the share of true candidates is high enough; ``bins``
    are rows of ``kind, step, candidates, true ones``."""
    out = {}
    for kind in {r[0] for r in bins}:
        step, n, true = (np.array(v) for v in zip(*sorted(((r[1], r[2], r[3]) for r in bins if r[0] == kind), reverse=True), strict=True))
        good = np.flatnonzero((np.cumsum(true) / np.cumsum(n) >= precision) & (step >= STEPS // 2))
        if len(good):
            out[kind] = int(step[good[-1]])
    return out


def _quotas(counts: dict, sample: int) -> dict:
    """Equal parts of ``sample`` for all strata; what small ones leave goes to the larger ones."""
    out, left = {}, sample
    for i, (stratum, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        out[stratum] = min(n, left // (len(counts) - i))
        left -= out[stratum]
    return out


def redactions(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id, text``; others ignored): ``doc_id, n_email, n_ip,
    n_card, n_phone, base_sha256, spans``.

    Counts and digest are of the base spans; ``spans`` lists all as ``kind:start:end`` in characters, end exclusive, by
    start and then kind. Null and empty texts have none. If one half's sample holds only one label, nothing is added in the other half.
    Repeated rows give a row each; a null doc_id is a value like others; an empty table gives no rows."""
    found = C.materialize(C.narrow(docs, "doc_id", "text").mapInArrow(_propose, FOUND))
    each = (found.select("doc_id", "mark", F.explode("found").alias("c")).select("doc_id", "mark", "c.*")
            .withColumn("draw", F.pmod(F.xxhash64("mark", "start", "end", "kind"), F.lit(DRAWS))).withColumn("half", F.pmod("draw", F.lit(2)).cast("int")))
    stratum = F.col("kind") * 2 + F.col("label")
    counts = dict(each.groupBy(stratum.alias("stratum")).agg(F.approx_count_distinct("draw")).collect())
    added = None
    models = {}
    if counts:
        below = {k: int(DRAWS * q / max(counts[k], 1)) for k, q in _quotas(counts, sample).items()}
        drawn = F.element_at(F.create_map(*[F.lit(v) for k, b in below.items() for v in (k, b)]), stratum)
        # A bounded sample of different candidates in one order, so that the same rows give the same trees.
        part = C.materialize(each.filter(F.col("draw") < drawn).select("kind", "label", "x", "draw", "half").dropDuplicates(["draw", "kind"])
                             .repartition(1).sortWithinPartitions("draw", "kind"))
        for half in (0, 1):
            fit = part.filter(F.col("half") != half).select(F.col("label").cast("double"), array_to_vector("x").alias("features"))
            if fit.select("label").distinct().count() == 2:
                models[half] = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(fit.coalesce(1))
    if models:
        # Every candidate, by the trees that did not see its half.
        halves = [model.transform(each.filter(F.col("half") == half).withColumn("features", array_to_vector("x")).drop("x"))
                  .select("doc_id", "mark", "start", "kind", "end", "over", "label", vector_to_array("probability")[1].alias("p")) for half, model in models.items()]
        scored = C.materialize(functools.reduce(DataFrame.unionByName, halves).withColumn("step", F.floor(F.col("p") * STEPS).cast("int")))
        limits = _calibrate(scored.groupBy("kind", "step").agg(F.count("*"), F.sum("label")).collect(), precision)
        if limits:
            limit = F.create_map(*[F.lit(v) for k, t in limits.items() for v in (k, t)])
            added = (scored.filter("not over").filter(F.col("step") >= F.try_element_at(limit, F.col("kind"))).select("doc_id", "mark", "start", "kind", "end", "p").distinct()
                     .groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "kind", "end", "p")).alias("added"))
                     .withColumnsRenamed({"doc_id": "d", "mark": "m"}))
    rows = found.select("doc_id", "mark", "base")
    if added is None:
        rows = rows.select("doc_id", "base", F.lit(None).cast("array<struct<start long, kind int, end long, p double>>").alias("added"))
    else:
        rows = rows.join(added, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left").select("doc_id", "base", "added")
    return rows.mapInArrow(_finish, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
