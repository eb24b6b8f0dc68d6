"""URL filters: host rules, and pattern rules indexed by their rarest literal token.

A pattern rule is a regular expression on the lower-cased url with the literal tokens (runs of a-z and
0-9) that any match must contain. The tokens' numbers of urls are counted once over the whole table; each rule is
filed under its rarest token. The tokens of a url fetch its candidate rules, and only those run their expression."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm import common as C

#: (verdict, host and path) of the host rules (fixed by the contract).
HOST_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Words and word sequences of urls that are not wanted in a corpus.
BLOCKED = ("casino", "poker", "slots", "jackpot", "free bets", "betting", "adult", "porn", "xxx", "escort", "cheap pills", "viagra", "cialis",
           "payday loan", "spam farm", "link farm", "ads track", "adserver", "doubleclick", "torrent", "warez", "keygen")
TOKEN = re.compile("[a-z0-9]+")


@dataclass(frozen=True)
class PatternRule:
    verdict: str
    pattern: str
    literals: tuple[str, ...]


def words_rule(verdict: str, words: str) -> PatternRule:
    """The words one after the other, as whole tokens, with any signs between."""
    tokens = tuple(words.split())
    return PatternRule(verdict, "(^|[^a-z0-9])" + "[^a-z0-9]+".join(tokens) + "([^a-z0-9]|$)", tokens)


PATTERN_RULES = tuple(words_rule("block", w) for w in BLOCKED)


def _lower(text: str) -> str:
    return text if text.islower() and text.isascii() else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = re.search("[/?#]", rest)
    cut = end.start() if end else len(rest)
    return _lower(rest[:cut]), re.split("[?#]", rest[cut:], maxsplit=1)[0]


class Judge:
    def __init__(self, host_rules, pattern_rules, counts: dict[str, int]):
        self.hosts: dict[str, list[tuple[str, str]]] = defaultdict(list)
        for verdict, rule in host_rules:
            host, slash, path = rule.partition("/")
            self.hosts[host].append((slash + path, verdict))
        self.index: dict[str, list[tuple[str, re.Pattern]]] = defaultdict(list)
        self.always: list[tuple[str, re.Pattern]] = []
        for r in pattern_rules:
            entry = (r.verdict, re.compile(r.pattern))
            (self.index[min(r.literals, key=lambda t: (counts.get(t, 0), t))] if r.literals else self.always).append(entry)

    def host_rule(self, host: str, path: str) -> tuple[str, str] | None:
        """Verdict and rule string of the longest rule that fits."""
        best = None
        labels = host.split(".") if host else []
        for i in range(len(labels)):
            name = ".".join(labels[i:])
            for prefix, verdict in self.hosts.get(name, ()):
                if path.startswith(prefix) and (best is None or len(name + prefix) > len(best[1])):
                    best = verdict, name + prefix
        return best

    def pattern_verdict(self, url: str | None) -> str:
        """allow if an allowing rule matches or none does."""
        text = _lower(url or "")
        found = {v for t in set(TOKEN.findall(text)) for v, p in self.index.get(t, ()) if p.search(text)}
        found |= {v for v, p in self.always if p.search(text)}
        return "block" if found == {"block"} else "allow"

    def __call__(self, url: str | None) -> tuple[str, str, str | None, str]:
        host, path = split_url(url)
        fits = self.host_rule(host, path)
        return host, path, fits and fits[1], fits[0] if fits else self.pattern_verdict(url)


def _literal_counts(literals: frozenset):
    schema = pa.schema([("token", pa.string()), ("urls", pa.int64())])

    def run(batches):
        counts = Counter()
        for batch in batches:
            for url in batch.column(0).to_pylist():
                counts.update(literals.intersection(TOKEN.findall(_lower(url or ""))))
        yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    return run


def _judged(judge):
    schema = pa.schema([("page_id", pa.int64()), *[(c, pa.string()) for c in ("host", "path", "rule", "verdict")]])

    def run(batches):
        for batch in batches:
            out = [judge(url) for url in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0).cast(pa.int64()), *[pa.array([x[i] for x in out], pa.string()) for i in range(4)]], schema=schema)

    return run


def judge_urls(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """One row for each row of ``pages`` (``page_id, url``; others ignored): ``page_id, host, path,
    rule, verdict``.

    A host rule fits its host and all subdomains when the path starts with the rule's; the longest one decides.
    Without one the pattern rules do. A null or empty url, or one without ``://``, has an empty host and path; it fits no host
    rule, and a null url is allowed. Repeated rows give a row each; an empty table gives no rows. The number
    of rules is that of a configuration; they travel with the task, not as data."""
    pages = C.narrow(pages, "page_id", "url")
    literals = frozenset(t for r in pattern_rules for t in r.literals)
    counts = dict(pages.select("url").mapInArrow(_literal_counts(literals), "token string, urls long").groupBy("token").agg(F.sum("urls")).collect())
    return pages.mapInArrow(_judged(Judge(host_rules, pattern_rules, counts)), "page_id long, host string, path string, rule string, verdict string")
