"""The registered queries of the operators, with production parameters over whole tables, and SQL
twins where SQL expresses the operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm import (collocations, decontaminate, exact_dedup, lexical_search, license_scan, minhash_join, mixing, ngram_join, pii, substring_dedup, token_counts, toxicity, url_filter)
from scorewright.llm.common import ALNUM_WORDS, SPACE_WORDS, table

LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redactions(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents (by a hash of the id) are the history, the others come after it."""
    docs = table(spark, sf_dir, "documents")
    before = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return exact_dedup.exact_dedup(docs.filter(before), docs.filter(~before)).drop("seen_before", "mark")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.histogram(token_counts.encoded_lengths(table(spark, sf_dir, "documents")))


def op11_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_url_filter, op3_decontaminate, op4_pii, op5_exact_dedup, op6_substring_dedup,
                                   op7_license_scan, op8_toxicity, op9_mixing, op10_token_counts, op11_minhash_join, op12_lexical_search,
                                   op13_collocations)}

_PATTERNS = "|".join(f"({r.pattern})" for r in url_filter.PATTERN_RULES)
_HOST_CASES = " UNION ALL ".join(
    f"SELECT '{v}' AS v, '{r}' AS r, '{r.partition('/')[0]}' AS h, '/{r.partition('/')[2]}' AS p" for v, r in url_filter.HOST_RULES)
_WEIGHTS = ", ".join(map(str, mixing.WEIGHTS))

def _links_sql(percent: int, more: str = "") -> str:
    """Sets of 3-word shingles, links by exact counts, and the smallest doc_id reached."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '{SPACE_WORDS}') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM words
), grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON x = r)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.c AS component_id{more}
FROM sets s JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) m USING (doc_id)"""


SQL = {
    "op1_ngram_join": _links_sql(90),
    "op11_minhash_join": _links_sql(85, ", s.doc_id = m.c AS kept"),
    "op2_url_filter": f"""
WITH urls AS (
  SELECT page_id, url, position('://' IN coalesce(url, '')) > 0 AS whole, substr(url, position('://' IN url) + 3) AS rest FROM pages
), split AS (
  SELECT page_id, url, CASE WHEN whole THEN {LOWER_SQL.format("regexp_extract(rest, '^([^/?#]*)', 1)")} ELSE '' END AS host,
    CASE WHEN whole THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM urls),
rules AS ({_HOST_CASES}),
fits AS (
  SELECT page_id, arg_max(r, length(r)) AS rule, arg_max(v, length(r)) AS verdict FROM split JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT s.page_id, s.host, s.path, f.rule,
  coalesce(f.verdict, CASE WHEN regexp_matches({LOWER_SQL.format("s.url")}, '{_PATTERNS}') THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN fits f USING (page_id)""",
    "op3_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '{ALNUM_WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '{ALNUM_WORDS}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, item_id, i, n FROM places JOIN win USING (n, k)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256 FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op9_mixing": f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{SPACE_WORDS}')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents
), src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM sized GROUP BY source),
weighed AS (SELECT source, source_size, source_size * 2.0::DOUBLE AS most, CAST([{_WEIGHTS}][(i - 1) % {len(mixing.WEIGHTS)} + 1] AS DOUBLE) AS weight FROM src),
level AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER w AS k
  FROM weighed WINDOW w AS (ORDER BY most / weight, source NULLS LAST)
), flat AS (SELECT min(k) AS k0, arg_min(level, k) AS flat FROM level WHERE level * weight <= most),
targets AS (SELECT source, source_size, CASE WHEN k0 IS NULL OR k < k0 THEN most ELSE flat * weight END AS target FROM level, flat),
numbered AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS s, floor(target) AS whole, ceil(source_size / {mixing.BLOCK_WORDS}::DOUBLE) AS n FROM targets),
goal AS (SELECT sum(target) AS goal, CAST(floor(sum(target) / {mixing.BLOCK_WORDS}) + 1 AS BIGINT) AS base FROM targets),
edges AS (
  SELECT s, CAST(round(coalesce(sum(target) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / goal * {mixing.POINTS}) AS BIGINT) AS lo,
    CAST(round(sum(target) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / goal * {mixing.POINTS}) AS BIGINT) AS hi
  FROM numbered, goal WHERE target > 0 WINDOW w AS (ORDER BY s)
), points AS (SELECT i, ((i % {1 << 31}) * {mixing.GOLDEN}) % {mixing.POINTS} AS point FROM (SELECT unnest(range(base + base // 16 + 1024)) AS i FROM goal)),
dealt AS (SELECT s, i AS slot, row_number() OVER (PARTITION BY s ORDER BY i) - 1 AS rank FROM points JOIN edges ON point >= lo AND point < hi),
needed AS (
  SELECT s, n, whole, source_size, CAST(CASE WHEN whole <= source_size THEN ceil(whole / {mixing.BLOCK_WORDS}::DOUBLE)
    ELSE n + ceil((whole - source_size) / {mixing.BLOCK_WORDS}::DOUBLE) END AS BIGINT) AS needed FROM numbered WHERE target > 0
), ranks AS (SELECT s, n, whole, source_size, unnest(range(needed)) AS rank FROM needed),
slots AS (
  SELECT r.s, CAST(rank % n AS BIGINT) AS block, CAST(floor(rank / n) AS BIGINT) AS epoch, coalesce(slot, base + base // 16 + 1024 + rank) AS slot,
    least({mixing.BLOCK_WORDS}, whole - floor(rank / n) * source_size - (rank % n) * {mixing.BLOCK_WORDS}) AS words
  FROM ranks r LEFT JOIN dealt d USING (s, rank), goal
), laid AS (
  SELECT doc_id, size, t.source_size, t.target, t.s, sum(size) OVER (PARTITION BY t.s ORDER BY h, doc_id) - size AS pos
  FROM sized d JOIN numbered t ON d.source IS NOT DISTINCT FROM t.source
), pieces AS (
  SELECT doc_id, least(pos + size - b.block * {mixing.BLOCK_WORDS}, words) - greatest(pos - b.block * {mixing.BLOCK_WORDS}, 0) AS got, slot
  FROM laid l JOIN slots b ON l.s = b.s AND size > 0 AND b.block >= pos // {mixing.BLOCK_WORDS} AND b.block <= (pos + size - 1) // {mixing.BLOCK_WORDS}
), sums AS (SELECT doc_id, sum(got) AS taken, min(slot) AS first_slot FROM pieces WHERE got > 0 GROUP BY doc_id)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, CAST(coalesce(first_slot, -1) AS BIGINT) AS first_slot
FROM laid LEFT JOIN sums USING (doc_id)""",
    "op12_lexical_search": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '{ALNUM_WORDS}') AS w FROM documents
), sized AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sized),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '{ALNUM_WORDS}')) AS term FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, whole GROUP BY term, big_n
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l))))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weights USING (term) JOIN sized USING (r), whole GROUP BY item_id, r, doc_id
), ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50""",
    "op13_collocations": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_SQL.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), listed AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
one AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM listed) GROUP BY ALL),
two AS (SELECT lang, g[1] AS x, g[2] AS y, count(*) AS f FROM (SELECT lang, unnest([w[i:i + 1] FOR i IN range(1, len(w))]) AS g FROM listed) GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, g[1] AS x, g[2] AS y, g[3] AS z, count(*) AS f FROM (SELECT lang, unnest([w[i:i + 2] FOR i IN range(1, len(w) - 1)]) AS g FROM listed) GROUP BY ALL HAVING count(*) >= 10),
sums AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang),
inner_pairs AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY ALL),
found AS (
  SELECT p.lang, p.x || ' ' || p.y AS phrase, p.f AS a, u.f AS l, v.f AS r, CAST((1000000::HUGEINT * p.f * p.f) // (u.f::HUGEINT * v.f) AS BIGINT) AS score
  FROM two p JOIN one u ON u.lang = p.lang AND u.x = p.x JOIN one v ON v.lang = p.lang AND v.x = p.y
  WHERE NOT EXISTS (SELECT 1 FROM inner_pairs i WHERE i.lang = p.lang AND i.x = p.x AND i.y = p.y AND 100 * i.f >= 50 * p.f)
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM (
    SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a, u.f AS l1, q.f AS r1, p.f AS l2, v.f AS r2,
      CAST((1000000::HUGEINT * t.f * t.f) // (u.f::HUGEINT * q.f) AS BIGINT) AS s1, CAST((1000000::HUGEINT * t.f * t.f) // (p.f::HUGEINT * v.f) AS BIGINT) AS s2
    FROM three t JOIN one u ON u.lang = t.lang AND u.x = t.x JOIN one v ON v.lang = t.lang AND v.x = t.z
      JOIN two p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN two q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z)
), ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM found)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sums USING (lang) WHERE rank <= 2000""",
}
