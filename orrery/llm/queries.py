"""Registered queries of the subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from orrery.llm import (bagminhash, decontaminate, language, licenses, mixing, periods, phrases,
                        pii, preference, quality, sharding, tokens, urls)
from orrery.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "row.doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols",
        "quality.n_dup_lines", "quality.n_repeat_words", "quality.base_failed", "quality.kept",
        "quality.lost_chars")


def _quality_oracle() -> str:
    """The base figures and line rules, line by line and window by window."""
    phrases = quality.boilerplate_pattern(quality.BOILERPLATE)
    ends = quality.ENDS.replace("'", "''")
    symbols = "'[#*$%&|<>]'"
    return f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d
), windows AS (
  SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w
), keyed AS (
  SELECT r, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS k FROM windows
), often AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM keyed) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT i + s) AS n FROM often, range(5) AS five(s) GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(t, chr(10))) AS l FROM d
), worded AS (
  SELECT r, l, regexp_replace(l, '[^\\p{{L}}]+', '', 'g') AS letters,
         length(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars
  FROM lines WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')
), judged AS (
  SELECT r, l, chars,
         NOT regexp_matches(l, '{ends}')
      OR length(l) - length(replace(l, '|', '')) >= {quality.MIN_BARS}
      OR (length(letters) >= {quality.MIN_SHOUT} AND upper(letters) = letters
          AND lower(letters) <> letters)
      OR length(l) - length(regexp_replace(l, {symbols}, '', 'g'))
           > CAST({quality.MAX_SYMBOL_SHARE} AS DOUBLE) * length(l)
      OR (regexp_matches(lower(l), '{phrases}') AND length(regexp_extract(lower(l), '{phrases}', 1))
           >= CAST({quality.MIN_BOILERPLATE_SHARE} AS DOUBLE) * length(l)) AS fails
  FROM worded
), by_doc AS (
  SELECT r, count(*) - count(DISTINCT l) AS dup,
         coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost
  FROM judged GROUP BY r
), figures AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(regexp_replace(t, {symbols}, '', 'g')) AS n_symbols,
         coalesce(b.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         coalesce(b.lost, 0) AS lost
  FROM w LEFT JOIN covered c USING (r) LEFT JOIN by_doc b USING (r)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < {quality.MIN_WORDS}
         OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS}
         OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words)
         AND lost <= CAST({quality.MAX_LOST} AS DOUBLE) * word_chars AS kept,
       CAST(lost AS BIGINT) AS lost_chars
FROM figures
"""


ORACLES["op10_quality_rules"] = _quality_oracle()

#: All pairs that share a shingle, exact overlaps, transitive closure.
ORACLES["op6_bagminhash"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT r, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3),
                        lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS s FROM d
), bags AS (
  SELECT r, s, count(*) AS c FROM shingles GROUP BY r, s
), sizes AS (
  SELECT r, sum(c) AS n FROM bags GROUP BY r
), met AS (
  SELECT a.r AS x, b.r AS y, sum(least(a.c, b.c)) AS common
  FROM bags a JOIN bags b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r
), links AS (
  SELECT x, y FROM met JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y
  WHERE common >= CAST({bagminhash.THRESHOLD} AS DOUBLE) * (p.n + q.n - common)
), reach AS (
  SELECT r AS x, r AS y FROM d
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, min(e.doc_id) AS class_id, count(*) AS class_size
FROM d JOIN reach ON reach.x = d.r JOIN d e ON e.r = reach.y GROUP BY d.r, d.doc_id
"""


@query
def op6_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(table(spark, sf_dir, "documents"))


@query
def op4_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item in it."""
    docs = table(spark, sf_dir, "documents")
    found = decontaminate.find_matches(
        docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    # The text is not wanted back from the tasks' output.
    return found.select(F.col("row.doc_id").alias("doc_id"), F.inline("matches"))


@query
def op5_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.sample(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return taken.select("row.doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


_TURNS = ", ".join(str(float(t)) for t in mixing.TURNS)
ORACLES["op5_systematic_mix"] = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''),
                                                '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(source_size AS DOUBLE) * 2 AS most, CAST(([{_TURNS}])[
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.TURNS)} + 1] AS DOUBLE)
    AS weight FROM sources
), summed AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * CAST({mixing.SHARE} AS DOUBLE)
      - coalesce(sum(most) OVER before, 0) AS to_share,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS still_open
  FROM weighed
  WINDOW before AS (ORDER BY most / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levelled AS (
  SELECT *, most * still_open <= to_share * weight AS capped,
    max(CASE WHEN most * still_open > to_share * weight THEN to_share / still_open END) OVER () AS level
  FROM summed
), goals AS (
  SELECT source, source_size,
    CASE WHEN capped THEN most ELSE least(most, level * weight) END AS target,
    ('0x' || substr(md5('{mixing.SEED}' || coalesce(':' || source, '')), 1, 6))::BIGINT AS shift
  FROM levelled
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS place
  FROM sized
), rated AS (
  SELECT p.doc_id, p.size, g.source_size, g.target, p.place, g.shift,
    CAST(CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size * 16777216)
         ELSE 0 END AS BIGINT) AS rate
  FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  (((place * rate + shift + rate) >> 24) - ((place * rate + shift) >> 24)) * size AS taken
FROM rated
"""


@query
def op2_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenize(table(spark, sf_dir, "documents"), tokens.vocabulary())


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = language.held_out(F.col("doc_id"))
    model = language.learn(docs.filter(~apart).select("text", "lang"))
    rows = docs.select(F.struct("doc_id", apart.alias("held_out")).alias("row"), "text")
    return language.predict(rows, model).select("row.*", "lang_pred", "score")


@query
def op8_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op1_permutation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.assign(docs, sharding.fill(sharding.names())).select(
        "row.doc_id", "slot", "shard")


#: The rules of op3.
URL_RULES = (
    urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"), urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)


@query
def op3_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select("row.page_id", "host", "path", "rule", "verdict")


ORACLES["op3_url_trie"] = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rhost, rpath, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
         ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), hits AS (
  SELECT p.page_id, r.rhost || r.rpath AS rule, r.action,
         row_number() OVER (PARTITION BY p.page_id
                            ORDER BY length(r.rhost) DESC, length(r.rpath) DESC) AS n
  FROM parts p JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost))
                           AND starts_with(p.path, r.rpath)
)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.action, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON h.page_id = p.page_id AND h.n = 1
"""


@query
def op9_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("row.doc_id", "license", "n_shingles", "n_found",
                                      "containment")


def _license_oracle() -> str:
    """Exact containment of every template in every document."""
    rows = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in item))
                     for item in licenses.TEMPLATES.items())
    return f"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, r, unnest(list_distinct(list_transform(range(1, len(w) - 1),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS s FROM words
), templates(license, text) AS (VALUES {rows}
), tw AS (
  SELECT license, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM templates
), ts AS (
  SELECT license, unnest(list_distinct(list_transform(range(1, len(w) - 1),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS s FROM tw
), sized AS (SELECT license, count(*) AS n_shingles FROM ts GROUP BY license)
SELECT d.doc_id, t.license, z.n_shingles, count(*) AS n_found,
       count(*) / z.n_shingles AS containment
FROM shingles d JOIN ts t USING (s) JOIN sized z USING (license)
GROUP BY d.r, d.doc_id, t.license, z.n_shingles
HAVING count(*) >= 0.8 * z.n_shingles
"""


ORACLES["op9_license_windows"] = _license_oracle()


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periods.detect(docs.select(
        F.struct("doc_id").alias("row"),
        periods.repeated_tail(F.col("text"), F.col("doc_id")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


#: CRC-32 of the decimal text of an integer column, bit by bit: a byte is
#: exclusive-ored in, then eight steps (-1) follow.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(CAST({0} AS VARCHAR), ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END),
    4294967295)"""

#: Every pair of equal five-word windows at a lag that may be a period;
#: stretches of them are the runs (a run has at least five equal words a lag
#: apart). A lag's stretch that a smaller lag has too is not the smallest period.
ORACLES["op13_periodic_runs"] = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, {_CRC32.format("doc_id")} AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), g AS (
  SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d
), planted AS (
  SELECT doc_id, r, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n),
    lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
    ELSE w END AS w FROM g
), places AS (
  SELECT r, n, unnest(w) AS x, unnest(range(0, n)) AS i FROM planted
), windows AS (
  SELECT r, n, i, hash(x, lead(x, 1) OVER t, lead(x, 2) OVER t, lead(x, 3) OVER t,
                       lead(x, 4) OVER t) AS k FROM places WINDOW t AS (PARTITION BY r ORDER BY i)
  QUALIFY lead(x, 4) OVER t IS NOT NULL
), pairs AS (
  SELECT a.r, b.i - a.i AS q, a.i FROM windows a JOIN windows b
  ON a.r = b.r AND a.k = b.k AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
), stretches AS (
  SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM (
    SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS s FROM pairs)
  GROUP BY r, q, s HAVING count(*) + 4 + q >= greatest(6, 4 * q)
), runs AS (
  SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length
), by_doc AS (
  SELECT r, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t,
    arg_max({{'start': start, 'length': length, 'period': period}},
            (length::DOUBLE / period, -start, -period)) AS best
  FROM runs GROUP BY r
), gone AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM places ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start,
       CAST(best.length AS BIGINT) AS length, CAST(best.period AS BIGINT) AS period,
       CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(b.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM planted LEFT JOIN by_doc b USING (r) LEFT JOIN kept k USING (r)
"""


@query
def op12_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    apart = language.held_out(F.col("doc_id"))
    model = preference.learn(docs.filter(~apart),
                             table(spark, sf_dir, "labels").filter(~apart))
    rows = docs.select(F.struct("doc_id", apart.alias("held_out")).alias("row"), "text")
    return preference.rank(rows, model).select("row.*", "score", "predicted")


@query
def op11_phrase_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


#: All contiguous phrases of up to three words, counted; every cut scored.
ORACLES["op11_phrase_tries"] = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS t
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(t, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2),
         lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))) AS phrase
  FROM worded, range(1, {phrases.MAX_WORDS} + 1) AS lengths(m) WHERE len(w) >= m
), counted AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase
), totals AS (
  SELECT lang, sum(f) AS n FROM counted WHERE m = 1 GROUP BY lang
), often AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= {phrases.MIN_COUNT}
), cuts AS (
  SELECT lang, phrase, m, f AS a, w, unnest(range(1, m)) AS k FROM often WHERE m > 1
), scores AS (
  SELECT c.*, x.f AS l, y.f AS r,
         1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, phrase, max(a) AS within FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
    FROM scores WHERE m = 3) GROUP BY lang, phrase
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang
                                 ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank
  FROM scores s LEFT JOIN inside i USING (lang, phrase)
  WHERE within IS NULL OR 100 * within < {phrases.COVERED_PERCENT} * a
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= {phrases.TOP}
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
