"""One query per operator over its whole table, and the SQL of those that SQL can express."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import (
    alignment, bktree, ctw, licenses, mixing, negatives, ngram_join, pages as web, pieces, quality, simhash, suffixes, urls,
)
from tidepanel.llm.words import documents, embeddings, pages

YEAR = 365


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).drop("spans")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir)).drop("_host", "_text")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched on a day that follows from the page's id; every seventh page reports its
    host, or the domain above, to the list."""
    rows = pages(spark, sf_dir).select("page_id", "url")
    captures = rows.withColumn("day", (F.col("page_id") * 53) % YEAR)
    name = F.split(urls.host(F.col("url")), r"\.")
    above = F.when((F.col("page_id") % 2 == 0) | (F.size(name) < 3), F.concat_ws(".", name)).otherwise(
        F.concat_ws(".", F.slice(name, 2, F.greatest(F.size(name) - 1, F.lit(0))))
    )
    entries = rows.filter(F.col("page_id") % 7 == 0).select(
        above.alias("domain"),
        ((F.col("page_id") * 37) % YEAR).alias("day"),
        F.when(F.col("page_id") % 3 == 0, "block").otherwise("allow").alias("action"),
    )
    return urls.judged(captures, entries)


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scored(documents(spark, sf_dir))


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.extracted(pages(spark, sf_dir))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), digests=True)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(documents(spark, sf_dir)).drop("n_links")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(documents(spark, sf_dir)).drop("span_starts", "span_ends")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.searched(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows get the next label, so that near rows of another label exist."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = embeddings(spark, sf_dir).withColumn("label", moved)
    return negatives.mined(rows, anchors=F.col("vec_id") % 50 == 0)


def op12_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bktree.linked(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.counted(documents(spark, sf_dir), *files)


QUERIES = {
    "op1_license_scans": op1_license_scans,
    "op2_source_mix": op2_source_mix,
    "op3_quality_rules": op3_quality_rules,
    "op4_url_filter": op4_url_filter,
    "op5_context_tree": op5_context_tree,
    "op6_page_text": op6_page_text,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_ngram_join": op8_ngram_join,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_simhash": op10_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_bk_trees": op12_bk_trees,
    "op13_token_alignment": op13_token_alignment,
}

_WORD = r"[^\x20\x09-\x0D]+"

_TEMPLATES = ", ".join(
    f"({n}, {base}, '{label}', {at}, {pairs}, {musts}, {must}, '{gram}')"
    for n, base, label, at, pairs, musts, must, gram in licenses.template_rows(licenses.BASE, licenses.MORE)
)

SQL = {
    "op1_license_scans": rf"""
WITH t(template, base, label, place, pairs, musts, must, gram) AS (VALUES {_TEMPLATES}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (SELECT r, unnest(ws) AS w, unnest(list_append(ws[2:], NULL)) AS v, generate_subscripts(ws, 1) - 1 AS p FROM d),
h AS (SELECT g.r, t.*, g.p - t.place AS start FROM g JOIN t ON g.w || ' ' || g.v = t.gram),
votes AS (
  SELECT r, template, base, label, pairs, musts, start, list(DISTINCT place) AS places,
         coalesce(list(DISTINCT place) FILTER (must), []) AS must, count(DISTINCT place) = pairs AS exact
  FROM h GROUP BY r, template, base, label, pairs, musts, start),
marked AS (
  SELECT *, CASE WHEN base OR exact OR lag(exact) OVER o OR lag(start) OVER o IS NULL
            OR start - lag(start) OVER o > {licenses.NEIGHBOURS} THEN 1 ELSE 0 END AS fresh
  FROM votes WINDOW o AS (PARTITION BY r, template ORDER BY start)),
banded AS (SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY start ROWS UNBOUNDED PRECEDING) AS band FROM marked),
bands AS (
  SELECT r, template, base, label, band, min(start) AS first, bool_or(exact) AS exact,
         len(list_distinct(flatten(list(places)))) / pairs AS cover,
         len(list_distinct(flatten(list(must)))) = musts AS decided
  FROM banded GROUP BY r, template, base, label, pairs, musts, band),
good AS (SELECT *, CASE WHEN base THEN exact ELSE decided AND cover >= {licenses.COVER}::DOUBLE END AS good FROM bands),
found AS (
  SELECT r, count(*) FILTER (good AND base) AS n_base, min(first) FILTER (good AND base) AS first_word,
         max(first) FILTER (good AND base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (good AND base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (good) AS labels, max(cover) AS score
  FROM good GROUP BY r)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN found USING (r)""",
    "op2_source_mix": rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (
  SELECT source, sum(size) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w
  FROM d GROUP BY source),
filled AS (
  SELECT *, sum(2 * source_size) OVER o AS full_, sum(w) OVER o AS w_, sum(w) OVER () AS all_w,
         1.5 * sum(source_size) OVER () AS total
  FROM s WINDOW o AS (ORDER BY 2 * source_size / w, source ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT greatest(max((total - full_) / nullif(all_w - w_, 0)), max(total / all_w)) AS lev FROM filled),
t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         least(2.0 * source_size, w * lev)::DOUBLE AS target FROM filled, level),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         floor(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END) AS times,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((times + CASE WHEN 2 * before + size < 2 * (target - times * source_size) THEN 1 ELSE 0 END) * size
            AS BIGINT) AS taken
FROM r""",
    "op3_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce('=' || source, '') AS host
  FROM documents),
w AS (SELECT r, doc_id, t, host, regexp_extract_all(t, '{_WORD}') AS ws, string_split(t, chr(10)) AS ls FROM d),
u AS (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
g AS (SELECT r, p, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM u WINDOW o AS (PARTITION BY r ORDER BY p)),
twice AS (SELECT r, p FROM g WHERE z IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, x, y, z) > 1),
covered AS (
  SELECT r, count(DISTINCT p + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
l AS (SELECT r, t, host, unnest(ls) AS line FROM w),
lw AS (SELECT r, t, host, line, regexp_extract_all(line, '{_WORD}') AS x FROM l),
ln AS (SELECT r, t, host, line, lower(array_to_string(x, ' ')) AS norm, len(x) AS n FROM lw WHERE len(x) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY r),
texts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
often AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT t) AS c FROM ln GROUP BY host, norm)
  JOIN texts USING (host) WHERE c > 10 AND c * c > n),
gone AS (SELECT r, sum(n) AS n FROM ln JOIN often USING (host, norm) GROUP BY r),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS gone
  FROM w LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - gone >= 0.3::DOUBLE * n_words AS kept,
       CAST(n_words - gone AS BIGINT) AS n_words_left
FROM m""",
    "op4_url_filter": r"""
WITH c AS (
  SELECT page_id, url, (page_id * 53) % 365 AS day,
         lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host
  FROM pages),
p AS (SELECT *, string_split(host, '.') AS parts FROM c),
e AS (
  SELECT CASE WHEN page_id % 2 = 0 OR len(parts) < 3 THEN host ELSE array_to_string(parts[2:], '.') END AS domain,
         (page_id * 37) % 365 AS since, max(page_id % 3 = 0) AS blocks
  FROM p WHERE page_id % 7 = 0 GROUP BY 1, 2),
i AS (SELECT *, lead(since, 1, 2147483647) OVER (PARTITION BY domain ORDER BY since) AS until FROM e),
a AS (
  SELECT page_id, day, unnest(list_transform(range(1, greatest(len(parts), 2)), lambda k: array_to_string(parts[k:], '.')))
         AS domain
  FROM p WHERE host <> ''),
f AS (
  SELECT a.page_id, a.domain, i.since, i.blocks FROM a JOIN i ON a.domain = i.domain AND i.since <= a.day
   AND a.day < i.until
  QUALIFY row_number() OVER (PARTITION BY a.page_id ORDER BY length(a.domain) DESC) = 1)
SELECT p.page_id, p.url, p.day, coalesce(f.blocks, false) AS blocked, f.domain AS entry_domain,
       CAST(f.since AS BIGINT) AS entry_since
FROM p LEFT JOIN f ON p.page_id = f.page_id""",
    "op8_ngram_join": rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '{_WORD}') AS ws FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(ws[i:i + 3], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS (
  SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r
  JOIN n x ON x.r = a.r JOIN n y ON y.r = b.r
  GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach(r, c) AS (SELECT r, r FROM d UNION SELECT l.a, reach.c FROM reach JOIN l ON l.b = reach.r)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(e.doc_id) AS component_id
FROM d JOIN reach ON reach.r = d.r JOIN d e ON e.r = reach.c LEFT JOIN n ON n.r = d.r GROUP BY d.r, d.doc_id""",
    "op11_hard_negatives": r"""
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 50 = 0),
p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score
   AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3""",
}
