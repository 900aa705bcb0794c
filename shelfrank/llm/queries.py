"""The registered queries of the operators and the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm.alignment import align_documents
from shelfrank.llm.bpe import encode_documents
from shelfrank.llm.collocations import collocations
from shelfrank.llm.common import table
from shelfrank.llm.curve_search import nearest_by_curves
from shelfrank.llm.decontamination import contaminated
from shelfrank.llm.jaccard_join import jaccard_join
from shelfrank.llm.language_model import score_documents
from shelfrank.llm.quality_votes import fit_votes, held_out, score_quality
from shelfrank.llm.registry import query
from shelfrank.llm.secret_scan import KINDS, count_of, find_secrets, span_text
from shelfrank.llm.sharding import balanced_shards
from shelfrank.llm.span_dedup import remove_repeated_spans
from shelfrank.llm.url_filter import Rule, filter_urls
from shelfrank.llm.warc import read_archives, write_archives

@query("op3_span_dedup")
def span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_spans(table(spark, sf_dir, "documents"))


@query("op4_nearest")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest_by_curves(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)
    return found.select(F.col("query_id").cast("long"), "rank", F.col("vec_id").cast("long"), "score")


@query("op5_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


WARC_SQL = """
WITH sized AS (SELECT page_id, coalesce(html, '') AS p, strlen(coalesce(html, '')) AS n FROM pages),
first AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY p) ELSE page_id END AS f FROM sized)
SELECT page_id, n AS payload_bytes, sha256(p) AS payload_digest,
  CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN f <> page_id THEN f END AS refers_to
FROM first
"""


@query("op6_warc", WARC_SQL)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(write_archives(table(spark, sf_dir, "pages"))).drop("url")


URL_RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
URL_SQL = r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
judged AS (
  SELECT parts.*, (SELECT max_by({'rule': rhost || rpath, 'verdict': verdict}, length(rhost || rpath)) FROM rules
    WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best
  FROM parts)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""


@query("op1_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit_votes(documents, table(spark, sf_dir, "labels"))
    scored = score_quality(documents, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


SECRET_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
patterns AS (SELECT
  '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS pa,
  'AKIA[A-Z0-9]+' AS pk, '[0-9a-f]{32,}' AS ph, '[A-Za-z0-9+/_-]{20,}' AS pc),
found AS (
  SELECT doc_id, t, 0 AS kind, string_split_regex(t, pa) AS gaps, regexp_extract_all(t, pa) AS hits, regexp_extract_all(t, pa, 2) AS cores
  FROM docs, patterns WHERE regexp_matches(t, pa)
  UNION ALL SELECT doc_id, t, 1, string_split_regex(t, pk), regexp_extract_all(t, pk), regexp_extract_all(t, pk) FROM docs, patterns WHERE regexp_matches(t, pk)
  UNION ALL SELECT doc_id, t, 2, string_split_regex(t, ph), regexp_extract_all(t, ph), regexp_extract_all(t, ph) FROM docs, patterns WHERE regexp_matches(t, ph)
  UNION ALL SELECT doc_id, t, 3, string_split_regex(t, pc), regexp_extract_all(t, pc), regexp_extract_all(t, pc) FROM docs, patterns WHERE regexp_matches(t, pc)),
placed AS (
  SELECT doc_id, kind, hits[i] AS hit, length(cores[i]) AS core,
    CAST(list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN hits[1:i - 1]]), 0) AS BIGINT) AS a
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found)),
spans AS (SELECT doc_id, kind, hit, a, a + length(hit) AS z FROM placed
  WHERE kind = 3 OR kind = 2 OR (kind = 1 AND core >= 16) OR (kind = 0 AND core >= 8)),
windows AS (
  SELECT doc_id, a, z, hit, substr(hit, CAST(j AS BIGINT), 20) AS w
  FROM (SELECT *, unnest(range(1, length(hit) - 18)) AS j FROM spans WHERE kind = 3
    AND NOT regexp_matches(hit, '^[A-Za-z+/_-]+$') AND NOT regexp_matches(hit, '^[0-9+/_-]+$')
    AND NOT regexp_matches(hit, '^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$')
    AND NOT regexp_matches(hit, '(?:[A-Za-z]{2,}[+/_-][0-9]{1,8}[+/_-]){2}')
    AND NOT regexp_matches(hit, '[Ee]xample|EXAMPLE|[Pp]laceholder|PLACEHOLDER|01234567|12345678|abcdefgh|ABCDEFGH|[xX]{6}'))),
weights AS (
  SELECT doc_id, a, z, w, list_sum([CAST(round(c * log2(c) * 1000000) AS BIGINT) FOR c IN
    [20 - length(replace(w, x, '')) FOR x IN list_distinct(string_split(w, ''))]]) AS s FROM windows),
random AS (
  SELECT DISTINCT doc_id, 3 AS kind, a, z FROM weights
  WHERE s <= floor(20 * (log2(20) - 3.75) * 1000000) OR (NOT regexp_matches(w, '[^0-9a-fA-F]') AND s <= floor(20 * (log2(20) - 3.0) * 1000000))),
base AS (SELECT doc_id, kind, a, z FROM spans WHERE kind < 3),
everything AS (
  SELECT * FROM base UNION ALL
  SELECT * FROM random r WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.a < r.z AND b.z > r.a)),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || a || ':' || z AS name FROM everything),
summed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    count(*) FILTER (kind = 3) AS n_entropy, coalesce(string_agg(name, ',' ORDER BY a, kind) FILTER (kind < 3), '') AS base,
    string_agg(name, ',' ORDER BY a, kind) AS spans FROM named GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN summed USING (doc_id)
"""


@query("op2_secret_scan", SECRET_SQL)
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind"] < KINDS.index("entropy"))
    return found.select(
        "doc_id",
        *[count_of(F.col("secrets"), kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"),
    )


@query("op7_url_filter", URL_SQL)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op8_jaccard")
def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).labelled("doc_id")


@query("op9_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = balanced_shards(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op10_bpe")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return encode_documents(table(spark, sf_dir, "documents"), path, ids=False, decoded=False)


PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, range(1, 6) AS s(size) WHERE len(w) >= size)),
sizes AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
freq AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM freq WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n,
    ((1000 * c.f::HUGEINT * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) c
  JOIN freq l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN freq r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN sizes z ON z.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT *, unnest(range(1, size - k + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS k FROM cand)) GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.f IS NULL OR 100 * i.f < 100 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::INTEGER AS rank, phrase, a, l, r, n::BIGINT AS n, score FROM ranked WHERE rank <= 2000
"""


@query("op11_collocations", PHRASE_SQL)
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query("op12_alignment")
def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, ranks = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
    aligned = align_documents(table(spark, sf_dir, "documents"), a, b, ranks_path=ranks, pattern=public_tokenizers.PATTERN)
    return aligned.withColumn("doc_id", F.col("doc_id").cast("long"))


@query("op13_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
