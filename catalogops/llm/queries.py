"""Registered queries of the training-text operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import stages
from . import (
    alignment, bpe, cotrain, decontaminate, embeddings, fim, html, language, minhash, secrets, sharding, urls, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the vocabulary of the registered queries lies; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Forty shards of equal weight, and one more.
SHARDS = {s: 1.0 for s in range(40)}
GROWN = SHARDS | {40: 1.0}


@query("op1_rendezvous_shards")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    placed = sharding.assign(docs, "doc_id", SHARDS, GROWN)
    return sharding.number_slots(placed, "doc_id", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@query("op10_bpe_round_trip")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip_digests(read(spark, sf, "documents"), tokenizer_path())


@query("op9_style_tree_text")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op3_arc_to_warc")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    arcs, warcs = stages.new_path(spark, "arc"), stages.new_path(spark, "warc")
    warc.write_archives(warc.arc_archives(read(spark, sf, "pages")), arcs)
    warc.convert(spark, arcs, warcs)
    stages.discard(spark, arcs)
    return warc.warc_records(warc.read_archives(spark, warcs)).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


RULES = (
    urls.rule("net/", "block"), urls.rule("example.net/en/", "allow"),
    urls.rule("example.com/de/", "block"), urls.rule("org/fr/", "allow"),
)


#: The same in SQL: aliases are what the edges of canonical and refresh tags reach, in either direction.
OP4_SQL = r"""WITH RECURSIVE
  rules(host, path, rule, verdict) AS (VALUES ('net', '/', 'net/', 'block'),
    ('example.net', '/en/', 'example.net/en/', 'allow'), ('example.com', '/de/', 'example.com/de/', 'block'),
    ('org', '/fr/', 'org/fr/', 'allow')),
  tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag
    FROM pages WHERE url IS NOT NULL),
  targets AS (SELECT url, CASE
      WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')
        THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''>\s]+)', 1)
      WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b')
        THEN regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?[\d.\s]*[;,]?\s*url\s*=\s*["'']?([^"''>\s]+)', 1)
      ELSE '' END AS target FROM tags),
  links AS (SELECT url, CASE WHEN contains(target, '://') THEN target WHEN target LIKE '//%' THEN 'x:' || target
      WHEN target LIKE '/%' THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || target
      ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)
        || coalesce(nullif(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*/)', 1), ''), '/') || target END AS target
    FROM targets WHERE target <> '' AND contains(url, '://')),
  urls AS (SELECT url FROM pages UNION SELECT target FROM links),
  parts AS (SELECT url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*(\?[^#]*)', 1), '') AS query FROM urls),
  ruled AS (SELECT url, any_value(parts.host) AS host, any_value(parts.path) AS path,
      CASE WHEN any_value(parts.host) <> '' THEN any_value(parts.host)
        || CASE WHEN any_value(parts.path) = '' THEN '/' ELSE any_value(parts.path) END || any_value(query) END AS node,
      arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM parts LEFT JOIN rules ON (parts.host = rules.host OR ends_with(parts.host, '.' || rules.host))
      AND starts_with(parts.path, rules.path) GROUP BY url),
  edges AS (SELECT a.node AS a, b.node AS b FROM links JOIN ruled a ON a.url = links.url JOIN ruled b ON b.url = links.target
    WHERE a.node <> b.node),
  both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
  reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
  aliases AS (SELECT reach.a AS node, min(ruled.verdict) AS verdict FROM reach JOIN ruled ON ruled.node = reach.b GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(ruled.verdict, aliases.verdict, 'allow') AS verdict
FROM pages LEFT JOIN ruled ON ruled.url IS NOT DISTINCT FROM pages.url LEFT JOIN aliases ON aliases.node = ruled.node"""


@query("op4_redirect_equivalence", OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages")
    return urls.judge(pages.select("page_id", "url"), RULES, urls.alias_edges(pages)).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@query("op7_quantised_links")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.link(read(spark, sf, "embeddings"))


@query("op5_weighted_minhash")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    found = minhash.classes(read(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("kept"))


#: The same in SQL: seeds as lists of words, joined, then agreements on each diagonal.
OP8_SQL = r"""WITH
  items AS (SELECT DISTINCT item_id, regexp_split_to_array(lower(t), '[^\pL\pN]+') AS w FROM (SELECT item_id,
      regexp_replace(text, '^[^\pL\pN]+|[^\pL\pN]+$', '', 'g') AS t FROM benchmark) WHERE t <> ''),
  docs AS (SELECT doc_id, text, regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pN]+') AS w,
    regexp_split_to_array(lower(regexp_replace(text, '^[^\pL\pN]+|[^\pL\pN]+$', '', 'g')), '[^\pL\pN]+') AS own,
    CASE WHEN regexp_matches(text, '^[^\pL\pN]') THEN 1 ELSE 0 END AS first FROM documents),
  masks(span, kept, low, high) AS (VALUES (6, [1, 2, 4, 5, 6], 12, 1000000000), (8, [1, 2, 4, 7, 8], 12, 1000000000),
    (11, [1, 2, 8, 10, 11], 12, 1000000000), (10, [1, 2, 3, 9, 10], 12, 1000000000),
    (4, [1, 2, 3, 4], 8, 11), (5, [1, 2, 4, 5], 8, 11), (8, [1, 2, 7, 8], 8, 11),
    (5, range(1, 6), 5, 5), (6, range(1, 7), 6, 6), (7, range(1, 8), 7, 7)),
  item_seeds AS (SELECT item_id, w, span, low, p AS at, list_transform(kept, lambda k: w[p + k]) AS seed
    FROM items JOIN masks ON len(w) BETWEEN low AND high, unnest(range(0, len(w) - span + 1)) AS t(p)),
  used AS (SELECT DISTINCT span, low FROM item_seeds),
  doc_seeds AS (SELECT doc_id, text, span, low, p AS at, list_transform(kept, lambda k: w[p + k]) AS seed
    FROM docs JOIN (SELECT masks.* FROM masks JOIN used USING (span, low)) AS m ON len(w) >= span,
      unnest(range(0, len(w) - span + 1)) AS t(p)),
  hits AS (SELECT DISTINCT d.doc_id, d.text, i.item_id, i.w AS words, d.at - i.at AS start
    FROM doc_seeds d JOIN item_seeds i ON hash(d.seed) = hash(i.seed) AND d.seed = i.seed AND d.span = i.span AND d.low = i.low
    UNION SELECT doc_id, text, item_id, items.w, first FROM docs JOIN items ON len(items.w) < 5 AND own = items.w),
  agreed AS (SELECT hits.doc_id, item_id, start, least(len(words), 13) AS width,
      list_transform(range(0, len(words)), lambda k:
        CASE WHEN start + k >= 0 AND start + k < len(docs.w) AND docs.w[start + k + 1] = words[k + 1] THEN 1 ELSE 0 END) AS agree
    FROM hits JOIN docs ON hits.doc_id IS NOT DISTINCT FROM docs.doc_id AND hits.text = docs.text),
  judged AS (SELECT doc_id, item_id, start, list_sum(agree) AS n_agree, width,
      list_max(list_transform(range(0, len(agree) - width + 1), lambda s: list_sum(agree[s + 1:s + width]))) AS window_agree
    FROM agreed),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id
      ORDER BY window_agree DESC, n_agree DESC, start) AS place FROM judged
    WHERE window_agree >= CASE WHEN width < 8 THEN width ELSE ceil(width * 0.75) END)
SELECT doc_id, item_id, CAST(n_agree AS BIGINT) AS n_agree, CAST(window_agree AS BIGINT) AS window_agree,
  CAST(start AS BIGINT) AS start FROM ranked WHERE place = 1"""


@query("op8_spaced_seeds", OP8_SQL)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.overlaps(
        read(spark, sf, "documents").select("doc_id", "text"), read(spark, sf, "benchmark"), ["doc_id"]
    )


@query("op2_random_secrets")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(read(spark, sf, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


@query("op6_co_trained_quality")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return cotrain.classify(docs, read(spark, sf, "labels")).select(
        "doc_id", "p_content", "p_metadata", "p_quality", "keep"
    )


@query("op11_kneser_ney_language")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    docs = read(spark, sf, "documents").withColumn("held_out", F.coalesce(remainder == 2, F.lit(False)))
    models = language.fit(docs.where("NOT held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), models).select(
        "doc_id", "held_out", "lang_pred", "score", "accepted"
    )


#: The same in SQL, by string functions over code points.
OP12_SQL = r"""WITH
  drawn AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
  numbers AS (SELECT doc_id, t, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
    CAST('0x' || h[17:24] AS BIGINT) % 100 AS p, CAST('0x' || h[25:32] AS BIGINT) % 100 AS s FROM drawn),
  cut AS (SELECT doc_id, t, n, least(c1, c2) AS i, greatest(c1, c2) AS j, CASE
    WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p >= 90 THEN 'plain'
    WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
  parts AS (SELECT *, t[1:i] AS prefix, t[i + 1:j] AS middle, t[j + 1:] AS suffix FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(i AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(j - i AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM parts"""


@query("op12_fenwick_middle", OP12_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return fim.round_trip_digests(read(spark, sf, "documents"))


@query("op13_deduplicated_alignment")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    measures, _ = alignment.align(
        read(spark, sf, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
    )
    return measures
