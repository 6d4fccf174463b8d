"""Named queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilmart.llm import alignment, bitsliced, bpe, cells, intervals, mincut, mixing, oddsketch, parsing, secretscan, toxicity, urls, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The URL rules as host, path and verdict.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.against_next(_table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), mixing.word_count(F.col("text")))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of an archive, checked against a replica with known damage.

    In the replica each 101st record has lost its last byte and each 211th is missing.
    """
    body = warc.record(F.col("url"), F.col("html"))
    lost = F.when(F.col("page_id") % 101 == 0, 1).otherwise(0)
    copy = F.substring(body, F.lit(1), F.octet_length(body) - lost)
    pages = _table(spark, sf_dir, "pages").select(
        "page_id", "url", "html", F.octet_length(copy).alias("copy_length"), F.sha2(copy, 256).alias("copy_hash")
    )
    archive = warc.archived(pages, keep=("copy_length", "copy_hash"))
    primary = archive.select("page_id", "file", "offset", "length", "hash")
    replica = archive.where("page_id % 211 <> 0").select(
        "file", "offset", F.col("copy_length").alias("length"), F.col("copy_hash").alias("hash")
    )
    found = warc.audit(primary, replica, data=None).select(
        "file", F.col("start").alias("offset"), "replica_length", "replica_hash", "status"
    )
    return primary.join(found, ["file", "offset"], "left").select(
        "page_id", "file", "offset", "hash", "replica_length", "replica_hash", F.coalesce("status", F.lit("ok")).alias("status")
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.coded(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digested(found).drop("ids")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut.extracted(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["place"] < len(secretscan.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in secretscan.BASE],
        F.sha2(secretscan.listed(base), 256).alias("base_sha256"),
        secretscan.listed(F.col("spans")).alias("spans"),
    )


def op11_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.without_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, model = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.aligned_documents(_table(spark, sf_dir, "documents"), ranks, model)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_url_filters": op4_url_filters,
    "op5_mixing": op5_mixing,
    "op6_warc_fixity": op6_warc_fixity,
    "op7_bpe": op7_bpe,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_secret_scans": op10_secret_scans,
    "op11_repeat_removal": op11_repeat_removal,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_ranked_search": op13_ranked_search,
    "pipeline": corpus_pipeline.run,
}

_WORDS = r"[^\x20\x09-\x0D]+"


def _secret_sql() -> str:
    """Positions from the gaps that a split leaves and the lengths of the matches."""
    kinds = []
    for place, rule in enumerate(secretscan.RULES):
        regex = rule.regex.replace("'", "''")
        kinds.append(
            f"SELECT row_id, {place} AS place, '{rule.kind}' AS kind,"
            f" string_split_regex(body, '{regex}') AS gaps,"
            f" regexp_extract_all(body, '{regex}', 0) AS hits,"
            f" regexp_extract_all(body, '{regex}', {rule.group}) AS found, {rule.least} AS least FROM d"
        )
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS body FROM documents),
    parts AS ({" UNION ALL ".join(kinds)}),
    hits AS (SELECT row_id, place, kind, least, hits, gaps, found, unnest(range(1, len(hits) + 1)) AS i FROM parts),
    spans AS (
        SELECT row_id, place, kind,
            list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS first,
            list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(hits[1:i], lambda x: length(x))) AS last
        FROM hits WHERE length(found[i]) >= least),
    texts AS (
        SELECT row_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
            count(*) FILTER (place = 2) AS n_hex,
            string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, place) FILTER (place < 3) AS base,
            string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, place) AS spans
        FROM spans GROUP BY row_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
        coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN texts USING (row_id)
    """


ORACLES: dict[str, str] = {
    "op4_url_filters": r"""
    WITH cut AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    split AS (
        SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw, coalesce(rest, '') AS rest FROM cut),
    parts AS (
        SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
        FROM split),
    rules(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
    SELECT page_id, host, path,
        (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
        coalesce((SELECT arg_max(verdict, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
    FROM parts
    """,
    "op5_mixing": rf"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS size,
            CAST(ceil(sqrt(count(*) OVER ())) AS BIGINT) AS buckets
        FROM documents),
    sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
            [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
        FROM d GROUP BY source),
    levels AS (
        SELECT *, 2 * source_size / weight AS full_at,
            (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER rising, 0))::DOUBLE
                / sum(weight) OVER falling AS level
        FROM sources
        WINDOW rising AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            falling AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    goals AS (
        SELECT source, source_size,
            least(2.0::DOUBLE * source_size, weight * (SELECT arg_min(level, full_at) FROM levels WHERE level <= full_at)) AS target,
            ('0x' || substr(md5('mix' || coalesce(source, '')), 1, 4))::INTEGER / 65536::DOUBLE AS start
        FROM levels),
    ranked AS (
        SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY size,
            ((coalesce(doc_id, 0) % buckets) + buckets) % buckets, doc_id NULLS FIRST) AS place
        FROM d)
    SELECT doc_id, size, source_size, target,
        size * least(2, CAST(floor(start + CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END * place)
            - floor(start + CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END * (place - 1)) AS BIGINT)) AS taken
    FROM ranked JOIN goals ON ranked.source IS NOT DISTINCT FROM goals.source
    """,
    "op6_warc_fixity": """
    WITH records AS (
        SELECT page_id, page_id // 1024 AS file,
            'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: '
            || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
            || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
            || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
        FROM pages),
    placed AS (
        SELECT page_id, file, record, CAST(coalesce(sum(strlen(record)) OVER (
            PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
        FROM records)
    SELECT page_id, file, "offset", sha256(record) AS hash,
        CASE WHEN page_id % 211 <> 0 AND page_id % 101 = 0 THEN CAST(strlen(record) - 1 AS BIGINT) END AS replica_length,
        CASE WHEN page_id % 211 <> 0 AND page_id % 101 = 0 THEN sha256(left(record, length(record) - 1)) END AS replica_hash,
        CASE WHEN page_id % 211 = 0 THEN 'missing' WHEN page_id % 101 = 0 THEN 'changed' ELSE 'ok' END AS status
    FROM placed
    """,
    "op10_secret_scans": _secret_sql(),
    "op11_repeat_removal": """
    WITH d AS (
        SELECT row_number() OVER () AS row_id, doc_id, hex(encode(coalesce(text, ''))) AS body, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes
        FROM documents),
    windows AS (
        SELECT row_id, first, md5(substr(body, 2 * first + 1, 800)) AS window_md5
        FROM (SELECT row_id, body, unnest(range(0, n_bytes - 399)) AS first FROM d WHERE n_bytes >= 400)),
    repeated AS (SELECT row_id, first FROM windows QUALIFY count(*) OVER (PARTITION BY window_md5) > 1),
    marked AS (
        SELECT row_id, first, CAST(first > lag(first, 1, -1000) OVER (PARTITION BY row_id ORDER BY first) + 400 AS INTEGER) AS opens
        FROM repeated),
    numbered AS (SELECT row_id, first, sum(opens) OVER (PARTITION BY row_id ORDER BY first) AS span FROM marked),
    spans AS (SELECT row_id, span, min(first) AS first, max(first) + 400 AS last FROM numbered GROUP BY row_id, span),
    gaps AS (SELECT row_id, first, last, lag(last, 1, 0) OVER (PARTITION BY row_id ORDER BY first) AS before FROM spans),
    cut AS (
        SELECT row_id, CAST(sum(last - first) AS BIGINT) AS n_removed, count(*) AS n_spans,
            string_agg(substr(body, 2 * before + 1, 2 * (first - before)), '' ORDER BY first) || substr(any_value(body), 2 * max(last) + 1) AS kept
        FROM gaps JOIN d USING (row_id) GROUP BY row_id)
    SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, body))) AS kept_sha256
    FROM d LEFT JOIN cut USING (row_id)
    """,
    "op13_ranked_search": r"""
    WITH found AS (
        SELECT doc_id, row_number() OVER () AS row_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
        FROM documents),
    sizes AS (SELECT row_id, doc_id, CAST(len(words) AS BIGINT) AS n FROM found WHERE len(words) > 0),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
    counted AS (
        SELECT row_id, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS tf
        FROM (SELECT row_id, unnest(words) AS word FROM found) GROUP BY ALL),
    asked AS (
        SELECT item_id, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS repeats
        FROM (SELECT item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word
              FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM counted, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
    scores AS (
        SELECT item_id, doc_id,
            CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
        FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (row_id), totals
        GROUP BY item_id, row_id, doc_id),
    placed AS (
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
        FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
    """,
}
