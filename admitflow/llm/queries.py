"""One query per corpus operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_jaccard_join

    return ngram_jaccard_join(_table(spark, sf_dir, "documents"))


def op2_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk_search import top_k_search

    return top_k_search(_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def url_rules() -> list:
    from .url_filter import Rule

    return [
        Rule("block", "com", "/en/"),
        Rule("allow", "example.com", "/en/7"),
        Rule("allow", "net", "/de/"),
        Rule("block", "example.net", "/de/8"),
        Rule("block", "org", "/es/"),
    ]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls

    return filter_urls(_table(spark, sf_dir, "pages"), url_rules())


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality, train_quality_model

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, train_quality_model(docs)).drop("text")


def op5_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_sequences

    return pack_sequences(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import hilbert_shards

    return hilbert_shards(_table(spark, sf_dir, "documents"))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find_contamination

    return find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def held_out():
    """Documents that language models don't learn from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify_language, train_language_models

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train_language_models(docs.where(~F.coalesce(held_out(), F.lit(False))))
    judged = identify_language(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_round_trip

    return archive_round_trip(_table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resample import importance_resample

    return importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import conversation_trie

    return conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_exact_topk_search,
        op3_url_filters,
        op4_quality_classifier,
        op5_cost_balanced_packing,
        op6_hilbert_sharding,
        op7_license_scans,
        op8_benchmark_decontamination,
        op9_language_id,
        op10_warc_revisits,
        op11_importance_resampling,
        op12_source_mixing,
        op13_conversation_trie,
    )
}

#: DuckDB has no CRC-32: its table of 256 by the shift rule, and the CRC of the bytes of ``words.w``.
_CRC32 = """
        t AS (
          SELECT list(c ORDER BY b) AS tab FROM (
            SELECT b, list_reduce(range(8), lambda a, k: xor(a >> 1, 3988292384 * (a & 1)), b) AS c FROM (SELECT unnest(range(256))::BIGINT AS b)
          ) AS bytes(b, c)
        ), crc AS (
          SELECT w, 4294967295 - list_reduce(range(strlen(w)), lambda a, k: xor(a >> 8, tab[1 + xor(a & 255, ('0x' || substr(x, (2 * k + 1)::INT, 2))::BIGINT)]), 4294967295::BIGINT) AS crc
          FROM (SELECT w, hex(encode(w)) AS x FROM words), t
        )"""

ORACLES: dict[str, str] = {
    "op11_importance_resampling": f"""
        WITH d AS (
          SELECT doc_id, row_number() OVER () AS n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
          FROM documents
        ), b AS (
          SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark
        ), f AS (
          SELECT n, w, count(*) AS c FROM (SELECT n, unnest(ws) AS w FROM d) GROUP BY n, w
        ), words AS (
          SELECT w FROM f UNION SELECT w FROM b
        ), {_CRC32.strip()}, s AS (
          SELECT crc % 10000 AS bucket, sum(c) AS s FROM f JOIN crc USING (w) GROUP BY 1
        ), tt AS (
          SELECT crc % 10000 AS bucket, count(*) AS t FROM b JOIN crc USING (w) GROUP BY 1
        ), g AS (
          SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM tt) + 10000)::DOUBLE)))::BIGINT AS gain
          FROM s LEFT JOIN tt USING (bucket)
        ), w AS (
          SELECT n, floor(sum(c * gain)::DOUBLE / sum(c)::DOUBLE)::BIGINT AS weight FROM f JOIN crc USING (w) JOIN g ON g.bucket = crc % 10000 GROUP BY n
        ), r AS (
          SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
          FROM d LEFT JOIN w USING (n)
        ), k AS (
          SELECT doc_id, n_features, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, (count(*) OVER () * 10) // 100 AS draw, n FROM (SELECT *, row_number() OVER () AS n FROM r WHERE n_features >= 20)
        )
        SELECT r.doc_id, r.n_features, r.weight, r.score, k.rank FROM r LEFT JOIN k ON k.doc_id = r.doc_id AND k.rank <= k.draw""",
    "op13_conversation_trie": f"""
        WITH own AS (
          SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
        ), words AS (
          SELECT DISTINCT conv_id::VARCHAR AS w FROM own
        ), {_CRC32.strip()}, c AS (
          SELECT w::BIGINT AS conv_id, crc % 6 AS h, w::BIGINT - w::BIGINT % 100 AS base FROM crc
        ), lead AS (
          SELECT c.conv_id, o.pos AS d, o.role, o.text FROM c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
        ), k AS (
          SELECT c.conv_id, c.h, count(lead.d) AS k FROM c LEFT JOIN lead USING (conv_id) GROUP BY ALL
        ), turns AS (
          SELECT * FROM lead UNION ALL SELECT conv_id, k + pos - h, role, text FROM own JOIN k USING (conv_id) WHERE pos > h
        ), seqs AS (
          SELECT c.conv_id, coalesce(list(md5(length(role) || ':' || role || ':' || text) ORDER BY d) FILTER (d IS NOT NULL), []) AS seq, coalesce(list(length(text) ORDER BY d) FILTER (d IS NOT NULL), []) AS chars
          FROM c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id
        ), p AS (
          SELECT conv_id, d::BIGINT AS d, array_to_string(seq[1:d], '') AS node, array_to_string(seq[1:d - 1], '') AS up, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars, len(seq) AS n
          FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM seqs)
        ), v AS (
          SELECT node, any_value(up) AS up, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, max(n) = any_value(d) AS leaf,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM p GROUP BY node
        ), s AS (
          SELECT p.node, count(*) FILTER (v.leaf) AS n_leaves, sum((v.n_convs - 1) * v.chars)::BIGINT AS saved_tokens FROM v JOIN p ON p.conv_id = v.conv_id AND p.d <= v.d GROUP BY p.node
        )
        SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, (SELECT count(*) FROM v x WHERE x.up = v.node AND x.d = v.d + 1) AS n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
        FROM v JOIN s USING (node) LEFT JOIN v u ON v.d > 0 AND u.node = v.up""",
    "op2_exact_topk_search": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
          FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op10_warc_revisits": """
        WITH p AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest, row_number() OVER () AS n FROM pages
        ), b AS (
          SELECT DISTINCT digest, from_hex(digest)::BIT::VARCHAR AS bits FROM p
        ), e AS (
          SELECT digest, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            (1 + list_sum(list_transform(range(5), lambda j: (substr(bits, (5 * i + j + 1)::INT, 1))::INT * (16 >> j::INT))))::INT, 1)), '') AS payload_digest FROM b
        ), r AS (
          SELECT *, first_value(page_id) OVER w AS original, row_number() OVER w AS place FROM p WINDOW w AS (PARTITION BY digest ORDER BY page_id DESC NULLS LAST, n)
        )
        SELECT page_id, payload_bytes, payload_digest, CASE place WHEN 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN original END AS refers_to
        FROM r JOIN e USING (digest)""",
    "op3_url_filters": """
        WITH u AS (
          SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), h AS (
          SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path FROM u
        ), r(verdict, rule_host, rule_path) AS (
          VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
        ), m AS (
          SELECT page_id, host, path, r.rule_host || r.rule_path AS rule, r.verdict,
            row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule_host || r.rule_path) DESC) AS n
          FROM h LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1""",
}
