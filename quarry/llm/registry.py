"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import (
    chat,
    decontaminate,
    lexical,
    licenses,
    linededup,
    merkle,
    mixing,
    neighbours,
    ngramjoin,
    quality,
    repeats,
    topk,
    warc,
)

QueryFn = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, _table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("matches")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = quality.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return drawn.select("doc_id", "importance", "noisy", "place")


def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounds of its SQL: one edit, lines of 20 characters or more."""
    done = linededup.dedup_lines(_table(spark, sf_dir, "documents"), max_edits=1, min_chars=20)
    return done.select("doc_id", "n_lines", "n_removed", "text")


def op7_line_dedup_tenth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pipeline's line stage does: one edit in ten characters, copies of lines of any length."""
    return linededup.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_repeat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(_table(spark, sf_dir, "documents"))


def op12_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    turns = chat.text_parts(table.unionByName(control))
    return chat.conversation_digests(chat.write_formatted(turns, spark))


QUERIES: dict[str, QueryFn] = {
    "op1_entropy_mix": op1_entropy_mix,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_license_scan": op3_license_scan,
    "op4_exact_topk": op4_exact_topk,
    "op5_importance_resample": op5_importance_resample,
    "op6_benchmark_leaks": op6_benchmark_leaks,
    "op7_line_dedup": op7_line_dedup,
    "op7_line_dedup_tenth": op7_line_dedup_tenth,
    "op8_ngram_join": op8_ngram_join,
    "op9_chat_format": op9_chat_format,
    "op10_repeat_cut": op10_repeat_cut,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_learned_partitions": op12_learned_partitions,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op2_warc_revisits": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
        r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) AS top FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM r""",
    "op4_exact_topk": """
        WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
              FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 10""",
    "op9_chat_format": """
        WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<|turn|>') + length(role) + length('<|text|>') + length('<|end|>') + length(text)
                   + len(regexp_extract_all(text, '\\\\|<\\||</?s>|</?SYS|<<SYS|<start_of|<end_of|\\[/?INST\\]'))) AS BIGINT)
                   AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op11_merkle_manifest": """
        WITH RECURSIVE f AS (
            SELECT row_number() OVER () AS r, doc_id, lang, text, source, CAST(n_chars AS VARCHAR) AS n,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
                   list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], flatten(list_transform(
                       string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda b: CAST(ascii(c) // (1 << b) % 2 AS UBIGINT))))),
                       lambda h, bit: xor(h // 2, CASE WHEN xor(h % 2, bit) = 1 THEN CAST(3988292384 AS UBIGINT) ELSE CAST(0 AS UBIGINT) END)) AS crc
            FROM documents),
        e AS (SELECT r, doc_id, lang, xor(crc, CAST(4294967295 AS UBIGINT)) % 3 = 0 AS hit,
                     list_transform([CAST(doc_id AS VARCHAR), source, lang, n], lambda x: coalesce(octet_length(encode(x)) || ':' || x, '-')) AS head,
                     coalesce(octet_length(encode(text)) || ':' || text, '-') AS own, coalesce(octet_length(encode(low)) || ':' || low, '-') AS other
              FROM f),
        leaves AS MATERIALIZED (SELECT r, doc_id, lang, sha256(array_to_string(head, '') || own) AS leaf,
                         CASE WHEN hit THEN sha256(array_to_string(head, '') || other) ELSE sha256(array_to_string(head, '') || own) END AS folded FROM e),
        placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
        tree AS (SELECT 0 AS level, lang, pos, n, leaf AS h FROM placed
                 UNION ALL
                 SELECT level + 1, lang, pos // 8, max(n) // 8 + CAST(max(n) % 8 > 0 AS INTEGER), sha256(string_agg(h, '' ORDER BY pos))
                 FROM tree WHERE n > 1 GROUP BY level, lang, pos // 8),
        subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
        crown AS (SELECT 0 AS level, pos, n, h FROM subroots
                  UNION ALL
                  SELECT level + 1, pos // 8, max(n) // 8 + CAST(max(n) % 8 > 0 AS INTEGER), sha256(string_agg(h, '' ORDER BY pos))
                  FROM crown WHERE n > 1 GROUP BY level, pos // 8),
        runs AS (SELECT level, lang, pos, n, list(h) OVER (PARTITION BY level, lang, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run FROM tree),
        crown_runs AS (SELECT level, pos, n, list(h) OVER (PARTITION BY level, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run FROM crown),
        steps AS (
            SELECT r, level, list_slice(run, 1, u.pos % 8) AS a, list_slice(run, u.pos % 8 + 2, 8) AS b
            FROM placed p JOIN runs u ON u.lang IS NOT DISTINCT FROM p.lang AND u.pos = p.pos // CAST(pow(8, u.level) AS BIGINT) WHERE u.n > 1
            UNION ALL
            SELECT r, 1000 + level, list_slice(run, 1, u.pos % 8), list_slice(run, u.pos % 8 + 2, 8)
            FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN crown_runs u ON u.pos = s.pos // CAST(pow(8, u.level) AS BIGINT) WHERE u.n > 1),
        proofs AS (SELECT r, list(array_to_string(a, '') || '|' || array_to_string(b, '') ORDER BY level) AS proof FROM steps GROUP BY r),
        final AS (SELECT p.*, coalesce(proof, []) AS proof FROM placed p LEFT JOIN proofs USING (r)),
        top AS (SELECT h AS root FROM crown WHERE n = 1),
        done AS (SELECT doc_id, leaf, s.h AS subroot, root, sha256(replace(array_to_string(proof, ''), '|', '')) AS proof_sha256,
                        list_reduce(list_concat([folded], proof), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root
                 FROM final p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang, top)
        SELECT *, folded_root = root AS verified FROM done""",
    "op13_lexical_search": """
        WITH t AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        d AS (SELECT r, doc_id, len(w) AS n FROM t WHERE len(w) > 0),
        s AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
        q AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
        p AS MATERIALIZED (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(w) AS w FROM t) WHERE w IN (SELECT w FROM q) GROUP BY ALL),
        f AS (SELECT w, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY w),
        z AS (SELECT item_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
              FROM q JOIN p USING (w) JOIN f USING (w) JOIN d USING (r), s GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
        FROM z JOIN d USING (r) WHERE score > 0 QUALIFY rank <= 10""",
    "op7_line_dedup": """
        WITH parts AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
        o AS (SELECT doc_id AS doc, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM parts),
        d AS (SELECT line, length(line) AS n, min({'doc': doc, 'place': place}) AS first FROM o WHERE length(line) >= 20 GROUP BY line),
        c AS (SELECT a.line AS x, b.line AS y FROM d a JOIN d b ON a.n = b.n AND a.line[:a.n // 2] = b.line[:b.n // 2]
              UNION SELECT a.line, b.line FROM d a JOIN d b ON a.n = b.n AND a.line[a.n // 2 + 1:] = b.line[b.n // 2 + 1:]
              UNION SELECT a.line, b.line FROM d a JOIN d b ON a.n = b.n - 1 AND a.line[:a.n // 2] = b.line[:(b.n - 1) // 2]
              UNION SELECT a.line, b.line FROM d a JOIN d b ON a.n = b.n - 1 AND a.line[a.n // 2 + 1:] = b.line[(b.n - 1) // 2 + 2:]),
        near AS (SELECT x, y FROM c WHERE x <> y AND levenshtein(x, y) <= 1),
        gone AS (SELECT DISTINCT CASE WHEN a.first < b.first THEN b.line ELSE a.line END AS line
                 FROM near JOIN d a ON a.line = x JOIN d b ON b.line = y),
        marked AS (SELECT o.*, d.line IS NOT NULL AND (g.line IS NOT NULL OR d.first <> {'doc': doc, 'place': place}) AS cut
                   FROM o LEFT JOIN d USING (line) LEFT JOIN gone g USING (line)),
        kept AS (SELECT doc, count(*) AS n_lines, CAST(count(*) FILTER (WHERE cut) AS BIGINT) AS n_removed,
                        coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT cut), '') AS text
                 FROM marked GROUP BY doc)
        SELECT p.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
               CASE WHEN p.text IS NOT NULL THEN kept.text END AS text
        FROM parts p LEFT JOIN kept ON p.doc_id = kept.doc""",
    "op8_ngram_join": """
        WITH RECURSIVE t AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
                  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM t),
        z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM c JOIN z p ON p.doc_id = x JOIN z q ON q.doc_id = y WHERE c.n >= 0.8 * (p.n + q.n - c.n) - 1e-9),
        r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
        k AS (SELECT doc_id, least(doc_id, coalesce(min(y), doc_id)) AS class_id FROM documents LEFT JOIN r ON x = doc_id GROUP BY doc_id)
        SELECT k.doc_id, class_id, (SELECT count(*) FROM l WHERE l.x = k.doc_id) AS n_links,
               count(*) OVER (PARTITION BY class_id) AS class_size
        FROM k""",
}
