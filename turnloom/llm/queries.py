"""The registered queries of the corpus operators, over whole tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    license_scan,
    lm_score,
    periodic_runs,
    personal_data,
    quality,
    shingle_join,
    simhash_dedup,
    token_files,
    vector_codes,
)
from .common import scratch_folder, table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks: one row per document and benchmark item that it repeats."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.leaks(docs, items).withColumnRenamed("id", "doc_id")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lm_score.language_model_scores(table(spark, sf_dir, "documents"))
    return rows.withColumnRenamed("id", "doc_id")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip_digests(docs, vocabulary("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/tokens-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    token_files.write_shards(docs, path, vocabulary("word_bpe_49k.json"), end_id=2)
    return token_files.read_documents(spark, path).withColumnRenamed("id", "doc_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return rows.drop("row").withColumnRenamed("id", "doc_id")


ESCAPED_TEXT = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # Derived from the table's schema; one conversation made of control strings.
    extra = spark.createDataFrame(
        [(-7, 0, "user", ESCAPED_TEXT), (-7, 1, "assistant", ESCAPED_TEXT)], given.schema
    )
    path = f"{scratch_folder(spark)}/chats-{uuid.uuid4().hex}"
    chat_format.windows(given.unionByName(extra)).write.parquet(path)
    rows = chat_format.read_back(spark.read.parquet(path))
    return rows.select(
        F.col("conv").alias("conv_id"),
        "n_turns",
        F.sha2("turns_text", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and license notice that it holds."""
    docs = table(spark, sf_dir, "documents")
    return license_scan.license_matches(docs, license_scan.templates(spark)).withColumnRenamed("id", "doc_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.quality_scores(docs, labels).withColumnRenamed("id", "doc_id")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_dedup.simhash_components(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans."""
    rows = personal_data.personal_data(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        F.col("id").alias("doc_id"),
        *[count(i).alias(f"n_{name}") for i, name in enumerate(personal_data.KINDS)],
        F.sha2(personal_data.span_text(F.col("base")), 256).alias("base_sha256"),
        personal_data.span_text(F.col("spans")).alias("spans"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    digits = F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0"))
    return vector_codes.with_label_errors(codes).select(
        F.col("id").alias("vec_id"),
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.codebooks_digest(books)).alias("codebooks_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), with_repeats=True)
    listed = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    best = F.col("strongest")
    return rows.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shingle_join.similar_components(table(spark, sf_dir, "documents"))
    return rows.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_lm_score": op2_lm_score,
    "op3_bpe": op3_bpe,
    "op4_token_files": op4_token_files,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_license_scan": op7_license_scan,
    "op8_quality": op8_quality,
    "pipeline": pipeline,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_personal_data": op10_personal_data,
    "op11_vector_codes": op11_vector_codes,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_shingle_join": op13_shingle_join,
}

def _vector_codes_sql(rounds: int = 4, entries: int = 256) -> str:
    """All distances in every round, one pair of tables a round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (
            SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
            FROM (SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(range(1, len(p.v) + 1),
                         lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))::BIGINT AS d
                  FROM parts p JOIN b{r} b ON p.part = b.part)
            GROUP BY vec_id, part)""")
        if r < rounds:
            steps.append(f"""
        b{r + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
            FROM b{r} b LEFT JOIN (
                SELECT part, entry, list(mean ORDER BY place) AS v
                FROM (SELECT p.part, a.entry, u.place, floor(sum(p.v[u.place])::DOUBLE / count(*))::BIGINT AS mean
                      FROM parts p JOIN a{r} a USING (vec_id, part), unnest(range(1, len(p.v) + 1)) u(place)
                      GROUP BY ALL)
                GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry)""")
    return f"""
        WITH kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
        ), parts AS MATERIALIZED (
            SELECT vec_id, q.part, v[1 + q.part * (len(v) // 4) : (q.part + 1) * (len(v) // 4)] AS v
            FROM kept, range(4) q(part)
        ), b0 AS MATERIALIZED (
            SELECT p.part, f.entry, p.v
            FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
                  ORDER BY vec_id LIMIT {entries}) f JOIN parts p USING (vec_id)
        ), {",".join(steps)}, coded AS (
            SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
            FROM a{rounds} GROUP BY vec_id
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{rounds})
                   AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)"""


ORACLES: dict[str, str] = {
    "op11_vector_codes": _vector_codes_sql(),
    "op13_shingle_join": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'),
                       lambda w: w <> '') AS words
            FROM documents
        ), shingles AS MATERIALIZED (
            SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS s
            FROM worded, unnest(range(1, greatest(len(words) - 4, 1) + 1)) t(i) WHERE len(words) > 0
        ), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), links AS MATERIALIZED (
            SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
                              FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
            JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
            WHERE 100 * common >= 80 * (sa.n + sb.n - common)
        ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        )
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
        FROM (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) LEFT JOIN sizes USING (doc_id)""",
    "op5_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op6_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(i)
        ), sized AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place,
                   len(list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) + 4 AS tokens,
                   length(regexp_replace(role, '([<\[])(\\*)(\||/?s>|</?SYS>|/?INST\])', '\1\\\2\3', 'g'))
                   + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|</?SYS>|/?INST\])', '\1\\\2\3', 'g'))
                   + 12 + 1 + 11 AS chars
            FROM turns
        ), summed AS (
            SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY place
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM sized
        ), placed AS (
            SELECT *, 2 * (before // 512) + ((before + tokens - 1) // 512 > before // 512)::INT AS win FROM summed
        ), openings AS (
            SELECT conv_id, win, min(place) AS place, min(before) AS reach FROM placed GROUP BY ALL
        ), formed AS (
            SELECT conv_id, sum(chars) AS chars FROM (
                SELECT conv_id, chars FROM placed
                UNION ALL
                SELECT p.conv_id, p.chars FROM placed p JOIN openings o USING (conv_id)
                WHERE p.place = 0 AND p.role = 'system' AND o.place > 0
                UNION ALL
                SELECT p.conv_id, p.chars FROM placed p JOIN openings o
                  ON p.conv_id = o.conv_id AND p.place BETWEEN o.place - 2 AND o.place - 1
                WHERE o.reach - p.before <= 256 AND (p.place > 0 OR p.role <> 'system')
            ) GROUP BY conv_id
        ), texts AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS whole,
                   coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '') AS loss
            FROM placed GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars,
               sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
        FROM texts JOIN formed USING (conv_id)""",
}
