"""One query per operator over the given tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tanisight.llm import bpe, exact, infill, jaccardjoin, language, licenses, neardup, packing, quality, resampling, substrings, tokenfiles, toxicity
from tanisight.session import ship_package

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held(rest: Column, value: int) -> Column:
    """Whether the row belongs to the fold that nothing is learned from."""
    return F.coalesce(rest == value, F.lit(False))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held(toxicity.fold(F.col("doc_id")), 1)
    machine = toxicity.train(spark, docs, table(spark, sf_dir, "labels"), ~out)
    return toxicity.score(spark, docs, machine).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), BYTE_BPE)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link_copies(spark, table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.saved(spark, table(spark, sf_dir, "documents"), WORD_BPE)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths come from the table: source, then ranges of doc_id; short documents stand for licence files."""
    docs = table(spark, sf_dir, "documents")
    name = F.when(F.char_length("text") <= 400, F.lit("LICENSE-")).otherwise(F.lit("text-"))
    path = F.concat_ws("/", "source", F.expr("doc_id div 10000"), F.expr("doc_id div 100"), F.concat(name, F.col("doc_id")))
    return licenses.scan(spark, docs.select("doc_id", path.alias("path"), "text"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held(language.fold(F.col("doc_id"), 4), 2)
    trees = language.train(spark, docs, ~out)
    return language.identify(spark, docs, trees).select("doc_id", out.alias("held_out"), "lang_pred", "score", "bits")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean(table(spark, sf_dir, "documents")).drop("text_clean")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(spark, table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(spark, table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.transform(table(spark, sf_dir, "documents"), seed=42, rate=50, spm_rate=80)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.draw(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccardjoin.join_documents(spark, table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_sum_of_squares_packing": op1,
    "op2_factorization_toxicity": op2,
    "op3_prefix_bpe": op3,
    "op4_minmax_near_dedup": op4,
    "op5_arrow_token_files": op5,
    "op6_license_scan": op6,
    "op7_ppm_language": op7,
    "op8_line_first_quality": op8,
    "op9_suffix_tree_dedup": op9,
    "op10_extendible_hash_dedup": op10,
    "op11_repeated_capture_infill": op11,
    "op12_bracketed_resampling": op12,
    "op13_multi_match_jaccard_join": op13,
    "pipeline": pipeline,
}

#: Texts that SQL can state whole. The other operators are tested against brute force, the library or held-out rows.
SQL = {
    "op11_repeated_capture_infill": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS x,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), h AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4
  FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
""",
    "op10_extendible_hash_dedup": """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n
  FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(n) AS text_sha256
FROM t WINDOW w AS (PARTITION BY n)
""",
    "op9_suffix_tree_dedup": r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM p
), f AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first_doc FROM g
), r AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM f WHERE first_doc < doc_id
), l AS (
  SELECT doc_id, list(k) AS ks FROM r GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ks IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(ks, x[2])), lambda x: x[1]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN l USING (doc_id)
""",
}
