"""The registered queries of the dealt operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitfit.llm import (
    embedding, fim, html_text, langid, licenses, packing, pieces, secrets, toxicity, whitening,
)
from orbitfit.llm.base import fold, table
from orbitfit.llm.exact_dedup import exact_dedup
from orbitfit.llm.mixing import mix
from orbitfit.llm.simhash import near_dedup


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), check=True)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                      keep=lambda k: fold(k, 5) != 0)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"), keep=("url",))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~held_out), F.col("doc_id"), "text", "lang")
    return (docs.select("doc_id", held_out.alias("held_out"), langid.identify(docs, model).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score", "p.ambiguous"))


def op9_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_dedup(table(spark, sf_dir, "embeddings"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "loss_tokens")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = rows.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained",
                       "identity_error", "residual")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units,
         [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) for k in [0, 1, 2, 3]] AS r FROM d),
c AS (
  SELECT *, len(units) AS n, least(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS a,
         greatest(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS b FROM u),
p AS (
  SELECT doc_id, t, n, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90
              THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_toxicity": op2_toxicity,
        "op3_mixing": op3_mixing,
        "op4_licenses": op4_licenses,
        "op5_simhash": op5_simhash,
        "op6_html": op6_html,
        "op7_secrets": op7_secrets,
        "op8_language": op8_language,
        "op9_embedding": op9_embedding,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_fim": op11_fim,
        "op12_packing": op12_packing,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_exact_dedup": OP10_SQL, "op11_fim": OP11_SQL}
