"""Exact dedup as a tree-merge of sorted digest runs (DataFrame functions only).

Every scan partition writes one run: a row per document with the SHA-256 of
its normalised text, sorted by digest. Runs then merge in rounds: ``fan_in``
neighbouring runs become one, equal digests meet and the smallest identifier
and the number of rows are kept. Each round combines inside the map tasks
before it exchanges rows, so a text that a third of all rows share leaves a
map task as one row. A digest class counts as equal only if the second hash
and the byte length of its texts are equal as well; they are part of the key
at every level. The last round leaves one row per distinct text, which the
runs are joined to.

Cases: null text counts as empty; a null identifier is larger than any other
(it stays only when its whole group has none); of repeated rows (same
identifier, same text) one stays; an empty table gives an empty result;
other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitfit.llm.base import SPACE, fresh, written


def normalised(text: Column) -> Column:
    """White-space runs become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest_runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One sorted run per scan partition: id, row number, digest, check."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
    rows = rows.select(
        "id",
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.xxhash64("t", F.octet_length("t")).alias("check"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
    )
    return written(rows.sortWithinPartitions("digest", "check"), "runs")


def merge_runs(runs: DataFrame, fan_in: int = 16) -> DataFrame:
    """Merge the runs in rounds to one row per text: digest, check, first, size."""
    level = runs.select("digest", "check", "run",
                        F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("first"),
                        F.lit(1).cast("long").alias("size"))
    left = (runs.agg(F.max("run")).first()[0] or 0) + 1
    while True:
        left = -(-left // fan_in)
        level = (level.groupBy(F.floor(F.col("run") / fan_in).cast("int").alias("run"), "digest", "check")
                 .agg(F.min("first").alias("first"), F.sum("size").alias("size")))
        if left == 1:
            return level.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fan_in: int = 16) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, digest (binary SHA-256)."""
    runs = digest_runs(docs, id_col, text_col)
    merged = merge_runs(runs, fan_in)
    return runs.join(merged, ["digest", "check"]).select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        "digest",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: one row per distinct text.

    Of rows with the same identifier and text that differ in other columns,
    any one stays.
    """
    (name,) = fresh(docs, "__key")

    def key(digest: Column) -> Column:
        return F.concat(digest, F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary"))

    kept = exact_dedup(docs, id_col, text_col).filter("kept").select(key(F.col("digest")).alias(name))
    marked = docs.withColumn(name, key(F.unhex(F.sha2(normalised(F.col(text_col)), 256))))
    # The semi join's exchange on the key also serves the removal of repeated rows.
    return (marked.join(kept, name, "left_semi").dropDuplicates([name])
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
