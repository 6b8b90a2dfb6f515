"""Duplicates hidden by formatting differences (problem 3).

Every distinct literal value is canonicalised once into its parts; each distinct part gets an
integer identifier; a value becomes the sorted tuple of its parts' identifiers; the compact
tuples are grouped. An identifier is the pair (least value key, part number) at which the part
occurs, so it is the same however often a task is repeated, and no dictionary goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import attach_by_key, min_by_key
from ..session import cut, table

#: A word, in which signs between two digits belong to the number.
WORD = r"((?:\p{N}(?:[^\p{L}\p{M}\p{N}\p{Z}\p{Cc};|]*\p{N})*|[\p{L}\p{M}])+)"


def fold_case(c: Column) -> Column:
    """Lower case in which letters with two lower-case or no upper-case forms agree, too."""
    return F.translate(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), "µςſ", "μσs")


def canonical_parts(c: Column) -> Column:
    """The parts that ``;`` or ``|`` separates, each as its words in one case with a blank between.

    A sign between two digits stays, accents stay; parts without letters and digits are left
    out; a text without any gives an empty array and a null text null.
    """
    parts = F.transform(F.split(fold_case(c), r"[;|]"), lambda p: F.array_join(F.regexp_extract_all(p, F.lit(WORD), F.lit(1)), " "))
    return F.filter(parts, lambda p: p != "")


def copies(rows: DataFrame) -> DataFrame:
    """(table_name, record_id, text) to (table_name, record_id, keep_id): each record with the first of its content.

    Texts that are null or without letters and digits are left out. Records with one key count
    once each; extra columns are dropped. Beyond the first grouping a text travels as its digest.
    """
    rows = rows.where(F.col("text").isNotNull() & F.col("text").rlike(r"[\p{L}\p{N}]")).select("table_name", "record_id", "text")
    digest = F.unhex(F.md5("text")).alias("digest")
    values = rows.groupBy("table_name", "text").agg(F.min("record_id").alias("value_id"))
    # Canonicalised once: read three times below.
    values = cut(values.select("table_name", "value_id", digest, canonical_parts(F.col("text")).alias("said")))
    parts = values.select("table_name", "value_id", F.posexplode("said").alias("no", "part"))
    coded = min_by_key(parts.withColumn("at", F.struct("value_id", "no")), ["table_name", "part"], "at", "part_id", ["value_id"])
    tuples = coded.groupBy("table_name", "value_id").agg(F.sort_array(F.collect_list("part_id")).alias("parts")).withColumn("parts", F.unhex(F.md5(F.to_json("parts"))))
    classes = min_by_key(tuples, ["table_name", "parts"], "value_id", "keep_id", ["value_id"]).select("table_name", "value_id", "keep_id")
    known = values.select("table_name", "value_id", "digest").join(classes, ["table_name", "value_id"]).select("table_name", "digest", "keep_id")
    return attach_by_key(rows.select("table_name", "record_id", digest), known, ["table_name", "digest"], ["record_id"]).select("table_name", "record_id", "keep_id")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "agent1_unified_lines").select(F.lit("agent1_unified_lines").alias("table_name"), F.col("line_id").alias("record_id"), F.col("enriched_purchase_description").alias("text"))
    b = table(spark, sf_dir, "translation_results").select(F.lit("translation_results").alias("table_name"), F.col("result_id").alias("record_id"), F.col("source_text").alias("text"))
    return a.unionByName(b)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(sources(spark, sf_dir)).where(F.col("record_id") != F.col("keep_id")).select("table_name", "keep_id", F.col("record_id").alias("copy_id"))


def p3_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each content once per table with the number of its records."""
    return copies(sources(spark, sf_dir)).groupBy("table_name", "keep_id").agg(F.count(F.lit(1)).alias("records"))


_CTE = r"""
WITH r AS (SELECT 'agent1_unified_lines' AS table_name, line_id AS id, enriched_purchase_description AS t FROM agent1_unified_lines
           UNION ALL SELECT 'translation_results', result_id, source_text FROM translation_results),
k AS (SELECT table_name, id, list_sort(list_filter(list_transform(regexp_split_to_array(translate(replace(lower(t), 'ß', 'ss'), 'µςſ', 'μσs'), '[;|]'),
        lambda p: array_to_string(regexp_extract_all(p, '((?:\p{N}(?:[^\p{L}\p{M}\p{N}\p{Z}\p{Cc};|]*\p{N})*|[\p{L}\p{M}])+)', 1), ' ')), lambda p: p <> '')) AS parts FROM r WHERE t IS NOT NULL),
f AS (SELECT table_name, id, min(id) OVER (PARTITION BY table_name, parts) AS keep, count(*) OVER (PARTITION BY table_name, parts) AS n FROM k WHERE len(parts) > 0)
"""
SQL = {
    "p3_found": _CTE + "SELECT table_name, keep AS keep_id, id AS copy_id FROM f WHERE id <> keep",
    "p3_contents": _CTE + "SELECT table_name, keep AS keep_id, n AS records FROM f WHERE id = keep",
}
