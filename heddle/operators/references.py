"""References to records that do not exist (problem 5).

Parent and child keys are united in long form, tagged, and grouped by parent table
and key; a group whose parent flag is missing, or whose parent came after some
child, is kept. Nothing is collected per group but a bounded set of slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .skew import salt

# 32 hexadecimal digits on end, or in the 8-4-4-4-12 form, free of other letters and digits around.
PLAIN = r"(?i)(?<![0-9A-Za-z])([0-9a-f]{32})(?![0-9A-Za-z])"
DASHED = r"(?i)(?<![0-9A-Za-z])([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})(?![0-9A-Za-z])"


def document_key(c: Column | str) -> Column:
    """The 32-digit identifier in a text, in lower case without dashes; null if there is none."""
    c = F.col(c) if isinstance(c, str) else c
    plain = F.nullif(F.regexp_extract(c, PLAIN, 1), F.lit(""))
    dashed = F.nullif(F.replace(F.regexp_extract(c, DASHED, 1), F.lit("-"), F.lit("")), F.lit(""))
    return F.lower(F.coalesce(plain, dashed))


def orphans(children: DataFrame, parents: DataFrame, fan: int | None = None) -> DataFrame:
    """Rows of ``children`` (parent_table, key, at, …) for which no parent row with the key came by ``at``.

    ``parents`` has parent_table, key, at (null if the parent doesn't count). A null child key is
    no reference and is left out; a null ``at`` of a child counts as before every parent, a null ``at``
    of a parent as missing. Repeated children stay; extra child columns are kept.
    """
    names = [c for c in children.columns]
    kids = children.where(F.col("key").isNotNull()).withColumn("__h_slot", salt(*[F.col(f"`{c}`") for c in names], fan=fan))
    tagged = parents.where(F.col("key").isNotNull()).select("parent_table", "key", F.lit(None).cast("int").alias("__h_slot"), F.col("at").alias("__h_parent_at"), F.lit(None).cast("timestamp").alias("__h_child_at")).unionByName(
        kids.select("parent_table", "key", "__h_slot", F.lit(None).cast("timestamp").alias("__h_parent_at"), F.coalesce("at", F.lit("0001-01-01").cast("timestamp")).alias("__h_child_at"))
    )
    groups = (
        tagged.groupBy("parent_table", "key")
        .agg(F.min("__h_parent_at").alias("__h_have"), F.min("__h_child_at").alias("__h_first"), F.collect_set("__h_slot").alias("__h_slots"))
        .where(F.col("__h_first").isNotNull() & (F.col("__h_have").isNull() | (F.col("__h_have") > F.col("__h_first"))))
        .select("parent_table", "key", "__h_have", F.explode("__h_slots").alias("__h_slot"))
    )
    late = F.col("__h_have").isNull() | F.col("at").isNull() | (F.col("__h_have") > F.col("at"))
    return kids.join(groups, ["parent_table", "key", "__h_slot"]).where(late).select(*names)


def invoice_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references from transactions to invoice documents: row_no, ref_field, key, at."""
    t = table(spark, sf_dir, "max_transactions").select("row_no", "documentidentifier", "invoicelink", "loaded_at")
    kids = t.select(
        "row_no",
        F.col("loaded_at").alias("at"),
        F.lit("invoice_lines").alias("parent_table"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("ref_field"), document_key(c).alias("key")) for c in ("documentidentifier", "invoicelink")])),
    )
    parents = table(spark, sf_dir, "invoice_lines").select(
        F.lit("invoice_lines").alias("parent_table"), document_key("xml_file_name").alias("key"), F.when(F.col("deleted_at").isNull(), F.col("received_at")).alias("at")
    )
    return orphans(kids, parents)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoice_references(spark, sf_dir).select("row_no", "ref_field")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per parent table, field and month of loading."""
    o = invoice_references(spark, sf_dir)
    return o.groupBy("parent_table", "ref_field", F.date_format("at", "yyyy-MM").alias("period")).agg(F.count(F.lit(1)).alias("orphans"), F.countDistinct("key").alias("keys"))


_KEY = "lower(replace(coalesce(nullif(regexp_extract({0}, '(?i)(?:^|[^0-9A-Za-z])([0-9a-f]{{32}})(?:$|[^0-9A-Za-z])', 1), ''), nullif(regexp_extract({0}, '(?i)(?:^|[^0-9A-Za-z])([0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}})(?:$|[^0-9A-Za-z])', 1), '')), '-', ''))"
_ORPHANS = f"""
WITH p AS (SELECT {_KEY.format('xml_file_name')} AS k, min(received_at) AS have FROM invoice_lines WHERE deleted_at IS NULL GROUP BY 1),
c AS (SELECT row_no, loaded_at, 'documentidentifier' AS ref_field, {_KEY.format('documentidentifier')} AS k FROM max_transactions
      UNION ALL SELECT row_no, loaded_at, 'invoicelink', {_KEY.format('invoicelink')} FROM max_transactions),
o AS (SELECT c.* FROM c LEFT JOIN p ON c.k = p.k WHERE c.k IS NOT NULL AND (p.have IS NULL OR c.loaded_at IS NULL OR p.have > c.loaded_at))
"""
SQL = {
    "p5_found": _ORPHANS + "SELECT row_no, ref_field FROM o",
    "p5_report": _ORPHANS + "SELECT 'invoice_lines' AS parent_table, ref_field, strftime(loaded_at, '%Y-%m') AS period, count(*) AS orphans, count(DISTINCT k) AS keys FROM o GROUP BY 2, 3",
}
