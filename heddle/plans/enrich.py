"""Description enrichment: row typing, duplicates, evidence pooled over join keys, markers, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.skew import attach_by_key, salt

# Words that open a total row.
TOTALS = "total|sum|subtotal|grand\\s*total|yhteens[aä]|summa|delsumma|razem|suma|gesamt|netto|brutto|vat|alv|moms|podatek"
# Weights of the confidence and what each basis and tier is worth.
WEIGHTS = {"basis": 0.28, "translation": 0.18, "evidence": 0.16, "corroboration": 0.10, "specificity": 0.20, "match": 0.08}
BASIS = {"description": 1.0, "context": 0.65, "taxonomy": 0.3, "none": 0.0}
TIERS = {"key": 1.0, "fuzzy": 0.75, "semantic": 0.6, "none": 0.5}


def row_type(description: Column, line_no: Column, quantity: Column, amount: Column, item: Column, document: Column) -> Column:
    """EMPTY, TOTAL, SUBTOTAL, LINE or HEADER from what a row holds (amount and quantity parsed, null if none)."""
    full = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    nothing = ~(full(description) | full(line_no) | full(item) | full(document)) & quantity.isNull() & amount.isNull()
    total = F.coalesce(description, F.lit("")).rlike(rf"(?i)^\s*({TOTALS})\b")
    return (
        F.when(nothing, "EMPTY").when(total & full(line_no), "SUBTOTAL").when(total, "TOTAL")
        .when(full(line_no) | quantity.isNotNull() | full(item) | full(description), "LINE")
        .when(full(document) & amount.isNotNull(), "HEADER").otherwise("EMPTY")
    )


def flag_duplicates(rows: DataFrame, signature: list[Column], row_id: str, order: str, fan: int | None = None) -> DataFrame:
    """is_duplicate and duplicate_of (the first row of the signature); rows are flagged, never dropped.

    The first row of each signature is found by partial minima, so a signature of a third of all rows is no single task.
    """
    s = rows.withColumn("_sig", F.sha2(F.concat_ws("\u001f", *[F.coalesce(c.cast("string"), F.lit("")) for c in signature]), 256))
    first = s.groupBy("_sig", salt(row_id, fan=fan).alias("_p")).agg(F.min(F.struct(F.col(order).alias("o"), F.col(row_id).alias("r"))).alias("m")).groupBy("_sig").agg(F.min("m").alias("m")).select("_sig", F.col("m.r").alias("_first"))
    j = attach_by_key(s, first, ["_sig"], [row_id])
    return j.withColumn("is_duplicate", F.col("_first") != F.col(row_id)).withColumn("duplicate_of", F.when(F.col("is_duplicate"), F.col("_first"))).drop("_sig", "_first")


def pool_evidence(keyed: DataFrame, sets: list[str]) -> DataFrame:
    """(key, columns) to one row per key with the sorted distinct non-blank values of each column."""
    return keyed.groupBy("key").agg(*[F.array_sort(F.collect_set(F.nullif(F.trim(c), F.lit("")))).alias(c) for c in sets])


def join_evidence(keyed: DataFrame, row_id: str, sets: list[str]) -> DataFrame:
    """Each row with the evidence of all its keys united, its tier, and the score of its most specific key.

    ``keyed`` has row_id, pos (0 for the most specific key), key and the columns to pool. The score is 1.0
    if the first key names a line (POL, INVL or DOCL), else 0.8; rows without a key don't occur here.
    """
    pool = pool_evidence(keyed, sets)
    got = attach_by_key(keyed.select(row_id, "pos", "key"), pool, ["key"], [row_id, "pos"])
    merged = got.groupBy(row_id).agg(F.min_by("key", "pos").alias("first_key"), *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in sets])
    line = F.col("first_key").rlike("^(POL|INVL|DOCL):")
    return merged.withColumn("match_tier", F.lit("key")).withColumn("match_score", F.when(line, 1.0).otherwise(0.8))


def marker_tally(c: Column, markers: list[str]) -> Column:
    """How many of the markers occur: single words as tokens, several words as a run of text."""
    key = T.lookup_key(c)
    single, multi = [m for m in markers if " " not in m], [m for m in markers if " " in m]
    hits = F.size(F.array_intersect(T.tokens(key), F.lit(single)))
    for m in multi:
        hits = hits + F.contains(key, F.lit(m)).cast("int")
    return F.coalesce(hits, F.lit(0))


def item_or_service(own: Column, context: Column, service: list[str], material: list[str]) -> Column:
    """The line's own words decide; if they are silent or balanced its context does; else Unclear."""
    os, om, cs, cm = marker_tally(own, service), marker_tally(own, material), marker_tally(context, service), marker_tally(context, material)
    return F.when(os > om, "Service").when(om > os, "Material").when(cs > cm, "Service").when(cm > cs, "Material").otherwise("Unclear")


def confidence(basis: Column, coverage: Column, fields: Column, systems: Column, specificity: Column, tier: Column, description: Column) -> tuple[Column, Column]:
    """(score 0 to 100, band) of an enriched description."""
    pick = lambda c, m, d: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), c), F.lit(d))
    b = pick(basis, BASIS, 0.0)
    raw = (
        b * WEIGHTS["basis"] + F.bround(F.least(F.lit(1.0), coverage), 3) * WEIGHTS["translation"] + F.bround(F.least(F.lit(1.0), fields / 4.0), 3) * WEIGHTS["evidence"]
        + F.bround(F.least(F.lit(1.0), F.greatest(F.lit(0), systems - 1) / 2.0), 3) * WEIGHTS["corroboration"] + specificity * WEIGHTS["specificity"] + pick(tier, TIERS, 0.5) * WEIGHTS["match"]
    )
    score = F.bround(F.round(F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)) * 100, 9)).cast("int")
    score = F.when(F.coalesce(description, F.lit("")) == "", 0).when(basis == "taxonomy", F.least(score, F.lit(49))).otherwise(score)
    return score, F.when(score >= 75, "High").when(score >= 50, "Medium").otherwise("Low")


def specificity(c: Column, generic: list[str]) -> Column:
    """Share of informative words (not generic, longer than two letters), three decimals."""
    w = T.tokens(T.lookup_key(c))
    informative = F.filter(w, lambda t: (F.length(t) > 2) & ~t.isin(generic))
    distinct = F.coalesce(F.size(F.array_distinct(informative)) / F.nullif(F.size(informative), F.lit(0)), F.lit(0.0))
    return F.bround(F.least(F.lit(1.0), 0.7 * F.size(informative) / 4.0 + 0.3 * distinct), 3)


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; ``order`` ends in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
