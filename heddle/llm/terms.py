"""Frequency of every distinct value or term (problem 4), by suffix-sorted n-gram counting.

Each position of a text gives the suffix that starts there, truncated to the longest term
wanted, and the length from which its prefixes are new to the record: so records are counted by
sums, and no set of records is held however many have a term. Equal suffixes are combined, routed
by their first term, sorted in reverse lexicographic order, and read once with a stack whose
levels hold the counts of the prefix so far; a prefix is final as soon as a suffix comes that
doesn't share it. A first term may fill a third of all rows, so its suffixes are spread over
slots, whose counts just add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import salt
from ..session import table

SPACE = r"[\p{Z}\t\n\x0b\f\r\x1c-\x1f\x85]+"


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def label(c: Column) -> Column:
    """The whole label as one term in lower case, trimmed, inner white space as one blank; empty for a blank one."""
    return F.filter(F.array(F.trim(F.regexp_replace(F.lower(c), SPACE, " "))), lambda x: x != "")


def _suffixes(longest: int):
    """Each position's suffix with the least length at which its prefix didn't stand in the record before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fields, suffixes, new, weights = [], [], [], []
            for field, tokens, weight in zip(*(b.column(c).to_pylist() for c in ("field_name", "tokens", "weight"))):
                seen: set[tuple[str, ...]] = set()
                for i in range(len(tokens)):
                    s = tuple(tokens[i : i + longest])
                    # A prefix that is new makes every longer one new.
                    at = next((j for j in range(1, len(s) + 1) if s[:j] not in seen), len(s) + 1)
                    seen.update(s[:j] for j in range(at, len(s) + 1))
                    fields.append(field)
                    suffixes.append(s)
                    new.append(at)
                    weights.append(weight)
                    if len(fields) >= 50_000:
                        yield _rows(fields, suffixes, new, weights)
                        fields, suffixes, new, weights = [], [], [], []
            yield _rows(fields, suffixes, new, weights)

    return run


def _rows(fields: list, suffixes: list, new: list, weights: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(fields, pa.string()), pa.array(suffixes, pa.list_(pa.string())), pa.array(new, pa.int32()), pa.array(weights, pa.int64())], ["field_name", "suffix", "new", "weight"])


def _stack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    field: str | None = None
    path: list[str] = []
    count: list[int] = []
    records: list[int] = []
    out: list[tuple] = []

    def pop(keep: int) -> None:
        while len(path) > keep:
            c = count.pop()
            out.append((field, list(path), c, records.pop()))
            path.pop()
            if path:
                count[-1] += c

    for b in batches:
        for f, s, new, w in zip(b["field_name"], b["suffix"], b["new"], b["weight"]):
            if f != field:
                pop(0)
                field = f
            n, same = len(s), 0
            while same < n and same < len(path) and path[same] == s[same]:
                same += 1
            pop(same)
            for x in s[same:]:
                path.append(x)
                count.append(0)
                records.append(0)
            count[-1] += w
            for j in range(new - 1, n):
                records[j] += w
        if len(out) > 20_000:
            yield pd.DataFrame(out, columns=["field_name", "terms", "cf", "df"])
            out = []
    pop(0)
    if out:
        yield pd.DataFrame(out, columns=["field_name", "terms", "cf", "df"])


def term_counts(rows: DataFrame, longest: int = 1, fan: int | None = None) -> DataFrame:
    """(field_name, tokens) per record to (field_name, terms, occurrences, records) of every n-gram up to ``longest`` terms.

    Records with equal tokens are read once with their number as weight. Null or empty tokens
    give no term; extra columns are dropped; an empty table gives no row.
    """
    values = rows.where(F.size("tokens") > 0).groupBy("field_name", "tokens").agg(F.count(F.lit(1)).alias("weight"))
    each = values.mapInArrow(_suffixes(longest), "field_name string, suffix array<string>, new int, weight bigint")
    suffixes = each.groupBy("field_name", "suffix", "new").agg(F.sum("weight").alias("weight")).withColumn("_slot", salt("suffix", fan=fan))
    routed = suffixes.repartition("field_name", F.col("suffix")[0], "_slot").sortWithinPartitions("field_name", F.desc("suffix")).select("field_name", "suffix", "new", "weight")
    part = routed.mapInPandas(_stack, "field_name string, terms array<string>, cf bigint, df bigint")
    return part.groupBy("field_name", "terms").agg(F.sum("cf").alias("occurrences"), F.sum("df").alias("records"))


def marked(rows: DataFrame, longest: int = 1) -> DataFrame:
    """term_counts with a mark: rare in at most 2 records, common in more than a tenth of the records that hold a term."""
    held = rows.where(F.size("tokens") > 0).groupBy("field_name").agg(F.count(F.lit(1)).alias("held"))  # one row a field
    c = term_counts(rows, longest).join(F.broadcast(held), "field_name")
    mark = F.when(F.col("records") <= 2, "rare").when(F.col("records") * 10 > F.col("held"), "common")
    return c.select("field_name", F.array_join("terms", " ").alias("term"), "occurrences", "records", mark.alias("mark"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "agent1_unified_lines").select(F.lit("enriched_purchase_description").alias("field_name"), words(F.col("enriched_purchase_description")).alias("tokens"))
    b = table(spark, sf_dir, "agent2_purchase_groups").select(F.lit("ai_purchase_group_l5").alias("field_name"), label(F.col("ai_purchase_group_l5")).alias("tokens"))
    return a.unionByName(b)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A term in at most 2 records of fewer than 20 is both; rare is said first.
    return marked(sources(spark, sf_dir)).where(F.col("mark").isNotNull()).select("field_name", "term", "mark")


def p4_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term with its occurrences, records and mark."""
    return marked(sources(spark, sf_dir))


def p4_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of up to three terms with its occurrences, records and mark."""
    return marked(sources(spark, sf_dir), longest=3)


_CTE = r"""
WITH r AS (SELECT 'enriched_purchase_description' AS field_name, line_id AS id, regexp_extract_all(lower(enriched_purchase_description), '[\p{{L}}\p{{N}}]+') AS w FROM agent1_unified_lines
  UNION ALL SELECT 'ai_purchase_group_l5', group_row, list_filter([trim(regexp_replace(lower(ai_purchase_group_l5), '[\p{{Z}}\t\n\x0b\f\r\x1c-\x1f\x85]+', ' ', 'g'))], lambda x: x <> '') FROM agent2_purchase_groups),
h AS (SELECT field_name, count(*) AS held FROM r WHERE len(w) > 0 GROUP BY 1),
t AS ({}),
c AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT id) AS records FROM t WHERE term IS NOT NULL GROUP BY 1, 2),
m AS (SELECT c.*, CASE WHEN records <= 2 THEN 'rare' WHEN records * 10 > held THEN 'common' END AS mark FROM c JOIN h USING (field_name))
"""
_WORDS = "SELECT field_name, id, unnest(w) AS term FROM r"
_RUNS = " UNION ALL ".join([_WORDS, *(f"SELECT field_name, id, array_to_string(w[k:k + {n}], ' ') FROM (SELECT *, unnest(range(1, len(w) - {n - 1})) AS k FROM r)" for n in (1, 2))])
_ALL = "SELECT field_name, term, occurrences::BIGINT AS occurrences, records::BIGINT AS records, mark FROM m"
SQL = {"p4_found": _CTE.format(_WORDS) + "SELECT field_name, term, mark FROM m WHERE mark IS NOT NULL", "p4_terms": _CTE.format(_WORDS) + _ALL, "p4_ngrams": _CTE.format(_RUNS) + _ALL}
