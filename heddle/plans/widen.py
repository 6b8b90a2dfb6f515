"""Widening join: each transaction with its invoice line and its purchase order line; rows in equal rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.ladder import climb, fold
from ..operators.skew import attach_by_key
from ..session import cut

# The invoice columns carried over, in order.
INVOICE_FIELDS = ["invoice_key", "invoice_id", "row_number", "xml_file_name", "article_id", "article_name", "free_text", "quantity_charged", "quantity_delivered", "unit_price_excl_vat", "unit_price_net", "row_total_excl_vat", "row_total_incl_vat", "vat_amount", "vat_rate"]


def invoice_index(lines: DataFrame, order: str) -> DataFrame:
    """Invoice rows under each of their document keys, delivered twice kept once (the first by ``order``)."""
    own = F.coalesce(F.nullif(F.col("invoice_key"), F.lit("")), F.col("invoice_id"))
    # Each text is normalised once, in a step of its own, before keys are made of it.
    n = lines.withColumns({"_own": T.normalise_text(own), "_key": T.normalise_text("invoice_key"), "_id": T.normalise_text("invoice_id"), "_xml": T.normalise_text("xml_file_name"), "_no": T.normalise_text("row_number"), "_sum": T.normalise_text("row_total_excl_vat")})
    x = n.where(~(T.blank_of(F.col("_own")) & T.blank_of(F.col("_xml")))).withColumns({"_row": T.line_of(F.col("_no")), "_dup": T.compact_of(F.col("_own")), "_art": T.lookup_key(F.coalesce("article_name", F.lit(""))), "_file": T.document_of(F.col("_xml"))})
    # Combined before the shuffle, so rows without any identifier, which share one key, are no hot group.
    x = x.groupBy("_dup", "_row", "_art").agg(F.min_by(F.struct(*x.columns), order).alias("_f")).select("_f.*")
    keys = F.array_distinct(F.array_compact(F.array(*[F.when(~T.blank_of(F.col(c)), F.nullif(T.compact_of(F.col(c)), F.lit(""))) for c in ("_key", "_id")], F.nullif(F.col("_file"), F.lit("")))))
    x = x.select(*lines.columns, "_row", F.col("_row").rlike(r"^\d+$").alias("is_line"), T.amount_of(F.col("_sum")).alias("total"), keys.alias("_keys"))
    return x.withColumn("key", F.explode("_keys")).drop("_keys")


def transaction_keys(tx: DataFrame, row_id: str) -> DataFrame:
    """(row, _inv, _doc, _did, _line): the join keys of a transaction, empty where it has none."""
    fields = {"_a": "invoice_number", "_b": "document_number", "_c": "documentidentifier", "_d": "invoicelink", "_e": "document_line_number"}
    n = tx.select(row_id, *[T.normalise_text(c).alias(k) for k, c in fields.items()])
    unless = lambda c: F.when(T.blank_of(F.col(c)), "").otherwise(T.compact_of(F.col(c)))
    n = cut(n)
    n = n.select(row_id, unless("_a").alias("_inv"), unless("_b").alias("_doc"), T.document_of(F.col("_c")).alias("_c"), T.document_of(F.col("_d")).alias("_d"), T.line_of(F.col("_e")).alias("_line"))
    return n.select(row_id, "_inv", "_doc", F.when(F.col("_c") != "", F.col("_c")).otherwise(F.col("_d")).alias("_did"), "_line")


def document_summary(index: DataFrame) -> DataFrame:
    """Lines and their total per document key."""
    cents = F.round(F.coalesce("total", F.lit(0.0)) * 100).cast("bigint")
    return index.groupBy("key").agg(F.count_if("is_line").alias("doc_lines"), (F.coalesce(F.sum(F.when(F.col("is_line"), cents)), F.lit(0)) / 100).alias("doc_total"))


def _blocks(index: DataFrame) -> DataFrame:
    """Folded blocks per (key, line) and per key; numeric lines only where a group has any."""
    cents = F.sum(F.round(F.coalesce("total", F.lit(0.0)) * 100).cast("bigint"))
    names = F.array_join(F.slice(F.array_sort(F.collect_set(F.nullif(F.col("article_name"), F.lit("")))), 1, 12), "; ").alias("names")

    def part(rows: DataFrame, kind: str, line: Column) -> DataFrame:
        g = rows.withColumn("line", line)
        any_line = fold(g.where("is_line"), ["key", "line"], INVOICE_FIELDS, cents.alias("cents"), names)
        lone = g.groupBy("key", "line").agg(F.max("is_line").alias("has")).where("NOT has").select("key", "line")
        rest = fold(g.join(lone, ["key", "line"], "left_semi"), ["key", "line"], INVOICE_FIELDS, cents.alias("cents"), names)
        return any_line.unionByName(rest).withColumn("rung_kind", F.lit(kind))

    return part(index.where("_row <> ''"), "line", F.col("_row")).unionByName(part(index, "header", F.lit("")))


def widen_invoices(tx: DataFrame, invoices: DataFrame, row_id: str, order: str) -> DataFrame:
    """The transactions with level, strategy, count, the unanimous invoice fields and the document's figures (prefix ``inv_``)."""
    index = cut(invoice_index(invoices, order))  # read five times below
    keys = transaction_keys(tx, row_id)
    names = [("invoice-number", "_inv"), ("document-number", "_doc"), ("document-id", "_did")]
    rungs = [(f"{n} + line", F.col(k), F.col("_line")) for n, k in names] + [(n, F.col(k), None) for n, k in names]
    blocks = attach_by_key(_blocks(index), document_summary(index), ["key"], ["line", "rung_kind"])
    got = climb(keys, row_id, rungs, blocks)
    out = got.select(
        row_id,
        F.coalesce("rung_kind", F.lit("none")).alias("inv_match_level"),
        F.coalesce("strategy", F.lit("")).alias("inv_match_strategy"),
        F.coalesce("match_count", F.lit(0)).alias("inv_match_count"),
        *[F.coalesce(c, F.lit("")).alias(f"inv_{c}") for c in INVOICE_FIELDS],
        F.coalesce("doc_lines", F.lit(0)).alias("inv_document_lines"),
        F.col("doc_total").alias("inv_document_total"),
        F.when(F.col("cents") != 0, F.col("cents") / 100).alias("inv_matched_total"),
        F.coalesce("names", F.lit("")).alias("inv_article_names"),
    )
    return tx.join(out, row_id)


def widen_orders(tx: DataFrame, row_id: str, order_no: Column, line: Column, hint: Column, systems: dict[str, DataFrame], fields: list[str]) -> DataFrame:
    """The best purchase order system's line for each row: exact line, then an order of one line, then the order.

    ``systems`` maps a name to rows (order_key, line_key, fields…). A system that the hint names goes one rank
    ahead; equal ranks are settled by name. Level is line only if one candidate is left.
    """
    # All systems climb at once: a line beats the header of its own system by rank, so one minimum settles every rung.
    rows = None
    for name in sorted(systems):
        one = systems[name].withColumnsRenamed({"order_key": "key", "line_key": "line"}).where("key <> ''").withColumn("system", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    header = fold(rows, ["system", "key"], fields).withColumn("line", F.lit(""))
    exact = fold(rows.where("line <> ''"), ["system", "key", "line"], fields)
    keys = tx.select(row_id, order_no.alias("key"), line.alias("_line"), hint.alias("_hint")).where("key <> ''")
    tries = keys.withColumn("line", F.explode(F.when(F.col("_line") != "", F.array(F.lit(""), F.col("_line"))).otherwise(F.array(F.lit(""))))).drop("_line")
    found = attach_by_key(tries, header.unionByName(exact), ["key", "line"], [row_id, "line"])
    is_line, single = F.col("line") != "", F.col("match_count") == 1
    strategy = F.when(is_line, "po-number + line").when(single, "po-number, single-line order").otherwise("po-number")
    rank = F.when(is_line, 0).when(single, 1).otherwise(2) - F.when(F.contains(F.lower("_hint"), F.col("system")), 1).otherwise(0)
    on_order = F.max(F.when(~is_line, F.col("match_count"))).alias("lines_on_order")
    per = found.withColumns({"rank": rank, "strategy": strategy}).groupBy(row_id, "system").agg(F.min(F.struct("rank", "strategy", "match_count", *fields)).alias("b"), on_order)
    best = per.groupBy(row_id).agg(F.min(F.struct("b.rank", "system", "b.strategy", "b.match_count", "lines_on_order", *[f"b.{c}" for c in fields])).alias("b"))
    cols = ["system", "strategy", "match_count", "lines_on_order", *fields]
    best = best.select(row_id, *[F.col(f"b.{c}").alias(f"po_{c}") for c in cols])
    out = tx.join(best, row_id, "left")
    return out.withColumn("po_match_level", F.when(F.col("po_match_count").isNull(), "none").when(F.col("po_match_count") == 1, "line").otherwise("header"))


def key_population(tx: DataFrame, order_id: str, invoices: DataFrame, order: str) -> DataFrame:
    """Per key field: rows that hold it, distinct keys, and distinct keys the other side has."""
    index = invoice_index(invoices, order).select("key").distinct().withColumn("_hit", F.lit(1))
    long = transaction_keys(tx, order_id).select(F.inline(F.array(*[F.struct(F.lit(n).alias("key_field"), k.alias("key")) for n, k in (("invoice_number", F.col("_inv")), ("document_number", F.col("_doc")), ("document_id", F.col("_did")))]))).where("key <> ''")
    per = long.groupBy("key_field", "key").agg(F.count(F.lit(1)).alias("n")).join(index, "key", "left")
    return per.groupBy("key_field").agg(F.sum("n").alias("populated"), F.count(F.lit(1)).alias("distinct_keys"), F.count("_hit").alias("available"), F.coalesce(F.sum(F.when(F.col("_hit") == 1, F.col("n"))), F.lit(0)).alias("rows_hit"))
