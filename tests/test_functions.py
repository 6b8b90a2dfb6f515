"""Golden cases of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from heddle.functions import extract as X
from heddle.functions import text as T
from heddle.plans import consolidate as C
from heddle.plans import enrich as E
from heddle.plans import group as G
from heddle.plans import match as M

CASES = [
    (T.parse_amount, "1 234,56", 1234.56), (T.parse_amount, "1,234.56", 1234.56), (T.parse_amount, "1.234,56", 1234.56), (T.parse_amount, "4 820,00", 4820.0), (T.parse_amount, "(1.234,56)", -1234.56),
    (T.parse_amount, "1,234", 1234.0), (T.parse_amount, "1,5", 1.5), (T.parse_amount, "1.234", 1.234), (T.parse_amount, "1,234,567", None), (T.parse_amount, "-", None), (T.parse_amount, "", None), (T.parse_amount, "abc", None), (T.parse_amount, None, None),
    (T.separate_welded_codes, "157238asbestipurku", "157238 asbestipurku"), (T.separate_welded_codes, "WH-CH520", "WH-CH520"), (T.separate_welded_codes, "MODEL 3", "MODEL 3"),
    (T.soften_caps, "VUOKRA", "vuokra"), (T.soften_caps, "Valve DN50", "Valve DN50"), (T.compact_key, "po-23983000004", "PO23983000004"), (T.compact_key, None, ""),
    (T.line_key, "1", "1"), (T.line_key, "01", "1"), (T.line_key, "1.0", "1"), (T.line_key, "0", ""), (T.line_key, "A-1", "A1"), (T.line_key, None, ""),
    (T.document_id_key, "http://x/?docid=ABCDEF0123456789", "abcdef0123456789"), (T.document_id_key, "0123456789abcdef_15613_x.xml", "0123456789abcdef"), (T.document_id_key, "short", ""),
    (T.signature, "removal of asbestos", "asbestos|removal"), (T.signature, "asbestos removal", "asbestos|removal"), (T.sentence_case, "pump PPE", "Pump PPE"), (T.parse_date, "5.3.2024", "2024-03-05"), (T.parse_date, "soon", "soon"),
    (T.supplier_key, "Siemens Oy", "siemens"), (T.supplier_key, "SIEMENS OY AB", "siemens"), (T.supplier_key, "Siemens Oy Ab", "siemens"), (T.supplier_key, "Oy Ab", "oy ab"), (T.supplier_key, "Firma Sp. z o.o.", "firma"),
    (T.format_amount, 12.0, "12"), (T.format_amount, 1.25, "1.25"), (T.format_amount, None, ""), (T.format_percent, 0.125, 12), (T.format_percent, 0.135, 14), (T.format_percent, 1.7, 100), (T.format_percent, -0.2, 0),
    (T.strip_noise, "Pump see attachment 12345 x@y.fi", "Pump"), (T.repair_mojibake, "sÃ¤iliÃ¶", "säiliö"), (T.fold_accents, "Łódź Straße", "Lodz Strasse"),
    (X.emails, "Ask A.B@X.fi or a.b@x.fi", "a.b@x.fi"), (X.dates, "on 3.4.2024, 2024-05-06 and 11.3. or 45.3.2024", "--03-11; 2024-04-03; 2024-05-06"), (X.percentages, "10 % and 5%", "10%; 5%"), (X.lead_time_days, "2 viikkoa, 3 days", 14),
    (X.dimensions, "1250 x 2500", "1250x2500"), (X.model_codes, "pump WH-CH520, 3 kW", "WH-CH520"), (X.references, "LO1-K570-570-00083 12-05-2026", "LO1-K570-570-00083"), (X.intent, "pump maintenance", "Maintenance and repair"), (X.intent, "zzz", ""),
]


@pytest.mark.parametrize("fn,arg,want", CASES)
def test_golden(spark, fn, arg, want):
    kind = "double" if isinstance(arg, float) or fn in (T.format_amount, T.format_percent) else "string"
    assert spark.createDataFrame([(arg,)], f"x {kind}").select(fn("x")).first()[0] == want


@pytest.mark.parametrize("word,want", [("valves", "valve"), ("bodies", "body"), ("boxes", "box"), ("asbestos", "asbestos"), ("analysis", "analysis"), ("gas", "gas")])
def test_lemma(spark, word, want):
    assert spark.createDataFrame([(word,)], "x string").select(T.suffix_lemma(F.col("x"))).first()[0] == want


@pytest.mark.parametrize("word,want", [("A4", True), ("DN50", True), ("VALVE", True), ("PPE", False), ("valve", False)])
def test_code(spark, word, want):
    assert spark.createDataFrame([(word,)], "x string").select(T.is_code_token(F.col("x"))).first()[0] is want


@pytest.mark.parametrize("a,b,want", [("valve DN50", "valve DN200", False), ("3 kW", "3000 W", True), ("valve", "DN50", None)])
def test_specs(spark, a, b, want):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(X.spec_agreement(X.spec_read("a"), X.spec_read("b"))).first()[0] is want


@pytest.mark.parametrize("a,b,want", [("wireless headphones", "wireless keyboard", False), ("asbestos removal", "asbestos demolition", True), ("tank cleaning", "pipe cleaning", False)])
def test_types(spark, a, b, want):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(M.type_compatible(F.col("a"), F.col("b"), ["cleaning", "removal", "demolition"])).first()[0] is want


def test_scores(spark):
    d = spark.createDataFrame([(20, 1000.0, None, 4, False), (2, 1000.0, None, 4, False)], "t int, s double, st double, p int, x boolean")
    assert [tuple(r) for r in d.select(*M.candidate_score(*[F.col(c) for c in ("t", "s", "st", "p", "x")])).collect()] == [(78, "Yes"), (0, "No")]
    g = spark.createDataFrame([(0.5, 1, 80.0, True, False), (0.5, 1, 80.0, True, True)], "c double, n int, u double, s boolean, o boolean")
    assert [r[0] for r in g.select(G.group_confidence(*[F.col(c) for c in "cnuso"])).collect()] == [61, 0]


def test_labels(spark):
    rows = [("a", t, 1) for t in ("asbestos removal service", "asbestos demolition", "asbestos removal")] + [("b", t, 1) for t in ("tank cleaning", "reactor cleaning", "industrial cleaning")]
    got = {r["k"]: r["label"] for r in G.consensus_label(spark.createDataFrame(rows, "k string, text string, w int"), ["k"], "text", "w").collect()}
    assert got == {"a": "Asbestos removal", "b": "Industrial cleaning"}


def test_coverage(spark):
    rows = [("s", "v", "A", "x", True, "100"), ("s", "v", "B", "x", True, "50"), ("s", "v", "B", "y", True, "50")]
    p = C.portfolio(spark.createDataFrame(rows, "scope_level string, scope_value string, supplier string, item string, named boolean, spend string").withColumn("spend", F.col("spend").cast("decimal(18,4)")))
    got = {(r["supplier"], r["partner"]): (r["coverage"], r["similarity_band"]) for r in C.overlaps(p).collect()}
    assert got == {("A", "B"): (1.0, "High"), ("B", "A"): (0.5, "Medium")}


def test_row_types(spark):
    rows = [("pump", "1", 1.0, 2.0, "", "d"), ("Total", "", None, 5.0, "", "d"), ("Total", "3", None, 5.0, "", "d"), ("", "", None, 5.0, "", "d"), ("", "", None, None, "", "")]
    d = spark.createDataFrame(rows, "t string, l string, q double, a double, i string, d string")
    assert [r[0] for r in d.select(E.row_type(*[F.col(c) for c in "tlqaid"])).collect()] == ["LINE", "TOTAL", "SUBTOTAL", "HEADER", "EMPTY"]
