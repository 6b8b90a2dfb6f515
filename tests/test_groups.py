"""Groups on lines, ordered outputs, readers, column maps, files and hot keys on small cases."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[1]))

from heddle import providers  # noqa: E402
from heddle.functions import extract as X  # noqa: E402
from heddle.functions import reading as R  # noqa: E402
from heddle.operators.skew import attach_by_key, pairs_within, slots_of_a_key  # noqa: E402
from heddle.plans import attach as G  # noqa: E402
from heddle.plans import match as M  # noqa: E402
from heddle.plans import ordered as O  # noqa: E402
from heddle.sources import files, sinks, tables  # noqa: E402


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


def test_hot_key_is_spread(spark):
    """A key with a third of the rows makes no partition that is twice the median."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(300_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
        facts = rows.select("k").distinct().withColumn("f", F.col("k") * 2)
        got = attach_by_key(rows, facts, ["k"], ["id"])
        sizes = sorted(r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        assert sum(sizes) == 300_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert slots_of_a_key() >= 24


def test_pairs_within(spark):
    df = spark.createDataFrame([("a", i) for i in range(40)] + [("b", 99), (None, 1), (None, 2)], "g string, m int")
    got = {tuple(r) for r in pairs_within(df, "g", "m", "x", "y").collect()}
    assert got == {(i, j) for i in range(40) for j in range(i + 1, 40)}


def test_numbered_is_the_sorted_order(spark):
    df = spark.range(5_000).select(((F.col("id") * 7919) % 5_003).alias("v"), F.lit("x").alias("position_of"))
    got = O.numbered(df.repartition(7), [F.desc("v")]).collect()
    want = sorted((r["v"] for r in got), reverse=True)
    assert [r["v"] for r in sorted(got, key=lambda r: r["position"])] == want and sorted(r["position"] for r in got) == list(range(1, 5_001))
    assert O.numbered(df.limit(0), [F.desc("v")]).count() == 0


def test_registry_keeps_the_first(spark):
    cols = "bucket string, signature string, label string, run string, ord bigint"
    old = G.registry(spark.createDataFrame([("b", "s", "First", "r1", 1), ("b", "s", "Later", "r1", 2), ("b", "t", " ", "r1", 3), (None, "s", "x", "r1", 4)], cols))
    new = G.registry(spark.createDataFrame([("b", "s", "Other label", "r2", 1), ("b", "u", "First", "r2", 2)], cols))
    got = {r["signature"]: r for r in G.merge_registry(old, new).collect()}
    assert set(got) == {"s", "u"} and got["s"]["label"] == "First" and not got["s"]["is_new"] and got["u"]["is_new"]
    assert got["u"]["group_id"] == got["s"]["group_id"]  # same label in the same bucket


def test_lines_without_a_group_are_other(spark):
    lines = spark.createDataFrame([(1, "b", "s"), (2, "b", "none"), (3, None, "s"), (4, "b", "loose"), (5, "b", "s")], "line_id bigint, bucket string, signature string")
    groups = spark.createDataFrame([("b", "s", "Pump repair", "G-1", 0.5, 1, 80.0), ("b", "loose", "Loose", "G-2", 0.1, 9, 80.0)], "bucket string, signature string, label string, group_id string, cohesion double, members bigint, upstream double")
    got = {r["line_id"]: (r["label"], r["group_id"], r["confidence"]) for r in G.attach_groups(lines, groups, "line_id").collect()}
    assert got == {1: ("Pump repair", "G-1", 61), 5: ("Pump repair", "G-1", 61), 2: ("Other", "", 0), 3: ("Other", "", 0), 4: ("Other", "", 0)}
    src = lines.withColumn("label", F.lit("own"))
    back = G.appended(src, G.attach_groups(lines, groups, "line_id"), "line_id", ["label", "group_id"])
    assert back.columns == [*src.columns, "ai_label", "group_id"] and back.count() == 5


def test_suppliers_of_lines(spark):
    lines = spark.createDataFrame([(1, "Siemens Oy", "V1"), (2, "Simens", "V1"), (3, "Simens", None), (4, None, None), (5, "Old Name AB", "V9")], "row_no bigint, name string, number string")
    over = spark.createDataFrame([("old name", "new name")], "name string, canonical string")
    win = spark.createDataFrame([("V1", "siemens"), ("", "nobody")], "number string, supplier string")
    got = {r["row_no"]: (r["supplier"], r["via"]) for r in G.supplier_of_lines(lines, "row_no", "name", "number", over, win).collect()}
    assert got == {1: ("siemens", "number"), 2: ("siemens", "number"), 3: ("simens", "name"), 4: ("", "none"), 5: ("new name", "override")}


def test_the_larger_spend_survives(spark):
    pairs = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0), ("x", "y", 1.0)], "k string, other string, score double")
    spend = spark.createDataFrame([("a", 5), ("b", 9), ("c", 20), ("x", 1), ("y", 1), ("y", None)], "k string, spend int")
    assert sorted(map(tuple, G.survivors(pairs, spend).collect())) == [("a", "b"), ("b", "c"), ("y", "x")]


def test_retrievals_are_united(spark):
    a = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.5)], "query bigint, item bigint, score double")
    b = spark.createDataFrame([(1, 2, 0.7), (1, 3, 0.1)], "query bigint, item bigint, score double")
    assert sorted(map(tuple, M.united(a, b).collect())) == [(1, 1, 0.9, 0.0), (1, 2, 0.5, 0.7), (1, 3, 0.0, 0.1)]


@pytest.mark.parametrize("word,want", [("pumppuhuolto", ["pump", "repair"]), ("huoltohuolto", ["repair", "repair"]), ("pumppuxhuolto", None), ("pumppu", ["pump"]), ("", []), ("huoltohuoltohuoltohuolto", None), ("pumppupump", None)])
def test_exact_cover(word, want):
    assert R.exact_cover(word, {"pumppu": "pump", "huolto": "repair", "pum": "x"}) == want


def test_reading(spark):
    assert one(spark, R.proper_nouns("x"), "Repair at Olkiluoto by Anna and ABB") == ["Anna", "Olkiluoto"]
    assert one(spark, R.prose("x"), "see https://x.fi pump AB-1234-X 3 x 20 mail a@b.fi end") == "see pump mail end"
    assert one(spark, R.reference_text("x", 10), "alpha beta gamma | tail") == "alpha beta" and one(spark, R.reference_text("x", 9), "alpha beta") == "alpha"
    assert one(spark, R.reference_text("x"), None) is None
    assert one(spark, X.money("x"), "costs 1234,50 EUR or € 20, not 30 mm") == "1234,50eur; €20"
    assert one(spark, R.gather(F.col("x"), F.lit("PUMP"), F.lit("n/a"), F.lit("valve")), "pump") == ["pump", "valve"]
    assert one(spark, G.weak_label(F.col("x")), "Services and Work") and not one(spark, G.weak_label(F.col("x")), "Pump work") and one(spark, G.weak_label(F.col("x")), None)
    assert one(spark, R.factors(b=F.col("x"), a=F.lit(1)), "v") == '{"a":1,"b":"v"}'


def test_reader_cache_and_verdicts(spark):
    class Upper:
        name = "upper"

        def answer(self, questions):
            return [q.upper() if q != "skip" else None for q in questions]

    rows = spark.createDataFrame([(1, "a", "x"), (2, "skip", "y"), (3, None, "z"), (4, "a", "w")], "id bigint, q string, label string")
    ask = lambda p, cache=None: providers.ask(rows.select(F.col("q").alias("question")), p, cache)
    nothing = providers.apply_verdicts(rows, "id", "q", ask(providers.NullProvider()), "label").collect()
    assert {r["label"] for r in nothing} == {"x", "y", "z", "w"} and {r["decided_by"] for r in nothing} == {"rules"}
    first = ask(Upper()).cache()
    assert sorted((r["question"], r["answer"]) for r in first.collect()) == [("a", "A"), ("skip", None)]
    again = ask(Upper(), first)
    assert sorted((r["question"], r["answer"]) for r in again.collect()) == [("a", "A"), ("skip", None)]
    got = {r["id"]: (r["label"], r["decided_by"]) for r in providers.apply_verdicts(rows, "id", "q", first, "label").collect()}
    assert got == {1: ("A", "reader"), 4: ("A", "reader"), 2: ("y", "rules"), 3: ("z", "rules")}


@pytest.mark.parametrize("text,want", [('so {"a": {"b": 1}} there', {"a": {"b": 1}}), ("{broken {\"a\": 2}", {"a": 2}), ("none", None), (None, None), ("[1]", None)])
def test_json_object(text, want):
    assert providers.json_object(text) == want


def test_columns_and_names(spark):
    assert tables.column_map(["PO Number", "Desc", "PONUM"], {"po": ["ponum", "po number"], "text": ["desc"]}) == {"po": "PONUM", "text": "Desc"}
    assert tables.reference_columns(["My Item Description", "Code"], {"description": ["description", "item description"], "id": ["code"]}) == {"id": "Code", "description": "My Item Description"}
    assert tables.output_name("PO", "PO number") == "PO_number" and tables.output_name("PO", "line text") == "PO_line_text"
    df = spark.createDataFrame([(1, 2, 3)], "`PO number` int, number int, _src_file int")
    assert tables.prefixed(df, "PO").columns == ["PO_number", "PO_number_2", "_src_file"]


def test_files(spark, tmp_path):
    root = str(tmp_path)
    files.put(spark, f"{root}/a/x.txt", "ä")
    files.put(spark, f"{root}/a/x.txt", "ö")
    assert files.get(spark, f"{root}/a/x.txt") == "ö" and files.get(spark, f"{root}/none") is None
    assert files.head(spark, f"{root}/a/x.txt", 1) == "ö".encode()[:1]
    (tmp_path / "t.csv").write_text("a;b\n1;x\n2;y\n")
    (tmp_path / ".hidden.csv").write_text("a\n")
    assert tables.discover(root, spark) == tables.discover(root) == sorted([f"{root}/a/x.txt", f"{root}/t.csv"])
    assert [(r["a"], r["_row_no"]) for r in tables.read_table(spark, f"{root}/t.csv").collect()] == [("1", 2), ("2", 3)]
    sinks.write_manifest(spark, f"{root}/m.json", spark.range(3).agg(F.count("*").alias("rows")), run="r")
    assert '"rows": 3' in files.get(spark, f"{root}/m.json")
    sinks.save_snapshot(spark.range(2), f"{root}/reg", version=2)
    assert sinks.load_snapshot(spark, f"{root}/reg", "id bigint").count() == 0 and sinks.load_snapshot(spark, f"{root}/reg", "id bigint", version=2).count() == 2
    with pytest.raises(ValueError):
        sinks.write_stage(spark.range(1), root, "s")
        sinks.read_stage(spark, root, "s", ["gone"])
