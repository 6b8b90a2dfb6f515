"""Joins, components, clustering, references, sources and sinks on small cases, with nulls, ties and hot keys."""

import datetime as dt
import itertools
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from heddle.operators.graph import components
from heddle.operators.ladder import fold
from heddle.operators.references import document_key, orphans
from heddle.operators.skew import attach_by_key
from heddle.plans import group as G
from heddle.plans import match as M
from heddle.sources import sinks, tables, xlsx

H = "0123456789abcdef0123456789abcdef"


def t(s):
    return dt.datetime.fromisoformat(s)


def test_attach_hot_key(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    facts = spark.createDataFrame([("hot", 1), ("3", 2), (None, 9)], "k string, v int")
    got = attach_by_key(rows, facts, ["k"], ["id"])
    assert got.count() == 667 and got.agg(F.sum("v")).first()[0] == 666 + 2


def test_components(spark):
    random.seed(1)
    e = [(random.randrange(200), random.randrange(200)) for _ in range(120)] + [(None, 1), (5, 5)] + [(900 + i, 901 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in e:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    want = {x: find(x) for x in parent}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(e, "a bigint, b bigint")).collect()}
    assert got == {k: v for k, v in want.items() if k in got} and set(got) == set(want) - {5 if 5 in want and sum(5 in p for p in e) == 1 else -1}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("text,want", [(H, H), (f" {H.upper()} ", H), ("{01234567-89ab-cdef-0123-456789ABCDEF}", H), (f"http://x/a?docid={H}&t=1", H), (f"inbox/2025/{H}-13.xml", H), (f"x{H}", None), (H + "0", None), ("", None), (None, None)])
def test_document_key(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(document_key("x")).first()[0] == want


def test_orphans(spark):
    kids = spark.createDataFrame([("p", "a", t("2024-02-01"), 1), ("p", "a", t("2024-01-01"), 2), ("p", "b", t("2024-01-01"), 3), ("p", None, t("2024-01-01"), 4), ("p", "c", None, 5), ("p", "b", t("2024-01-01"), 3)], "parent_table string, key string, at timestamp, _slot int")
    parents = spark.createDataFrame([("p", "a", t("2024-01-15")), ("p", "a", None), ("p", "b", None), ("p", "c", t("2024-01-01"))], "parent_table string, key string, at timestamp")
    assert sorted(r["_slot"] for r in orphans(kids, parents).collect()) == [2, 3, 3, 5]
    assert orphans(kids.limit(0), parents).count() == 0
    assert orphans(kids, parents.limit(0)).count() == 5


def test_fold_is_unanimous(spark):
    d = spark.createDataFrame([("k", "a", ""), ("k", "a", "x"), ("k", None, "y")], "key string, u string, v string")
    assert fold(d, ["key"], ["u", "v"]).first().asDict() == {"key": "k", "match_count": 3, "u": "a", "v": ""}


def test_linkage_against_brute_force():
    r = np.random.default_rng(3)
    for _ in range(20):
        n = 14
        sim = r.random((n, n))
        sim = np.triu(sim, 1) + np.triu(sim, 1).T
        groups = [[i] for i in range(n)]
        while True:
            best = max((np.mean([sim[i, j] for i in a for j in b]), -x, -y) for (x, a), (y, b) in itertools.combinations(enumerate(groups), 2)) if len(groups) > 1 else (0, 0, 0)
            if best[0] <= 0.55:
                break
            x, y = -best[1], -best[2]
            groups[x] += groups.pop(y)
        want = {frozenset(g) for g in groups}
        lab, _ = G._linkage(sim, 0.55)
        got = {frozenset(i for i in range(n) if lab[i] == c) for c in set(lab)}
        assert got == want


def test_nearest(spark):
    r = np.random.default_rng(1)
    v = spark.createDataFrame([(i, [float(x) for x in r.normal(size=8)]) for i in range(60)] + [(99, None)], "id bigint, v array<double>")
    got = M.nearest(v, v.where("id % 20 = 0"), "id", "v", -1.0, 3, block=2).collect()
    m = {x["id"]: np.array(x["v"]) for x in v.collect() if x["v"]}
    for q in (0, 20, 40):
        want = sorted(((-(m[q] @ m[i]) / np.linalg.norm(m[q]) / np.linalg.norm(m[i]), i) for i in m if i != q))[:3]
        assert [x["item"] for x in sorted((g for g in got if g["query"] == q), key=lambda g: g["rank"])] == [i for _, i in want]


def test_delimited(spark, tmp_path):
    for enc, sep in itertools.product(("utf-8-sig", "utf-8", "cp1252"), ",;\t|"):
        p = tmp_path / f"a_{enc}_{ord(sep)}.csv"
        p.write_bytes("\n".join(sep.join(x) for x in [("PONUM", "POLINENUM", "LINECOST", "ITEMNUM", "VENDOR"), ("1", "2", "3", "ä", "Söder"), ("4", "5", "6")]).encode(enc))
        df = tables.read_table(spark, str(p))
        assert [tuple(r)[:5] for r in df.collect()] == [("1", "2", "3", "ä", "Söder"), ("4", "5", "6", "", "")]
    assert len(tables.discover(str(tmp_path))) == 12
    assert tables.classify(df.columns) == "orders_a" and tables.classify(["x"]) is None
    assert tables.resolve(df.columns)["po_number"] == "PONUM"
    assert tables.read_folder(spark, str(tmp_path))["orders_a"].count() == 24


def _workbook(path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="One" sheetId="1" r:id="r1"/><sheet name="Two" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Name</t></si><si><t>Date</t></si><si><r><t>Pu</t></r><r><t>mp</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c></row><row r="3"><c r="A3" t="s"><v>2</v></c><c r="C3" s="1"><v>45292</v></c></row><row r="4"><c r="B4"><v>12.0</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>Name</t></is></c></row><row r="2"><c r="A2" t="b"><v>1</v></c></row></sheetData></worksheet>')


def test_workbook(spark, tmp_path):
    _workbook(tmp_path / "b.xlsx")
    (tmp_path / "~$b.xlsx").write_bytes(b"lock")
    df = tables.read_table(spark, str(tmp_path / "b.xlsx"))
    assert df.columns == ["Name", "column_2", "Date", "_src_file", "_src_sheet", "_row_no"]
    assert sorted((tuple(r) for r in df.collect()), key=lambda r: (r[4], r[5])) == [("Pump", "", "2024-01-01", "b.xlsx", "One", 3), ("", "12", "", "b.xlsx", "One", 4), ("TRUE", None, None, "b.xlsx", "Two", 2)]
    assert xlsx.serial_to_iso(45292.5) == "2024-01-01 12:00:00" and xlsx.column_index("AB12") == 27
    assert len(xlsx.workbooks(str(tmp_path))) == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("ä", 1, "e")], "a string, n int, ev string")
    sinks.export_csv(df, str(tmp_path / "x.csv"), ["a", "n"])
    assert (tmp_path / "x.csv").read_bytes().startswith(b"\xef\xbb\xbfa,n")
    sinks.write_jsonl(df, str(tmp_path / "j"), {"evidence": ["n", "ev"]})
    assert spark.read.json(str(tmp_path / "j")).first()["evidence"]["ev"] == "e"
    root = str(tmp_path / "reg")
    assert sinks.load_snapshot(spark, root, "a string").count() == 0
    (tmp_path / "reg").mkdir()
    sinks.save_snapshot(df.select("a"), root)
    sinks.save_snapshot(sinks.load_snapshot(spark, root, "a string").unionByName(df.select("a")), root)
    assert sinks.load_snapshot(spark, root, "a string").count() == 2


def test_core_stands_alone():
    import ast
    from pathlib import Path

    import heddle

    for p in Path(heddle.__file__).parent.rglob("*.py"):
        if "llm" not in p.parts:
            assert not any("llm" in (getattr(n, "module", "") or "") for n in ast.walk(ast.parse(p.read_text())) if isinstance(n, ast.ImportFrom)), p
