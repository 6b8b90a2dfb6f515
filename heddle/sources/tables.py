"""Delimited extracts whose encoding, delimiter and columns are found at run time; only the driver's sniff reads a prefix, the scan reads all."""

from __future__ import annotations

import csv
import os
import re
from difflib import SequenceMatcher
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..pyfold import fold
from . import files
from .xlsx import ExcelSource

SNIFF = 256 * 1024
ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "cp1250", "latin-1")
SUFFIXES = {".csv", ".tsv", ".txt", ".xlsx", ".xlsm"}
#: Java's names; the Windows pages need spark.sql.legacy.javaCharsets.
JAVA = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "cp1252": "windows-1252", "cp1250": "windows-1250", "latin-1": "ISO-8859-1"}

# Header spellings of the logical fields, compared by header key.
ALIASES: dict[str, list[str]] = {
    "document_number": ["document number", "document no", "doc number"], "document_line_number": ["document line number", "doc line"], "po_number": ["po number", "ponum", "order number", "purchase order"],
    "po_line_number": ["po line number", "polinenum", "po line"], "invoice_number": ["invoice number", "invoice no", "invoice id"], "item_number": ["item number", "itemnum", "item id", "item code", "article id"],
    "description": ["description", "line description", "document line desc", "po line desc", "article name", "item description", "item name", "supplier product name"], "supplier_name": ["erp supplier name", "supplier name", "vendor name", "supplier"],
    "supplier_id": ["erp supplier number", "supplier code", "vendor", "supplier number"], "spend": ["spend in eur", "line cost", "row total excl vat", "po net sum company", "amount"], "quantity": ["quantity", "order qty", "po line quantity", "quantity charged"],
    "unit_price": ["unit cost", "unit price", "unit price excl vat"], "currency": ["currency code", "currency", "po currency company"], "posting_date": ["posting date", "order date", "po creation date"],
    "category_l1": ["category l1", "main category"], "category_l2": ["category l2", "sub category"], "category_l3": ["category l3"], "category_l4": ["category l4"], "business_area": ["business area"], "division": ["division"],
    "company_code": ["company code", "buyer company"], "company_name": ["company name"], "country": ["country"], "unit": ["unit", "uom"], "material_group": ["materialgroupname", "material group name", "commodity group"],
}
# Columns by which the role of an extract is known.
ROLES = {
    "transactions": ["sourcerowid", "datasource", "documentidentifier", "invoicelink", "spendineur", "erpsuppliername"],
    "orders_a": ["ponum", "polinenum", "linecost", "itemnum", "vendor", "orderdate"],
    "orders_b": ["ordernumber", "polinenumber", "supplierproductname", "ponetsumcompany", "maincategory", "orderstatus"],
    "invoices": ["invoicekey", "rownumber", "xmlfilename", "articlename", "rowtotalexclvat", "quantitycharged"],
}


def discover(root: str, spark: SparkSession | None = None) -> list[str]:
    """Table files under a folder (or the file itself), sorted; dot files and lock files are left out. With a session any file system of Spark's."""
    if spark is not None:
        names = [(p, p.rsplit("/", 1)[-1]) for p in files.walk(spark, root)]
        return [p for p, n in names if p == root or (os.path.splitext(n)[1].lower() in SUFFIXES and not n.startswith((".", "~$")))]
    if os.path.isfile(root):
        return [root]
    return sorted(str(p) for p in Path(root).rglob("*") if p.is_file() and p.suffix.lower() in SUFFIXES and not p.name.startswith((".", "~$")))


def detect_encoding(head: bytes) -> str:
    """The first encoding that decodes the head; a character cut at its end doesn't count against it."""
    for enc in ENCODINGS:
        try:
            if enc == "utf-8-sig" and not head.startswith(b"\xef\xbb\xbf"):
                continue
            head.decode("utf-8" if enc == "utf-8-sig" else enc)
            return enc
        except UnicodeDecodeError as e:
            if enc.startswith("utf-8") and e.end >= len(head) - 3 and len(head) >= SNIFF:
                return enc
    return "latin-1"


def detect_delimiter(sample: str) -> str:
    """Comma, semicolon, tab or bar: by the sniffer, else the one most frequent in the header."""
    try:
        return csv.Sniffer().sniff(sample, delimiters=",;\t|").delimiter
    except csv.Error:
        first = sample.split("\n", 1)[0]
        return max(",;\t|", key=first.count)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """One file as text columns with provenance; rows are padded or cut to the header, missing cells are empty."""
    if path.lower().endswith((".xlsx", ".xlsm")):
        spark.dataSource.register(ExcelSource)
        return spark.read.format("heddle_xlsx").load(path)
    head = files.head(spark, path, SNIFF)
    enc = detect_encoding(head)
    sep = detect_delimiter(head.decode(enc, "replace")[:16_384])
    if enc in ("cp1252", "cp1250"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    df = spark.read.csv(path, header=True, sep=sep, encoding=JAVA[enc], inferSchema=False, multiLine=True, quote='"', escape='"', mode="PERMISSIVE")
    df = df.toDF(*[c.lstrip("﻿").strip() or f"column_{i + 1}" for i, c in enumerate(df.columns)])
    # A file whose cells may hold line ends is read by one task, in order, so its rows are numbered as they stand; the header is row 1.
    number = (F.monotonically_increasing_id() + 2).cast("bigint")
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns], F.lit(os.path.basename(path)).alias("_src_file"), F.lit("").alias("_src_sheet"), number.alias("_row_no"))


def header_key(name: str) -> str:
    return re.sub("[^a-z0-9]", "", fold(name))


def resolve(columns: list[str], aliases: dict[str, list[str]] = ALIASES, fuzzy: float = 0.92) -> dict[str, str]:
    """Logical field to physical column: by alias, leftmost first, then by likeness of at least ``fuzzy``."""
    keys: dict[str, str] = {}
    for c in columns:
        keys.setdefault(header_key(c), c)
    out: dict[str, str] = {}
    for f, names in aliases.items():
        for k in [header_key(f), *map(header_key, names)]:
            if k in keys:
                out[f] = keys[k]
                break
    free = {k: c for k, c in keys.items() if c not in out.values()}
    for f, names in aliases.items():
        if f not in out:
            best = max(((SequenceMatcher(None, k, header_key(n)).ratio(), c) for k, c in free.items() for n in [f, *names]), default=(0, ""))
            if best[0] >= fuzzy:
                out[f] = best[1]
    return out


def rename(df: DataFrame, aliases: dict[str, list[str]] = ALIASES) -> DataFrame:
    """The logical fields that were found, then provenance; metadata only, no data is read."""
    return df.select(*[F.col(f"`{c}`").alias(f) for f, c in resolve(df.columns, aliases).items()], *[c for c in ("_src_file", "_src_sheet", "_row_no") if c in df.columns])


def classify(columns: list[str], accept: float = 0.34) -> str | None:
    """The role of which the largest share of columns is there, at least ``accept``."""
    have = {header_key(c) for c in columns}
    score, role = max((sum(k in have for k in ks) / len(ks), r) for r, ks in ROLES.items())
    return role if score >= accept else None


def profile(df: DataFrame, sample: int = 200) -> tuple[list[str], list[str]]:
    """(descriptive, context) columns of an unknown table, from a documented sample of rows: words, letters and variety.

    The choice of columns is metadata; it never limits what is read later.
    """
    rows = [r.asDict() for r in df.limit(sample).collect()]
    scored = []
    for c in df.columns:
        v = [str(r[c]) for r in rows if r[c] not in (None, "")]
        if c.startswith("_") or len(v) < 3:
            continue
        words = sum(len(x.split()) for x in v) / len(v)
        alpha = sum(ch.isalpha() for x in v for ch in x) / max(1, sum(len(x) for x in v))
        s = 0.45 * min(words / 4, 1) + 0.30 * alpha + 0.25 * len(set(v)) / len(v)
        k = header_key(c)
        s += 0.25 * any(h in k for h in ("desc", "text", "name", "nimi", "selite")) - 0.45 * any(h in k for h in ("date", "id", "number", "code", "amount", "sum"))
        scored.append((-s, c))
    scored.sort()
    top = [c for s, c in scored if -s >= 0.5][:3]
    return top, [c for s, c in scored if -s >= 0.35 and c not in top][:4]


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail before any work if a column of the contract is missing."""
    gone = [c for c in columns if c not in df.columns]
    if gone:
        raise ValueError(f"missing columns: {', '.join(gone)}")
    return df


def read_folder(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of a folder by role, headers united by name; files that can't be read or placed are reported and left out."""
    out: dict[str, DataFrame] = {}
    for order, p in enumerate(discover(root, spark)):
        try:
            df = read_table(spark, p).withColumn("_table_ord", F.lit(order))
        except Exception as e:  # a broken file must not end the run
            print(f"left out {p}: {type(e).__name__}")
            continue
        role = classify(df.columns)
        if role:
            out[role] = out[role].unionByName(df, allowMissingColumns=True) if role in out else df
    return out


def content_hash(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha256"))


def column_map(columns: list[str], synonyms: dict[str, list[str]]) -> dict[str, str]:
    """Field to column for the synonyms of one role, the first synonym that is there; columns are taken once."""
    keys: dict[str, str] = {}
    for c in columns:
        keys.setdefault(header_key(c), c)
    out: dict[str, str] = {}
    for field, names in synonyms.items():
        hit = next((keys[k] for k in map(header_key, [*names, field]) if k in keys and keys[k] not in out.values()), None)
        if hit:
            out[field] = hit
    return out


def reference_columns(columns: list[str], aliases: dict[str, list[str]]) -> dict[str, str]:
    """Field to column of a library of references: an alias, else the longest alias that a header contains."""
    out = column_map(columns, aliases)
    for field, names in aliases.items():
        if field not in out:
            for k in sorted(map(header_key, names), key=lambda k: (-len(k), k)):
                hit = next((c for c in columns if k in header_key(c) and c not in out.values()), None)
                if hit:
                    out[field] = hit
                    break
    return out


def output_name(prefix: str, header: str) -> str:
    """The prefix and the header in words joined by underscores, a prefix that the header begins with said once (C11)."""
    words = re.findall(r"[^\W_]+", header)
    if words and header_key(words[0]) == header_key(prefix):
        words = words[1:]
    return "_".join([prefix, *words])


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """The native columns under a prefix; provenance keeps its names, and a name met twice gets a number."""
    used: dict[str, int] = {}

    def name(c: str) -> str:
        n = c if c.startswith("_") else output_name(prefix, c)
        used[n] = used.get(n, 0) + 1
        return n if used[n] == 1 else f"{n}_{used[n]}"

    return df.toDF(*[name(c) for c in df.columns])
