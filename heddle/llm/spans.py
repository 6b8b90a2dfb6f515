"""Long exact spans shared between records (problem 10).

Hashing lines or paragraphs can't find a stretch that begins and ends inside a line, so the
units here are set by the content: each window of ``least`` characters names the gram in it
with the least hash, so equal windows name equal grams. A run of windows that name one gram
is a unit. Unit digests are grouped globally with the first and last document that hold them;
a unit in two documents is shared whole. Only where a gram is shared but the unit around it
is not (at the ends of a copied passage) are the single windows compared. Offsets are those
of the original text. No pair of documents is ever formed, so a passage that a third of the
corpus holds is as cheap as any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import salt
from ..session import cut, table

#: Characters of text that a worker hashes at a time; a longer text goes alone.
CHUNK = 600_000
# Odd multipliers of the two rolling hashes and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a base and of its inverse, up to n; kept by the worker for the usual sizes."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, CHUNK + 10_000)
        up, down = np.full(size, BASES[which], np.uint64), np.full(size, pow(BASES[which], -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 4 * CHUNK:
            _POWERS[which] = have
    return have


class Rolling:
    """Hashes of any stretch of a text by prefix sums."""

    def __init__(self, codes: np.ndarray, which: int):
        up, self.down = _powers(which, len(codes))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_mix(codes + np.uint64(0x1000 * (which + 1))) * up[: len(codes)], out=self.sums[1:])

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return _mix((self.sums[start + size] - self.sums[start]) * self.down[start])


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _units(texts: list[str], least: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of the texts, put end to end: (text number, first window, windows, gram hash, first window less gram, digest) per unit."""
    sizes = np.array([len(t) for t in texts], np.int64)
    if sizes.sum() >= 1 << 28:
        raise ValueError("a text of 2**28 characters or more can't be told apart by position")
    begin = np.cumsum(sizes) - sizes
    r = Rolling(_codes(texts), 0)
    starts = np.arange(int(sizes.sum()) - gram + 1)
    grams = r.of(starts, gram)
    packed = (grams & ~np.uint64((1 << 28) - 1)) | starts.astype(np.uint64)
    width, span = least - gram + 1, 1
    low = packed
    while span * 2 <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    spot = (low & np.uint64((1 << 28) - 1)).astype(np.int64)  # of the window that starts here
    text = np.repeat(np.arange(len(texts)), sizes)[: len(spot)]
    inside = np.arange(len(spot)) + least <= (begin + sizes)[text]
    new = np.concatenate([[True], (spot[1:] != spot[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(spot)]]))
    keep = inside[first]
    first, count = first[keep], count[keep]
    at = spot[first]
    return text[first], first - begin[text[first]], count, grams[at], first - at, r.of(first, count + (least - 1))


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, n = at, 0
        while end < len(texts) and (end == at or n + len(texts[end]) <= CHUNK):
            n += len(texts[end])
            end += 1
        yield at, end
        at = end


def _read_units(least: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            with np.errstate(over="ignore"):
                for i, j in _groups(texts):
                    text, first, count, fp, rel, digest = _units(texts[i:j], least, gram)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[i:j][text]), pa.array(first), pa.array(count.astype(np.int32)), pa.array(fp.view(np.int64)), pa.array(rel.astype(np.int32)), pa.array(digest.view(np.int64))], ["doc_id", "first", "n", "fp", "rel", "digest"]
                    )

    return run


def _read_windows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, work = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            with np.errstate(over="ignore"):
                for doc, t, units in zip(ids, texts, work):
                    codes = _codes([t])
                    a, c = Rolling(codes, 0), Rolling(codes, 1)
                    n = np.array([u["n"] for u in units])
                    first = np.array([u["first"] for u in units])
                    at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    lo, hi = (np.repeat(np.array([u[k] for u in units], np.int64), n) for k in ("lo", "hi"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), doc)), pa.array(at.astype(np.int64)), pa.array(a.of(at, least).view(np.int64)), pa.array(c.of(at, least).view(np.int64)), pa.array(lo), pa.array(hi)], ["doc_id", "first", "w1", "w2", "lo", "hi"]
                    )

    return run


def _with_range(rows: DataFrame, keys: list[str], lo: str, hi: str, extra: list = (), keep=None) -> DataFrame:
    """Attach the least and largest document of each key (and ``extra`` least/largest pairs), two steps for hot keys."""
    slotted = rows.withColumn("_slot", salt("doc_id", "first"))
    part = slotted.groupBy(*keys, "_slot").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"), *[F.min(x).alias(f"_a{i}") for i, x in enumerate(extra)], *[F.max(x).alias(f"_b{i}") for i, x in enumerate(extra)])
    whole = part.groupBy(*keys).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.min(f"_a{i}").alias(f"_a{i}") for i in range(len(extra))], *[F.max(f"_b{i}").alias(f"_b{i}") for i in range(len(extra))], F.collect_set("_slot").alias("_slots"))
    if keep is not None:
        whole = whole.where(keep)
    back = whole.withColumn("_slot", F.explode("_slots")).drop("_slots")
    return slotted.drop("lo", "hi").join(back, [*keys, "_slot"]).drop("_slot")


def shared_spans(docs: DataFrame, least: int = 200, later: bool = False) -> DataFrame:
    """(doc_id, text) to (doc_id, span_start, span_end): each longest run of positions that lie in a stretch of ``least`` characters which another document holds too.

    Positions count code points from 1, ends included. Null texts and texts shorter than ``least``
    give nothing; rows of one ``doc_id`` count as one document; other columns are dropped. With ``later``
    only what a document with a smaller id holds too: the spans to remove where the earliest occurrence is kept.
    """
    gram = max(1, least // 2)
    texts = docs.where(F.length("text") >= least).select("doc_id", "text")
    units = texts.mapInArrow(_read_units(least, gram), "doc_id bigint, first bigint, n int, fp bigint, rel int, digest bigint")
    met = _with_range(units, ["fp"], "doc_id", "doc_id", [F.struct("rel", "n", "digest")], F.col("lo") < F.col("hi"))
    met = cut(met.select("doc_id", "first", "n", "fp", "rel", "digest", (F.col("_a0") != F.col("_b0")).alias("open")))
    known = cut(_with_range(met, ["fp", "rel", "n", "digest"], "doc_id", "doc_id").select("doc_id", "first", "n", "open", "lo", "hi"))
    wanted = F.col("lo") < (F.col("doc_id") if later else F.col("hi"))
    whole = known.where(wanted).select("doc_id", (F.col("first") + 1).alias("s"), (F.col("first") + F.col("n") + (least - 1)).alias("e"))
    work = known.where("open AND doc_id = lo").groupBy("doc_id").agg(F.collect_list(F.struct("first", "n", "lo", "hi")).alias("work"))
    windows = texts.join(work, "doc_id").mapInArrow(_read_windows(least), "doc_id bigint, first bigint, w1 bigint, w2 bigint, lo bigint, hi bigint").withColumnsRenamed({"lo": "l", "hi": "h"})
    single = _with_range(windows, ["w1", "w2"], "l", "h", (), F.col("lo") < F.col("hi")).where(wanted).select("doc_id", (F.col("first") + 1).alias("s"), (F.col("first") + least).alias("e"))
    by_doc = Window.partitionBy("doc_id").orderBy("s", "e")
    before = F.max("e").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = whole.unionByName(single).withColumn("new", F.when(before >= F.col("s") - 1, 0).otherwise(1)).withColumn("run", F.sum("new").over(by_doc))
    return runs.groupBy("doc_id", "run").agg(F.min("s").alias("span_start"), F.max("e").alias("span_end")).select("doc_id", "span_start", "span_end")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(table(spark, sf_dir, "documents"))


def p10_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document that shares anything: spans, shared characters and their part of the text."""
    docs = table(spark, sf_dir, "documents")
    s = shared_spans(docs).groupBy("doc_id").agg(F.count(F.lit(1)).alias("spans"), F.sum(F.col("span_end") - F.col("span_start") + 1).alias("shared_chars"))
    return s.join(docs.select("doc_id", F.length("text").cast("bigint").alias("chars")), "doc_id").withColumn("share", F.round(F.col("shared_chars") / F.col("chars"), 6))


def p10_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans, in their original offsets, that go if of each shared stretch only the earliest document keeps it."""
    return shared_spans(table(spark, sf_dir, "documents"), later=True)


_CTE = """
WITH w AS (SELECT doc_id, k, substr(text, k, 200) AS s FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS k FROM documents WHERE length(text) >= 200)),
d AS (SELECT s, min(doc_id) AS lo FROM w GROUP BY s HAVING min(doc_id) <> max(doc_id)), h AS (SELECT doc_id, k AS a, k + 199 AS b FROM w JOIN d USING (s) WHERE {}),
r AS (SELECT *, CASE WHEN max(b) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= a - 1 THEN 0 ELSE 1 END AS fresh FROM h),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a) AS n FROM r),
f AS (SELECT doc_id, min(a)::BIGINT AS span_start, max(b)::BIGINT AS span_end FROM g GROUP BY doc_id, n)
"""
SQL = {
    "p10_found": _CTE.format("true") + "SELECT * FROM f",
    "p10_removed": _CTE.format("doc_id > lo") + "SELECT * FROM f",
    "p10_share": _CTE.format("true") + "SELECT doc_id, spans, shared_chars, length(text)::BIGINT AS chars, round(shared_chars / length(text), 6) AS share FROM (SELECT doc_id, count(*) AS spans, sum(span_end - span_start + 1)::BIGINT AS shared_chars FROM f GROUP BY 1) JOIN documents USING (doc_id)",
}
