"""Evaluation texts leaking into training text (problem 9), by q-gram lemma filtering.

Texts and items are reduced to their words in lower case with one blank between, so whatever
stood between the words is gone. A stretch of ``least`` letters that occurs with at most
``edits`` edits shares at least ``least + 1 - q (edits + 1)`` q-grams with its source, all of
them within ``edits`` diagonals (q-gram lemma). The corpus is read once, whatever the number of
items: the q-grams of all items lie in a bitmap of fixed size, and only the parts of a text
in which enough q-grams lie close enough together to be of some item go on. The q-grams of the
distinct parts are joined with those of the items and counted in bands of diagonals that overlap;
a band that reaches the bound of its item becomes a region, and a region is verified by banded
alignment. For pN_found an exact check of the words in a row follows inside the verified pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import attach_by_key
from ..session import cut, parts, table

#: The bitmap of the items' q-grams has two to this power bits (8 MB), however many items there are; more items only let more parts pass.
BITS = 26
#: Characters that are hashed at a time.
CHUNK = 400_000
MULT = np.uint64(0x9E3779B97F4A7C15)


def word_line(c: Column) -> Column:
    """The words of a text, in lower case with one blank between and none around."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit value for each q-gram; equal q-grams get equal values (unequal ones only cost a failed verification)."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(q):
            h = (h ^ (codes[i : i + n] + np.uint64(1))) * MULT
            h ^= h >> np.uint64(29)
    return h


def _shortest(line: str, run: int) -> int:
    """Letters of the shortest stretch of ``run`` words; 0 if there are fewer words."""
    w = line.split(" ")
    size = np.cumsum([0] + [len(x) + 1 for x in w])
    return int((size[run:] - size[:-run]).min()) - 1 if len(w) >= run else 0


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < CHUNK):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


class Filter:
    """The bitmap of the items' q-grams, and how many of them a stretch of ``least`` letters has at least within ``edits``."""

    def __init__(self, words: np.ndarray, bits: int, q: int, least: int, edits: int):
        self.words, self.mask, self.q = words, np.uint64((1 << bits) - 1), q
        self.bound, self.width = max(1, least + 1 - q * (edits + 1)), least + edits - q + 1

    def hits(self, grams: np.ndarray) -> np.ndarray:
        at = grams & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    def parts(self, texts: list[str]) -> Iterator[tuple[int, str]]:
        """(number of the text, part) of the parts, in whole words, in which each place lies in a stretch with enough hits."""
        whole = "\x00".join(texts)
        start = np.cumsum([0] + [len(t) + 1 for t in texts])
        h = _grams(_codes(whole), self.q)
        if not len(h):
            return
        hit = np.flatnonzero(self.hits(h))
        if len(hit) < self.bound:
            return
        # Stretches from one hit to the (bound-1)-th after it that are short enough and of one text.
        first, last = hit[: len(hit) - self.bound + 1], hit[self.bound - 1 :]
        text = np.searchsorted(start, first, "right") - 1
        good = (last - first < self.width) & (last < start[text + 1] - 1)
        first, last, text = first[good], last[good], text[good]
        if not len(first):
            return
        new = np.flatnonzero(np.concatenate([[True], (first[1:] > last[:-1] + self.q) | (text[1:] != text[:-1])]))
        for a, b in zip(new, [*(new[1:] - 1), len(first) - 1]):
            t = int(text[a])
            begin, end = int(first[a] - start[t]), int(last[b] - start[t]) + self.q
            line = texts[t]
            # What lies before the first and behind the last hit may belong to the stretch as well: an edit spoils q grams.
            begin, end = max(0, begin - self.width), end + self.width
            begin = line.rfind(" ", 0, begin) + 1
            end = line.find(" ", end)
            yield t, line[begin : end if end >= 0 else len(line)]


def banded_match(a: str, b: str, shift: int, edits: int, least: int) -> bool:
    """Whether a stretch of ``a`` of at least ``least - edits`` letters aligns with one of ``b`` within ``edits`` edits, near the diagonal ``shift``.

    Runs along each diagonal of the band are extended with at most ``edits`` jumps to a
    neighbouring diagonal or over a letter: the longest stretch for each number of edits.
    """
    width = 2 * edits + 1
    la, lb = len(a), len(b)
    need = least - edits
    far = [[0] * (edits + 1) for _ in range(width + 2)]  # letters matched so far, per diagonal and edits, ending at the present row
    for i in range(la):
        new = [[0] * (edits + 1) for _ in range(width + 2)]
        for d in range(width):
            j = i + shift + d - edits
            if not 0 <= j < lb:
                continue
            here, left, up = far[d + 1], new[d], far[d + 2]
            for e in range(edits + 1):
                if a[i] == b[j]:
                    best = here[e] + 1
                elif e:
                    best = max(here[e - 1] + 1, left[e - 1], up[e - 1])
                else:
                    best = 0
                new[d + 1][e] = best
                if best >= need:
                    return True
        far = new
    return False


def _row_windows(line: str, run: int) -> set[str]:
    w = line.split(" ")
    return {" ".join(w[i : i + run]) for i in range(len(w) - run + 1)}


def _exact(line: str, doc: str, run: int) -> bool:
    padded = f" {doc} "
    return any(f" {x} " in padded for x in _row_windows(line, run))


def _item_rows(run: int):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(least=[_shortest(x, run) for x in b["line"]]).query("least > 0")

    return read


def _gram_rows(key: str, q: int, keep: Filter | None = None):
    """Rows (key, gram, place) of the q-grams of each line; with a filter only those it lets pass."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, lines = b.column(0), b.column(1).to_pylist()
            for k, t in enumerate(lines):
                h = _grams(_codes(t), q)
                at = np.flatnonzero(keep.hits(h)) if keep else np.arange(len(h))
                own = pa.array([keys[k].as_py()] * len(at), keys.type)
                yield pa.RecordBatch.from_arrays([own, pa.array(h[at].view(np.int64)), pa.array(at.astype(np.int32))], [key, "gram", "place"])

    return read


def leaks(docs: DataFrame, items: DataFrame, run: int = 12, edits: int = 1, exact: bool = True, bits: int = BITS) -> DataFrame:
    """(doc_id, text) and (item_id, text) to (doc_id, item_id) of each document with a passage of an item.

    A passage is ``run`` words of the item in a row; with ``exact`` they must stand in a row in
    the document, else ``edits`` letters may differ. Whole texts are scanned, once for all items.
    Null texts and items of fewer words give nothing; a pair comes once even for repeated rows;
    other columns are dropped.
    """
    spark = docs.sparkSession
    lines = docs.where(F.col("text").isNotNull()).select("doc_id", word_line(F.col("text")).alias("line")).where(F.length("line") > 0)
    numbered = items.where(F.col("text").isNotNull()).select("item_id", word_line(F.col("text")).alias("line"))
    known = cut(numbered.distinct().mapInPandas(_item_rows(run), "item_id bigint, line string, least int"))
    least = known.agg(F.min("least")).first()[0]
    if least is None:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint")
    q = max(1, min(10, least // (edits + 2)))
    grams = cut(known.select("item_id", "line").mapInArrow(_gram_rows("item_id", q), "item_id bigint, gram bigint, place int"))
    bit = F.col("gram").bitwiseAND((1 << bits) - 1)
    set_bits = grams.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, int((gram & {(1 << bits) - 1}L) & 63))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    words = np.zeros(1 << bits - 6, np.uint64)
    words[set_bits["w"].to_numpy(np.int64)] = set_bits["b"].to_numpy(np.int64).view(np.uint64)
    keep = spark.sparkContext.broadcast(Filter(words, bits, q, least, edits))  # of fixed size

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in _chunks(texts):
                got = [(keys[i + t], part) for t, part in keep.value.parts(texts[i:j])]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.int64()), pa.array([x for _, x in got], pa.string())], ["doc_id", "part"])

    found = cut(lines.mapInArrow(scan, "doc_id bigint, part string").select("doc_id", F.unhex(F.md5("part")).alias("key"), "part"))
    parts_once = cut(found.groupBy("key").agg(F.min("part").alias("part")))
    marks = parts_once.mapInArrow(lambda batches: _gram_rows("key", q, keep.value)(batches), "key binary, gram bigint, place int")
    posted = attach_by_key(marks, grams.join(known.select("item_id", "least"), "item_id").select("item_id", "gram", "least", F.col("place").alias("off")), ["gram"], ["key", "place"])
    width = edits + 1
    band = F.floor(F.col("diag") / width)
    # Each diagonal lies in its own band and in the one before, which is two widths broad.
    banded = posted.withColumn("diag", F.col("place") - F.col("off")).select("key", "item_id", "least", "place", "diag", F.explode(F.array(band, band - 1)).alias("band"))
    counted = banded.groupBy("key", "item_id", "least", "band").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"), F.max("place").alias("last"), F.min("diag").alias("low"), F.max("diag").alias("high"))
    regions = counted.where(F.col("n") >= F.greatest(F.lit(1), F.col("least") + 1 - q * (edits + 1))).select("key", "item_id", "least", "n", "first", "last", F.expr("int((low + high) / 2)").alias("diag"))
    full = attach_by_key(attach_by_key(regions, known.select("item_id", "line"), ["item_id"], ["key"]), parts_once, ["key"], ["item_id"])
    full = full.repartition(parts(spark), "key", "item_id").sortWithinPartitions("key", "item_id", F.desc("n"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = None  # the pair that is settled already; its other regions follow it
        for b in batches:
            got = []
            for key, item, size, first, diag, last, line, part in zip(*(b[c] for c in ("key", "item_id", "least", "first", "diag", "last", "line", "part"))):
                if (key, item) == done:
                    continue
                begin = max(0, first - size - q)
                if banded_match(part[begin : last + 2 * q + size], line, begin - diag, edits + 1, size):
                    done = (key, item)
                    if not exact or _exact(line, part, run):
                        got.append((key, item))
            yield pd.DataFrame(got, columns=["key", "item_id"])

    proved = full.mapInPandas(verify, "key binary, item_id bigint")
    return attach_by_key(found.select("doc_id", "key"), proved, ["key"], ["doc_id"]).select("doc_id", "item_id").distinct()


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


SQL = {
    "p9_found": r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
g AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i WHERE len(w) >= 12)),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d WHERE len(w) >= 12))
SELECT DISTINCT doc_id, item_id FROM h JOIN g USING (g)"""
}
