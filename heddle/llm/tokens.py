"""Encoding of the whole corpus with a public byte-level tokenizer (problem 8).

Each partition encodes its own texts, so nothing is shuffled. The words of a batch that were
not met before become token-position rows in DuckDB; a recursive query joins neighbouring
tokens with the merge table and contracts every word's minimum-rank pair, leftmost first,
until no pair is left; ordered aggregation gives the ids of each word, and of each text.

All places of a word's minimum-rank pair are contracted in one step of the recursion. That
gives the same as one by one: a pair that a contraction creates holds the new token, whose
rank is higher, so none can come before the other places of the same pair. In a run of
overlapping places (a pair of one token with itself) every second one counts, from the left.
The recursion is keyed by word and position, so it holds one row per byte, whatever the steps.

A word of more than ``LONG`` bytes (a run of letters without a blank) is contracted in
overlapping pieces. Tokens are the encoding of a word exactly if each two neighbours are the
encoding of their own bytes, since no contraction looks further than its two neighbours. So two
pieces may be joined wherever both end a token at one byte and the tokens on both sides pass that
test; where no such byte is found the next piece begins at the end of a token of the one before.
"""

from __future__ import annotations

import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

#: Where the vocabulary files of public tokenizers lie; a parameter of every function here.
FOLDER = os.environ.get("HEDDLE_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the pattern by which this family of tokenizers cuts a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Rows sent to Python at a time, and words whose ids a worker remembers before it starts afresh.
BATCH_CHARS, REMEMBER = 2_000_000, 300_000
#: Bytes of new words that one recursive query takes, and words of a long text that are looked up at a time.
STEP_BYTES, SLICE = 300_000, 200_000
#: Words of more bytes are contracted in pieces of PIECE bytes, each of which reads LAP bytes of the next one too.
LONG, PIECE, LAP = 128, 64, 32

_STEP = """
WITH RECURSIVE state(w, pos, tok) USING KEY (w, pos) AS (
  SELECT w, pos, tok FROM fresh
  UNION ALL
  (WITH pair AS (SELECT s.w, s.pos, s.tok, lead(s.tok) OVER o AS nxt, row_number() OVER o AS rn FROM state s WHERE s.tok >= 0 WINDOW o AS (PARTITION BY s.w ORDER BY s.pos)),
   ranked AS (SELECT p.*, m.rank, m.id FROM pair p LEFT JOIN merges m ON m.a = p.tok AND m.b = p.nxt),
   least AS (SELECT *, min(rank) OVER (PARTITION BY w) AS best FROM ranked),
   live AS (SELECT *, rank IS NOT NULL AND rank = best AS hit FROM least WHERE best IS NOT NULL),
   run AS (SELECT *, rn - row_number() OVER (PARTITION BY w, hit ORDER BY rn) AS grp FROM live),
   odd AS (SELECT *, hit AND (tok <> nxt OR row_number() OVER (PARTITION BY w, hit, grp ORDER BY rn) % 2 = 1) AS merge FROM run),
   gone AS (SELECT *, coalesce(lag(merge) OVER (PARTITION BY w ORDER BY rn), false) AS eaten FROM odd)
   SELECT w, pos, CASE WHEN eaten THEN -1 WHEN merge THEN id ELSE tok END FROM gone)
)
SELECT w, list(tok ORDER BY pos) AS ids FROM state WHERE tok >= 0 GROUP BY w
"""


def _byte_letters() -> list[str]:
    """The letter by which the vocabulary file writes each byte: itself if it can be seen, else the next free one from 256."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(free)) for b in range(256)]


class Encoder:
    """The tokenizer of one worker: the merge table in DuckDB and the words met so far."""

    def __init__(self, file: str):
        import duckdb
        import regex

        model = json.load(open(file, encoding="utf-8"))["model"]
        vocab = model["vocab"]
        self.byte = [vocab[c] for c in _byte_letters()]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        merges = pa.table({"a": [vocab[a] for a, _ in pairs], "b": [vocab[b] for _, b in pairs], "rank": range(len(pairs)), "id": [vocab[a + b] for a, b in pairs]})
        self.con.execute("CREATE TABLE merges AS SELECT a::INT a, b::INT b, rank::INT rank, id::INT id FROM merges")
        self.find = regex.compile(PATTERN)
        letter = {c: b for b, c in enumerate(_byte_letters())}
        self.bytes = {i: bytes(letter[c] for c in t) for t, i in vocab.items() if all(c in letter for c in t)}
        self.known: dict[str, list[int]] = {}
        self.pieces: dict[bytes, list[int]] = {}

    def contract(self, raws: list[bytes]) -> list[list[int]]:
        """The ids of each byte string, in recursive queries of a bounded size each."""
        got: list[list[int]] = [[] for _ in raws]
        at = 0
        while at < len(raws):
            end, n = at, 0
            while end < len(raws) and (end == at or n + len(raws[end]) <= STEP_BYTES):
                n += len(raws[end])
                end += 1
            some = raws[at:end]
            size = np.array([len(x) for x in some])
            w = np.repeat(np.arange(len(some), dtype=np.int32), size)
            pos = np.arange(n, dtype=np.int32) - np.repeat(np.cumsum(size) - size, size).astype(np.int32)
            fresh = pa.table({"w": w, "pos": pos, "tok": np.array(self.byte, np.int32)[np.frombuffer(b"".join(some), np.uint8)]})  # noqa: F841
            for i, ids in self.con.execute(_STEP).fetchall() if n else []:
                got[at + i] = ids
            at = end
        return got

    def piece(self, raws: list[bytes]) -> None:
        """Have the ids of each byte string in ``pieces``."""
        new = sorted(set(raws) - self.pieces.keys())
        self.pieces.update(zip(new, self.contract(new)))

    def ends(self, ids: list[int], start: int) -> dict[int, int]:
        """Byte at which each token of a piece ends, with the number of tokens up to it; the start of the piece ends none."""
        return {int(e): k + 1 for k, e in enumerate(np.cumsum([len(self.bytes[i]) for i in ids]) + start)} | {start: 0}

    def neighbours(self, a: list[int], a_at: int, b: list[int], b_at: int, after: int) -> list[tuple[int, int, int]]:
        """(byte, tokens of ``a`` before it, tokens of ``b`` before it) wherever both end a token beyond ``after``."""
        x, y = self.ends(a, a_at), self.ends(b, b_at)
        return [(p, x[p], y[p]) for p in sorted(x.keys() & y.keys()) if p > after and x[p] and y[p] < len(b)]

    def fit(self, a: int, b: int) -> bool:
        return self.pieces.get(self.bytes[a] + self.bytes[b]) == [a, b]

    def ids(self, raw: bytes, s: int) -> list[int]:
        return self.pieces[raw[s : s + PIECE + LAP]]

    def prepare(self, raws: list[bytes]) -> None:
        """The pieces of long words, and the tests of their junctions, in as few queries as may be."""
        if len(self.pieces) > REMEMBER:
            self.pieces = {}
        self.piece([r[s : s + PIECE + LAP] for r in raws for s in range(0, len(r), PIECE)])
        tests = []
        for r in raws:
            for s in range(0, len(r) - PIECE, PIECE):
                a, b = self.ids(r, s), self.ids(r, s + PIECE)
                tests += [self.bytes[a[x - 1]] + self.bytes[b[y]] for _, x, y in self.neighbours(a, s, b, s + PIECE, s)]
        self.piece(tests)

    def long_word(self, raw: bytes) -> list[int]:
        size = PIECE + LAP
        ids = lambda s: self.ids(raw, s)
        out: list[int] = []
        here, used, base = 0, 0, 0  # start of the present piece, tokens of it that are out, byte at which they end
        while here + size < len(raw):
            a, step = ids(here), None
            t = (here + size - LAP) // PIECE * PIECE
            if t > here:
                step = next(((t, x, y, p) for p, x, y in self.neighbours(a, here, ids(t), t, base) if self.fit(a[x - 1], ids(t)[y])), None)
            if step is None:
                for p, x in sorted(self.ends(a, here).items(), reverse=True):
                    if base < p <= here + size - LAP // 2:
                        self.piece([raw[p : p + size]])
                        first = ids(p)[0]
                        self.piece([self.bytes[a[x - 1]] + self.bytes[first]])
                        if self.fit(a[x - 1], first):
                            step = (p, x, 0, p)
                            break
            if step is None:
                return self.contract([raw])[0]
            out += a[used : step[1]]
            here, _, used, base = step
        return out + ids(here)[used:]

    def learn(self, words: list[str]) -> None:
        raws = [w.encode("utf-8", "replace") for w in words]
        short = [k for k, r in enumerate(raws) if len(r) <= LONG]
        for k, ids in zip(short, self.contract([raws[k] for k in short])):
            self.known[words[k]] = ids
        some, n = [], 0
        for k, r in enumerate(raws):
            if len(r) > LONG:
                some.append(k)
                n += len(r)
            if some and (n > STEP_BYTES or k == len(raws) - 1):
                self.prepare([raws[i] for i in some])
                self.known.update((words[i], self.long_word(raws[i])) for i in some)
                some, n = [], 0

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a text's words are looked up in slices, so that a very long one needs no more memory than its ids."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        short = [k for k, t in enumerate(texts) if t and len(t) <= BATCH_CHARS]
        cut = [self.find.findall(texts[k]) for k in short]
        self.have({x for ws in cut for x in ws})
        for k, ws in zip(short, cut):
            out[k] = np.fromiter((i for x in ws for i in self.known[x]), np.int32)
        for k, t in enumerate(texts):
            if t and len(t) > BATCH_CHARS:
                found, some = (m.group() for m in self.find.finditer(t)), []
                while ws := list(itertools.islice(found, SLICE)):
                    self.have(set(ws))
                    some.append(np.fromiter((i for x in ws for i in self.known[x]), np.int32))
                out[k] = np.concatenate(some)
        return out

    def have(self, words: set[str]) -> None:
        if len(self.known) > REMEMBER:
            self.known = {}
        self.learn(sorted(words - self.known.keys()))


_ENCODERS: dict[str, Encoder] = {}


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", file: str | None = None) -> DataFrame:
    """(doc_id, text) to (doc_id, ids): the token ids of each text, without special tokens.

    A null and an empty text both give the empty list; strings that look like special tokens are
    ordinary text; words and texts of any length are taken whole; ids and repeated rows pass as
    they are; other columns are dropped.
    """
    file = file or os.path.join(FOLDER, "byte_bpe_50k.json")
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _ENCODERS.get(file) or _ENCODERS.setdefault(file, Encoder(file))
        for b in batches:
            texts = b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, n = at, 0
                while end < len(texts) and (end == at or n + len(texts[end] or "") <= BATCH_CHARS):
                    n += len(texts[end] or "")
                    end += 1
                got = enc.encode(texts[at:end])
                ids = pa.ListArray.from_arrays(np.cumsum([0, *map(len, got)]).astype(np.int32), np.concatenate(got))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), ids], ["id", "ids"])
                at = end

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
