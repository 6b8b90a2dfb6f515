"""Missing or wrong document language labels (problem 7): a byte convolutional network.

Filters of several widths over the bytes of a text, maximum pooling over windows of fixed
length and a softmax, trained in numpy on the labelled samples. Applied to a text, every word
gets the window around it; the best path through the windows, at a price for each change of
language, gives the stretches of one language, each with a confidence.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .garbled import mend

LANGS = ["de", "en", "fi", "no", "pl", "sv"]
# Usual notations of the languages; a region may follow.
NOTATIONS = {
    "de": ["de", "deu", "ger", "german"], "en": ["en", "eng", "english"], "fi": ["fi", "fin", "finnish"],
    "no": ["no", "nor", "nb", "nob", "nn", "nno", "norwegian"], "pl": ["pl", "pol", "polish"], "sv": ["sv", "swe", "swedish"],
}
#: Bytes of a window and how many of them lie before the word.
WINDOW, BEFORE = 32, 10
WIDTHS, EMBED, FILTERS = (2, 3, 4, 5), 12, 32
#: Labelled rows that training reads at most, and passes over them.
SAMPLE_BOUND, EPOCHS = 20_000, 24
#: Price of a change of language along a text, in units of log probability; words a stretch has at least.
CHANGE, LEAST_WORDS = 11.0, 4
#: A text with fewer words of letters only is codes and numbers, no text in a language.
TEXT_WORDS = 2

# Fixed value: the letters of the six alphabets and of loan words in them; a word with any other is a foreign word.
_WORD = re.compile(r"[a-zåäöæøüßąćęłńóśźżéèáàõôîû]+(?:['’-][a-zåäöæøüßąćęłńóśźżéèáàõôîû]+)*", re.I)


def content(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The words in lower case, and where each stands; words that hold a digit or a foreign letter are left out."""
    words, at = [], []
    for m in re.finditer(r"[^\W_]+(?:['’-][^\W_]+)*", text):
        w = m.group()
        if _WORD.fullmatch(w) and len(w) > 1:
            words.append(w.lower())
            at.append(m.span())
    return words, at


def _strip(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).translate(str.maketrans("łøæ", "loa")).replace("ß", "ss")


class Network:
    """The weights; ``train`` fits them, ``windows`` gives log probabilities of windows of a text."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.rng = r
        self.p = {"embed": r.normal(0, 0.3, (256, EMBED))}
        for w in WIDTHS:
            self.p[f"w{w}"] = r.normal(0, np.sqrt(2 / (w * EMBED)), (w * EMBED, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p["out"] = r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(LANGS)))
        self.p["bias"] = np.zeros(len(LANGS))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def train(self, texts: list[str], langs: list[str]) -> Network:
        """Adam on random windows of each text; a third of the texts of a pass loses its accents."""
        lines = [" ".join(content(t)[0]) for t in texts]
        y_all = np.array([LANGS.index(x) for x in langs])
        state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        step = 0
        for epoch in range(EPOCHS):
            xs, ys = [], []
            for t, y in zip(lines, y_all):
                for _ in range(6):
                    raw = (_strip(t) if self.rng.random() < 0.3 else t).encode()
                    at = int(self.rng.integers(-BEFORE, max(1, len(raw) - WINDOW // 2)))
                    piece = raw[max(0, at) : at + int(self.rng.integers(16, WINDOW + 1))]
                    xs.append(np.frombuffer((b"\0" * max(0, -at) + piece).ljust(WINDOW, b"\0")[:WINDOW], np.uint8))
                    ys.append(y)
            x, y = np.array(xs), np.array(ys)
            order = self.rng.permutation(len(x))
            rate = 0.004 * (1 - epoch / EPOCHS) + 0.0003
            for i in range(0, len(x), 128):
                step += 1
                self._step(x[order[i : i + 128]], y[order[i : i + 128]], state, step, rate)
        return self

    def _step(self, x: np.ndarray, y: np.ndarray, state: dict, step: int, rate: float) -> None:
        p, n = self.p, len(x)
        e = p["embed"][x]
        pooled, keep = [], {}
        for w in WIDTHS:
            cols = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(n, WINDOW - w + 1, w * EMBED)
            z = cols @ p[f"w{w}"] + p[f"b{w}"]
            best = z.argmax(1)
            top = np.take_along_axis(z, best[:, None], 1)[:, 0]
            keep[w] = (cols, best, top)
            pooled.append(np.maximum(top, 0))
        h = np.concatenate(pooled, 1)
        mask = (self.rng.random(h.shape) > 0.3).astype(np.float32) / 0.7
        h = h * mask
        s = h @ p["out"] + p["bias"]
        s = np.exp(s - s.max(1, keepdims=True))
        s /= s.sum(1, keepdims=True)
        s[np.arange(n), y] -= 1
        s /= n
        g = {"out": h.T @ s, "bias": s.sum(0), "embed": np.zeros_like(p["embed"])}
        dh = (s @ p["out"].T) * mask
        for k, w in enumerate(WIDTHS):
            cols, best, top = keep[w]
            d = dh[:, k * FILTERS : (k + 1) * FILTERS] * (top > 0)
            picked = cols[np.arange(n)[:, None], best]  # n, filters, w*embed
            g[f"w{w}"] = np.einsum("nfc,nf->cf", picked, d)
            g[f"b{w}"] = d.sum(0)
            back = d[:, :, None] * p[f"w{w}"].T[None]
            for j in range(w):
                np.add.at(g["embed"], x[np.arange(n)[:, None], best + j], back[:, :, j * EMBED : (j + 1) * EMBED])
        for k, v in g.items():
            m, q = state[k]
            m *= 0.9
            m += 0.1 * v
            q *= 0.999
            q += 0.001 * v * v
            p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)

    def tables(self) -> dict[int, np.ndarray]:
        """For each width, what each byte adds to each filter at each place: embedding and filter in one."""
        return {w: np.stack([self.p["embed"] @ self.p[f"w{w}"][j * EMBED : (j + 1) * EMBED] for j in range(w)]) for w in WIDTHS}


class Reader:
    """A trained network ready to read texts."""

    def __init__(self, net: Network):
        self.t, self.p = net.tables(), net.p

    def windows(self, raws: list[bytes], starts: list[list[int]]) -> list[np.ndarray]:
        """Log probabilities (words × languages) of the windows that begin ``BEFORE`` bytes ahead of each start."""
        pad = b"\0" * (WINDOW + BEFORE)
        base, parts, n = [], [], 0
        for r in raws:
            parts += [pad[:BEFORE], r, pad[: WINDOW + 8]]
            base.append(n)
            n += BEFORE + len(r) + WINDOW + 8
        x = np.frombuffer(b"".join(parts), np.uint8)
        at = np.concatenate([np.array(s, np.int64) + b for s, b in zip(starts, base)]) if starts else np.empty(0, np.int64)
        h = np.empty((len(at), FILTERS * len(WIDTHS)), np.float32)
        for k, w in enumerate(WIDTHS):
            z = self.t[w][0][x[: len(x) - w + 1]]
            for j in range(1, w):
                z = z + self.t[w][j][x[j : len(x) - w + 1 + j]]
            span, want = 1, WINDOW - w + 1
            while span * 2 <= want:
                z = np.maximum(z[: len(z) - span], z[span:])
                span *= 2
            h[:, k * FILTERS : (k + 1) * FILTERS] = np.maximum(z[at], z[at + want - span]) + self.p[f"b{w}"]
        s = np.maximum(h, 0) @ self.p["out"] + self.p["bias"]
        s -= s.max(1, keepdims=True)
        s -= np.log(np.exp(s).sum(1, keepdims=True))
        cuts = np.cumsum([len(q) for q in starts])[:-1]
        return np.split(s, cuts)

    def read(self, texts: list[str]) -> list[list[tuple[str, float, int, int]]]:
        """The stretches of each text in reading order: (language, confidence, first and last offset)."""
        words = [content(t) for t in texts]
        raws, starts = [], []
        for ws, _ in words:
            enc = [w.encode() for w in ws]
            raws.append(b" ".join(enc))
            starts.append(list(np.cumsum([0] + [len(w) + 1 for w in enc[:-1]])) if enc else [])
        out = []
        for (ws, at), lp in zip(words, self.windows(raws, starts)):
            out.append([(LANGS[g], c, at[a][0], at[b - 1][1]) for g, c, a, b in _stretches(np.maximum(lp, -8.0))] if len(ws) >= TEXT_WORDS else [])
        return out


def _stretches(lp: np.ndarray) -> list[tuple[int, float, int, int]]:
    """The best path; runs of fewer words than a stretch has go to the neighbour that fits better."""
    n, k = lp.shape
    score, back = lp[0].copy(), np.zeros((n, k), np.int64)
    for i in range(1, n):
        top = int(score.argmax())
        stay = score >= score[top] - CHANGE
        back[i] = np.where(stay, np.arange(k), top)
        score = np.where(stay, score, score[top] - CHANGE) + lp[i]
    path = [int(score.argmax())]
    for i in range(n - 1, 0, -1):
        path.append(int(back[i][path[-1]]))
    path = path[::-1]
    runs = []
    for i, g in enumerate(path):
        if runs and runs[-1][0] == g:
            runs[-1][2] = i + 1
        else:
            runs.append([g, i, i + 1])
    while len(runs) > 1:
        short = min(range(len(runs)), key=lambda i: runs[i][2] - runs[i][1])
        if runs[short][2] - runs[short][1] >= LEAST_WORDS:
            break
        g, a, b = runs.pop(short)
        near = [r for r in (runs[short - 1] if short else None, runs[short] if short < len(runs) else None) if r]
        host = max(near, key=lambda r: lp[a:b, r[0]].sum())
        host[1], host[2] = min(host[1], a), max(host[2], b)
        merged = [runs[0]]
        for r in runs[1:]:
            if r[0] == merged[-1][0]:
                merged[-1][2] = r[2]
            else:
                merged.append(r)
        runs = merged
    return [(g, float(np.exp(lp[a:b, g]).mean()), a, b) for g, a, b in runs]


_TRAINED: dict[str, Network] = {}


def trained(samples: DataFrame) -> Network:
    """A network fitted on at most SAMPLE_BOUND rows of (sample_id, text, lang), the first by id; the fit is kept for the session."""
    rows = samples.where(F.col("lang").isin(LANGS) & F.col("text").isNotNull()).orderBy("sample_id").limit(SAMPLE_BOUND).select("text", "lang").collect()
    if not rows:
        raise ValueError("no labelled samples to train on")
    key = hashlib.sha256("\n".join(f"{r['lang']}\t{r['text']}" for r in rows).encode()).hexdigest()
    if key not in _TRAINED:
        _TRAINED[key] = Network().train([r["text"] for r in rows], [r["lang"] for r in rows])
    return _TRAINED[key]


def named_language(label: Column) -> Column:
    """The language that a label names in a usual notation, else null."""
    head = F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]+)(?:[-_ (].*)?$", 1)
    c = F.lit(None).cast("string")
    for code, forms in NOTATIONS.items():
        c = F.when(head.isin(forms), code).otherwise(c)
    return c


def languages(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """(result_id, text, label) to one row per stretch: result_id, no, stretches, lang_code, confidence, stretch, label_code.

    ``no`` counts from 1 in reading order and ``stretches`` is their number in the text. A text that has
    fewer than two words of letters only (codes, numbers, nothing) is ``und`` with confidence 0; a null
    text gives no row; other columns are dropped.
    """
    net = rows.sparkSession.sparkContext.broadcast(Reader(trained(samples)))  # a few hundred kB, fixed by its shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 500):
                some = b.iloc[at : at + 500]
                texts = [mend(t)[1] if not t.isascii() else t for t in some["text"]]
                out = []
                for i, lab, t, found in zip(some["result_id"], some["label_code"], texts, net.value.read(texts)):
                    if not found:
                        out.append((i, 1, 1, "und", 0.0, t, lab))
                    for no, (g, c, s, e) in enumerate(found, 1):
                        out.append((i, no, len(found), g, round(c, 4), t[s:e], lab))
                yield pd.DataFrame(out, columns=["result_id", "no", "stretches", "lang_code", "confidence", "stretch", "label_code"])

    src = rows.where(F.col("text").isNotNull()).select("result_id", "text", named_language(F.col("label")).alias("label_code"))
    return src.mapInPandas(run, "result_id bigint, no int, stretches int, lang_code string, confidence double, stretch string, label_code string")


def translation_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "translation_results").select("result_id", F.col("source_text").alias("text"), F.col("language").alias("label"))
    return languages(t, table(spark, sf_dir, "language_samples"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = translation_languages(spark, sf_dir).where("lang_code <> 'und'")
    return s.where((F.col("stretches") > 1) | F.col("label_code").isNull() | (F.col("label_code") != F.col("lang_code"))).select(
        "result_id", F.when(F.col("stretches") == 1, 0).otherwise(F.col("no")).cast("int").alias("segment_no"), "lang_code"
    )


def p7_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text and stretch with its language and the confidence that replaces the given one."""
    return translation_languages(spark, sf_dir).select("result_id", F.when(F.col("stretches") == 1, 0).otherwise(F.col("no")).cast("int").alias("segment_no"), "lang_code", "confidence", "stretch")
