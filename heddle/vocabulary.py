"""The controlled vocabulary and the text operators that need it; it is a parameter, a small default is shipped.

Order-dependent steps run as Arrow functions over the distinct texts and are joined back, since a text recurs on many lines.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.skew import attach_by_key

_WORD = re.compile(r"[^\W_]+")


def on_distinct(rows: DataFrame, key: str, fn: Callable[[str], tuple], out: str, names: list[str]) -> DataFrame:
    """``fn`` once per distinct ``text``, joined back to (key, text) rows without sending a hot text to one task; null texts count as empty."""
    rows = rows.select(key, F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(t, *fn(t)) for t in b["text"]], columns=["text", *names])

    dim = rows.select("text").distinct().mapInPandas(run, f"text string, {out}")
    return attach_by_key(rows, dim, ["text"], [key]).select(key, *names)


@dataclass(frozen=True)
class Vocabulary:
    """Phrases and terms by language, parts of compounds, marker words; keys folded, targets in English."""

    version: str
    phrases: dict[str, dict[str, str]]
    terms: dict[str, dict[str, str]]
    parts: dict[str, dict[str, str]]
    service_markers: list[str]
    material_markers: list[str]
    generic: list[str]
    stopwords: dict[str, list[str]]
    letters: dict[str, str]

    @staticmethod
    def load(path: str | Path) -> Vocabulary:
        """From a JSON file of the documented shape; a missing or broken file gives an empty vocabulary."""
        try:
            d = json.loads(Path(path).read_text(encoding="utf-8"))
        except (OSError, ValueError):
            d = {}
        return Vocabulary(d.get("version", ""), d.get("phrases", {}), d.get("terms", {}), d.get("compound_parts", {}), d.get("service_markers", []), d.get("material_markers", []), d.get("generic", []), d.get("stopwords", {}), d.get("letters", {}))

    @property
    def stop(self) -> list[str]:
        return sorted({w for ws in self.stopwords.values() for w in ws})

    def detect_text(self, text: str) -> tuple[str, float]:
        """Letters of a language 0.6 each up to 3, its small words 1.4, its vocabulary 2.0; plain ASCII speaks 0.8 for English."""
        from .pyfold import fold

        low = text.lower()
        words = _WORD.findall(fold(text))
        if not words:
            return "und", 0.0
        scores = dict.fromkeys([*self.letters, *self.stopwords], 0.0)
        for lang in scores:
            scores[lang] += min(3.0, 0.6 * sum(low.count(c) for c in self.letters.get(lang, "")))
            scores[lang] += 1.4 * sum(w in self.stopwords.get(lang, ()) for w in words)
            scores[lang] += 2.0 * sum(w in self.terms.get(lang, ()) for w in words)
        if text.isascii():
            scores["en"] = scores.get("en", 0.0) + 0.8
        ranked = sorted(scores.items(), key=lambda kv: (-kv[1], kv[0]))
        best, second = ranked[0][1], ranked[1][1] if len(ranked) > 1 else 0.0
        conf = round(min(1.0, (best - second) / max(best, 1.0) + 0.25), 3) if best > 0 else 0.0
        return ("und", conf) if best == 0 or (len(words) == 1 and conf < 0.5) else (ranked[0][0], conf)

    def split_word(self, word: str, lang: str | None = None) -> str | None:
        """A compound into English parts, longest known part first, one unknown letter allowed between parts; null below two parts."""
        table = self.parts.get(lang or "") or {k: v for d in self.parts.values() for k, v in d.items()}
        if len(word) < 8:
            return None
        at, found = 0, []
        while at < len(word):
            for end in range(len(word), at + 1, -1):
                if word[at:end] in table:
                    found.append(table[word[at:end]])
                    at = end
                    break
            else:
                if found and at + 1 < len(word) and any(word[at + 1 : e] in table for e in range(at + 3, len(word) + 1)):
                    at += 1
                    continue
                return None
        found = [x for x in found if x]
        return " ".join(found) if len(found) >= 2 else None

    def render_text(self, text: str) -> tuple[str, float, str]:
        """(English, coverage, unresolved words): phrases longest first, then word by word: code, term, compound, else kept."""
        from .pyfold import fold

        lang, _ = self.detect_text(text)
        line, emitted, out, missing, total = f" {fold(text)} ", 0, [], [], 0
        for src, to in sorted(self.phrases.get(lang, {}).items(), key=lambda kv: (-len(kv[0]), kv[0])):
            pattern = rf"(?<!\w){re.escape(src)}(?!\w)"
            if len(src) >= 5 and re.search(pattern, line):
                emitted += len(src.split())
                line = re.sub(pattern, f" \x01{to}\x01 ", line)
        terms = self.terms.get(lang, {})
        for piece in re.split(r"(\x01[^\x01]*\x01)", line):
            if piece.startswith("\x01"):
                out.append(piece.strip("\x01"))
                continue
            for w in _WORD.findall(piece):
                if any(c.isdigit() for c in w) or len(w) <= 2:
                    out.append(w)
                    continue
                total += 1
                got = terms.get(w) or (w if lang == "en" else None) or self.split_word(w, lang)
                out.append(got or w)
                if got:
                    emitted += 1
                else:
                    missing.append(w)
        count = total + sum(len(s.split()) for s in self.phrases.get(lang, {}) if len(s) >= 5 and re.search(rf"(?<!\w){re.escape(s)}(?!\w)", fold(text)))
        return " ".join(out), round(min(count, emitted) / count, 4) if count else 1.0, " ".join(dict.fromkeys(missing))

    def compose_text(self, text: str, context: str, most: int = 12) -> tuple[str, str]:
        """(description, basis): fragments longest first, those whose words were all said left out, up to ``most`` words."""
        from .pyfold import fold

        for basis, source in (("description", text), ("context", context)):
            said, out, seen = set(), [], set()
            frags = [[w for w in _WORD.findall(f) if not (any(c.isdigit() for c in w) or len(w) <= 2) and fold(w) not in self.stop] for f in re.split(r"[,;:/|–—]|\s-\s", source)]
            for f in sorted((f for f in frags if f), key=lambda f: (-len(f), " ".join(f).lower())):
                words = frozenset(fold(w) for w in f)
                if words in seen or words <= said or sum(map(len, out)) + len(f) > most:
                    continue
                seen.add(words)
                said |= words
                out.append(f)
            if out:
                s = ", ".join(" ".join(f).lower() for f in out)
                return s[0].upper() + s[1:], basis
        return "", "none"

    def detect(self, rows: DataFrame, key: str) -> DataFrame:
        return on_distinct(rows, key, self.detect_text, "lang string, confidence double", ["lang", "confidence"])

    def render(self, rows: DataFrame, key: str) -> DataFrame:
        return on_distinct(rows, key, self.render_text, "english string, coverage double, unresolved string", ["english", "coverage", "unresolved"])

    def split(self, words: DataFrame) -> DataFrame:
        def run(batches):
            for b in batches:
                yield pd.DataFrame({"text": b["text"], "parts": [self.split_word(w) for w in b["text"]]})

        return words.mapInPandas(run, "text string, parts string").where("parts IS NOT NULL")

    def compose(self, rows: DataFrame, key: str) -> DataFrame:
        both = rows.select(key, F.concat(F.coalesce("text", F.lit("")), F.lit("\x1f"), F.coalesce("context", F.lit(""))).alias("text"))
        return on_distinct(both, key, lambda t: self.compose_text(*t.split("\x1f", 1)), "description string, basis string", ["description", "basis"])


@lru_cache(1)
def default() -> Vocabulary:
    return Vocabulary.load(Path(__file__).parent / "resources" / "vocabulary.json")
