"""Garbled text from a wrong character encoding (problem 1).

For every letter or sign that the texts may hold and every pair of encodings, the sequence
that results from writing in the one and reading in the other is computed beforehand. Those
of two characters or more go into a multi-pattern automaton; only the spans it matches are
replaced, so correct text beside them stays. One letter read as another single letter is no
proof by itself (an ê may be right): it counts if it stands where no language has it (a sign
between two letters, a foreign script inside a word), or if the word it would come from is
known to the corpus and more frequent there than the word as it stands.

Letters of other scripts (Greek, Cyrillic, Chinese and so on) have an automaton of their own.
A lone sequence of it may be right where it stands, so these count in runs that touch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import attach_by_key
from ..session import cut, table

# Letters beyond ASCII of the six languages, and signs met in such texts.
LETTERS = "åäöæøüßąćęłńóśźżÅÄÖÆØÜĄĆĘŁŃÓŚŹŻ"
#: Letters of other languages that names and loan words bring in.
GUESTS = "ÂÃÇÊÈÉËÎÏÔÕÛÙÐÞÑâãçêèéëîïôõûùðþñŒœ"
SIGNS = "°²³½¼¾±µ€№–—‘’“”„…•×·§«»©®™Ωφπ≤≥≈→√\xa0"
# First and last letters of other scripts.
SCRIPTS = {"greek": (0x370, 0x3FF), "cyrillic": (0x400, 0x52F), "hebrew": (0x590, 0x5FF), "arabic": (0x600, 0x6FF), "kana": (0x3000, 0x30FF), "han": (0x4E00, 0x9FFF), "hangul": (0xAC00, 0xD7A3)}
#: Written in UTF-8 and read as one of these.
READ_AS = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp437", "cp850", "cp852", "cp1251", "mac_roman", "cp866", "koi8-r", "cp1257", "cp1254")
#: Written in the first and read as the second, a letter for a letter.
ONE_BYTE = [(w, r) for w in ("cp1250", "cp1252", "iso8859-2", "mac_roman", "cp850") for r in ("cp1252", "cp437", "cp850", "cp1250", "mac_roman", "cp1251", "cp866", "koi8-r") if w != r]
SPACE_LIKE = "\xa0–—‘’“”„…•‚"
EDGES = "\"'“”„.!?[]{}–-"
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]")


def read_wrongly(raw: bytes, encoding: str) -> str:
    """Decode, letting bytes that the encoding leaves open pass as control characters, as readers do."""
    out = []
    for b in raw:
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


def sequences() -> dict[str, dict[str, str]]:
    """Garbled sequence to what it stands for under each encoding, read wrongly once or twice."""
    targets = dict.fromkeys([*LETTERS, *SIGNS, *map(chr, [*range(0xA0, 0x180)])])
    found: dict[str, dict[str, str]] = {}
    for enc in READ_AS:
        for c in targets:
            once = read_wrongly(c.encode("utf-8"), enc)
            for seq, way in ((once, enc), (read_wrongly(once.encode("utf-8"), enc), enc + " twice")):
                if len(seq) > 1 and any(ord(x) > 127 for x in seq):
                    found.setdefault(seq, {}).setdefault(way, c)
    return found


@lru_cache(1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for k, v in sequences().items():
        a.add_word(k, (k, v))
    a.make_automaton()
    return a


@lru_cache(1)
def _scripts():
    """The sequences of other scripts under every encoding, each with the letter it stands for."""
    import ahocorasick

    a = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for enc in READ_AS:
        letter = [read_wrongly(bytes([b]), enc) for b in range(256)]
        for lo, hi in SCRIPTS.values():
            for c in range(lo, hi + 1):
                seq = "".join(letter[b] for b in chr(c).encode("utf-8"))
                if not a.exists(seq):
                    a.add_word(seq, c)
    a.make_automaton()
    return a


def _script(c: int) -> str:
    return next(k for k, (lo, hi) in SCRIPTS.items() if lo <= c <= hi)


@lru_cache(1)
def _bytes() -> list[dict[str, int]]:
    return [{read_wrongly(bytes([b]), enc): b for b in range(256)} for enc in READ_AS]


def _reread(run: str) -> str | None:
    """A run under the encoding that makes the most of it letters of one script; one sequence may stand for two letters under two encodings."""
    found = []
    for back in _bytes():
        try:
            t = bytes(back[c] for c in run).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        kinds = [next((k for k, (lo, hi) in SCRIPTS.items() if lo <= ord(c) <= hi), "") for c in t if not c.isascii()]
        east = sum(k in ("kana", "han") for k in kinds)
        found.append((max(east, *(kinds.count(k) for k in SCRIPTS)) - len(kinds), -sum(c.isascii() for c in t), t))
    return max(found)[2] if found else None


def mend_scripts(text: str) -> str:
    """The text with garbled runs of other scripts mended: sequences that touch, and those beside them with no letter between."""
    spans = [(end - len(chr(c).encode("utf-8")) + 1, end + 1, c) for end, c in _scripts().iter_long(text)]
    groups: list[list[tuple[int, int, int]]] = []
    for s in spans:
        gap = text[groups[-1][-1][1] : s[0]] if groups else "x"
        if groups and gap.isascii() and not re.search("[A-Za-z]", gap):
            groups[-1].append(s)
        else:
            groups.append([s])
    out, at = [], 0
    for g in groups:
        if any(x[1] == y[0] and _script(x[2]) == _script(y[2]) for x, y in zip(g, g[1:])):
            out += [text[at : g[0][0]], _reread(text[g[0][0] : g[-1][1]]) or text[g[0][0] : g[-1][1]]]
            at = g[-1][1]
    return "".join([*out, text[at:]])


@lru_cache(1)
def _single() -> list[dict[str, str]]:
    """For each pair of one-byte encodings: wrong character to right letter or sign."""
    maps: list[dict[str, str]] = []
    for w, r in ONE_BYTE:
        m = {}
        for c in LETTERS + GUESTS + "°²½±µØ–€":
            try:
                g = read_wrongly(c.encode(w), r)
            except UnicodeEncodeError:
                continue
            if g != c and ord(g[0]) > 127:
                m[g] = c
        maps.append(m)
    return maps


@lru_cache(1)
def _suspects() -> re.Pattern:
    return re.compile("[" + re.escape("".join(sorted({g for m in _single() for g in m} - set(LETTERS)))) + "]")


def _sure(text: str, i: int) -> bool:
    """Whether the character at ``i`` can't be right where it stands."""
    c = text[i]
    before, after = text[i - 1] if i else " ", text[i + 1] if i + 1 < len(text) else " "
    left, right = bool(_LATIN.match(before)), bool(_LATIN.match(after))
    o = ord(c)
    if 0x2500 <= o <= 0x25A0:
        # Drawn tables hold them side by side, or a plain line alone.
        return left or right or before.isdigit() or (c not in "─│═║" and not any(0x2500 <= ord(x) <= 0x25A0 for x in (before, after)))
    if 0x370 <= o <= 0x52F and o != 0x3BC:  # Greek or Cyrillic inside a Latin word; a lone one may be a sign
        return left and right or (left or right) and not (before.isspace() and after.isspace()) and len(re.findall(r"\w+", text[max(0, i - 12) : i + 12])) > 0 and _mixed(text, i)
    if c == "ⁿ":
        return left
    if c in "ûÇ":  # a dash and a euro sign of their own
        return before.isspace() and after.isspace()
    if not c.isalpha() and c not in SPACE_LIKE and c not in "°²½¼¾±€№·&×§©®™":
        return left and right
    if c in "³¹":
        return right
    return False


def _mixed(text: str, i: int) -> bool:
    a = i
    while a and text[a - 1].isalpha():
        a -= 1
    b = i
    while b < len(text) and text[b].isalpha():
        b += 1
    return bool(re.search("[A-Za-z]", text[a:b]))


def _spans(text: str) -> list[tuple[int, int, dict[str, str]]]:
    """The spans that the automaton matches, none if all of them may be right as they stand."""
    spans = []
    for end, (k, v) in _automaton().iter_long(text):
        start = end - len(k) + 1
        weak = False
        if k[0] in "ÄÅÃÂ" and len(k) == 2 and k[1] in SPACE_LIKE:
            after = text[end + 1 : end + 2]
            weak = k[0] in "ÄÅ" and (k[1] in "\xa0–—“”’‘•" or bool(start and text[start - 1].isupper() and not after.isalpha()))
        spans.append((start, end + 1, v, weak))
    return [] if all(w for *_, w in spans) else [x[:3] for x in spans]


def stays_garbled(text: str) -> bool:
    """Whether a mended text still holds sequences or signs that can't be right, or lost characters."""
    return "\ufffd" in text or bool(_spans(text)) or mend_scripts(text) != text or any(_sure(text, m.start()) for m in _suspects().finditer(text))


def mend(text: str) -> tuple[bool, str, list[tuple[int, str, str]]]:
    """(damaged for sure, text with sure spans mended, words in doubt with their place and what they would have been)."""
    raw, text = text, mend_scripts(text)
    spans = _spans(text)
    # One sequence can stand for two characters under two encodings; the encoding that explains most of the text decides.
    ways: dict[str, int] = {}
    for _, _, v in spans:
        for way in v:
            ways[way] = ways.get(way, 0) + 1
    way = max(ways, key=ways.get) if ways else ""
    out, at = [], 0
    for s, e, v in spans:
        out += [text[at:s], v.get(way) or next(iter(v.values()))]
        at = e
    now = "".join([*out, text[at:]])
    damaged = bool(spans) or "�" in now or text != raw
    hits = [m.start() for m in _suspects().finditer(now)]
    if not hits:
        return damaged, now, []
    sure = [i for i in hits if _sure(now, i)]
    doubt: list[tuple[int, str, str]] = []
    if sure:
        damaged = True
        # The pair that explains most of what is sure, then most beside letters and least elsewhere.
        beside = {i: bool(i and _LATIN.match(now[i - 1])) for i in hits}
        best = max(_single(), key=lambda m: (sum(now[i] in m for i in sure), sum((1 if beside[i] else -1) for i in hits if now[i] in m)))
        bad = set(now[i] for i in sure)
        now = "".join(best.get(c, c) if c in bad or (c in best and beside.get(i) and not c.isalnum()) else c for i, c in enumerate(now))
    for m in re.finditer(r"[^\s,;:|/()]+", now):
        w = m.group().lstrip(EDGES)
        at, w = m.end() - len(w), w.rstrip(EDGES)
        if re.search("[A-Za-z]", w) and _suspects().search(w):
            for right in {"".join(m.get(c, c) if m.get(c, c) in LETTERS else c for c in w) for m in _single()}:
                if right != w and all(c.isalpha() for c in right) and not any(c in right for c in set(_suspects().findall(w)) - set(LETTERS)):
                    doubt.append((at, w, right))
    return damaged, now, doubt


def _without(text: str, doubt: list[tuple[int, str, str]]) -> str:
    """The text with the words in doubt blanked; they are judged by the corpus."""
    for at, w, _ in doubt:
        text = text[:at] + " " * len(w) + text[at + len(w) :]
    return text


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = [mend(t) for t in b["text"]]
        yield pd.DataFrame({"table_name": b["table_name"], "record_id": b["record_id"], "damaged": [g[0] for g in got], "mended": [g[1] for g in got], "doubt": [[{"at": i + 1, "word": w, "right": r} for i, w, r in g[2]] for g in got], "lost": [g[0] and stays_garbled(_without(g[1], g[2])) for g in got]})


def words(c) -> F.Column:
    """The words of a text that hold a letter beyond ASCII, in lower case."""
    return F.array_distinct(F.filter(F.transform(F.split(c, r"[\s,;:|/()]+"), lambda w: F.lower(F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[.!?\"'“”\]\}–-]+$", ""))), lambda w: w.rlike(r"[^\x00-\x7f]")))


def garbled(rows: DataFrame) -> DataFrame:
    """(table_name, record_id, text) to (table_name, record_id, original_text) of each record with damaged characters.

    ``original_text`` is null where a character is lost for good or garbled characters are left. Null, empty and plain ASCII texts are
    never damaged; repeated records are reported once each; other columns are dropped.
    """
    suspect = rows.where(F.col("text").rlike(r"[^\x00-\x7f]")).select("table_name", "record_id", "text")
    read = cut(suspect.mapInPandas(_read, "table_name string, record_id bigint, damaged boolean, mended string, doubt array<struct<at int, word string, right string>>, lost boolean"))
    counts = suspect.select(F.explode(words(F.col("text"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    each = read.where(F.size("doubt") > 0).select("table_name", "record_id", F.explode("doubt").alias("d")).select("table_name", "record_id", "d.at", "d.word", "d.right")
    pairs = each.select("word", "right").distinct().withColumn("lw", F.lower("word")).withColumn("lr", F.lower("right"))
    known = (
        pairs.join(counts.select(F.col("w").alias("lr"), F.col("n").alias("good")), "lr")
        .join(counts.select(F.col("w").alias("lw"), F.col("n").alias("bad")), "lw", "left")
        .where(F.col("good") > 2 * F.coalesce("bad", F.lit(0)))
        .groupBy("word").agg(F.max_by("right", F.struct("good", "right")).alias("right"))
    )
    spots = each.select("table_name", "record_id", "at", "word").distinct()
    proved = attach_by_key(spots, known, ["word"], ["record_id", "at"]).groupBy("table_name", "record_id").agg(F.sort_array(F.collect_set(F.struct("at", "word", "right")), asc=False).alias("swaps"))
    whole = read.join(proved, ["table_name", "record_id"], "left").where(F.col("damaged") | F.col("swaps").isNotNull())
    # From the last place to the first, so that the places before stay where they were.
    none = F.array().cast("array<struct<at:int,word:string,right:string>>")
    mended = F.aggregate(F.coalesce("swaps", none), F.col("mended"), lambda t, s: F.overlay(t, s["right"], s["at"], F.length(s["word"])))
    return whole.select("table_name", "record_id", F.when(~F.col("lost"), mended).alias("original_text"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "translation_results").select(F.lit("translation_results").alias("table_name"), F.col("result_id").alias("record_id"), F.col("source_text").alias("text"))
    b = table(spark, sf_dir, "reference_items").select(F.lit("reference_items").alias("table_name"), F.col("item_row").alias("record_id"), F.col("description").alias("text"))
    return a.unionByName(b)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled(sources(spark, sf_dir)).select("table_name", "record_id")


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged records with their original text, null where it can't be restored."""
    return garbled(sources(spark, sf_dir))
