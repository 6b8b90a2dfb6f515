"""Sizes, ratings and quantities in product titles, in base units."""

from __future__ import annotations

import re
import unicodedata

# Unit spellings, the dimension they measure and the factor to its base unit.
UNITS: dict[str, tuple[str, float]] = {
    "mm": ("length", 1), "cm": ("length", 10), "dm": ("length", 100), "m": ("length", 1000), "metre": ("length", 1000), "metres": ("length", 1000), "meter": ("length", 1000), "metr": ("length", 1000), "metriä": ("length", 1000),
    "mm2": ("area", 1), "sqmm": ("area", 1), "mm²": ("area", 1), "qmm": ("area", 1), "cm2": ("area", 100), "cm²": ("area", 100), "m2": ("area", 1e6), "m²": ("area", 1e6),
    "ml": ("volume", 1), "cl": ("volume", 10), "dl": ("volume", 100), "l": ("volume", 1000), "litre": ("volume", 1000), "liter": ("volume", 1000), "litra": ("volume", 1000), "litraa": ("volume", 1000),
    "mg": ("mass", 0.001), "g": ("mass", 1), "gr": ("mass", 1), "gram": ("mass", 1), "kg": ("mass", 1000), "t": ("mass", 1e6),
    "w": ("power", 1), "watt": ("power", 1), "kw": ("power", 1000), "mw": ("power", 1e6), "hp": ("power", 745.7), "v": ("voltage", 1), "volt": ("voltage", 1), "kv": ("voltage", 1000), "mv": ("voltage", 0.001),
    "mah": ("charge", 1), "ah": ("charge", 1000), "a": ("current", 1), "ma": ("current", 0.001), "hz": ("frequency", 1), "khz": ("frequency", 1000),
    "bar": ("pressure", 1), "mbar": ("pressure", 0.001), "mpa": ("pressure", 10), "kpa": ("pressure", 0.01), "psi": ("pressure", 0.0689476),
    "°c": ("temperature", 1), "ºc": ("temperature", 1), "°": ("temperature", 1), "lm": ("light", 1), "rpm": ("speed", 1), "nm": ("torque", 1),
    "pcs": ("pack", 1), "pc": ("pack", 1), "st": ("pack", 1), "stk": ("pack", 1), "stck": ("pack", 1), "stück": ("pack", 1), "kpl": ("pack", 1), "szt": ("pack", 1), "pack": ("pack", 1), "er-pack": ("pack", 1), "pieces": ("pack", 1),
}
# Words before a number that name what it measures.
NAMED = {"dn": "dn", "nominal size": "dn", "pn": "pressure", "ip": "ip", "pack of": "pack", "set of": "pack", "size": "size", "sz": "size", "gr": "size", "größe": "size", "koko": "size", "storlek": "size", "stl": "size", "rozmiar": "size", "rozm": "size"}

_NUM = r"(\d+(?:[.,]\d+)?)"
_UNIT = "|".join(sorted(map(re.escape, UNITS), key=len, reverse=True))
_BY_NAME = re.compile(rf"(?<![^\W_])({'|'.join(sorted(map(re.escape, NAMED), key=len, reverse=True))})[.:=]?[\s-]*{_NUM}(?!\d)(?![.,]\d)(?!\s*°)", re.I)
_BY_UNIT = re.compile(rf"(?<![\w.,]){_NUM}[\s-]*({_UNIT})(?![^\W\d_]|[²2]|-?[^\W_])", re.I)
_BY_LETTER = re.compile(rf"(?<![^\W_])[LU]={_NUM}[\s-]*({_UNIT})(?![^\W_]|[²2])", re.I)


def _value(number: str, factor: float) -> str:
    return f"{float(number.replace(',', '.')) * factor:.6g}"


def read_title(text: str) -> tuple[list[str], list[str]]:
    """(attributes as ``dimension:value`` in base units, words of letters only in lower case) of a title, in order."""
    text = unicodedata.normalize("NFC", text)
    # A character lost for good after a unit or before a C can only have been the square or the degree sign.
    text = re.sub(r"(?<=m)\ufffd+", "²", re.sub(r"(?<=\d)(\s*)\ufffd+(?=[Cc]\b)", r"\1°", text))
    found: list[tuple[int, str]] = []
    taken: list[tuple[int, int]] = []
    for kind, pattern in (("n", _BY_NAME), ("u", _BY_LETTER), ("u", _BY_UNIT)):
        for m in pattern.finditer(text):
            if any(s < m.end() and m.start() < e for s, e in taken):
                continue
            if kind == "n":
                dim, val = NAMED[m.group(1).lower()], _value(m.group(2), 1)
                tail = re.match(rf"[\s-]*(bar|mpa|kpa)\b", text[m.end() :], re.I)
                end = m.end() + (tail.end() if tail else 0)
            else:
                dim, factor = UNITS[m.group(2).lower()]
                val, end = _value(m.group(1), factor), m.end()
            taken.append((m.start(), end))
            found.append((m.start(), f"{dim}:{val}"))
    found.sort()
    rest = list(text)
    for s, e in taken:
        rest[s:e] = " " * (e - s)
    words = [w.lower() for w in re.findall(r"(?<![\d])(?<![^\W_])[^\W\d_]{3,}(?![^\W_])(?!-?\s?\d)", "".join(rest))]
    return list(dict.fromkeys(a for _, a in found)), words
