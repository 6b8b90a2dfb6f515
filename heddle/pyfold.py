"""Folding in Python, for the Arrow functions: the same as the native lookup key for Latin text."""

from __future__ import annotations

import unicodedata

_MORE = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ŧ": "t", "ı": "i", "æ": "ae", "ß": "ss"})


def fold(text: str) -> str:
    t = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
    return " ".join(t.translate(_MORE).split())
