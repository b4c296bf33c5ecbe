"""Document statistics that rules and classifiers look at."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_DIGIT = re.compile(r"\d")
_SHAPE = re.compile(r"[^\W\d_]+")
WINDOW = 8


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text or "")


def repeated_words(words: list[str]) -> int:
    """Words within windows of eight words that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    # identity of windows of 2, 4 and 8 words, by doubling: exact, without hashing
    for step in (1, 2, 4):
        x = np.unique(x[:-step] * (int(x.max()) + 1) + x[step:], return_inverse=True)[1]
    often = np.flatnonzero(np.bincount(x)[x] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, often, 1)
    np.add.at(edge, often + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def base(text: str | None, words: list[str] | None = None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; words: those of the text, if known."""
    words = words_of(text) if words is None else words
    lines = Counter(x for x in (text or "").split("\n") if _WORD.search(x))
    return len(words), sum(map(len, words)), len(_SYMBOL.findall(text or "")), sum(lines.values()) - len(lines), repeated_words(words)


#: What `features` returns, and the direction in which quality may go with it (0: any).
FEATURES = {"log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "distinct": 0, "digits": 0, "letters": 0, "upper": 0, "line_words": 0, "stops": 0, "odd_words": -1}


def features(text: str | None, b: tuple[int, int, int, int, int], words: list[str] | None = None) -> list[float]:
    text, (n, chars, symbols, dup, rep) = text or "", b
    words, size, lines = words_of(text) if words is None else words, max(1, len(text)), text.count("\n") + 1
    shapes, digits = _SHAPE.findall(text), len(_DIGIT.findall(text))
    letters, odd = sum(map(len, shapes)), sum(1 for w in set(words) - set(shapes) if not _SHAPE.search(w)) and sum(1 for w in words if not _SHAPE.search(w))
    return [np.log1p(n), chars / max(1, n), symbols / max(1, n), dup / lines, rep / max(1, n), len(set(words)) / max(1, n), digits / size, letters / size, sum(map(str.isupper, text)) / size, n / lines, (text.count(".") + text.count("!") + text.count("?")) / max(1, n), odd / max(1, n)]
