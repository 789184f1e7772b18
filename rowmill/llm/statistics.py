"""Statistics of one text, as numbers for a classifier: shares and means, so that texts of any length compare."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np

SYMBOLS = b"#*$%&|<>"
DIGITS = b"0123456789"
UPPER = bytes(range(65, 91))
MARKS = b".,;:?!\"'()-"
NAMES = (
    "chars", "words", "word_mean", "word_spread", "word_longest", "symbols", "pipes", "digits", "upper", "marks", "exclaims", "other_bytes",
    "distinct_words", "commonest", "lines", "line_mean", "repeated_lines", "ended_lines", "squeezed", "controls", "letters_only", "long_words",
)
_ZERO = [0.0] * len(NAMES)


def _share(data: bytes, chars: bytes, size: int) -> float:
    return (len(data) - len(data.translate(None, chars))) / size


def statistics(text: str) -> list[float]:
    """One number for each of NAMES; zeros for an empty text."""
    if not text:
        return _ZERO
    data = text.encode()
    size = len(data)
    words = text.split()
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x and not x.isspace()] or [""]
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        float(lengths.mean()),
        float(lengths.std()),
        math.log1p(int(lengths.max())),
        _share(data, SYMBOLS, size),
        data.count(b"|") / size,
        _share(data, DIGITS, size),
        _share(data, UPPER, size),
        _share(data, MARKS, size),
        data.count(b"!") / size,
        (size - len(text)) / size,
        math.log1p(len(counts)) / math.log1p(n),
        max(counts.values(), default=0) / n,
        math.log1p(len(lines)),
        math.log1p(len(text) / len(lines)),
        1 - len(set(lines)) / len(lines),
        sum(x.rstrip().endswith((".", "!", "?", '"', ":", "…")) for x in lines) / len(lines),
        len(zlib.compress(data, 1)) / (size + 16),
        sum(map(data.count, (b"\x00", b"\xef\xbf\xbd", b"\t", b"\r"))) / size,
        sum(map(str.isalpha, words)) / n,
        float((lengths > 20).mean()),
    ]
