"""Text units that a byte-level BPE pattern never matches across.

The pattern of such vocabularies is a list of alternatives that begin with at most one space and go on with characters other than
white space, or are white space only. So no match holds a character other than white space followed by white space, and
no lookahead of the pattern looks from one side of such a place to the other. Cutting a text there leaves its matches
as they are: the pieces of a text are the pieces of its units, and equal units have equal tokens wherever they stand.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Python's \s holds all white space of the pattern and four more characters, so cuts are never made where the pattern could join.
_RUN = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= )")


def spaced_words(text: str) -> list[str] | None:
    """The text split at its spaces where each of them is a safe cut: unit i > 0 is a space and word i. None for other texts."""
    return None if _RUN.search(text) else text.split(" ")


def units(text: str) -> list[str]:
    """The text in units, cut before each space that follows another character than white space."""
    return _CUT.split(text)


class Memo(dict):
    """Results by key, worked out when first asked for. At most about ``most`` are kept, keys over ``width`` characters never.

    When half of them are new, the half before is dropped; what is asked for again in the meantime counts as new.
    """

    def __init__(self, work: Callable, most: int = 1 << 19, width: int = 64):
        super().__init__()
        self.work, self.half, self.width = work, most // 2, width
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.work(key)
        if len(key) <= self.width:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
