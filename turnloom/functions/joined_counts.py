"""Token counts of joined texts from encodings of their parts.

A tokenizer's counts need not add up, as tokens may reach across the joints. But around a
joint only a stretch of text has to be encoded anew: from where its tokens have met those of
a known part, the rest of that part is as before.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from itertools import accumulate

# Id, first character, end.
Token = tuple[int, int, int]


class Encoded:
    """A text with its tokens."""

    def __init__(self, text: str, encode: Callable):
        ids, spans = encode(text)
        self.text = text
        self.tokens: list[Token] = [(i, s, e) for i, (s, e) in zip(ids, spans)]
        self.starts = list(accumulate((t[1] for t in self.tokens), max))

    def starting(self, at: int) -> int | None:
        """The first token that starts at a character."""
        i = bisect_left(self.starts, at)
        return i if i < len(self.starts) and self.starts[i] == at else None

    def boundary(self, at: int) -> int:
        """Where the last token starts that starts at or before a character; 0 without one."""
        if at <= 0 or not self.starts:
            return 0
        i = bisect_left(self.starts, at + 1) - 1
        return self.starts[i] if i >= 0 else 0


class JoinedCounts:
    """Counts under one statement about ``encode``: encodings of two texts that go on with the
    same characters give the same tokens from there on once they have given the same tokens
    over ``agreement`` characters, and the end of a text changes no more than its last
    ``agreement`` characters. Where parts do not meet, more is encoded, up to the whole text.
    """

    def __init__(self, encode: Callable, agreement: int):
        self.encode, self.agreement = encode, agreement

    def known(self, text: str) -> Encoded:
        return Encoded(text, self.encode)

    def _agree(self, a: list[Token], i: int, b: list[Token], j: int, shift: int, end: int) -> bool:
        """Whether tokens a[i:] and b[j:], ``shift`` characters on, are the same for long enough."""
        begin = a[i][1]
        while i < len(a) and j < len(b):
            (x, s, e), (y, t, u) = a[i], b[j]
            if x != y or (s + shift, e + shift) != (t, u) or e > end:
                return False
            if e - begin >= self.agreement:
                return True
            i, j = i + 1, j + 1
        return False

    def _meet(self, window: Encoded, known: Encoded, shift: int, begin: int, end: int) -> tuple[int, int] | None:
        """The first tokens of a window and of a known part, between two characters of the
        window, from which on they are the same."""
        for i in range(bisect_left(window.starts, begin), len(window.tokens)):
            start = window.tokens[i][1]
            if start >= end:
                return None
            j = known.starting(start + shift) if start >= begin else None
            if j is not None and self._agree(window.tokens, i, known.tokens, j, shift, end):
                return i, j
        return None

    def count(self, left: Encoded, middle: str, right: Encoded, at: int = 0) -> int:
        """Number of tokens of ``left``, ``middle`` and ``right`` from character ``at``, joined."""
        width = 8 * self.agreement + 32
        while True:
            low = left.boundary(len(left.text) - width)
            high = min(len(right.text), at + width)
            joint = len(left.text) - low + len(middle)
            window = self.known(left.text[low:] + middle + right.text[at:high])
            first: tuple[int, int] | None = (0, 0)
            last: tuple[int, int] | None = (len(window.tokens), len(right.tokens))
            if low:
                first = self._meet(window, left, low, 0, len(left.text) - low - self.agreement)
            if high < len(right.text):
                last = self._meet(window, right, at - joint, joint, joint + high - at - self.agreement)
            if first and last:
                return first[1] + last[0] - first[0] + len(right.tokens) - last[1]
            width *= 4
