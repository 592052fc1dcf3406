"""Character spans (code points, end exclusive) and how they are written."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Sequence

Span = tuple[int, int, str]


def written(spans: list[Span], kinds: Sequence[str]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], kinds.index(s[2]), s[1])))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Covered:
    """Whether places meet any of some spans, by bisection in the merged spans."""

    def __init__(self, spans: list[Span]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b, _ in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, start: int, end: int) -> bool:
        k = bisect.bisect_left(self.starts, end) - 1
        return k >= 0 and self.ends[k] > start
