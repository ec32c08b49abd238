"""Spans of whole texts: shared by the operators that find secrets and personal data."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Sequence

Span = tuple[str, int, int]


def listed(spans: Sequence[Span], kinds: Sequence[str]) -> str:
    """kind:start:end by start, then the order of kinds, then end; comma-joined."""
    place = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda x: (x[1], place[x[0]], x[2])))


class Cover:
    """The union of spans; a question costs the logarithm of their number."""

    def __init__(self, spans: Iterable[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda x: x[1:]):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            elif a < b:
                self.starts.append(a)
                self.ends.append(b)

    def touches(self, a: int, b: int) -> bool:
        """Whether [a, b) and some span share a place."""
        i = bisect_right(self.ends, a)
        return i < len(self.starts) and self.starts[i] < b

    def add(self, a: int, b: int) -> None:
        """Adds a span that touches none."""
        i = bisect_left(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


class Nested:
    """Which spans lie in one another; those of a kind are disjoint."""

    def __init__(self, spans: Iterable[Span]):
        self.kinds: dict[str, tuple[list[int], list[int]]] = {}
        for kind, a, b in sorted(spans, key=lambda x: x[1:]):
            starts, ends = self.kinds.setdefault(kind, ([], []))
            starts.append(a)
            ends.append(b)

    def agrees(self, a: int, b: int) -> bool:
        """Whether some span holds [a, b) or lies in it."""
        for starts, ends in self.kinds.values():
            i = bisect_right(starts, a)
            if i and b <= ends[i - 1]:
                return True
            i = bisect_left(starts, a)
            if i < len(starts) and ends[i] <= b:
                return True
        return False


def replaced(text: str, spans: Sequence[Span], mark: str = "[{}]") -> str:
    """text with every maximal run of overlapping spans replaced by its first span's kind."""
    out, at = [], 0
    for kind, a, b in sorted(set(spans), key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], mark.format(kind.upper())]
        at = max(at, b)
    return "".join([*out, text[at:]])
