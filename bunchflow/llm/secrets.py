"""Secret scans: base patterns, and probabilistic automata inferred from labelled credentials.

Grammar inference: labelled credentials, as sequences of character classes,
make a prefix tree with counts for each format; states whose outgoing
frequencies agree by Hoeffding's bound (and whose successors do) are merged,
oldest first, into a probabilistic automaton. Candidates are runs of credential
characters and their parts: a part starts with the run, behind a delimiter or at
a prefix that all examples of a format have, and ends with the run, before a
delimiter or behind padding. Each is scored by its log likelihood a symbol under
each automaton, the end's probability included, against two backgrounds: words
and numbers in turn, and few characters over and over. One that some format
explains well enough is a span of kind `learned`, unless it touches a base span.

Documents that can't hold a match are passed over by byte searches on whole
chunks; the others are searched as a whole. Texts cost time in proportion to
their length, but for runs crafted to stay just below what is accepted: a walk
over a part ends DROP bits below.
"""

from __future__ import annotations

import math
import os
import random
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spans import Cover, Span, replaced
from .tasks import table, with_arrow
from .words import LOWER, chunks

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "learned")
ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Byte strings of which a text with an assign or access match has one, in lower case.
NEEDLES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key", b"akia")
#: A maximal run of credential characters, of at least LEAST; it and its parts are candidates.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
LEAST = 20
DELIMITERS = "=/-"

#: Public credential formats as (name, prefix, alphabet, least and greatest length after the prefix).
LETTERS_LOW, LETTERS_UP, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FORMATS = [
    ("hex", "", "0123456789abcdef", 32, 64),
    ("upper_hex", "", "0123456789ABCDEF", 32, 64),
    ("forge_token", "ghp_", LETTERS_LOW + LETTERS_UP + DIGITS, 36, 36),
    ("map_key", "AIza", LETTERS_LOW + LETTERS_UP + DIGITS + "_-", 35, 35),
    ("payment_key", "sk_live_", LETTERS_LOW + LETTERS_UP + DIGITS, 24, 32),
    ("chat_token", "xoxb-", DIGITS + LETTERS_LOW + LETTERS_UP, 24, 48),
    ("base64_key", "", LETTERS_LOW + LETTERS_UP + DIGITS + "+/", 40, 44),
]
#: Labelled credentials of a format, and the level of the Hoeffding test.
EXAMPLES = 400
ALPHA = 0.05
#: Least advantage over the background, in bits a symbol, and most bits a symbol below the format's own mean.
ADVANTAGE = 0.35
SLACK = 0.8
#: Bits below what is accepted at which a walk over a run is given up, and symbols in which a later start may replace an earlier one.
DROP = 24.0
NEAR = 64


def classes(token: str) -> str:
    """Hex letters, other small letters, capitals and digits by class; other characters by themselves."""
    return token.translate(_CLASS)


_CLASS = {ord(c): "h" if c in "abcdef" else "l" for c in LETTERS_LOW} | {ord(c): "H" if c in "ABCDEF" else "U" for c in LETTERS_UP} | {ord(c): "d" for c in DIGITS}


def labelled(seed: int = 5) -> list[tuple[str, str]]:
    """Seeded examples (format, credential) of FORMATS; base64 is padded to whole groups of four."""
    rng = random.Random(seed)
    out = [(name, prefix + "".join(rng.choices(alphabet, k=rng.randint(a, b)))) for name, prefix, alphabet, a, b in FORMATS for _ in range(EXAMPLES)]
    return [(name, x + "=" * (-len(x) % 4 % 3) if name == "base64_key" else x) for name, x in out]


class Automaton:
    """A probabilistic automaton learned by merging the states of a prefix tree."""

    def __init__(self, examples: Iterable[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.times: list[dict[str, int]] = [{}]
        self.ends, self.seen = [0], [0]
        for x in examples:
            state = 0
            self.seen[0] += 1
            for c in x:
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.times.append({})
                    self.ends.append(0)
                    self.seen.append(0)
                self.times[state][c] = self.times[state].get(c, 0) + 1
                state = self.next[state][c]
                self.seen[state] += 1
            self.ends[state] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n, m = self.seen[p], self.seen[q]
            if not n or not m:
                continue
            if self._differ(self.ends[p], n, self.ends[q], m):
                return False
            for c in {*self.times[p], *self.times[q]}:
                if self._differ(self.times[p].get(c, 0), n, self.times[q].get(c, 0), m):
                    return False
                if c in self.next[p] and c in self.next[q]:
                    todo.append((self.next[p][c], self.next[q][c]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Adds the tree below q to p."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.seen[p] += self.seen[q]
            self.ends[p] += self.ends[q]
            for c, k in self.times[q].items():
                self.times[p][c] = self.times[p].get(c, 0) + k
                if c in self.next[p]:
                    todo.append((self.next[p][c], self.next[q][c]))
                else:
                    self.next[p][c] = self.next[q][c]

    def _merge_all(self) -> None:
        red, blue = [0], [(0, c) for c in sorted(self.next[0])]
        while blue:
            at, c = blue.pop(0)
            q = self.next[at][c]
            if q in red:
                continue
            into = next((p for p in red if self._compatible(p, q)), None)
            if into is None:
                red.append(q)
                blue += [(q, x) for x in sorted(self.next[q])]
            else:
                self.next[at][c] = into
                self._fold(into, q)
                blue += [(p, x) for p in red for x in sorted(self.next[p]) if self.next[p][x] not in red and (p, x) not in blue]
        self.states = len(red)
        logs = {p: {c: math.log2(k / self.seen[p]) for c, k in self.times[p].items()} for p in red}
        self.end = {p: math.log2(self.ends[p] / self.seen[p]) for p in red if self.ends[p]}
        self.logs, self.next = logs, {p: self.next[p] for p in red}
        self.times = self.ends = self.seen = None

    def bits(self, symbols: str) -> float | None:
        """Mean log2 likelihood of a symbol and of the end, or None for a sequence that the automaton can't make."""
        state, total = 0, 0.0
        for c in symbols:
            if c not in self.logs[state]:
                return None
            total += self.logs[state][c]
            state = self.next[state][c]
        return (total + self.end[state]) / (len(symbols) + 1) if state in self.end else None


def _logs(**share: float) -> dict[str, float]:
    return {c: math.log2(x) for c, x in share.items()}


#: log2 likelihood of a symbol in ordinary small words, capital words and numbers, and of any other symbol; bits that a change of these costs.
BACKGROUND = (
    (_logs(h=0.3, l=0.62, H=0.01, U=0.03, d=0.03), math.log2(0.01)),
    (_logs(h=0.01, l=0.03, H=0.3, U=0.62, d=0.03), math.log2(0.01)),
    (_logs(h=0.005, l=0.005, H=0.005, U=0.005, d=0.9), math.log2(0.05)),
)
CHANGE = 9.0
#: log2 of the characters of a class; bits that name one character of a token of few, and bits a symbol against such a token.
WIDTH = {c: math.log2(n) for c, n in (("h", 6), ("l", 20), ("H", 6), ("U", 20), ("d", 10))}
NAMED = 6.0
OVER = 1.0


class Formats:
    def __init__(self, examples: list[tuple[str, str]]):
        self.automata = []
        for name in dict.fromkeys(x[0] for x in examples):
            tokens = [x for n, x in examples if n == name]
            own = [classes(x) for x in tokens]
            a = Automaton(own)
            mean = sum(a.bits(x) or 0.0 for x in own) / len(own)
            self.automata.append((os.path.commonprefix(tokens), a, mean))

    def _ends(self, a: Automaton, mean: float, run: str, symbols: str, start: int) -> tuple[float, int] | None:
        """(odds in bits, end) of the longest part from start that the format explains better than both backgrounds."""
        state, got, best = 0, 0.0, None
        usual, kinds = 0.0, [0.0] * len(BACKGROUND)
        width, different = 0.0, set()
        for i in range(start, len(run)):
            c = symbols[i]
            if c not in a.logs[state]:
                break
            different.add(run[i])
            width += WIDTH.get(c, 0.0)
            got += a.logs[state][c]
            kinds = [max(x, usual - CHANGE) + logs.get(c, rare) for x, (logs, rare) in zip(kinds, BACKGROUND)]
            usual = max(kinds)
            state, n = a.next[state][c], i + 1 - start
            few = width - n * (math.log2(len(different)) + OVER) - NAMED * len(different)
            plain = max(usual, few)
            short = min(got - plain - ADVANTAGE * n, got - (mean - SLACK) * n)
            if short < -DROP:
                break
            if n >= LEAST and state in a.end and (i + 1 == len(run) or run[i + 1] in DELIMITERS or run[i] == "="):
                whole = got + a.end[state]
                if whole - plain >= ADVANTAGE * n and whole >= (mean - SLACK) * (n + 1):
                    best = whole - plain, i + 1
        return best

    def spans(self, run: str) -> list[tuple[int, int]]:
        """Disjoint parts of a run that formats explain: those of formats with a prefix, then the likeliest others."""
        symbols, taken = classes(run), Cover()
        for prefix, a, mean in self.automata:
            at = run.find(prefix) if prefix else -1
            while at >= 0:
                got = None if taken.touches(at, at + 1) else self._ends(a, mean, run, symbols, at)
                if got and not taken.touches(at, got[1]):
                    taken.add(at, got[1])
                at = run.find(prefix, got[1] if got else at + 1)
        starts = [0, *(i + 1 for i, c in enumerate(run) if c in DELIMITERS)]
        held: tuple[float, int, int] | None = None
        for at in starts:
            if held and held[1] + NEAR <= at < held[2] or taken.touches(at, at + 1):
                continue
            for prefix, a, mean in self.automata:
                got = None if prefix else self._ends(a, mean, run, symbols, at)
                if not got or taken.touches(at, got[1]):
                    continue
                if held and at >= held[2]:
                    taken.add(*held[1:])
                    held = None
                if not held or got[0] > held[0]:
                    held = got[0], at, got[1]
        if held:
            taken.add(*held[1:])
        return list(zip(taken.starts, taken.ends))

    def accepts(self, token: str) -> bool:
        """Whether some format explains the whole token better than the background."""
        symbols = classes(token)
        return any((got := self._ends(a, mean, token, symbols, 0)) and got[1] == len(token) for _, a, mean in self.automata)


@lru_cache(maxsize=1)
def default_formats() -> Formats:
    return Formats(labelled())


def base_spans(text: str) -> list[Span]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def find(text: str, formats: Formats) -> list[Span]:
    """Base spans, then learned ones that touch none of them; code points, end exclusive."""
    base = base_spans(text)
    cover = Cover(base)
    learned = [("learned", m.start() + a, m.start() + b) for m in CANDIDATE.finditer(text) for a, b in formats.spans(m.group())]
    return base + [x for x in learned if not cover.touches(*x[1:])]


_RUN = np.zeros(256, bool)
_RUN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True


def rows_to_search(texts: pa.Array) -> set[int]:
    """Rows with a needle of the base patterns, or a run of LEAST credential characters with a digit."""
    out: set[int] = set()
    for row, _, data, offsets in chunks(texts):
        low = LOWER[data].tobytes()
        at: list[int] = []
        for x in NEEDLES:
            i = low.find(x)
            while i >= 0:
                at.append(i)
                i = low.find(x, i + 1)
        other = np.concatenate(([-1], np.flatnonzero(~_RUN[data]), [len(data)]))
        long_run = np.flatnonzero(np.diff(other) > LEAST)
        at += [int(other[i]) + 1 for i in long_run]
        # a run may cross from one text into the next, so each row that it reaches counts
        for i in long_run:
            first, last = (int(np.searchsorted(offsets, x, "right")) - 1 for x in (other[i] + 1, other[i + 1] - 1))
            out.update(range(row + first, row + min(last, len(offsets) - 2) + 1))
        out.update(row + int(x) for x in np.searchsorted(offsets, np.array(at, np.int64), "right") - 1)
    return out


def scanned(docs: DataFrame, text: str = "text", formats: Formats | None = None, keep: list[str] | None = None) -> DataFrame:
    """docs with secrets, an array of (kind, start, end) in code points.

    Null and empty texts have none. Equal spans of a kind count once; spans of
    different kinds may overlap; order is by start, then kind. Repeated rows get
    equal results. A column of docs named secrets is replaced.
    """
    formats = formats or default_formats()
    shared = docs.sparkSession.sparkContext.broadcast(formats)
    kind = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        order = {k: i for i, k in enumerate(KINDS)}
        for i in rows_to_search(texts):
            spans = sorted(set(find(texts[i].as_py() or "", shared.value)), key=lambda x: (x[1], order[x[0]], x[2]))
            out[i] = [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        return {"secrets": pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))}

    return with_arrow(docs, text, [T.StructField("secrets", T.ArrayType(kind))], work, keep)


def redacted(docs: DataFrame, text: str = "text", formats: Formats | None = None) -> DataFrame:
    """The columns of docs, with every secret of text replaced by its kind and n_chars counted anew.

    Nulls stay null; the texts pass Python once.
    """
    columns = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(formats or default_formats())

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        out = {i: replaced(x, found) for i in rows_to_search(texts) if (found := find(x := texts[i].as_py() or "", shared.value))}
        return {text: pa.array([out.get(i, x) for i, x in enumerate(texts.to_pylist())], pa.string()) if out else texts}

    found = with_arrow(docs, text, [T.StructField(text, T.StringType())], work)
    if "n_chars" in columns:
        found = found.withColumn("n_chars", F.coalesce(F.length(f"`{text}`").cast("long"), "n_chars"))
    return found.select(*[f"`{c}`" for c in columns])


def joined(spans: str, kinds: tuple[str, ...] | None = None):
    """kind:start:end of a span column, comma-joined; all or some kinds."""
    chosen = F.filter(spans, lambda x: x["kind"].isin(*kinds)) if kinds else F.col(spans)
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def counted(spans: str, kind: str):
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    counts = [counted("secrets", k).alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined("secrets", BASE), 256).alias("base_sha256"), joined("secrets").alias("spans"))
