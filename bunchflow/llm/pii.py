"""Personal data: base patterns, and spans that a classifier of weakly supervised candidates adds.

Candidates are broad matches: mail-like runs (parts of at most 64 characters, as mail allows) and number-like
ones (7 to 19 digits, as phone, account and card numbers have); postal addresses are not looked for.
Labelers vote on each (yes, no, or abstain): regular expressions, checksums,
gazetteers and context words. The votes of all candidates of all documents are
counted by pattern (a bounded number of patterns, counted in Spark);
expectation-maximisation over the counts estimates each labeler's reliability
and each pattern's posterior; a logistic span classifier is trained on the
posteriors, with span features that no labeler reads alone. A candidate that
the classifier accepts, and that touches no base span, is a span of kind
`learned`.

Only texts with a digit, an at sign or a plus sign can hold a match; the others
are passed over by one table look-up a byte. Every search takes time in
proportion to the text's length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .secrets import counted, joined
from .spans import Cover, Nested, Span
from .tasks import in_arrow, table, with_arrow
from .words import chunks

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "learned")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is entered at its first digit only: a match that starts later in it exists only if that one does.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Least posterior of a learned span. The distinct (votes, features) patterns that reach the driver are 3**8 by 2**6 at most.
ACCEPT = 0.95
MAIL_WORDS = frozenset(["mail", "email", "e-mail", "contact", "correo", "courriel"])
CALL_WORDS = frozenset(["phone", "tel", "call", "mobile", "fax", "telefon", "anruf", "teléfono", "téléphone"])
NUMBER_WORDS = frozenset(["ssn", "iban", "passport", "account", "card", "social", "ausweis", "konto", "cuenta", "compte"])
#: Gazetteers, fixed values: usual top-level domains, and unit or money words that follow a mere number.
DOMAINS = frozenset(["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk"])
UNITS = frozenset(["km", "kg", "eur", "usd", "percent", "mm", "cm", "mb", "gb", "years", "pages"])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost non-overlapping matches of local@domain, found from their at signs in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        if at >= end:
            a = at
            while a > end and text[a - 1] in _LOCAL:
                a -= 1
            m = _DOMAIN.match(text, at + 1) if a < at else None
            if m:
                end = m.end()
                yield "email", a, end
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    out = list(emails(text))
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


_NUMBER = re.compile(r"(?<![\w.+-])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![\w])")
_MAIL = re.compile(r"(?<!\w)[\w.+-]{1,64}\x20?(?:@|\[at\]|\(at\))\x20?[\w-]{1,64}(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z]{2,10})+(?!\w)")
_DOT = re.compile(r"\.|\[dot\]|\(dot\)")


def candidates(text: str) -> list[Span]:
    out = [("number", m.start(), m.end()) for m in _NUMBER.finditer(text)]
    if "@" in text or "at]" in text or "at)" in text:
        out += [("mail", m.start(), m.end()) for m in _MAIL.finditer(text)]
    return out


def votes(text: str, kind: str, a: int, b: int, base: Nested) -> str:
    """One of + - 0 from each labeler, then the span's features as digits; base: the text's base spans."""
    span = text[a:b]
    digits = "".join(c for c in span if c in "0123456789")
    before = re.findall(r"[\w-]+", text[max(0, a - 40) : a].lower())[-4:]
    after = re.findall(r"[\w-]+", text[b : b + 20].lower())[:1]
    separators = [c for c in span if c in " -."]
    grouped = bool(re.fullmatch(r"\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}|\d{3}-\d{2}-\d{4}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}", span))
    # a number that is named as a phone's or an account's needs no separators, and no card's checksum
    named = any(w in CALL_WORDS or w in NUMBER_WORDS and w != "card" for w in before)
    spelt = kind == "mail" and ("at]" in span or "at)" in span)
    seen = [
        "+" if spelt or base.agrees(a, b) else "0",  # a strict pattern
        "+" if len(digits) >= 13 and luhn(digits) else "-" if len(digits) >= 13 and kind == "number" and not named else "0",  # checksum
        "+" if grouped else "-" if kind == "number" and not separators and len(digits) < 13 and not named else "0",  # shape
        "+" if kind == "mail" and _DOT.split(span)[-1].strip().lower() in DOMAINS else "0",  # gazetteer
        "+" if any(w in MAIL_WORDS or w in CALL_WORDS or w in NUMBER_WORDS for w in before) else "0",  # context before
        "-" if after and after[0] in UNITS else "0",  # context after
        "-" if re.fullmatch(r"(19|20)\d\d[.-]\d\d[.-]\d\d|\d+\.\d+", span) else "0",  # dates and decimals
        "-" if digits and len(set(digits)) <= 2 else "0",  # filler
    ]
    features = [kind == "mail", "(" in span, "-" in span, "." in span, " " in span, 9 <= len(digits) <= 16]
    return "".join(seen) + "".join(str(int(x)) for x in features)


LABELERS, FEATURES = 8, 6


def estimated(patterns: dict[str, int], rounds: int = 50) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of each pattern, and the labelers' reliabilities [class, labeler, vote], by EM with smoothed counts."""
    keys = sorted(patterns)
    weight = np.array([patterns[k] for k in keys], float)
    seen = np.array([["0+-".index(c) for c in k[:LABELERS]] for k in keys])
    score = np.array([k[:LABELERS].count("+") - k[:LABELERS].count("-") for k in keys], float)
    p = 1 / (1 + np.exp(-2 * score))
    rel = np.zeros((2, LABELERS, 3))
    for _ in range(rounds):
        for y, q in enumerate((1 - p, p)):
            for j in range(LABELERS):
                # a labeler that votes is right more often than not, before the data speak
                prior = np.array([8.0, 0.5 + y, 1.5 - y])
                rel[y, j] = np.bincount(seen[:, j], weights=q * weight, minlength=3) + prior
        rel /= rel.sum(2, keepdims=True)
        share = min(max((p * weight).sum() / max(weight.sum(), 1.0), 0.01), 0.99)
        odds = math.log(share / (1 - share)) + sum(np.log(rel[1, j, seen[:, j]] / rel[0, j, seen[:, j]]) for j in range(LABELERS))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(keys, p.tolist())), rel


class Classifier:
    """Logistic regression on votes and span features, trained on posteriors."""

    def __init__(self, patterns: dict[str, int], posteriors: dict[str, float], steps: int = 300):
        self.w = np.zeros(2 * LABELERS + FEATURES + 1)
        if patterns:
            keys = sorted(patterns)
            x = np.array([self.vector(k) for k in keys])
            y, n = np.array([posteriors[k] for k in keys]), np.array([patterns[k] for k in keys], float)
            n /= n.sum()
            for _ in range(steps):
                p = 1 / (1 + np.exp(-np.clip(x @ self.w, -30, 30)))
                self.w -= 2.0 * (x.T @ (n * (p - y)) + 1e-4 * self.w)

    @staticmethod
    def vector(pattern: str) -> list[float]:
        v, f = pattern[:LABELERS], pattern[LABELERS:]
        return [float(c == "+") for c in v] + [float(c == "-") for c in v] + [float(c == "1") for c in f] + [1.0]

    def share(self, pattern: str) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(self.vector(pattern), self.w)))))))

    def accepts(self, pattern: str) -> bool:
        """Sure enough: no labeler's vote alone decides."""
        return self.share(pattern) >= ACCEPT


_HINT = np.zeros(256, bool)
_HINT[[*b"0123456789@+"]] = True


def rows_to_search(texts: pa.Array) -> list[int]:
    out: set[int] = set()
    for row, _, data, offsets in chunks(texts):
        hits = np.flatnonzero(_HINT[data])
        out.update((row + np.unique(np.searchsorted(offsets, hits, "right") - 1)).tolist())
        # an address may be spelt without a sign
        low = data.tobytes()
        for x in (b"[at]", b"(at)"):
            i = low.find(x)
            while i >= 0:
                out.add(row + int(np.searchsorted(offsets, i, "right")) - 1)
                i = low.find(x, i + 1)
    return sorted(out)


def _patterns(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        counts: Counter = Counter()
        texts = batch.column(0)
        for i in rows_to_search(texts):
            text = texts[i].as_py() or ""
            base = Nested(base_spans(text))
            counts.update(votes(text, k, a, b, base) for k, a, b in candidates(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pattern", "times"])


def trained(docs: DataFrame, text: str = "text") -> Classifier:
    """A classifier of the candidates of all documents; without any, one that accepts nothing."""
    rows = in_arrow(docs.select(F.col(f"`{text}`").cast("string").alias("text")), _patterns, "pattern string, times long")
    patterns = {r[0]: r[1] for r in rows.groupBy("pattern").agg(F.sum("times")).collect()}
    return Classifier(patterns, estimated(patterns)[0] if patterns else {})


def find(text: str, classifier: Classifier) -> list[Span]:
    base = base_spans(text)
    cover, nested = Cover(base), Nested(base)
    return base + [("learned", a, b) for k, a, b in candidates(text) if not cover.touches(a, b) and classifier.accepts(votes(text, k, a, b, nested))]


def scanned(docs: DataFrame, text: str = "text", classifier: Classifier | None = None, keep: list[str] | None = None) -> DataFrame:
    """docs with personal_data, an array of (kind, start, end) in code points, by start, then kind.

    Null and empty texts have none; repeated rows get equal results; a column of
    docs named personal_data is replaced. On an empty table nothing is learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier or trained(docs, text))
    kind = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        order = {k: i for i, k in enumerate(KINDS)}
        for i in rows_to_search(texts):
            spans = sorted(set(find(texts[i].as_py() or "", shared.value)), key=lambda x: (x[1], order[x[0]], x[2]))
            out[i] = [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        return {"personal_data": pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))}

    return with_arrow(docs, text, [T.StructField("personal_data", T.ArrayType(kind))], work, keep)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    counts = [counted("personal_data", k).alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined("personal_data", BASE), 256).alias("base_sha256"), joined("personal_data").alias("spans"))
