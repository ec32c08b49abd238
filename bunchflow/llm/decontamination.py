"""Benchmark decontamination with an FM-index over each training shard.

A shard is one Arrow batch of documents. Words that no benchmark text has can't
lie in a benchmark window, so a shard's index holds only its runs of benchmark
words that are as long as the shortest window; the rest of the text would never
be reached by a search. The index is a suffix array's Burrows-Wheeler transform
in a wavelet matrix with rank tables, and suffix positions sampled every
SAMPLE words. All windows are searched backward together; occurrences are
walked to a sampled suffix, mapped to document words and merged into spans.

Memory: one shard's index, and one block of windows (BLOCK_WORDS words of
benchmark text and one item more at most, broadcast). A larger benchmark takes
several blocks, one after another: each passes all documents, whose hits so far
are written with them, and its broadcast is gone before the next one is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tasks import dropped, in_arrow, table, written
from .words import ALNUM, batches

WINDOW = 10
SAMPLE = 4
#: Benchmark words in one broadcast block.
BLOCK_WORDS = 500_000


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; s ends in its only 0."""
    rank, step, n = s.astype(np.int64), 1, len(s)
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (int(rank.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([0], np.diff(key[order]) != 0)))
        if new[order[-1]] == n - 1:
            return order
        rank, step = new, step * 2


class FMIndex:
    """Counts and locates word sequences in s, an array of small non-negative ints without a final 0."""

    def __init__(self, s: np.ndarray, sample: int = SAMPLE):
        s = np.concatenate((s, [0]))
        order = suffix_order(s)
        bwt = s[order - 1]
        self.n, self.sample = len(s), sample
        self.levels = max(1, int(s.max()).bit_length())
        self.less = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=1 << self.levels))))
        self.ones, self.zeros, level = [], [], bwt
        for bit in range(self.levels - 1, -1, -1):
            b = (level >> bit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(b, dtype=np.int32))))
            self.zeros.append(int(self.n - b.sum()))
            level = np.concatenate((level[b == 0], level[b == 1]))
        self.marked = order % sample == 0
        self.marks = np.concatenate(([0], np.cumsum(self.marked, dtype=np.int32)))
        self.sampled = order[self.marked]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c[j] before row i[j]."""
        begin = np.zeros_like(i)
        for at, bit in enumerate(range(self.levels - 1, -1, -1)):
            one = (c >> bit) & 1 == 1
            up, down = self.ones[at][i], self.ones[at][begin]
            i = np.where(one, self.zeros[at] + up, i - up)
            begin = np.where(one, self.zeros[at] + down, begin - down)
        return i - begin

    def symbol(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros_like(i)
        for at in range(self.levels):
            one = self.ones[at][i + 1] - self.ones[at][i] == 1
            i = np.where(one, self.zeros[at] + self.ones[at][i], i - self.ones[at][i])
            c = c * 2 + one
        return c

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns, one in each row, by backward search."""
        # a symbol that s can't hold is in no table
        live = np.flatnonzero((patterns < 1 << self.levels).all(axis=1))
        lo, hi = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
        hi[live] = self.n
        for c in patterns.T[::-1]:
            c = c[live]
            lo[live], hi[live] = self.less[c] + self.rank(c, lo[live]), self.less[c] + self.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in s of suffix rows: steps back to the next sampled one."""
        at, out, steps, live = rows.copy(), np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        while len(live):
            hit = self.marked[at[live]]
            out[live[hit]] = self.sampled[self.marks[at[live[hit]]]] + steps
            live = live[~hit]
            c = self.symbol(at[live])
            at[live] = self.less[c] + self.rank(c, at[live])
            steps += 1
        return out


def window_block(texts: list[tuple[object, str | None]], window: int) -> dict:
    """Vocabulary, and for each length the windows with the items that have them."""
    ids, windows = [], {}
    vocabulary: dict[int, int] = {}
    for item, text in texts:
        for _, _, w in batches(pa.array([text], pa.string()), ALNUM, True):
            words = [vocabulary.setdefault(int(h), len(vocabulary) + 2) for h in w.hashes]
            if words:
                size = min(window, len(words))
                for i in range(len(words) - size + 1):
                    windows.setdefault(size, {}).setdefault(tuple(words[i : i + size]), set()).add(len(ids))
        ids.append("null" if item is None else str(item))
    known = np.array(list(vocabulary), np.uint64)
    order = np.argsort(known)
    by_size = [(k, np.array(list(v), np.int64).reshape(-1, k), [sorted(x) for x in v.values()]) for k, v in sorted(windows.items())]
    return {"hashes": known[order], "symbols": order + 2, "windows": by_size, "ids": ids, "least": min(windows, default=0)}


def blocks(benchmark: DataFrame, window: int, most: int = BLOCK_WORDS) -> Iterator[dict]:
    held, words = [], 0
    for r in benchmark.select("item_id", F.col("text").cast("string")).toLocalIterator():
        held.append((r[0], r[1]))
        words += len((r[1] or "").split()) + 1
        if words >= most:
            yield window_block(held, window)
            held, words = [], 0
    if held:
        yield window_block(held, window)


def shard_hits(texts: pa.Array, block: dict) -> tuple[np.ndarray, dict[int, list[tuple[int, int]]], dict[int, set[str]], dict[int, object]]:
    """Words of each text; by row: merged word spans, item ids, and the bytes of these spans."""
    counts, spans, items = np.zeros(len(texts), np.int64), {}, {}
    runs, where = [], []
    total = 0
    flags = np.zeros(1 << 16, bool)
    flags[(block["hashes"] & np.uint64(0xFFFF)).astype(np.int64)] = True
    held = []
    for row, end, w in batches(texts, ALNUM, True):
        counts[row:end] = w.counts
        if not block["least"] or not len(w.hashes):
            continue
        maybe = np.flatnonzero(flags[(w.hashes & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(block["hashes"], w.hashes[maybe]), len(block["hashes"]) - 1)
        same = block["hashes"][place] == w.hashes[maybe]
        at, symbol = maybe[same], block["symbols"][place[same]]
        if not len(at):
            continue
        doc = np.searchsorted(w.lo, at, "right") - 1
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(doc) != 0)) + 1
        bounds = np.concatenate(([0], cut, [len(at)]))
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= block["least"]:
                runs.append(np.concatenate((symbol[a:b], [1])))
                where.append((total, row + int(doc[a]), int(at[a] - w.lo[doc[a]])))
                total += b - a + 1
        held.append((row, end, w))
    if not runs:
        return counts, {}, {}, {}
    index = FMIndex(np.concatenate(runs))
    begins = np.array([x[0] for x in where])
    for size, patterns, owners in block["windows"]:
        lo, hi = index.search(patterns)
        found = np.repeat(np.arange(len(patterns)), hi - lo)
        rows = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi) if b > a] or [np.zeros(0, np.int64)])
        for p, at in zip(found, index.locate(rows)):
            begin, row, first = where[int(np.searchsorted(begins, at, "right")) - 1]
            spans.setdefault(row, []).append((first + int(at) - begin, first + int(at) - begin + size))
            items.setdefault(row, set()).update(block["ids"][i] for i in owners[p])
    spans = {row: merged(x) for row, x in spans.items()}
    places = {}
    for row, end, w in held:
        for r in range(row, end):
            if r in spans:
                lo, start = w.lo[r - row], None
                text = texts[r].as_py().encode()
                base = int(w.starts[lo]) - first_word(text)
                places[r] = [(int(w.starts[lo + a]) - base, int(w.ends[lo + b - 1]) - base) for a, b in spans[r]]
    return counts, spans, items, places


def first_word(text: bytes) -> int:
    for _, _, w in batches(pa.array([text.decode()]), ALNUM, True):
        return int(w.starts[0])
    return 0


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SPANS = T.ArrayType(T.ArrayType(T.LongType()))
RESULT = [T.StructField("n_words", T.LongType()), T.StructField("word_spans", SPANS), T.StructField("byte_spans", SPANS), T.StructField("item_ids", T.ArrayType(T.StringType()))]


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", keep: list[str] | None = None, cut: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with n_words long, word_spans and byte_spans (merged [start, end) pairs) and item_ids (sorted strings).

    A null or wordless text has 0 words and empty lists; so has every text when
    the benchmark is empty. A benchmark text of fewer than `window` words, but
    not none, is one window; null and wordless ones have no window. A null
    item_id counts as "null"; equal ids count once. Repeated rows, and equal
    windows of several items, keep their own results. Input columns named as a
    result column are replaced. cut: the spans are taken out of text on the way.
    """
    spark = docs.sparkSession
    names = [f.name for f in RESULT]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names and not (cut and c == text)]
    data = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text__"))
    parts = blocks(benchmark, window, block_words)
    block = next(parts, None) or window_block([], window)
    while True:
        following = next(parts, None)
        shared = spark.sparkContext.broadcast(block)
        found = _searched(data, shared, keep, (text if cut else None) if following is None else "__text__", following is None and cut)
        if following is None:
            return found
        before, data, block = data, written(found), following
        shared.unpersist()
        if hasattr(before, "_bunchflow_path"):
            dropped(before)


def _searched(data: DataFrame, shared, keep: list[str], name: str | None, cut: bool) -> DataFrame:
    """data with the hits of one more block; name: that of the text in the result, if it stays."""
    n_keep, before = len(keep), "item_ids" in data.columns
    fields = [*(data.schema[c] for c in keep), *([T.StructField(name, T.StringType())] if name else []), *RESULT]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if not (n := batch.num_rows):
                continue
            texts = batch.column(n_keep)
            counts, spans, items, places = shard_hits(texts, shared.value)
            if before:
                spans, places = (_both(batch.column(n_keep + i), x) for i, x in ((2, spans), (3, places)))
                earlier = batch.column(n_keep + 4)
                items = {r: {*items.get(r, ()), *more} for r in range(n) if (more := earlier[r].as_py()) or r in items}
            if cut and places:
                texts = pa.array([without_spans(x.as_py().encode(), places[r]).decode() if r in places else x.as_py() for r, x in enumerate(texts)], pa.string())
            pairs = pa.list_(pa.list_(pa.int64()))
            new = [pa.array(counts), *(pa.array([x.get(r, []) for r in range(n)], pairs) for x in (spans, places)), pa.array([sorted(items.get(r, ())) for r in range(n)], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n_keep)), *([texts] if name else []), *new], names=[f.name for f in fields])

    return in_arrow(data, run, T.StructType(fields))


def _both(earlier: pa.Array, found: dict[int, list]) -> dict[int, list]:
    """Spans of earlier blocks and of this one, merged, by row."""
    out = {}
    for r, x in enumerate(earlier):
        if (held := x.as_py()) or r in found:
            out[r] = merged([*map(tuple, held), *found.get(r, ())])
    return out


def without_spans(text: bytes, spans: list) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The columns of docs, with the benchmark passages cut out of text and n_chars counted anew; a null text stays null."""
    columns = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"__in_{c}") for c in columns])
    found = contaminated_spans(inner, benchmark, window, cut=True)
    chosen = {c: F.col("text" if c == "text" else f"`__in_{c}`") for c in columns}
    if "n_chars" in columns:
        chosen["n_chars"] = F.coalesce(F.length("text").cast("long"), "__in_n_chars")
    return found.select(*[x.alias(c) for c, x in chosen.items()])


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated_spans(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    hit = F.aggregate("word_spans", F.lit(0).cast("long"), lambda n, x: n + x[1] - x[0])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("word_spans") > 0).alias("contaminated"),
    )
