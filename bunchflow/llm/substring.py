"""Exact removal of word passages that recur anywhere in the corpus.

A window of WINDOW words is judged by whether its word sequence also starts at
another place. Texts with equal word sequences are one class. The first pass
writes the texts, one of each class that a task meets, under the number of their
group, so that later passes read the same groups however their scans are split.

1. Each window has an anchor, its least hashed SEED-word phrase, so equal windows
   have equal anchors, and a text has one anchor in about 14 words. Anchors of
   several places are counted; a fixed-size filter of them goes to all tasks.
2. Windows with such an anchor are hashed and confirmed by a count over the
   corpus. A task's texts come in groups; a group announces a window once, by its
   first place, so passages of many documents cost a row a group, not one an
   occurrence.
3. Confirmed windows that follow each other are phrases, cut where the group's
   texts go on differently, so that an occurrence of a window in the group always
   is part of one of its phrase.
4. Each group of texts compiles its phrases into Aho-Corasick automata of bounded
   size and streams its texts over them; the matches are the passages removed.

An automaton so holds just the phrases that its group of texts can contain, and a
text meets the automata of one group: work and memory stay linear in the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import hot_keys, key_filter, looked_up
from .tasks import by_group, dropped, in_arrow, table, written
from .words import SPACED, Words, batches, signed, tokenize

WINDOW = 35
SEED = 8
#: Words of a group of texts (one longer text makes its own).
GROUP_WORDS = 1_500_000
#: Words of an automaton's phrases, three nodes each; a group compiles as many automata as it needs.
AUTOMATON_WORDS = 300_000
LETTERS = 3
EMPTY = hashlib.sha256(b"").hexdigest()


def window_hashes(w: Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, anchor, text, position in the text) of every window."""
    hashes, ok = w.phrases(window)
    seeds, _ = w.phrases(seed)
    least, width = seeds, 1
    need = window - seed + 1
    while width * 2 <= need:
        least = np.minimum(least[: len(least) - width], least[width:]) if len(least) > width else least[:0]
        width *= 2
    if width < need:
        more = need - width
        least = np.minimum(least[: len(least) - more], least[more:]) if len(least) > more else least[:0]
    at = np.flatnonzero(ok)
    doc = np.repeat(np.arange(len(w.counts)), w.counts)[at]
    return hashes[at], least[at], doc, at - w.lo[doc]


def whole_keys(w: Words) -> np.ndarray:
    return signed(w.whole())


def _measured(docs: DataFrame, key: str, text: str, window: int, group_words: int) -> DataFrame:
    """(id, n_words, class, sha256) of each document; (class, group, text) with a null n_words of the texts to search.

    Those are texts of at least a window, one of each class that the task
    meets; group: a number of its own for every group_words words of them.
    """
    data = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), F.monotonically_increasing_id().alias("group"))
    kinds = [("n_words", T.LongType()), ("class", T.LongType()), ("sha256", T.StringType()), ("group", T.LongType()), ("text", T.StringType())]
    schema = T.StructType([data.schema["id"], *(T.StructField(c, t) for c, t in kinds)])
    names = schema.names

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        group, words = None, 0
        for batch in it:
            numbers = batch.column(2).to_numpy()
            for row, end, w in batches(batch.column(1), SPACED, False):
                n, keys, texts = end - row, whole_keys(w), batch.column(1).slice(row, end - row)
                sha = [hashlib.sha256(b" ".join((x.as_py() or "").encode().split())).hexdigest() for x in texts]
                rows = [batch.column(0).slice(row, n), pa.array(w.counts.astype(np.int64)), pa.array(keys), pa.array(sha), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays(rows, names=names)
                at = [i for i in np.flatnonzero(w.counts >= window).tolist() if not (int(keys[i]) in seen or seen.add(int(keys[i])))]
                if not at:
                    continue
                # the number of the group's first chunk names it: no other task has it
                group = int(numbers[row]) if group is None else group
                n, words = len(at), words + int(w.counts[at].sum())
                rows = [pa.nulls(n, batch.schema.field(0).type), pa.nulls(n, pa.int64()), pa.array(keys[at]), pa.nulls(n, pa.string()), pa.array(np.full(n, group, np.int64)), texts.take(pa.array(at))]
                yield pa.RecordBatch.from_arrays(rows, names=names)
                if words >= group_words:
                    group, words = None, 0

    return in_arrow(data, run, schema)


def _anchors(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """(anchor, class, often): anchors of a chunk's windows; often: one of its windows occurs twice in the chunk."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for _, _, w in batches(batch.column(0), SPACED, False):
                value, anchor, doc, _ = window_hashes(w, window, seed)
                if not len(value):
                    continue
                order = np.argsort(value)
                twice = np.zeros(len(value), bool)
                same = value[order][1:] == value[order][:-1]
                twice[order[1:][same]] = twice[order[:-1][same]] = True
                first = np.ones(len(anchor), bool)
                first[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | twice[1:]
                keys = whole_keys(w)
                yield pa.RecordBatch.from_arrays([pa.array(signed(anchor[first])), pa.array(keys[doc[first]]), pa.array(twice[first])], names=["anchor", "class", "often"])

    return in_arrow(texts.select("text"), run, "anchor long, class long, often boolean")


def phrases_of(value: np.ndarray, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(once, first, twice, begins, ends) of a group's windows, in order of text and place.

    once: windows with no equal one; first: the first place of each other
    window; twice: all places of those. begins, ends: bounds of the phrases, as
    places in the input. Two windows are of one phrase when wherever either
    occurs the other stands beside it.
    """
    n = len(value)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    order = np.argsort(value, kind="stable")
    lead = np.ones(n, bool)
    lead[1:] = value[order][1:] != value[order][:-1]
    starts = np.flatnonzero(lead)
    times = np.diff(np.append(starts, n))
    number = np.empty(n, np.int64)
    number[order] = np.cumsum(lead) - 1
    more = times > 1
    near = (key[1:] == key[:-1]) & (at[1:] == at[:-1] + 1)
    after, before = np.full(n, -1), np.full(n, -1)
    after[:-1][near] = number[1:][near]
    before[1:][near] = number[:-1][near]

    def only(beside: np.ndarray) -> np.ndarray:
        """The one window beside each window, or -1."""
        low, high = np.minimum.reduceat(beside[order], starts), np.maximum.reduceat(beside[order], starts)
        return np.where(low == high, low, -1)

    after, before = only(after), only(before)
    first = np.sort(order[starts[more]])
    u, v = number[first[:-1]], number[first[1:]]
    joined = (first[1:] == first[:-1] + 1) & (after[u] == v) & (before[v] == u)
    cuts = np.flatnonzero(~joined) + 1
    begins = first[np.append(0, cuts)] if len(first) else first
    ends = first[np.append(cuts, len(first)) - 1] + 1 if len(first) else first
    return np.flatnonzero(~more[number]), first, np.flatnonzero(more[number]), begins, ends


def _windows(texts: DataFrame, window: int, seed: int, only) -> DataFrame:
    """kind 0: a window (value, group, class, at) that its group has once; 1: one that it has more often.

    2: a phrase at .. till of the latter; 3: a text with any of the latter.
    Of a group that a scan splits, each part announces its own.
    """

    def emit(group: int, held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        value, key, at = (np.concatenate([h[i] for h in held]) for i in range(3))
        once, first, twice, begins, ends = phrases_of(value, key, at)
        yield _rows(0, group, value[once], key[once], at[once], at[once] + 1)
        yield _rows(1, group, value[first], key[first], at[first], at[first] + 1)
        yield _rows(2, group, value[begins], key[begins], at[begins], at[ends - 1] + 1)
        some = np.unique(key[twice])
        none = np.zeros(len(some), np.int64)
        yield _rows(3, group, none.astype(np.uint64), some, none, none)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        group = None
        for batch in it:
            numbers = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(numbers)]):
                if held and numbers[a] != group:
                    yield from emit(group, held)
                    held = []
                group = int(numbers[a])
                for _, _, w in batches(batch.column(1).slice(a, b - a), SPACED, False):
                    value, anchor, doc, at = window_hashes(w, window, seed)
                    keep = only.value.has(signed(anchor))
                    held.append((value[keep], whole_keys(w)[doc[keep]], at[keep]))
        if held:
            yield from emit(group, held)

    return in_arrow(texts.select("group", "text"), run, "kind int, value long, group long, class long, at long, till long")


def _rows(kind: int, group: int, value: np.ndarray, key: np.ndarray, at: np.ndarray, till: np.ndarray) -> pa.RecordBatch:
    n = len(value)
    columns = [pa.array(np.full(n, kind, np.int32)), pa.array(signed(value)), pa.array(np.full(n, group, np.int64)), *(pa.array(c.astype(np.int64)) for c in (key, at, till))]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "value", "group", "class", "at", "till"])


def _group_texts(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(group, class, text): the texts of the classes (a written column `class`), and maybe some more."""
    only = texts.sparkSession.sparkContext.broadcast(key_filter(classes, "class"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield batch.filter(pa.array(only.value.has(batch.column(1).to_numpy())))

    return in_arrow(texts.select("group", "class", "text"), run, "group long, class long, text string")


def merged(kind: np.ndarray, key: np.ndarray, at: np.ndarray, till: np.ndarray) -> list[tuple[int, int, int]]:
    """(class, at, till) of phrases: windows of kind 0 that follow each other are one; others stay as they are."""
    out: list[tuple[int, int, int]] = [tuple(x) for x in np.stack((key, at, till), 1)[kind != 0].tolist()]
    order = np.lexsort((at[kind == 0], key[kind == 0]))
    key, at, till = (c[kind == 0][order] for c in (key, at, till))
    begin = np.ones(len(key), bool)
    begin[1:] = (key[1:] != key[:-1]) | (at[1:] > till[:-1])
    starts = np.flatnonzero(begin)
    if len(starts):
        out += zip(key[starts].tolist(), at[starts].tolist(), np.append(till[starts[1:] - 1], till[-1]).tolist())
    return out


def lettered(w: Words) -> list[str]:
    """Each text as a string with LETTERS letters for each word; few letters, since automata look branches up one by one."""
    words, number = np.unique(w.hashes, return_inverse=True)
    base = 2
    while base**LETTERS < len(words):
        base += 1
    letters = np.empty((len(number), LETTERS), np.uint32)
    for i in range(LETTERS):
        letters[:, i] = number // base**i % base + 1
    return [letters[a:b].tobytes().decode("utf-32-le") for a, b in zip(w.lo[:-1], w.lo[1:])]


def occurrences(texts: list[str], phrases: Iterator[str]) -> list[list[tuple[int, int]]]:
    """Bounds, in words, of all occurrences of the phrases in each text, by automata of AUTOMATON_WORDS."""
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    automaton, held = ahocorasick.Automaton(ahocorasick.STORE_INTS), 0

    def stream() -> None:
        automaton.make_automaton()
        for spans, text in zip(found, texts):
            # letters that don't end with a word belong to no phrase
            spans += [((end + 1) // LETTERS - n, (end + 1) // LETTERS) for end, n in automaton.iter(text) if (end + 1) % LETTERS == 0]

    for phrase in phrases:
        n = len(phrase) // LETTERS
        if automaton.add_word(phrase, n):
            held += n
        if held >= AUTOMATON_WORDS:
            stream()
            automaton, held = ahocorasick.Automaton(ahocorasick.STORE_INTS), 0
    if held:
        stream()
    return found


def _located(texts: DataFrame, phrases: DataFrame, window: int, with_text: bool) -> DataFrame:
    """(class, n_cut, cut_sha256, kept) of the texts in which phrases of their group occur."""
    nothing = F.lit(None)
    rows = phrases.select("group", "class", "kind", "at", "till", nothing.cast("string").alias("text"))
    rows = rows.unionByName(texts.select("group", "class", F.lit(4).alias("kind"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("till"), "text"))

    def locate(rows: pa.Table) -> pa.RecordBatch | None:
        kind, key, at, till = (rows[c].to_numpy() for c in ("kind", "class", "at", "till"))
        is_text = kind == 4
        column = rows["text"].combine_chunks().filter(pa.array(is_text))
        keys = key[is_text].tolist()
        place = {c: i for i, c in enumerate(keys)}
        raw = [x.as_py().encode() for x in column]
        offsets = np.cumsum([0, *map(len, raw)])
        coded = lettered(tokenize(np.frombuffer(b"".join(raw), np.uint8), offsets, SPACED, False))
        some = ~is_text
        wanted = merged(kind[some], key[some], at[some], till[some])
        found = occurrences(coded, (coded[place[c]][LETTERS * a : LETTERS * (b - 1 + window)] for c, a, b in wanted))
        got = [(c, *cut_words(t.split(), [(a, b - window + 1) for a, b in spans], window)) for c, t, spans in zip(keys, raw, found) if spans]
        if not got:
            return None
        sha = [hashlib.sha256(x[2]).hexdigest() for x in got]
        kept = [x[2].decode() if with_text else None for x in got]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], names=["class", "n_cut", "cut_sha256", "kept"])

    return by_group(rows, ["group"], locate, "class long, n_cut long, cut_sha256 string, kept string")


def cut_words(words: list[bytes], runs: list[tuple[int, int]], window: int) -> tuple[int, bytes]:
    """Words covered by the windows that start in the runs, and the other words joined by one space."""
    out, at, removed = [], 0, 0
    for a, b in sorted(runs):
        b = b - 1 + window
        out += words[at:a] if a > at else []
        removed += max(0, b - max(a, at))
        at = max(at, b)
    return removed, b" ".join(out + words[at:])


def removed(docs: DataFrame, window: int = WINDOW, seed: int = SEED, key: str = "doc_id", text: str = "text", with_text: bool = False, group_words: int = GROUP_WORDS) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) for each row of docs; with_text adds kept, the words left, joined by one space, or null where nothing was removed.

    A word is removed if some window of `window` consecutive words over it
    starts at another place of the corpus too, in the same text or another;
    windows are judged on the input. Texts of fewer words, null and empty ones
    lose nothing. Repeated rows are different places. Any length is taken
    whole. An empty table gives no rows; other columns aren't looked at. docs is
    read once.
    """
    spark = docs.sparkSession
    made = written(_measured(docs, key, text, window, group_words))
    rows = made.where("n_words IS NOT NULL").select("id", "n_words", "class", "sha256")
    texts = made.where("n_words IS NULL").select("group", "class", "text")
    copies = written(rows.where(F.col("n_words") >= window).groupBy("class").agg(F.count("*").alias("copies")).where("copies > 1"))

    places = _anchors(texts, window, seed).groupBy("anchor").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.max("often").alias("often"))
    anchors = written(places.where("often OR least <> most").select("anchor"))
    only = spark.sparkContext.broadcast(key_filter(anchors, "anchor"))
    found = written(_windows(texts, window, seed, only))

    # a value's rows are one a group of texts at most, and are merged where they are before they meet
    place = F.struct("class", "at")
    told = found.where("kind < 2").groupBy("value").agg(F.max("kind").alias("told"), F.min(place).alias("least"), F.max(place).alias("most"))
    told = told.where("told = 1 OR least <> most").select("value")
    confirmed = found.where("kind = 0").join(told, "value", "left_semi").select("kind", "group", "class", "at", "till")
    # a class with copies loses all its words anyway; phrases of other texts may be read from it
    confirmed = written(confirmed.join(copies, "class", "left_anti"))
    phrases = confirmed.unionByName(found.where("kind = 2").select(*confirmed.columns))
    streamed = found.where("kind = 3").select("class").join(copies, "class", "left_anti")
    classes = written(phrases.select("class").union(streamed).distinct())
    cuts = _located(_group_texts(texts, classes), phrases, window, with_text)
    cuts = written(cuts.groupBy("class").agg(F.first("n_cut").alias("n_cut"), F.first("cut_sha256").alias("cut_sha256"), F.first("kept").alias("kept")))
    dropped(anchors, found, confirmed, classes)
    both = copies.join(cuts, "class", "full")
    out = looked_up(rows, both, "class", hot_keys(copies, "class", "copies"))
    all_gone = F.col("copies").isNotNull()
    columns = [
        F.col("id"),
        F.col("n_words"),
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(all_gone, F.lit(EMPTY)).otherwise(F.coalesce("cut_sha256", "sha256")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(all_gone, F.lit("")).otherwise(F.col("kept")).alias("kept"))
    return out.select(*columns)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
