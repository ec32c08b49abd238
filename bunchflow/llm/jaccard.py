"""Exact n-gram Jaccard join: links, and groups, of documents whose shingle sets overlap enough.

Documents become sets of hashed word shingles. Equal sets are one class, so
copies are never paired. Two sets that link must share one of their rarest
shingles (prefix filtering); a fixed-size count sketch of all shingles puts
frequent ones last in every set's order, so common passages rarely tie
documents together. Any order gives the same links.

Candidates are found on bitmaps. First each set meets the set it shares most
with, which ties groups of near copies together in linear time. Then the
(shingle, size band) groups that still hold several clusters are searched by
signature trees: nodes hold OR-combined shingle bitmaps and size ranges; a dual
traversal prunes pairs of nodes that lie in one cluster, whose sizes can't
match, or whose greatest possible overlap is too small.

Links are found by signature trees too: each set goes once to its cluster,
whose tree is traversed against itself; pairs of leaves that no bound prunes
compare their shingles. That gives each set's number of links and the
components. A large cluster is split by size bands and blocks, a task for each
pair of blocks, so that no task holds more than two blocks; its work grows with
the pairs of its sets, as the number of its links does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import components, hot_keys, key_filter, looked_up
from .tasks import by_group, dropped, in_arrow, measured, table, written
from .words import SPACED, Words, _ranges, batches, signed

#: Buckets of the count sketch (4 bytes each).
SKETCH = 1 << 20
#: Sets and shingles of a block.
BLOCK = 512
BLOCK_SHINGLES = 400_000
#: Bitmaps of a block.
BITMAP_BLOCK = 4096
#: Texts that shingle_sets takes at once: as many as 12 bits number.
MOST_TEXTS = 1 << 12
_SET_BASE = 0xC2B2AE3D27D4EB4F


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): each text's distinct k-word shingles in order of hash; fewer words are one shingle.

    A hash has 52 bits, above which the text's place in the chunk stands while
    sorting, so one plain sort serves all texts.
    """
    n = len(w.counts)
    if n > MOST_TEXTS:
        raise ValueError("too many texts in a chunk")
    grams, ok = w.phrases(k)
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    doc = np.concatenate((np.repeat(np.arange(n), w.counts)[ok], short)).astype(np.uint64)
    value = np.concatenate((grams[ok], w.whole()[short])) >> np.uint64(12)
    both = np.sort(doc << np.uint64(52) | value)
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    both = both[new]
    return both & np.uint64((1 << 52) - 1), np.searchsorted(both >> np.uint64(52), np.arange(n + 1))


def set_keys(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set; equal sets have equal keys."""
    return signed(_ranges(value, bounds[:-1], bounds[1:], _SET_BASE))


def links(inter: int, a: int, b: int, num: int, den: int) -> bool:
    return den * inter >= num * (a + b - inter) and inter > 0


def _numbered(docs: DataFrame, key: str, text: str, row: str | None) -> DataFrame:
    """(id, row, text) of docs, whose rows keep their numbers however often and in whatever parts they are read.

    Numbers that a scan makes up depend on how it splits the files, so they are
    written; a column of docs named by row holds numbers that were.
    """
    number = F.col(f"`{row}`") if row else F.monotonically_increasing_id()
    out = docs.select(F.col(f"`{key}`").alias("id"), number.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    return out if row else written(out)


def _measured(data: DataFrame, k: int) -> DataFrame:
    """kind 0: (id, row, n, set) of each document; kind 1: (row, n) as (bucket, times) of a task's frequent buckets."""
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("id", data.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in ("row", "n", "set"))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, total, of = np.zeros(SKETCH, np.uint32), 0, None
        for batch in it:
            of = batch.schema.field(0).type
            for row, end, w in batches(batch.column(2), SPACED, True, MOST_TEXTS):
                value, bounds = shingle_sets(w, k)
                sketch += np.bincount((value & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
                n = end - row
                total += n
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), *(batch.column(i).slice(row, n) for i in (0, 1)), pa.array(np.diff(bounds)), pa.array(set_keys(value, bounds))], names=["kind", "id", "row", "n", "set"])
        if of is not None:
            mean = float(sketch.mean())
            at = np.flatnonzero(sketch >= max(8.0, mean + 8 * mean**0.5, total / 500))
            n = len(at)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.nulls(n, of), pa.array(at.astype(np.int64)), pa.array(sketch[at].astype(np.int64)), pa.array(np.zeros(n, np.int64))], names=["kind", "id", "row", "n", "set"])

    return in_arrow(data, run, schema)


def _picked(it: Iterator[pa.RecordBatch], only) -> Iterator[pa.RecordBatch]:
    """Rows of (row, text) batches that a filter of row numbers passes: a superset of the wanted ones."""
    for batch in it:
        hit = only.value.has(batch.column(0).to_numpy())
        if hit.any():
            yield batch.filter(pa.array(hit))


def prefix(value: np.ndarray, bounds: np.ndarray, times: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each set's prefix, and their ranks: its rarest values, by (sketch count, value); values are in order in each set.

    A value of no frequent bucket counts 0, so most sets just take their first
    such values; only sets with too few of them order the others.
    """
    n = np.diff(bounds)
    need = n - (num * n + den - 1) // den + 1
    need[n == 0] = 0
    rare = times == 0
    rank = np.cumsum(rare) - rare
    rank -= np.repeat(rank[np.minimum(bounds[:-1], len(rank) - 1)] if len(rank) else bounds[:-1], n)
    take = rare & (rank < np.repeat(need, n))
    have = np.add.reduceat(np.append(rare, False), bounds[:-1]) * (n > 0) if len(n) else need
    for i in np.flatnonzero(have < need):
        at = np.arange(bounds[i], bounds[i + 1])[~rare[bounds[i] : bounds[i + 1]]]
        order = np.lexsort((value[at], times[at]))
        at = at[order[: need[i] - have[i]]]
        take[at], rank[at] = True, have[i] + np.arange(len(at))
    at = np.flatnonzero(take)
    return at, rank[at]


def _prefixes(docs: DataFrame, text: str, k: int, num: int, den: int, sketch, rows, only) -> DataFrame:
    """(token, set, n, rank) of the prefix of the set of each row that the filter `rows` passes; only: a filter of tokens."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _picked(it, rows):
            for _, _, w in batches(batch.column(1), SPACED, True, MOST_TEXTS):
                value, bounds = shingle_sets(w, k)
                n, keys = np.diff(bounds), set_keys(value, bounds)
                new = np.zeros(len(n), bool)
                for i in np.flatnonzero(n):
                    if (x := int(keys[i])) not in seen:
                        seen.add(x)
                        new[i] = True
                at, rank = prefix(value, bounds, sketch.value[(value & np.uint64(SKETCH - 1)).astype(np.int64)], num, den)
                doc = np.repeat(np.arange(len(n)), n)[at]
                token = value[at]
                keep = new[doc]
                if only is not None:
                    keep &= only.value.has(signed(token))
                yield pa.RecordBatch.from_arrays([pa.array(signed(token[keep])), pa.array(keys[doc[keep]]), pa.array(n[doc[keep]].astype(np.int32)), pa.array(rank[keep].astype(np.int32))], names=["token", "set", "n", "rank"])

    return in_arrow(docs.select("row", "text"), run, "token long, set long, n int, rank int")


def _made(docs: DataFrame, text: str, k: int, wanted: DataFrame, make) -> DataFrame:
    """(set, data) with data = make(values) as bytes for the sets of the rows of `wanted`, a written table.

    Sets travel as their values: unlike a text of repeated words, they take what
    their size says. A few other sets, and a set of several tasks more than once,
    may come along; where the filter of rows is crowded, a join keeps them out.
    """
    rows = key_filter(wanted, "row")
    only = docs.sparkSession.sparkContext.broadcast(rows)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _picked(it, only):
            for row, end, w in batches(batch.column(1), SPACED, True, MOST_TEXTS):
                value, bounds = shingle_sets(w, k)
                keys = set_keys(value, bounds)
                new = np.zeros(len(keys), bool)
                for i, x in enumerate(keys.tolist()):
                    if rows_joined or x not in seen:
                        seen.add(x)
                        new[i] = True
                at = np.flatnonzero(new)
                data = [make(value[bounds[i] : bounds[i + 1]]).tobytes() for i in at]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row).filter(pa.array(new)), pa.array(keys[at]), pa.array(data, pa.binary())], names=["row", "set", "data"])

    rows_joined = rows.crowded
    made = in_arrow(docs.select("row", "text"), run, "row long, set long, data binary")
    if rows_joined:
        made = made.join(wanted.select("row"), "row", "left_semi")
    return written(made.select("set", "data"))


def _values(column: pa.Array, dtype=np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype) for x in column]


class Union:
    def __init__(self, of: list[int]):
        first: dict[int, int] = {}
        self.up = [first.setdefault(c, i) for i, c in enumerate(of)]

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.top(i), self.top(j)
        self.up[max(i, j)] = min(i, j)


class SignatureTree:
    """Levels of nodes over sets in order of size; a node holds OR-combined bitmaps and ranges of its sets.

    bits of a set: shingle hash modulo a power of two. A set's excess is its size
    less its set bits, so two sets share at most their common bits plus the
    lesser excess, and so do any two sets below two nodes with the nodes' bits
    and greatest excess.
    """

    FAN = 8

    def __init__(self, bits: np.ndarray, size: np.ndarray, leaf: int = 1):
        """bits: a row of 64-bit words for each set; size: the sets' sizes; leaf: sets of a node of level 0."""
        excess = size - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.levels = [(bits, size, size, excess)]
        if leaf > 1:
            at = np.arange(0, len(size), leaf)
            self.levels = [(np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(size, at), np.maximum.reduceat(size, at), np.maximum.reduceat(excess, at))]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, excess = self.levels[-1]
            at = np.arange(0, len(low), self.FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at)))

    def below(self, level: int, i: int) -> range:
        return range(i * self.FAN, min((i + 1) * self.FAN, len(self.levels[level - 1][1])))

    def may_link(self, level: int, i: int, j: int, num: int, den: int) -> bool:
        bits, low, high, excess = self.levels[level]
        if den * min(high[i], high[j]) < num * max(low[i], low[j]):
            return False
        most = int(np.bitwise_count(bits[i] & bits[j]).sum()) + int(min(excess[i], excess[j]))
        return (num + den) * min(most, int(high[i]), int(high[j])) >= num * int(low[i] + low[j])


    def pairs(self, num: int, den: int) -> Iterator[tuple[int, int]]:
        """Pairs i <= j of nodes of level 0 that may hold linked sets, by a dual traversal from the root."""
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, i, j = stack.pop()
            if not self.may_link(level, i, j, num, den):
                continue
            if level == 0:
                yield i, j
                continue
            below = self.below(level, i)
            stack += [(level - 1, x, y) for x in below for y in (self.below(level, j) if i != j else range(x, below.stop))]


def bitmap_bits(size: int) -> int:
    """Bits of the bitmap of a set: a power of two, at least its size, within 64 and 65536."""
    return 1 << min(16, max(6, (max(size, 1) - 1).bit_length()))


def bitmap(values: np.ndarray, bits: int) -> np.ndarray:
    row = np.zeros(bits, bool)
    row[(values >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(row, bitorder="little")


def folded(rows: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of several powers of two of bits, OR-folded to the least, as rows of 64-bit words."""
    least = min(map(len, rows))
    return np.stack([np.bitwise_or.reduce(r.reshape(-1, least), axis=0) for r in rows]).view(np.uint64)


def traversed(tree: SignatureTree, component: list[int], joins, num: int, den: int) -> list[tuple[int, int]]:
    """Dual traversal: pairs (i, j) of sets in different components that may link and for which joins(i, j) holds."""
    union, out = Union(component), []
    whole: dict[tuple[int, int], int] = {}

    def one_component(level: int, i: int) -> int | None:
        """The component of all sets below a node; once they agree they stay together."""
        if level == 0:
            return union.top(i)
        got = whole.get((level, i))
        if got is not None:
            return union.top(got)
        tops = {one_component(level - 1, x) for x in tree.below(level, i)}
        if len(tops) == 1 and (top := tops.pop()) is not None:
            whole[level, i] = top
            return top
        return None

    stack = [(len(tree.levels) - 1, 0, 0)]
    while stack:
        level, i, j = stack.pop()
        top = one_component(level, i)
        if top is not None and top == one_component(level, j):
            continue
        if i != j and not tree.may_link(level, i, j, num, den):
            continue
        if level == 0:
            if i != j and joins(i, j):
                out.append((i, j))
                union.join(i, j)
            continue
        below = tree.below(level, i)
        stack += [(level - 1, x, y) for x in below for y in (tree.below(level, j) if i != j else range(x, below.stop)) if level > 1 or x != y]
    return out


#: Sets of a leaf of the trees that find links, and shingles that are compared at once.
LEAF = 64
COLUMNS = 1 << 13


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of the ordered sets of a with those of b, as a matrix."""
    one, two = np.concatenate(a), np.concatenate(b)
    of_one, of_two = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b))
    shared = np.intersect1d(one, two)
    out = np.zeros((len(a), len(b)))
    for i in range(0, len(shared), COLUMNS):
        some = shared[i : i + COLUMNS]
        tables = []
        for value, of, n in ((one, of_one, len(a)), (two, of_two, len(b))):
            at = np.minimum(np.searchsorted(some, value), len(some) - 1)
            hit = some[at] == value
            has = np.zeros((n, len(some)), np.float32)
            has[of[hit], at[hit]] = 1
            tables.append(has)
        out += tables[0] @ tables[1].T
    return np.rint(out).astype(np.int64)


def all_links(sets: list[np.ndarray], num: int, den: int, weight: np.ndarray, own: np.ndarray, block: np.ndarray, same: bool) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(links of each set by weight of its partners, edges that connect what links), by a signature tree.

    Guests (not own) are not paired with each other; unless `same`, neither are sets of one block.
    """
    order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i])))
    size = np.array([len(s) for s in sets])
    bits = folded([bitmap(sets[i], bitmap_bits(int(size.max()))) for i in order])
    tree = SignatureTree(bits, size[order], LEAF)
    leaves = [np.array(order[i : i + LEAF]) for i in range(0, len(order), LEAF)]
    links, edges, root = np.zeros(len(sets), np.int64), [], np.arange(len(sets))

    def tie(i: int, j: int) -> None:
        edges.append((i, j))
        root[root == root[j]] = root[i]

    def compared(a: int, b: int) -> None:
        i, j = leaves[a], leaves[b]
        inter = common([sets[x] for x in i], [sets[x] for x in j])
        hit = (den * inter >= num * (size[i][:, None] + size[j] - inter)) & (inter > 0) & (own[i][:, None] | own[j])
        if not same:
            hit &= block[i][:, None] != block[j]
        if a == b:
            hit &= ~np.eye(len(i), dtype=bool)
        links[i] += hit @ weight[j]
        if a != b:
            links[j] += weight[i] @ hit
        while (apart := hit & (root[i][:, None] != root[j])).any():
            for x in np.flatnonzero(apart.any(1)):
                y = int(apart[x].argmax())
                if root[i[x]] != root[j[y]]:
                    tie(int(i[x]), int(j[y]))

    for a, b in tree.pairs(num, den):
        compared(a, b)
    return links, edges


def _blocks(rows: DataFrame, blocks) -> DataFrame:
    """Rows for each pair of blocks x <= y of their group; a row is in as many pairs as its group has blocks."""
    rows = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")}).drop("other", "blocks")


def _bands(num: int, den: int):
    """(band, own) of a set: sets that link are in one band of sizes or in two that follow each other, so it is a guest in the next."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(den / num)) * 1.0000001)).cast("int")
    return F.explode(F.array(F.struct(band.alias("at"), F.lit(True).alias("own")), F.struct((band + 1).alias("at"), F.lit(False).alias("own"))))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with comp, the cluster of their set."""
    return rows.join(labels.withColumnRenamed("node", "set"), "set", "left").withColumn("comp", F.coalesce("label", "set")).drop("label")


def _of_tokens(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """The (token, set, n, rank) rows of the tokens, a written table, and maybe a few more."""
    only = rows.sparkSession.sparkContext.broadcast(key_filter(tokens, "token"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield batch.filter(pa.array(only.value.has(batch.column(0).to_numpy())))

    return written(in_arrow(rows.select("token", "set", "n", "rank"), run, "token long, set long, n int, rank int"))


def _enough(behind, low, high, num: int, den: int):
    """Whether sets of sizes low and high can link: both have enough left from the first value on that they share."""
    behind, low, high = (c.cast("long") for c in (behind, low, high))
    return (behind * (num + den) >= (low + high) * num) & (low * den >= high * num)


def _brief(num: int, den: int):
    """A set at one of its tokens in a long: 8 bits of size, 4 of the token's rank, 52 of the set's key.

    size: twelfths of its logarithm to base 2, rounded down, 255 at most; rank:
    sixteenths of the part of a set that a prefix takes, rounded down, 15 at most.
    """
    size = F.least(F.floor(F.log2(F.col("n").cast("double")) * 12), F.lit(255))
    rank = F.least(F.floor(F.col("rank").cast("double") * (16 * den) / (F.col("n").cast("double") * (den - num))), F.lit(15)) if den > num else F.lit(0)
    return F.shiftleft(size.cast("long"), 56).bitwiseOR(F.shiftleft(rank.cast("long"), 52)).bitwiseOR(F.col("set").bitwiseAND((1 << 52) - 1))


def _briefly(num: int, den: int):
    """_enough for the two sets that least and most describe, by bounds: never false for sets that link."""
    size, rank = ([F.shiftrightunsigned(c, at).bitwiseAND(mask).cast("double") for c in ("least", "most")] for at, mask in ((56, 255), (52, 15)))
    hopeful = F.lit(True)
    for i, j in ((0, 1), (1, 0)):
        ratio = F.pow(F.lit(2.0), (size[j] - size[i] - 1) / 12)  # size j is at least so many times size i
        left = 1 - rank[i] * ((den - num) / (16 * den))  # the part of i from the token on, at most
        hopeful &= (ratio * num <= den * (1 + 1e-9)) & (left * (1 + 1e-9) >= (1 + ratio) * (num / (num + den)))
    return hopeful | (F.greatest(*size) == 255)


def _nearest(shared: DataFrame, maps: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) from sets to the set that shares most of their prefix among the least of its shingles, if bitmaps let them link."""
    leaders = written(shared.groupBy("token").agg(F.min(F.struct("set", "n")).alias("lead"), F.max("set").alias("most"), F.count("*").alias("rows")).where("lead.set <> most"))
    meets = looked_up(shared, leaders, "token", hot_keys(leaders, "token", "rows")).where(F.col("set") != F.col("lead.set"))
    meets = meets.where(F.least("n", "lead.n").cast("long") * den >= F.greatest("n", "lead.n").cast("long") * num)
    times = meets.groupBy("set", "n", F.col("lead").alias("lead")).agg(F.count("*").alias("times"))
    # two sets that link share at least one value of their prefixes; one that shares a tenth of it is worth a look
    pairs = times.groupBy("set", "n").agg(F.max(F.struct("times", "lead")).alias("best")).where(F.col("best.times") * 10 * den >= F.col("n").cast("long") * (den - num))
    pairs = written(pairs.select(F.col("set").alias("a"), F.col("n").alias("n_a"), F.col("best.lead.set").alias("b"), F.col("best.lead.n").alias("n_b")))

    def may(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sizes = zip(*(batch.column(i).to_pylist() for i in (1, 3)))
            ok = []
            for (n, m), x, y in zip(sizes, *(_values(batch.column(i), np.uint8) for i in (4, 5))):
                low, high = ((n, x), (m, y)) if n <= m else ((m, y), (n, x))
                ok.append(SignatureTree(folded([low[1], high[1]]), np.array([low[0], high[0]])).may_link(0, 0, 1, num, den))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    # many sets have one leader
    left, right = (maps.select(F.col("set").alias(c), F.col("data").alias(f"data_{c}")) for c in "ab")
    both = looked_up(pairs.join(left, "a"), right, "b", hot_keys(pairs.groupBy("b").count(), "b"))
    found = written(in_arrow(both.select("a", "n_a", "b", "n_b", "data_a", "data_b"), may, "a long, b long"))
    dropped(leaders, pairs)
    return found


def _across(shared: DataFrame, labels: DataFrame, maps: DataFrame, num: int, den: int) -> DataFrame | None:
    """Edges (a, b) between clusters whose sets bitmaps let link, from signature trees over the (shingle, size band) groups."""
    measures = [F.count("*").alias("size"), F.min("n").alias("low"), F.max("n").alias("high"), F.min(F.col("n") - F.col("rank")).alias("behind"), F.min("comp").alias("c0"), F.max("comp").alias("c1")]
    hopeful = F.expr("c0 <> c1") & ((F.col("size") > 2) | _enough(F.col("behind"), F.col("low"), F.col("high"), num, den))
    # most tokens lie in one cluster or are shared by two sets that can't link: they go before rows are doubled
    tokens = written(_labelled(shared, labels).groupBy("token").agg(*measures).where(hopeful).select("token"))
    held = _labelled(_of_tokens(shared, tokens), labels).select("token", "set", "n", "rank", "comp", _bands(num, den).alias("p"))
    # a group's name; should two have one name, their sets just meet as well
    held = written(held.select(F.xxhash64("token", "p.at").alias("name"), "set", "n", "rank", "comp", "p.own"))
    groups = held.groupBy("name").agg(*measures, F.max("own").alias("any_own"), F.bit_xor(F.xxhash64("set", "own")).alias("mark"))
    groups = groups.where(hopeful & F.col("any_own"))
    # tokens that the very same sets share make the same group: one of them stays
    groups = written(groups.groupBy("mark", "size").agg(F.min("name").alias("name")))
    members = looked_up(held.drop("rank"), groups.select("name", "size"), "name", hot_keys(groups, "name", "size")).where("size IS NOT NULL")
    paired = _blocks(members, F.ceil(F.col("size") / BITMAP_BLOCK)).join(maps, "set")

    def cluster(rows: pa.Table) -> pa.RecordBatch | None:
        order = np.lexsort((rows["set"].to_numpy(), rows["n"].to_numpy()))
        own, block, key, n, comp = (rows[c].to_numpy()[order] for c in ("own", "block", "set", "n", "comp"))
        if den * n[-1] < num * n[0] and len(n) == 2:
            return None
        same, bits = rows["x"][0] == rows["y"][0], _values(rows["data"], np.uint8)
        tree = SignatureTree(folded([bits[i] for i in order]), n)
        # guests meet each other in their own band; sets of one block in the block's own task
        return _edges(traversed(tree, comp.tolist(), lambda i, j: bool(own[i] or own[j]) and bool(same or block[i] != block[j]), num, den), key)

    paired = paired.select("name", "x", "y", "set", "n", "comp", F.col("own").cast("int").alias("own"), "block", "data")
    may = written(by_group(paired, ["name", "x", "y"], cluster, "a long, b long").distinct())
    dropped(tokens, held, groups)
    return may


def _links(docs: DataFrame, reps: DataFrame, clusters: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """kind 0: (a, n): set a links to n rows of other sets; 1: an edge (a, b) of the graph of links. reps: set, row, n, copies."""
    sizes = written(reps.join(clusters.withColumnRenamed("node", "set"), "set").select("set", "row", "n", "copies", F.col("label").alias("cluster")))
    values = _made(docs, "text", k, sizes, lambda x: x)

    def per(rows: DataFrame, key: str) -> DataFrame:
        blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
        return written(rows.groupBy(key).agg(blocks.alias("blocks"), F.count("*").alias("rows")))

    whole = per(sizes, "cluster")
    of = looked_up(sizes, whole, "cluster", hot_keys(whole, "cluster", "rows"))
    small = of.where("blocks = 1").select(F.col("cluster").alias("name"), "set", "n", "copies", F.lit(True).alias("own"), F.lit(1).alias("blocks"))
    # the sets of a large cluster meet those of like size only
    large = of.where("blocks > 1").select("cluster", "set", "n", "copies", _bands(num, den).alias("p"))
    bands = written(large.select(F.xxhash64("cluster", "p.at").alias("name"), "set", "n", "copies", "p.own"))
    parts = per(bands, "name")
    large = looked_up(bands, parts, "name", hot_keys(parts, "name", "rows")).select("name", "set", "n", "copies", "own", F.col("blocks").cast("int").alias("blocks"))
    searched = _blocks(small.unionByName(large), F.col("blocks")).join(values, "set")

    def search(rows: pa.Table) -> pa.RecordBatch | None:
        # a set may have come along twice
        once = np.unique(rows["set"].to_numpy(), return_index=True)[1]
        sets = [x for x in _values(rows["data"].take(pa.array(once)))]
        own, block, key, copies = (rows[c].to_numpy()[once] for c in ("own", "block", "set", "copies"))
        if not own.any():
            return None
        n, edges = all_links(sets, num, den, copies, own == 1, block, rows["x"][0] == rows["y"][0])
        at = np.flatnonzero(n)
        a, b = (np.array([e[i] for e in edges], np.int64) for i in (0, 1))
        none = np.zeros(len(at), np.int64)
        columns = [np.repeat(np.array([0, 1], np.int32), [len(at), len(a)]), np.concatenate((key[at], key[a])), np.concatenate((none, key[b])), np.concatenate((n[at], np.zeros(len(a), np.int64)))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "a", "b", "n"])

    searched = searched.select("name", "x", "y", "set", F.col("own").cast("int").alias("own"), "block", "copies", "data")
    out = written(by_group(searched, ["name", "x", "y"], search, "kind int, a long, b long, n long"))
    dropped(values, sizes, whole, bands, parts)
    return out


def _edges(pairs: list[tuple[int, int]], key: np.ndarray) -> pa.RecordBatch | None:
    if not pairs:
        return None
    at = np.array(pairs)
    return pa.RecordBatch.from_arrays([pa.array(key[at[:, 0]]), pa.array(key[at[:, 1]])], names=["a", "b"])


def _candidates(docs: DataFrame, reps: DataFrame, made: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(node, label): clusters of sets such that all sets that link are in one."""
    spark = docs.sparkSession
    frequent = made.where("kind = 1").groupBy("row").agg(F.sum("n").alias("times")).collect()  # at most SKETCH rows
    counts = np.zeros(SKETCH, np.uint32)
    for r in frequent:
        counts[r[0]] = min(r[1], 2**32 - 1)
    sketch = spark.sparkContext.broadcast(counts)
    first = spark.sparkContext.broadcast(key_filter(reps, "row"))

    tokens = _prefixes(docs, "text", k, num, den, sketch, first, None).select("token", _brief(num, den).alias("brief"))
    tokens = tokens.groupBy("token").agg(F.min("brief").alias("least"), F.max("brief").alias("most"), F.count("*").alias("size"))
    # most shared tokens are chance: their two sets differ too much in size, or would have to share one before
    tokens = written(tokens.where((F.col("least") != F.col("most")) & ((F.col("size") > 2) | _briefly(num, den))).select("token"))
    only = spark.sparkContext.broadcast(key_filter(tokens, "token"))
    shared = written(_prefixes(docs, "text", k, num, den, sketch, first, only).distinct())
    maps = _made(docs, "text", k, written(reps.join(shared.select("set").distinct(), "set", "left_semi")), lambda x: bitmap(x, bitmap_bits(len(x))))
    near = _nearest(shared, maps, num, den)
    labels = components(near)
    more = _across(shared, labels, maps, num, den)
    if measured(more):
        labels = components(near.unionByName(more))
    dropped(tokens, shared, maps, near, more)
    return labels


def grouped(docs: DataFrame, k: int, num: int, den: int, key: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """(id, n_shingles, component_id, n_links) for each row of docs: the set's size, the least id that links reach, and the number of rows that link with it.

    Two rows link when den * |A & B| >= num * |A | B| for their sets of distinct
    k-word shingles of ASCII-lower-cased text. Null, empty and wordless texts
    have the empty set, which links with nothing: their component is their own
    id. Repeated rows and texts with equal sets are in one component, and link
    with each other. A null id
    never is a component's least unless all its ids are null. Very long texts
    are taken whole. An empty table gives no rows. Other columns aren't looked at.
    """
    docs = _numbered(docs, key, text, row)
    made = written(_measured(docs, k))
    rows = made.where("kind = 0").select("id", F.col("n").alias("n_shingles"), "set")
    # each set's first row stands for it
    reps = written(made.where("kind = 0 AND n > 0").groupBy("set").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.count("*").alias("copies"), F.min("id").alias("least")))
    found = None
    if num < den:  # else only equal sets link
        found = _links(docs, reps, _candidates(docs, reps, made, k, num, den), k, num, den)
    sets = reps.select("set", "least", "copies", F.col("set").alias("group"), (F.col("copies") - 1).alias("n_links"))
    if found is not None:
        labels = components(found.where("kind = 1"))
        times = found.where("kind = 0").groupBy(F.col("a").alias("set")).agg(F.sum("n").alias("others"))
        sets = sets.drop("group").join(labels.withColumnRenamed("node", "set"), "set", "left").join(times, "set", "left")
        sets = written(sets.select("set", "least", "copies", F.coalesce("label", "set").alias("group"), (F.col("n_links") + F.coalesce("others", F.lit(0))).alias("n_links")))
    groups = written(sets.groupBy("group").agg(F.min("least").alias("component_id"), F.count("*").alias("sets")))
    of_set = looked_up(sets.select("set", "group", "copies", "n_links"), groups, "group", hot_keys(groups, "group", "sets"))
    of_set = written(of_set.select("set", "copies", "component_id", "n_links"))
    out = looked_up(rows.where("n_shingles > 0"), of_set.drop("copies"), "set", hot_keys(of_set, "set", "copies"))
    alone = rows.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return out.select("id", "n_shingles", "component_id", "n_links").unionByName(alone)


def deduplicated(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, text: str = "text") -> DataFrame:
    """One row of each group of near copies (the first by row number), with the columns of docs, which is read once."""
    numbered = written(docs.select(*[F.col(f"`{c}`").alias(f"__in_{c}") for c in docs.columns], F.monotonically_increasing_id().alias("__row")))
    found = grouped(numbered, k, num, den, "__row", f"__in_{text}", "__row")
    go = written(found.where("id <> component_id").select(F.col("id").alias("__row")))
    only = docs.sparkSession.sparkContext.broadcast(key_filter(go, "__row"))

    def held(passes: bool):
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in it:
                yield batch.filter(pa.array(only.value.has(batch.column(batch.num_columns - 1).to_numpy()) == passes))

        return in_arrow(numbered, run, numbered.schema)

    # the filter never misses a row that goes, so only rows that pass it, not all texts, are shipped to be looked up
    stay = held(False).unionByName(held(True).join(go, "__row", "left_anti"))
    return stay.select(*[F.col(f"`__in_{c}`").alias(c) for c in docs.columns])


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return grouped(docs, 4, 85, 100).withColumnRenamed("id", "doc_id")
