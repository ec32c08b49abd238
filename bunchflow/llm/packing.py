"""Best-fit packing of tokenised documents, certified by lower bounds.

Documents become token ids (a tokenizer of the tokenizers library, then an end
id); one longer than a sequence is cut so that all but its first piece are full.
A full piece is a sequence of its own. The other pieces go to partitions of
about GROUP_ROWS pieces; each packs its pieces by best-fit decreasing and
compares its bins with the greatest of several lower bounds from dual-feasible
functions. Equal means that the partition is certified: no packing of its
pieces needs fewer bins. The partitions with a gap exchange the pieces of their
bins that are not full: these are dealt anew, whole bins at a time, to as many
partitions as they need, and packed again, until fewer than two partitions have
a gap or a round saves no bin (its packing is then given up for the one before).

Token ids come from tiktoken where it has the same vocabulary and gives the same
ids several times faster; a text that holds a special token's string, and any
that it fails on, goes to the tokenizer itself.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tasks import in_arrow, table, written

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Pieces of a partition, on average.
GROUP_ROWS = 20_000
#: Bits of a sequence's number for its bin and its partition; the round stands above.
BIN_BITS, GROUP_BITS = 24, 32


@lru_cache(maxsize=2)
def encoder(tokenizer: str, ranks: str | None):
    """text -> ids; loaded once in a worker."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    fast, slow = None, []
    if ranks:
        with open(public_tokenizers.path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    with open(public_tokenizers.path(tokenizer), encoding="utf-8") as f:
        special = [x["content"] for x in json.load(f)["added_tokens"]]

    def ids(text: str) -> np.ndarray:
        if fast is not None and not any(x in text for x in special):
            try:
                return fast.encode_to_numpy(text, disallowed_special=())
            except BaseException as e:  # a panic of the library is no Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit)):
                    raise
        if not slow:  # seldom needed, and large
            slow.append(Tokenizer.from_file(public_tokenizers.path(tokenizer)))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than a sequence."""
    first = length % capacity or capacity
    return [(0, min(first, length))] + [(a, capacity) for a in range(first, length, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = TOKENIZER, ranks: str | None = RANKS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each document's pieces: doc_id, piece int, start, length, ids_crc32 long. A null text is empty, so its end id alone."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(tokenizer, ranks)
        for batch in it:
            out: list[tuple] = []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = np.append(ids(t.as_py() or "").astype("<u4", copy=False), np.array([end_id], "<u4"))
                out += [(doc, i, a, n, zlib.crc32(got[a : a + n].tobytes())) for i, (a, n) in enumerate(cut(len(got), capacity))]
            columns = list(zip(*out)) or [()] * 5
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    data = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = data.schema["doc_id"].dataType.simpleString()
    return in_arrow(data, run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The greatest bound of a family of dual-feasible functions: no packing uses fewer bins.

    For each threshold e up to half a bin, pieces over capacity - e count as a
    whole bin, those under e as nothing, the others by their length; and for
    small k, the rounding functions that count pieces by k-ths of a bin.
    """
    if not len(lengths):
        return 0
    times = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1]
    size = np.arange(capacity + 1)
    best = math.ceil(int((times * size).sum()) / capacity)
    count, load = np.concatenate(([0], np.cumsum(times))), np.concatenate(([0], np.cumsum(times * size)))
    e = np.arange(1, capacity // 2 + 1)
    large = count[-1] - count[capacity - e + 1]
    middle = load[capacity - e + 1] - load[e]
    best = max(best, int((large + -(-middle // capacity)).max()))
    for k in range(2, 21):
        parts = size * (k + 1)
        value = np.where(parts % capacity == 0, size * k, parts // capacity * capacity)
        best = max(best, -(-int((times * value).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each piece by best-fit decreasing, and the number of bins.

    Bins wait in one stack for each amount of room; the least sufficient amount
    is read off a bit set, so a piece costs the same whatever the number of bins.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = stacks[room].pop()
            if not stacks[room]:
                rooms &= ~(1 << room)
        else:
            room, at, n = capacity, n, n + 1
        bins[i], offsets[i] = at, capacity - room
        room -= size
        stacks[room].append(at)
        rooms |= 1 << room
    return bins, offsets, n


_PACKED = "doc_id {kind}, piece int, start long, length long, ids_crc32 long, __row long, group long, bin long, offset long, bins long, least long, filled long"


def _pack_groups(rows: DataFrame, capacity: int) -> DataFrame:
    """Packs the pieces of each group; every row carries its group's bins and bound and its bin's load."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "__row"], ascending=[False, True], kind="stable")
        lengths = pdf["length"].to_numpy()
        bins, offsets, n = best_fit(lengths, capacity)
        load = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
        return pdf.assign(bin=bins, offset=offsets, bins=n, least=lower_bound(lengths, capacity), filled=load[bins])

    return rows.groupBy("group").applyInPandas(pack, _PACKED.format(kind=kind))


def packed(rows: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, list[dict]]:
    """rows of pieces() with sequence_id and offset, and for each round its bins, bound and open groups.

    Every piece is in exactly one sequence, whole; offsets are gapless from 0 and
    no sequence exceeds capacity. An empty table gives none. Equal rows are
    placed as often as they occur: a number that is written with each row deals them.
    """
    own = rows.columns
    rows = written(rows.withColumn("__row", F.monotonically_increasing_id()))
    short = rows.where(F.col("length") < capacity)
    full = rows.where(F.col("length") >= capacity)
    groups = max(1, math.ceil(short.count() / group_rows))
    dealt = short.withColumn("group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    done: list[DataFrame] = []
    report: list[dict] = []
    before, loose, turn = None, 0, 0
    while True:
        now = written(_pack_groups(dealt, capacity)).withColumn("turn", F.lit(turn))
        stats = now.groupBy("group").agg(F.first("bins").alias("bins"), F.first("least").alias("least"))
        total = stats.agg(F.sum("bins").alias("bins"), F.sum("least").alias("least"), F.sum((F.col("bins") > F.col("least")).cast("int")).alias("open")).first().asDict()
        report.append(total)
        if before is not None and total["bins"] >= loose:
            done.append(before)
            break
        is_open = (F.col("bins") > F.col("least")) & (F.col("filled") < capacity)
        if (total["open"] or 0) < 2:
            done.append(now)
            break
        done.append(now.where(~is_open))
        before = now.where(is_open)
        loose, travelling = before.agg(F.count_distinct("group", "bin"), F.count("*")).first()
        groups = max(1, math.ceil(travelling / group_rows))
        turn += 1
        dealt = before.select(*own, "__row", F.pmod(F.xxhash64(F.lit(turn), "group", "bin"), F.lit(groups)).alias("group"))
    number = sequence_number(F.col("turn"), F.col("group"), F.col("bin"))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    out = out.select(*own, number.alias("sequence_id"), "offset")
    # a full piece's number is negative, so it meets none of the above
    whole = full.select(*own, (-F.col("__row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return out.unionByName(whole), report


def sequence_number(turn, group, bin_):
    """A round, a partition and a bin in a long, each in bits of its own."""
    return F.shiftleft(turn.cast("long"), BIN_BITS + GROUP_BITS).bitwiseOR(F.shiftleft(group.cast("long"), BIN_BITS)).bitwiseOR(bin_.cast("long"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(pieces(table(spark, sf_dir, "documents")))[0]
