"""Language identification: known words first, then shorter and shorter character n-grams.

The model counts words and the character n-grams of padded words, n = 4 to 1,
for each language, on a bounded sample of labelled rows: the TRAIN_ROWS
different texts of a language with the least hashes, whole, each once however
many copies it has. All their words and n-grams stay. A known word scores the log of its
relative frequency in each language. An unseen word is covered by n-grams: at
each place the longest known one counts, and the word scores their mean.
A text's score is the sum over its words; the result is the best language and
its softmax share, tempered by the root of the number of words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tasks import in_arrow, table, with_arrow, written

#: Bounds: different labelled texts of a language, and languages; more of these are an error.
TRAIN_ROWS = 1000
MOST_LANGS = 1000
LONGEST = 4
UNKNOWN = "und"
_CACHE = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.lower()) if text else []


def has_letter(words: list[str]) -> bool:
    """Other numerals, such as a superscript two, are in words but are no letters."""
    return any(any(c.isalpha() for c in w) for w in words)


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 4 is 2; a null id counts as the text "null"."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))), F.lit(4)) == 2


def grams(word: str, n: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        by: dict[tuple[str, int], Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = Counter(words_of(text))
            by.setdefault((lang, 0), Counter()).update(words)
            for w, c in words.items():
                for n in range(1, LONGEST + 1):
                    more = by.setdefault((lang, n), Counter())
                    for g in grams(w, n):
                        more[g] += c
        for (lang, n), counts in by.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()), pa.array([n] * len(counts), pa.int32()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["lang", "n", "gram", "times"],
            )


class Model:
    """logs[n][gram]: the log of the relative frequency in each language; n = 0 holds words."""

    def __init__(self, rows: list[tuple[str, int, str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        place = {x: i for i, x in enumerate(self.langs)}
        total = np.ones((LONGEST + 1, len(self.langs)))
        counts: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST + 1)]
        for lang, n, gram, times, all_times in rows:
            counts[n].setdefault(gram, np.zeros(len(self.langs)))[place[lang]] = times
            total[n, place[lang]] = all_times
        self.logs = [{g: tuple(np.log((c + 0.1) / (total[n] + 1.0)).tolist()) for g, c in counts[n].items()} for n in range(LONGEST + 1)]
        self.cache: dict[str, tuple[float, ...]] = {}

    def word(self, w: str) -> tuple[float, ...]:
        got = self.logs[0].get(w)
        if got is None:
            padded, at, found = f"<{w}>", 0, []
            while at < len(padded):
                for n in range(LONGEST, 0, -1):
                    x = self.logs[n].get(padded[at : at + n]) if at + n <= len(padded) else None
                    if x is not None:
                        found.append(x)
                        break
                at += 1
            got = tuple(sum(x) / len(found) for x in zip(*found)) if found else (0.0,) * len(self.langs)
        if len(self.cache) >= _CACHE:
            self.cache.clear()
        self.cache[w] = got
        return got

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs or not has_letter(words):
            return UNKNOWN, 0.0
        totals, cache = [0.0] * len(self.langs), self.cache
        for w, c in Counter(words).items():
            got = cache.get(w) or self.word(w)
            totals = [t + c * x for t, x in zip(totals, got)]
        best = max(range(len(totals)), key=totals.__getitem__)
        heat = math.sqrt(len(words))
        return self.langs[best], 1.0 / sum(math.exp(max((t - totals[best]) / heat, -700.0)) for t in totals)


def sampled(labelled: DataFrame, rows: int) -> DataFrame:
    """(lang, text) of the `rows` different texts of each language with the least hashes; labelled: lang and text, no nulls.

    What is shuffled is hashes, then the chosen texts: a hot language or text is
    merged in its own tasks first.
    """
    keyed = labelled.withColumn("hash", F.xxhash64("text"))
    texts = written(keyed.groupBy("lang", "hash").agg(F.lit(1).alias("one")).select("lang", "hash"))
    counts = {r[0]: r[1] for r in texts.groupBy("lang").count().limit(MOST_LANGS + 1).collect()}
    if len(counts) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not counts:
        return labelled
    # twice as many as wanted pass a share of the hashes, or all where there are few; of these the least are exact
    shares = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, 2 * (rows + 50) / n)))])
    place = F.shiftrightunsigned("hash", 11).cast("double") / F.lit(float(1 << 53))
    near = texts.where(place < shares[F.col("lang")])
    order = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("hash", 11), "hash")
    # rows x MOST_LANGS rows of a language and a hash at most
    chosen = written(near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows).select("lang", "hash"))
    return keyed.join(F.broadcast(chosen), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min("text").alias("text")).select("lang", "text")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """A model of the labelled rows; those of null text or lang don't count. None left: a model that says `und`."""
    labelled = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counted = in_arrow(sampled(labelled, rows), _counted, "lang string, n int, gram string, times long").groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))
    found = [tuple(r) for r in counted.collect()]
    total: Counter = Counter()
    for lang_, n, _, times in found:
        total[lang_, n] += times
    return Model([(*r, total[r[0], r[1]]) for r in found])


def identified(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with lang_pred string and score double (0 to 1).

    A text that is null, empty or without a letter gets `und` and 0.0; so does
    every text under an empty model. Ties take the first language by name.
    Columns of docs that are named as a result are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        found = [shared.value.predict(t.as_py()) for t in texts]
        return {"lang_pred": pa.array([x[0] for x in found], pa.string()), "score": pa.array([x[1] for x in found], pa.float64())}

    return with_arrow(docs, text, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], work, keep)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identified(docs.withColumn("held_out", held_out(F.col("doc_id"))), model, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")
