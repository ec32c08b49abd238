"""Quality rules as a short-circuit cascade, with DataFrame functions only.

Each rule is a condition on a document's text statistics. On a bounded random
sample the operator measures every rule's cost (seconds of a run over the
sample, less those of a run without a rule) and how much it rejects, orders the
rules by rejection per cost, and applies them in that order. Each rule brings
the statistics that it needs, guarded by the verdict so far: a document that an
early rule rejects never pays for the statistics of later ones. The order
changes the cost alone; the verdict is the disjunction of all rules whatever the order.

Statistics of a null text are those of an empty one (no words, no lines). An
empty table stays empty. Repeated rows get equal results. Whole texts are
measured, of any length.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tasks import table

#: ASCII white space, and what counts as a symbol.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Bound on the sample that orders the rules, in rows, and how often a timed run goes through it.
SAMPLE_ROWS = 1000
TURNS = 4
#: Words in a window of n_repeat_words.
WINDOW = 3
_POSITION_BITS = 24


def prepared(docs: DataFrame, text: str) -> DataFrame:
    """docs with the text as __t, never null, its words as __w and n_words."""
    df = docs.withColumn("__t", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    trimmed = F.btrim("__t", F.lit(SPACE))
    df = df.withColumn("__w", F.when(trimmed != "", F.split(trimmed, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>")))
    return df.withColumn("n_words", F.size("__w").cast("long"))


Statistic = Callable[[DataFrame, Column], DataFrame]


def _symbols(df: DataFrame, wanted: Column) -> DataFrame:
    plain = F.col("__t")
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    return df.withColumn("n_symbols", F.when(wanted, (F.octet_length("__t") - F.octet_length(plain)).cast("long")))


def _word_chars(df: DataFrame, wanted: Column) -> DataFrame:
    return df.withColumn("word_chars", F.when(wanted, F.length(F.array_join("__w", "")).cast("long")))


def _lines(df: DataFrame, wanted: Column) -> DataFrame:
    df = df.withColumn("__l", F.when(wanted, F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")))
    df = df.withColumns({"n_lines": F.size("__l").cast("long"), "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long")})
    return df.drop("__l")


def _capitals(df: DataFrame, wanted: Column) -> DataFrame:
    return df.withColumn("n_capitals", F.when(wanted, F.regexp_count("__t", F.lit("[A-Z]")).cast("long")))


def _repeats(df: DataFrame, wanted: Column) -> DataFrame:
    """n_repeat_words: words in the windows whose hash another window of the text has.

    Windows with equal hashes are found by sorting. A position and 40 bits of
    its hash fit into one long, which sorts as a primitive. Where two hashes
    share these bits but differ, or a text has 2**24 windows, whole hashes are
    sorted. A window covers its own words but those that the next one covers too.
    """
    bits = _POSITION_BITS
    low = (1 << bits) - 1
    none = F.array().cast("array<bigint>")
    df = df.withColumn("__a", F.when(wanted & (F.col("n_words") > WINDOW), F.transform("__w", lambda w: F.xxhash64(w))).otherwise(none))
    hashes = F.transform("__a", lambda x, i: F.xxhash64(x, *[F.get("__a", i + k) for k in range(1, WINDOW)]))
    df = df.withColumn("__h", F.when(F.size("__a") > WINDOW, F.slice(hashes, 1, F.size("__a") - (WINDOW - 1))).otherwise(none))
    df = df.withColumn("__some", F.size("__h") > F.size(F.array_distinct("__h")))
    short = F.col("__some") & (F.size("__h") < 1 << bits)
    df = df.withColumn("__k", F.when(short, F.sort_array(F.transform("__h", lambda x, i: F.shiftleft(x, bits).bitwiseOR(i.cast("long"))))).otherwise(none))

    def pair(a: Column, b: Column) -> Column:
        """Both positions in a long, where the bits of the hashes agree."""
        alike = F.shiftrightunsigned(a, bits) == F.shiftrightunsigned(b, bits)
        return F.when(alike, F.shiftleft(a.bitwiseAND(low), 31).bitwiseOR(b.bitwiseAND(low)))

    first, second = (lambda x: F.shiftrightunsigned(x, 31)), (lambda x: x.bitwiseAND((1 << 31) - 1))
    df = df.withColumn("__q", F.filter(F.zip_with("__k", F.expr("slice(__k, 2, size(__k))"), pair), lambda x: x.isNotNull()))
    clash = F.exists("__q", lambda x: F.get("__h", first(x).cast("int")) != F.get("__h", second(x).cast("int")))
    df = df.withColumn("__whole", F.col("__some") & ((F.size("__h") >= 1 << bits) | clash))
    df = df.withColumn("__s", F.when(F.col("__whole"), F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i"))))))

    def among(x: Column, i: Column) -> Column:
        return (x["h"] == F.get("__s", i + 1)["h"]) | (x["h"] == F.get("__s", i - 1)["h"])

    wholly = F.transform(F.filter("__s", among), lambda x: x["i"])
    shortly = F.array_distinct(F.concat(F.transform("__q", first), F.transform("__q", second)))
    df = df.withColumn("__p", F.sort_array(F.when(F.col("__whole"), wholly).otherwise(shortly)))
    most = F.lit(WINDOW).cast("long")
    steps = F.transform("__p", lambda x, i: F.least(most, F.coalesce(F.get("__p", i + 1) - x, most)))
    return df.withColumn("n_repeat_words", F.when(wanted, F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x))).drop("__a", "__h", "__some", "__k", "__q", "__whole", "__s", "__p")


STATISTICS: dict[str, Statistic] = {"n_symbols": _symbols, "word_chars": _word_chars, "n_lines": _lines, "n_repeat_words": _repeats, "n_capitals": _capitals}


@dataclass(frozen=True)
class Rule:
    """rejects: a condition on n_words and the statistics named in `needs`; never null where these aren't."""

    name: str
    needs: tuple[str, ...]
    rejects: Column


def base_rules() -> list[Rule]:
    return [Rule("short", (), F.col("n_words") < 50), Rule("repeated_words", ("n_repeat_words",), F.col("n_repeat_words") * 100 > F.col("n_words") * 50)]


def rules() -> list[Rule]:
    """The rules with production thresholds; all counts are whole numbers, so no rounding decides."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return [
        Rule("symbols", ("n_symbols",), F.col("n_symbols") * 10 > n),
        Rule("repeated_lines", ("n_lines",), F.col("n_dup_lines") * 2 > F.col("n_lines")),
        Rule("word_length", ("word_chars",), (chars < n * 2) | (chars > n * 15)),
        Rule("capitals", ("word_chars", "n_capitals"), F.col("n_capitals") * 10 > chars * 6),
    ]


def with_statistics(df: DataFrame, names: Sequence[str], wanted: Column) -> DataFrame:
    """df with the statistics that it lacks, null where they aren't wanted."""
    for name in names:
        df = df if name in df.columns else STATISTICS[name](df, wanted)
    return df


def ordered(docs: DataFrame, text: str, of: Sequence[Rule], seed: int = 17) -> list[Rule]:
    """of, by rejection per cost on a random sample of about SAMPLE_ROWS rows of docs."""
    rows = docs.count()
    if rows == 0 or len(of) < 2:
        return list(of)
    sample = prepared(docs.sample(min(1.0, SAMPLE_ROWS / rows), seed), text).select("__t", "__w", "n_words").persist()
    always = F.lit(True)
    try:
        often = sample.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.lit(TURNS))))

        def run(needs: Sequence[str], rejects: Column) -> tuple[float, float]:
            """(seconds, share of rejected rows)"""
            seen = with_statistics(often, needs, always).agg(F.avg(rejects.cast("int")))
            began = time.perf_counter()
            share = seen.first()[0]
            return time.perf_counter() - began, share or 0.0

        run((), F.col("n_words") < 0)  # fills the cache
        idle, _ = run((), F.col("n_words") < 0)
        seen = [run(r.needs, r.rejects) for r in of]
    finally:
        sample.unpersist()
    return [of[i] for i in sorted(range(len(of)), key=lambda i: -seen[i][1] / max(seen[i][0] - idle, 1e-3))]


def cascade(df: DataFrame, of: Sequence[Rule], by: Column) -> DataFrame:
    """df with __by: `by` or, where it is null, the name of the first rule that rejects; no rule after it is evaluated."""
    df = df.withColumn("__by", by)
    for r in of:
        open_ = F.col("__by").isNull()
        df = with_statistics(df, r.needs, open_)
        df = df.withColumn("__by", F.when(open_, F.when(r.rejects, F.lit(r.name))).otherwise(F.col("__by")))
    return df


RESULT = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"]


def judged(docs: DataFrame, text: str = "text", of: Sequence[Rule] | None = None) -> DataFrame:
    """docs with the statistics, base_failed boolean, rejected_by (base, or the first rule that rejects, or null) and kept boolean.

    Columns of docs that are named as a result are replaced. Here the base's
    statistics are wanted of every document, so only the others are spared.
    """
    inner = docs.select(*[F.col(f"`{c}`").alias(f"__in_{c}") for c in docs.columns])
    of = ordered(inner, f"__in_{text}", rules() if of is None else of)
    df = with_statistics(prepared(inner, f"__in_{text}"), ["word_chars", "n_symbols", "n_lines", "n_repeat_words"], F.lit(True))
    df = df.withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
    df = cascade(df, of, F.when(F.col("base_failed"), F.lit("base"))).withColumnRenamed("__by", "rejected_by").withColumn("kept", F.col("rejected_by").isNull())
    own = [c for c in docs.columns if c not in RESULT]
    # a filter on a result must not be pushed below the projections, which would repeat their expressions; it passes no generator
    out = df.select(*[F.col(f"`__in_{c}`") for c in own], F.inline_outer(F.array(F.struct(*RESULT))))
    return out.select(*[F.col(f"`__in_{c}`").alias(c) for c in own], *RESULT)


def accepted(docs: DataFrame, text: str = "text", of: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of docs that no rule of the base or of `of` rejects, with their own columns."""
    # the statistics live under names of their own, whatever docs has
    inner = docs.select(*[F.col(f"`{c}`").alias(f"__in_{c}") for c in docs.columns])
    of = ordered(inner, f"__in_{text}", [*base_rules(), *(rules() if of is None else of)])
    df = cascade(prepared(inner, f"__in_{text}"), of, F.lit(None).cast("string"))
    kept = df.select(*[F.col(f"`__in_{c}`") for c in docs.columns], F.inline_outer(F.array(F.struct("__by")))).where("__by IS NULL")
    return kept.select(*[F.col(f"`__in_{c}`").alias(c) for c in docs.columns])


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: A text's statistics and the verdict in DuckDB's SQL.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS times FROM (
    SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 3)
), repeats AS (
  SELECT r, count(DISTINCT i + o) AS n FROM windows, (VALUES (0), (1), (2)) AS s(o) WHERE times > 1 GROUP BY r
), s AS (
  SELECT w.r, doc_id, t, len(w)::BIGINT AS n_words, coalesce(length(list_aggregate(w, 'string_agg', '')), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l) AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals
  FROM w LEFT JOIN repeats ON w.r = repeats.r
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 10 > n_words OR n_dup_lines * 2 > n_lines
    OR word_chars < n_words * 2 OR word_chars > n_words * 15 OR capitals * 10 > word_chars * 6) AS kept
FROM b
"""
