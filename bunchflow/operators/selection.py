"""Combinatorial selection: preselection, isolation, best triplet, cut flow.

Events are rows with an array of candidate structs, so everything here is free
of shuffles: the preselection is an array predicate that drops most events
before any combination is made, pions are generated from the array in order,
and the best triplet is the least of an array of triplets that the row itself makes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.candidates import charge
from ..functions.kinematics import delta_r2, mass


@dataclass(frozen=True)
class Cuts:
    """pt thresholds (every, second and first pion), least separation, mass window, isolation ring and limit."""

    pt1: float
    pt2: float
    pt3: float
    min_dr2: float
    min_mass: float
    max_mass: float
    ring_low: float
    ring_high: float
    max_iso: float


# Fixed values of the two published working points.
LOOSE = Cuts(7, 12, 15, 0.25, 40, 150, 1e-4, 0.0625, 2.0)
TIGHT = Cuts(9, 15, 20, 0.25, 60, 100, 1e-4, 0.0625, 1.0)

#: Codes of pions and electrons, which the selection takes as pions.
PION_CODES = (2, 3, 4, 5)


def is_pion(c: Column) -> Column:
    return c["pid"].isin(*PION_CODES)


def preselected(cands: Column, cuts: Cuts) -> Column:
    """At least three pions over pt1, two over pt2, one over pt3."""

    def over(pt):
        return F.size(F.filter(cands, lambda c: is_pion(c) & (c["pt"] >= F.lit(float(pt)))))

    return (over(cuts.pt1) >= 3) & (over(cuts.pt2) >= 2) & (over(cuts.pt3) >= 1)


def isolation(c: Column, cands: Column, cuts: Cuts) -> Column:
    """Sum of pt of the other candidates in the ring around c, over the pt of c."""

    def add(total: Column, x: Column) -> Column:
        d = delta_r2(c["eta"], c["phi"], x["eta"], x["phi"])
        inside = (x["i"] != c["i"]) & (d >= F.lit(cuts.ring_low)) & (d <= F.lit(cuts.ring_high))
        return total + F.when(inside, x["pt"]).otherwise(0.0)

    return F.aggregate(cands, F.lit(0.0), add) / c["pt"]


def pions(events: DataFrame, cuts: Cuts) -> DataFrame:
    """events with pions: the isolated ones over pt1, by descending pt, then index; candidates are pt, eta, phi (double), pid, i."""
    chosen = F.filter("cands", lambda c: is_pion(c) & (c["pt"] >= F.lit(float(cuts.pt1))))
    row = F.transform(chosen, lambda c: F.struct((-c["pt"]).alias("order"), c["i"].alias("i"), c["pt"].alias("pt"), c["eta"].alias("eta"), c["phi"].alias("phi"), c["pid"].alias("pid"), isolation(c, F.col("cands"), cuts).alias("iso")))
    return events.withColumn("pions", F.sort_array(F.filter(row, lambda c: c["iso"] <= F.lit(cuts.max_iso))))


def best_triplet(cuts: Cuts) -> Column:
    """The best triplet of the column pions, or null.

    Pions are strictly ordered by (pt descending, index), so each triplet is
    made once; the best has the greatest pt sum, ties going to the first in that order.
    """

    def after(place: Column) -> Column:
        return F.slice("pions", place + 2, F.greatest(F.size("pions") - place - 1, F.lit(0)))

    def third(a: Column, b: Column, c: Column) -> Column:
        total = charge(a["pid"]) + charge(b["pid"]) + charge(c["pid"])
        return (F.abs(total) == 1) & _apart(a, c, cuts) & _apart(b, c, cuts)

    def made(a: Column, b: Column, c: Column) -> Column:
        order = [F.struct(x["order"].alias("order"), x["i"].alias("i")).alias(n) for x, n in ((a, "x"), (b, "y"), (c, "z"))]
        return F.struct((-(a["pt"] + b["pt"] + c["pt"])).alias("s"), *order, mass(*[(x["pt"], x["eta"], x["phi"]) for x in (a, b, c)]).alias("mass"))

    def with_two(a: Column, b: Column, q: Column) -> Column:
        fit = (b["pt"] >= F.lit(float(cuts.pt2))) & _apart(a, b, cuts)
        return F.when(fit, F.transform(F.filter(after(q), lambda c: third(a, b, c)), lambda c: made(a, b, c))).otherwise(F.array())

    def with_one(a: Column, p: Column) -> Column:
        return F.when(a["pt"] >= F.lit(float(cuts.pt3)), F.flatten(F.transform(after(p), lambda b, j: with_two(a, b, p + 1 + j)))).otherwise(F.array())

    found = F.flatten(F.transform("pions", lambda a, p: with_one(a, p)))
    return F.array_min(F.filter(found, lambda t: t["mass"].between(float(cuts.min_mass), float(cuts.max_mass))))


def _with_triplet(events: DataFrame, cuts: Cuts) -> DataFrame:
    """events with their best triplet t, or null; pions are made of preselected events only."""
    return pions(events, cuts).withColumn("t", F.when(F.size("pions") >= 3, best_triplet(cuts)))


def triplets(events: DataFrame, cuts: Cuts) -> DataFrame:
    """The best triplet of each event that has one: event key columns, i1, i2, i3, pt_sum, mass.

    events: cands, an array of structs, and any other columns, which stay.
    """
    keys = [c for c in events.columns if c != "cands"]
    # Exploded, not filtered: a filter on t or on its fields moves below the projection of t, with the whole search in each of its terms.
    found = F.explode(F.when(F.col("t").isNotNull(), F.array("t")))
    best = _with_triplet(events.where(preselected(F.col("cands"), cuts)), cuts).select(*keys, found.alias("t"))
    return best.select(*keys, F.col("t.x.i").alias("i1"), F.col("t.y.i").alias("i2"), F.col("t.z.i").alias("i3"), (-F.col("t.s")).alias("pt_sum"), F.col("t.mass").alias("mass"))


def _apart(a: Column, b: Column, cuts: Cuts) -> Column:
    return delta_r2(a["eta"], a["phi"], b["eta"], b["phi"]) >= F.lit(cuts.min_dr2)


def cut_flow(events: DataFrame, cuts: Cuts) -> DataFrame:
    """One row: events, those preselected and those with a triplet, and the two fractions, in one pass."""
    passing = F.when(F.col("pre"), F.col("cands")).otherwise(F.slice("cands", 1, 0))
    flags = _with_triplet(events.withColumn("pre", preselected(F.col("cands"), cuts)).select("pre", passing.alias("cands")), cuts)
    total = flags.agg(F.count("*").alias("n_all"), F.coalesce(F.sum(F.col("pre").cast("long")), F.lit(0)).alias("n_pre"), F.count("t").alias("n_pass"))
    return total.select("n_all", "n_pre", "n_pass", F.round(F.col("n_pre") / F.col("n_all"), 9).alias("f_pre"), F.round(F.col("n_pass") / F.col("n_all"), 9).alias("f_pass"))


def histogram(values: DataFrame, column: str, bins: int, low: float, high: float) -> DataFrame:
    """(bin, lo, hi, entries) with bin 0 below low and bins + 1 from high on, empty bins included; nulls don't count.

    Partial counts make the shuffle a row for each bin and task.
    """
    width = (high - low) / bins
    x = F.col(column).cast("double")
    at = F.when(x < low, 0).when(x >= high, bins + 1).otherwise((F.floor((x - low) / width) + 1).cast("int"))
    counts = values.where(x.isNotNull()).groupBy(at.cast("long").alias("bin")).agg(F.count("*").alias("entries"))
    spine = values.sparkSession.range(bins + 2).withColumnRenamed("id", "bin")
    lo, hi = F.lit(low) + (F.col("bin") - 1) * width, F.lit(low) + F.col("bin") * width
    return spine.join(counts, "bin", "left").select("bin", lo.alias("lo"), hi.alias("hi"), F.coalesce("entries", F.lit(0)).alias("entries"))
