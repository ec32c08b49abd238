"""Operators against brute force, and the streaming forms."""

import itertools
import math

from pyspark.sql import functions as F

from bunchflow.operators import streams as S
from bunchflow.operators.layouts import described, flattened
from bunchflow.operators.selection import LOOSE, histogram, triplets
from bunchflow.plans.fixtures import events


def _dr2(a, b):
    d = a.phi - b.phi
    d -= 2 * math.pi * math.floor(d / (2 * math.pi) + 0.5)
    return (a.eta - b.eta) ** 2 + d * d


def _best(cands, cuts):
    pions = sorted((c for c in cands if 2 <= c.pid <= 5 and c.pt >= cuts.pt1), key=lambda c: (-c.pt, c.i))
    sign = {2: -1, 3: 1, 4: -1, 5: 1}
    best = None
    for a, b, c in itertools.combinations(pions, 3):
        if a.pt < cuts.pt3 or b.pt < cuts.pt2 or abs(sign[a.pid] + sign[b.pid] + sign[c.pid]) != 1:
            continue
        if min(_dr2(a, b), _dr2(a, c), _dr2(b, c)) < cuts.min_dr2:
            continue
        if any(sum(x.pt for x in cands if x.i != p.i and cuts.ring_low <= _dr2(p, x) <= cuts.ring_high) / p.pt > cuts.max_iso for p in (a, b, c)):
            continue
        e = sum(math.sqrt((p.pt * math.cosh(p.eta)) ** 2 + 0.1396**2) for p in (a, b, c))
        x, y, z = (sum(f(p) for p in (a, b, c)) for f in (lambda p: p.pt * math.cos(p.phi), lambda p: p.pt * math.sin(p.phi), lambda p: p.pt * math.sinh(p.eta)))
        m = math.sqrt(max(e * e - x * x - y * y - z * z, 0))
        if cuts.min_mass <= m <= cuts.max_mass and (best is None or a.pt + b.pt + c.pt > best[0]):
            best = (a.pt + b.pt + c.pt, a.i, b.i, c.i, round(m, 3))
    return best


def test_triplets_equal_brute_force(spark, sf_dir):
    rows = events(spark, sf_dir)
    want = {r.event: b for r in rows.collect() if (b := _best(r.cands, LOOSE))}
    got = {r.event: (r.pt_sum, r.i1, r.i2, r.i3, round(r.mass, 3)) for r in triplets(rows, LOOSE).collect()}
    assert got == want and want


def test_triplets_are_searched_once_an_event(spark, sf_dir):
    found = triplets(events(spark, sf_dir), LOOSE)
    for rows in (found, found.where("mass > 60"), histogram(found, "mass", 100, 0.0, 100.0)):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("array_min") == 1


def test_round_robin_stops_as_the_reader_does(spark):
    def loop(sizes):
        left, out, i, good = list(sizes), [], 0, [True] * len(sizes)
        while good[i]:
            if left[i]:
                left[i] -= 1
                out.append((i, sizes[i] - left[i]))
            else:
                good[i] = False
            i = (i + 1) % len(sizes)
        return out

    for sizes in ((2, 2, 2), (3, 1, 4), (5, 4, 1), (1, 5), (4,)):
        rows = spark.createDataFrame([(f, p) for f, n in enumerate(sizes) for p in range(n)], "file int, pos int")
        got = S.round_robin(rows, stop_first=True).orderBy("round", "file").collect()
        want = sorted(loop(sizes), key=lambda x: (x[1], x[0]))
        assert [(r.file, r["round"]) for r in got] == want, sizes


def test_strict_fails_and_passes(spark):
    rows = spark.createDataFrame([(1,), (2,)], "x int")
    assert S.strict(rows, {"big": F.col("x") > 2}).count() == 2
    try:
        S.strict(rows, {"big": F.col("x") > 1}).collect()
    except Exception as e:
        assert "violates big" in str(e)
    else:
        raise AssertionError


def test_file_names_that_are_none(spark):
    p = S.parse_file_name(F.col("n"))
    r = spark.createDataFrame([("other.txt",), ("run000037_ls0000_index000005_ts01.raw",)], "n string").select(*[c.alias(k) for k, c in p.items()]).collect()
    assert r[0].run is None and r[0].orbit is None
    assert (r[1].run, r[1].ls, r[1]["index"], r[1].ts, r[1].orbit) == (37, 0, 5, 1, 5)


def test_flattened_and_described(spark):
    df = spark.sql("SELECT 1 AS a, struct(2 AS b, struct(array(array(3)) AS d) AS c) AS s")
    assert flattened(df).columns == ["a", "s.b", "s.c.d"]
    assert [(r["column"], r.depth) for r in described(df).collect()] == [("a", 0), ("s.b", 0), ("s.c.d", 2)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "run long, orbit long, bx long, n long, good boolean, pos long, file long")
    assert S.continuity(none, ["run"], ["pos"]).count() == 0
    assert S.round_robin(none, stop_first=True).count() == 0
    assert S.violation_report(none, {"x": F.col("bx") > 1}).collect() == [("x", 0)]
    assert S.totals(none).first().events == 0


def test_demultiplexing_over_batches(spark, tmp_path):
    from bunchflow.streaming.live import demultiplexed, drained, watched

    parts = [[(1, 0), (2, 0)], [(1, 1), (2, 0)], [(1, 2), (3, 0)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "orbit long, slot int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = watched(spark, str(tmp_path / "in"), "orbit long, slot int", files_per_batch=1)
    assert [tuple(r) for r in drained(demultiplexed(stream, 3), "append").collect()] == [(1, 3, 0)]
