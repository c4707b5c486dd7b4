"""The range search against brute force: boundary-heavy grids, crowds, copies."""

import random

import pytest

from ionsift.operators import ranges
from ionsift.operators.partners import adduct_flags, adduct_pairs, duplicate_flags
from ionsift.params import Params

SCHEMA = (
    "FeatureNumber long, ExpID string, IonMode string, Mass double, RetentionTime double, "
    "Compound string, Score double, Frequency long"
)


def features(kind, seed, n):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        exp = rnd.choice("AB")
        mode = rnd.choice(["Positive", "Negative"])
        step = rnd.choice([0, 0, 21.98194, 17.02655, 44.0409])
        if kind == "grid":  # equality with the tolerances is common
            mass, rt = 100 + rnd.randrange(60) * 0.001 + step, rnd.randrange(1, 40) * 0.01
        elif kind == "crowd":  # nearly all in one cell
            mass, rt = 300 + rnd.random() * 0.004 + step, 5 + rnd.random() * 0.06
        elif kind == "copies":  # few places, many features each
            mass, rt = 250 + rnd.randrange(3) * 0.002 + step, 1 + rnd.randrange(3) * 0.05
        else:
            mass, rt = 80 + rnd.random() * 400, rnd.random() * 2
        if rnd.random() < 0.02:
            mass = None
        if rnd.random() < 0.02:
            rt = None
        out.append((i, exp, mode, mass, rt, "C", 1.0, 1))
    return out


def brute(rows, params, adducts, ppm, error, tol):
    """All matching pairs as (dataset, a, b, adduct) by testing every pair."""
    by = {}
    for r in rows:
        by.setdefault((r[1], r[2]), []).append(r)
    out = set()
    for key, group in by.items():
        top = max((r[3] for r in group if r[3] is not None), default=None)
        if top is None:
            continue
        half = top * error * 1e-6 if ppm else error / 1000
        for mode, name, delta in adducts:
            if mode not in (key[1], None):
                continue
            for a in group:
                for b in group:
                    if a[0] == b[0] or None in (a[3], a[4], b[3], b[4]):
                        continue
                    gap = b[3] - a[3]
                    if abs(a[4] - b[4]) <= tol and delta - half <= gap <= delta + half:
                        if not ppm or (abs(gap) - delta) / a[3] * 1e6 <= error:
                            out.add((key, a[0], b[0], name))
    return out


CASES = [
    ("grid", Params()),
    ("grid", Params(adduct_ppm=False, adduct_error=2, duplicate_ppm=False, duplicate_error=1, adduct_rt=0.03)),
    ("grid", Params(adduct_rt=0, duplicate_rt=0)),
    ("crowd", Params(rows_per_task=10)),
    ("crowd", Params(rows_per_task=10, duplicate_error=1.5, adduct_error=4, duplicate_rt=0.01, adduct_rt=0.004)),
    ("copies", Params(rows_per_task=5)),
    ("spread", Params(adduct_error=300, duplicate_error=300, adduct_rt=0.2, duplicate_rt=0.2)),
    ("spread", Params(adducts=(("Positive", "Tiny", 0.001), ("Positive", "Na", 21.98194), ("Negative", "Zero", 0.0)))),
]


@pytest.mark.parametrize("kind,params", CASES)
def test_equal_to_brute_force(spark, kind, params):
    rows = features(kind, 7, 260)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).cache()

    want = brute(rows, params, params.adducts, params.adduct_ppm, params.adduct_error, params.adduct_rt)
    got = {
        ((r.ExpID, r.IonMode), r.FeatureNumber, r.adduct_FeatureNumber, r.adduct)
        for r in adduct_pairs(df, params).collect()
    }
    assert got == want

    flagged = {r.FeatureNumber: r.asDict() for r in adduct_flags(df, params).collect()}
    assert len(flagged) == len(rows)
    modes = {name: mode for mode, name, _ in params.adducts}
    for r in rows:
        for name in params.adduct_names:
            own = modes[name] == r[2]
            has = any(a == r[0] and x == name for _, a, _, x in want)
            is_ = any(b == r[0] and x == name for _, _, b, x in want)
            assert flagged[r[0]][f"has_{name}_adduct"] is (has if own else None), (r, name)
            assert flagged[r[0]][f"is_{name}_adduct"] is (is_ if own else None), (r, name)

    zero = ((None, "same", 0.0),)
    pairs = brute(rows, params, zero, params.duplicate_ppm, params.duplicate_error, params.duplicate_rt)
    members = {x for _, a, b, _ in pairs for x in (a, b)}
    got = {r.FeatureNumber for r in duplicate_flags(df, params).where("Duplicate_Flag").collect()}
    assert got == members


def test_no_nested_loop_and_no_single_task(spark):
    df = spark.createDataFrame(features("grid", 1, 50), SCHEMA)
    for frame in (adduct_pairs(df), adduct_flags(df), duplicate_flags(df)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Python" not in plan


def test_one_huge_mass_changes_no_other_dataset(spark):
    """Near it every adduct lies within the mass window; no pairs are listed for it, nor elsewhere."""
    rows = features("crowd", 3, 150) + [(900, "C", "Positive", 900_000.0, 5.0, "C", 1.0, 1)]
    rows += [(901 + i, "C", "Positive", 300.0 + i * 0.003, 5.0 + i % 3 * 0.02, "C", 1.0, 1) for i in range(60)]
    for params in (Params(), Params(rows_per_task=15)):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        want = brute(rows, params, params.adducts, True, params.adduct_error, params.adduct_rt)
        flagged = adduct_flags(df, params)
        plan = flagged._jdf.queryExecution().toString()
        assert "a_mass" not in plan  # the column of listed pairs
        for r in flagged.where("IonMode = 'Positive'").collect():
            for name in ("Na", "Ammonium"):
                assert r[f"has_{name}_adduct"] is any(a == r.FeatureNumber and x == name for _, a, _, x in want)
                assert r[f"is_{name}_adduct"] is any(b == r.FeatureNumber and x == name for _, _, b, x in want)


def test_lanes_full_of_windows_are_cut(spark):
    """3,000 windows on one point, and a crowd of points: no slice holds much more than a task's share."""
    rnd = random.Random(6)
    rows = [("a", 1.0 + i * 1e-4, (i, 5.0, 0), None, None, None) for i in range(3000)] + [("a", 0.5, None, 5.0, 5.0, 1)]
    rows += [("b", rnd.random(), None, rnd.random(), rnd.random(), 1) for _ in range(900)] + [("b", float("inf"), (-1, 5.0, 0), None, None, None)]
    schema = "lane string, pos double, w struct<id:long,RetentionTime:double,_self:long>, latest double, earliest double, n long"
    df = spark.createDataFrame(rows, schema)
    sliced, crowded = ranges._sliced(df, ["lane"], 100)
    sizes = sliced.where("pos < double('inf')").groupBy("lane", "slice").count().collect()
    assert max(r["count"] for r in sizes) <= 150 and len(sizes) >= 35
    got = {r.w.id: r for r in ranges._swept(df, ["lane"], True, 100).collect()}
    assert all(got[i].best_n == 1 and got[i].best_latest == 5.0 for i in range(3000))
    points = [r for r in rows if r[0] == "b" and r[2] is None]
    assert got[-1].best_n == 900 and got[-1].best_latest == max(r[3] for r in points)
