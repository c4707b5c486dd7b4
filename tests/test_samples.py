"""Replicate statistics, blank subtraction and the flags counted from them."""

import statistics

import pytest

from ionsift.operators import blanks, replicates
from ionsift.params import Params

LONG = "ExpID string, IonMode string, FeatureNumber long, ModeDetail string, SampleDetail string, Rep string, volume double"


def abundance(spark, rows, mode="Positive"):
    """Rows of (feature, sample, [volumes])."""
    out = [("E", mode, f, "M", s, f"{i + 1}", v) for f, s, vols in rows for i, v in enumerate(vols)]
    return spark.createDataFrame(out, LONG)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_statistics_and_flags(spark):
    df = abundance(
        spark,
        [
            (1, "S1", [10.0, 20.0, 40.0]),
            (1, "S2", [5.0]),  # one replicate: no spread
            (2, "S1", [None, None]),  # nothing measured
            (3, "S1", [float("nan"), 7.0, 8.0, 9.0]),  # NaN is missing
            (4, "S1", [0.2, 0.3]),  # mean rounds to 0
        ],
    )
    got = by_key(replicates.replicate_summary(df), "FeatureNumber", "SampleDetail")
    a = got[1, "S1"]
    assert (a.NAbun, a.Count, a.MedAbun, a.MeanAbun) == (3, 3, 20.0, 23.0)
    assert a.StdAbun == round(statistics.stdev([10, 20, 40]), 2) and a.CV == round(15.28 / 23, 2)
    assert a.SampleFeature == 1
    assert got[1, "S2"].StdAbun is None and got[1, "S2"].SampleFeature == 1
    b = got[2, "S1"]
    assert (b.NAbun, b.MedAbun, b.MeanAbun, b.ReplicateThresholdFlag, b.SampleFeature) == (0, None, None, False, 0)
    assert (got[3, "S1"].NAbun, got[3, "S1"].MedAbun, got[3, "S1"].SampleFeature) == (3, 8.0, 0)
    assert got[4, "S1"].MeanAbun == 0 and got[4, "S1"].CV is None


def test_spread_threshold_is_three_valued(spark):
    df = abundance(spark, [(1, "S", [10.0, 20.0, 40.0]), (2, "S", [5.0]), (4, "S", [0.2, 0.3]), (5, "S", [9.0, 9.0])])
    got = by_key(replicates.replicate_summary(df, Params(replicate_cv=0.5)), "FeatureNumber")
    assert [got[k,].CVThresholdFlag for k in (1, 2, 4, 5)] == [False, None, False, True]
    assert [got[k,].SampleFeature for k in (1, 2, 4, 5)] == [0, None, 0, 1]
    off = by_key(replicates.replicate_summary(df, Params(replicate_cv=0)), "FeatureNumber")
    assert all(r.CVThresholdFlag for r in off.values())


@pytest.mark.parametrize("n", [7, 8, 1000, 1001])
def test_median_of_large_groups_by_bracket(spark, n):
    """A sketch far too coarse for the group still leads to the exact median."""
    values = [float((i * 7919) % 1013) for i in range(n)]
    df = abundance(spark, [(1, "S", values), (2, "S", [3.0, None, 4.0, 9.0, 1.0]), (3, "S", [5.0] * n)]).repartition(4)
    got = by_key(replicates.replicate_stats(df, accuracy=40, exact_up_to=3), "FeatureNumber")
    even = lambda x: float(round(x))
    assert got[1,].MedAbun == even(statistics.median(values))
    assert got[2,].MedAbun == even(statistics.median([3, 4, 9, 1]))
    assert got[3,].MedAbun == 5.0


def test_blank_subtraction(spark):
    df = abundance(
        spark,
        [
            (1, "Blank", [10.0, 10.0]), (1, "S1", [4.0, 4.0]), (1, "S2", [50.0, 50.0]),
            (2, "S1", [9.0, 9.0]),  # no blank at all
            (3, "Blank", [None]), (3, "S1", [6.0]),  # blank without a value counts as 0
            (4, "Blank", [8.0]),  # blank only: stays once, without sample
            (5, "Blank", [1.0]), (5, "S1", [None]),
        ],
    )
    stats = replicates.replicate_summary(df)
    got = by_key(blanks.blank_subtract(stats), "FeatureNumber", "SampleDetail")
    assert set(got) == {(1, "S1"), (1, "S2"), (2, "S1"), (3, "S1"), (4, None), (5, "S1")}
    assert (got[1, "S1"].subMedAbun, got[1, "S2"].subMedAbun) == (0.0, 40.0)
    assert got[2, "S1"].subMeanAbun is None and got[3, "S1"].subMeanAbun == 6.0
    assert got[4, None].Blank_medvol == 8.0 and got[4, None].subMedAbun is None
    assert got[5, "S1"].subMedAbun is None

    flags = by_key(blanks.sample_flags(blanks.blank_subtract(stats)), "FeatureNumber")
    assert [flags[k,].FalseSampleFeature_Flag for k in range(1, 6)] == [False, False, False, True, True]
    # A ratio that cannot be computed counts as not above.
    assert [flags[k,].BelowSpike_Flag for k in range(1, 6)] == [False, True, False, True, True]


def test_fraction_counts_the_blank_as_sample(spark):
    df = abundance(spark, [(1, "Blank", [1.0]), (1, "S1", [9.0]), (2, "S1", [9.0]), (2, "S2", [9.0]), (2, "S3", [9.0])])
    stats = replicates.replicate_summary(df)
    params = Params(min_samples=0.25, min_samples_is_fraction=True)
    got = by_key(
        blanks.present_in_samples(blanks.blank_subtract(stats), params, replicates.sample_counts(stats)), "FeatureNumber"
    )
    assert (got[1,].FalseSampleFeature_Flag, got[2,].FalseSampleFeature_Flag) == (True, False)  # 1/4 and 3/4


def test_heavy_feature_gives_the_same_rows(spark, rows):
    data = [(1, f"S{i}", [float(i)]) for i in range(300)] + [(1, "Blank", [5.0]), (2, "Blank", [1.0]), (3, "S1", [2.0])]
    stats = replicates.replicate_summary(abundance(spark, data))
    plain, parts = Params(), Params(rows_per_task=20)
    cut, heavy = blanks.blank_subtract_in_parts(stats, parts)
    assert heavy is not None and cut.select("_part").distinct().count() > 5
    assert rows(cut.drop("_part")) == rows(blanks.blank_subtract(stats, plain))


def test_single_injections(spark):
    df = abundance(spark, [(1, "Blank", [10.0]), (1, "S 1", [4.0, 30.0])]).replace("2", "2b", "Rep").replace("1", "x", "Rep")
    got = by_key(blanks.replicate_long(df, blanks.blank_subtract(replicates.replicate_summary(df))), "SampleDetail")
    assert set(got) == {("S.1-",), ("S.1-2",)}
    assert got["S.1-2",].subMedAbun == 20.0 and got["S.1-",].subMeanAbun == 0.0 and got["S.1-2",].MedAbun == 30.0
