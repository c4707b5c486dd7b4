"""Joining polarities, the lookup, scores, ranks and chart tables."""

import math

import pytest
from pyspark.sql import functions as F

from ionsift.operators import chart, lookup, modes, scoring
from ionsift.params import Params

MODES = (
    "ExpID string, IonMode string, FeatureNumber long, Compound string, Mass double, RetentionTime double, "
    "Score double, S1_subMedAbun double"
)


def two_modes(spark, extra=()):
    return spark.createDataFrame(
        [
            ("E", "Positive", 1, "A", 400.0, 5.0, 90.0, 1.0),
            ("E", "Negative", 1, "A", 400.0039, 5.9, 80.0, 2.0),  # 9.75 ppm and within 1 min
            ("E", "Positive", 2, "B", 400.0, 5.0, 90.0, 0.0),
            ("E", "Negative", 2, "B", 400.0045, 5.0, 80.0, 2.0),  # 11.25 ppm
            ("E", "Positive", 3, "C", 900.0, 5.0, 90.0, 1.0),
            ("E", "Negative", 3, "C", 900.006, 5.0, 80.0, 2.0),  # 6.7 ppm but 0.006 apart
            ("E", "Positive", 4, None, 500.0, 5.0, 90.0, 1.0),
            ("E", "Negative", 4, None, 500.0, 5.0, 80.0, 2.0),  # missing names never match
            ("E", "Negative", 5, "A", 400.0, 7.0, 80.0, 2.0),  # too late
            ("F", "Positive", 1, "A", 400.0, 5.0, 90.0, 1.0),  # experiment with one polarity
            *extra,
        ],
        MODES,
    )


def test_cross_mode(spark):
    df = two_modes(spark)
    pairs = [(r.FeatureNumber, r.match_FeatureNumber) for r in modes.cross_mode_match(df).collect()]
    assert pairs == [(1, 1)]
    flags = {(r.ExpID, r.IonMode, r.FeatureNumber): r.unique_mode for r in modes.unique_mode_flags(df).collect()}
    assert [k for k, v in flags.items() if not v] and {k for k, v in flags.items() if not v} == {
        ("E", "Positive", 1), ("E", "Negative", 1)
    }
    assert [tuple(r) for r in modes.mode_pairs(df).collect()] == [("E", "Positive", "Negative")]


def test_joined_table(spark):
    got = modes.join_modes(two_modes(spark)).collect()
    assert len(got) == 9 and {r.ExpID for r in got} == {"E"}
    hits = {(r.Compound, r.IonMode, r.RetentionTime): r.N_CompoundHits for r in got}
    assert hits["A", "Positive", 5.0] == 2  # the matched pair once, and the late one
    assert hits["A", "Negative", 7.0] == 2 and hits[None, "Negative", 5.0] == 2
    assert [r.S1_subMedAbun for r in got if r.Compound == "B" and r.IonMode == "Positive"] == [None]
    assert sorted(r.BothModes_Flag for r in got) == [False] * 7 + [True] * 2


def test_heavy_name_and_copies(spark, rows):
    """A name held by most rows, with copies: same flags when cut into small tasks, and by brute force."""
    data = [
        ("E", "Positive" if i % 2 else "Negative", i, "A", 300 + (i % 37) * 0.0011 + (i % 5 == 4) * i, 1 + (i % 23) * 0.21, 1.0, 1.0)
        for i in range(400)
    ]
    df = spark.createDataFrame(data, MODES)
    small = modes.unique_mode_flags(df, Params(rows_per_task=7))
    assert rows(small) == rows(modes.unique_mode_flags(df))
    pos, neg = [r for r in data if r[1] == "Positive"], [r for r in data if r[1] == "Negative"]
    hit = set()
    for a in pos:
        for b in neg:
            gap = abs(a[4] - b[4])
            if gap <= 0.005 and abs(a[5] - b[5]) <= 1 and gap / a[4] * 1e6 <= 10:
                hit |= {a[2], b[2]}
    assert {r.FeatureNumber for r in small.where("NOT unique_mode").collect()} == hit
    assert 0 < len(hit) < len(data)


LOOKUP = (
    "INPUT string, Preferred_Name string, DTXSID string, DATA_SOURCES string, TOXCAST___ACTIVE double, "
    f"{lookup.EXPOSURE} double"
)


def lookup_rows(spark):
    return spark.createDataFrame(
        [
            ("A", "a1", "D1", "10", 50.0, 1e-6), ("A", "a2", "D2", "5", 20.0, 0.0),  # exposure 0: no decade
            ("B", "b1", "D3", None, None, 1e-3), ("B", "b2", "D4", "8", 10.0, 1e-4),  # one unknown count: no ratio
            ("Z", "z1", "D5", "3", 99.0, 1e-2),  # no feature asks for it
        ],
        LOOKUP,
    )


def test_classification(spark):
    got = {r.DTXSID: r for r in lookup.chem_classify(lookup_rows(spark)).collect()}
    assert [got[d].Compound_Classification for d in ("D1", "D2", "D3", "D4", "D5")] == ["A1", "A2", "BNA", "ANA", "A1"]
    assert [got[d].ExposureCategory for d in ("D1", "D2", "D3", "D4")] == [3.0, None, 6.0, 5.0]
    assert got["D1"].Tox21_Activities == 0.5 and got["D2"].DataSourceRatio == 0.5


JOINED = (
    "ExpID string, IonMode string, Compound string, Mass double, RetentionTime double, Score double, "
    "S1_subMedAbun double, S2_subMedAbun double"
)


def joined(spark):
    return spark.createDataFrame(
        [
            ("E", "Positive", "A", 100.0, 1.0, 90.0, 100.0, 1000.0),
            ("E", "Negative", "A", 100.0, 1.0, 90.0, 10.0, None),
            ("E", "Positive", "B", 200.0, 1.0, 90.0, 1.0, None),
            ("E", "Positive", "C", 300.0, 1.0, 90.0, None, None),  # never measured: dropped
            ("E", "Positive", "300.1@5", 300.1, 5.0, 90.0, 7.0, 7.0),  # not a name
            ("E", "Positive", "Q", 400.0, 1.0, 90.0, 4.0, 4.0),  # no candidate
        ],
        JOINED,
    )


def test_presence_and_abundance(spark):
    rows = scoring.sample_presence(joined(spark))
    got = {(r.Compound, r.IonMode): r.SampleN for r in rows.collect()}
    assert got == {("A", "Positive"): 3, ("A", "Negative"): 3, ("B", "Positive"): 1, ("C", "Positive"): 0, ("Q", "Positive"): 2}
    logs = {(r.Compound, r.IonMode): r.log10_avgAbun for r in scoring.avg_log_abundance(rows).collect()}
    assert ("C", "Positive") not in logs and logs["A", "Positive"] == pytest.approx(2.5)
    assert logs["B", "Positive"] == 0.0 and logs["Q", "Positive"] == pytest.approx(math.log10(4))


@pytest.mark.parametrize("params", [Params(), Params(rows_per_task=1)])
def test_priority_scores(spark, params):
    got = scoring.priority_scores(joined(spark), lookup_rows(spark), params).collect()
    chemicals = {(r.Chemical, r.IonMode) for r in got}
    # D1 has one best row; the rest have a missing score, so all their rows stay.
    assert chemicals == {
        ("A: a1", "Positive"), ("A: a2", "Positive"), ("A: a2", "Negative"), ("B: b1", "Positive"),
        ("B: b2", "Positive"), (None, "Positive"),
    }
    best = next(r for r in got if r.DTXSID == "D1")
    assert (best.Pi_Bioactivity, best.Pi_Exposure, best.Pi_Abundance, best.Pi_Frequency) == (1.0, 0.0, 1.0, 1.0)
    assert best.ToxPiScore == 5.0 and best.Class == "A1α"
    letters = {r.DTXSID: r.alpha_beta for r in got}
    assert letters == {"D1": "α", "D2": "γ", "D3": "γ", "D4": "α", None: "γ"}
    assert next(r for r in got if r.DTXSID is None).Class == "NAγ"


def test_constant_indicator_is_missing(spark):
    rows = spark.createDataFrame([("E", 1.0, 2.0, 3.0, 4)] * 2, "ExpID string, Tox21_Activities double, ExposureCategory double, log10_avgAbun double, SampleN long")
    assert all(r.Pi_Exposure is None for r in scoring.pi_normalise(rows).collect())


def scored(spark, n):
    return spark.createDataFrame(
        [("E", "P", f"c{i:03}", 1.0, f"D{i}", float(i % 5), 0.1, 0.2, 0.3, 0.4) for i in range(n)]
        + [("E", "P", "none", 1.0, "X", None, None, None, None, None)],
        "ExpID string, IonMode string, Chemical string, Mass double, DTXSID string, ToxPiScore double, "
        "Pi_Bioactivity double, Pi_Exposure double, Pi_Abundance double, Pi_Frequency double",
    )


def test_chart_tables(spark):
    assert chart.weight_sectors() == [
        ("Pi_Bioactivity", 2.0, 2.0, 0.0, 1.0), ("Pi_Abundance", 1.0, 3.0, 2.0, 2.5),
        ("Pi_Exposure", 1.0, 4.0, 3.0, 3.5), ("Pi_Frequency", 2.0, 6.0, 4.0, 5.0),
    ]
    df = scored(spark, 25)
    pages = sorted((r.position, r.page, r.Chemical) for r in chart.chart_pages(df).collect())
    want = sorted(range(25), key=lambda i: (-(i % 5), i))
    assert [p[2] for p in pages] == [f"c{i:03}" for i in want]
    assert [p[1] for p in pages] == [i // 9 + 1 for i in range(25)]
    table = chart.score_chart_table(df).collect()
    assert len(table) == 100 and all(r.ToxPi == pytest.approx(2 * 0.1 + 0.3 + 0.2 + 2 * 0.4) for r in table)
    assert {r.page for r in table if r.Chemical == "c004"} == {1}


def test_polarities_stack_with_missing_columns(spark):
    a = spark.createDataFrame([(1, True)], "x int, is_Na_adduct boolean")
    b = spark.createDataFrame([(2, False)], "x int, is_Formate_adduct boolean")
    got = modes.stack_modes(a, b).orderBy("x").collect()
    assert tuple(got[0]) == (1, True, None) and tuple(got[1]) == (2, None, False)
    assert modes.stack_modes(a, b).where(F.col("is_Na_adduct").isNull()).count() == 1
