"""Labels, flags, cluster names, duplicates kept, and the final filter."""

from pyspark.sql import functions as F

from ionsift.functions import text
from ionsift.functions.nulls import null_tokens, zero_to_null
from ionsift.operators import partners, quality
from ionsift.operators.compounds import unique_compounds
from ionsift.params import Params

FEATURES = (
    "FeatureNumber long, ExpID string, IonMode string, Mass double, RetentionTime double, "
    "Compound string, Score double, Frequency long"
)


def features(spark, rows):
    """Rows of (number, mass, time, compound, score, frequency)."""
    return spark.createDataFrame([(r[0], "E", "Positive", *r[1:]) for r in rows], FEATURES)


def values(spark, schema, data, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {schema}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_numbers_and_text(spark):
    got = values(spark, "string", ["12", "-3.5", "1e3", "2D", "", None, "2,4", "0x1A", " 7 ", "7."], text.to_number)
    assert got == [12.0, -3.5, 1000.0, None, None, None, None, None, 7.0, 7.0]
    got = values(spark, "double", [900.0, 121.98194, 12345678.5, 0.1, 100.0, None], text.number_text)
    assert got == ["900", "121.98194", "12345678.5", "0.1", "100", None]
    notes = ["[db, overall=92.5, x]", "overall=80, a=1, b", "no score", None, "overall=71.1,"]
    assert values(spark, "string", notes, text.annotation_score) == [92.5, None, None, None, 71.1]
    names = ["Caffeine Esi+ 2", "A", None]
    assert values(spark, "string", names, lambda c: text.before(c, " Esi")) == ["Caffeine", "A", None]


def test_rough_names(spark):
    data = ["Caffeine x@2", "123.456@7", "2,4-D acid", "0.04@1", None, "C12H8 a b"]
    assert values(spark, "string", data, text.rough_name) == ["Caffeine", "123.5", None, "0.04", None, "C12H8"]


def test_half_even_rounding(spark):
    assert values(spark, "double", [0.5, 1.5, 2.5, 2.675], lambda c: F.bround(c, 0)) == [0.0, 2.0, 2.0, 3.0]


def test_tokens_and_zeros(spark):
    df = spark.createDataFrame([("NA", " ", "-", "0", "10", None)], "a string, b string, c string, d string, e string, f string")
    assert tuple(null_tokens(df).first()) == (None, None, None, None, "10", None)
    df = spark.createDataFrame([(0, 0.0, "0", False, 5)], "a long, b double, c string, d boolean, e int")
    assert tuple(zero_to_null(df).first()) == (None, None, None, False, 5)


def test_score_flags_and_label(spark):
    df = features(
        spark,
        [
            (1, 200.01, 1.5, "C6H4Cl2", 95.0, 1),
            (2, 200.01, 1.5, "C6H4Cl2", 60.0, 1),  # weak match, accepted
            (3, 200.01, 1.5, "C6H6", 60.0, 1),  # weak, nothing excuses it
            (4, 200.01, 1.5, "C6H4Cl2", None, 1),  # undecided: no label either
            (5, 200.40, 2.0, None, None, 1),
        ],
    )
    got = {r.FeatureNumber: r for r in quality.relabel(quality.score_mass_flags(df)).collect()}
    assert [got[i].LowScore_Flag for i in range(1, 6)] == [False, True, True, True, True]
    assert [got[i].WeakMatch_Flag for i in range(1, 6)] == [True, True, False, None, False]
    assert [got[i].Compound for i in range(1, 6)] == ["C6H4Cl2", "C6H4Cl2", "200.01@1.5", None, "200.4@2"]


def test_keep_one_per_cluster(spark):
    df = features(
        spark,
        [
            (1, 100.0, 1.01, "A x", 50.0, 9), (2, 100.0, 1.02, "A y", 80.0, 1), (3, 100.0, 1.04, "A", 80.0, 5),
            (4, 100.0, 0.99, "A", 80.0, 5),  # score and frequency tie: lowest number wins
            (5, 100.0, 3.0, "B", 70.0, None), (6, 100.0, 3.0, "B", 60.0, 4),  # the best has no frequency: none kept
            (7, 100.0, 5.0, "2,4-D", 1.0, 1), (8, 100.0, 5.0, "3,5-E", None, 7),  # no cluster name: one cluster
            (9, 100.0, 7.0, "F", None, None), (10, 100.0, 7.0, "F", None, 0),
        ],
    )
    kept = {r.FeatureNumber for r in partners.duplicate_keep(df).collect()}
    assert kept == {3, 7, 10}


def test_duplicates_are_not_the_whole_cluster(spark):
    df = features(
        spark,
        [
            (1, 100.0, 1.00, "A", 10.0, 1), (2, 100.0005, 1.02, "A", 90.0, 1),
            (3, 300.0, 1.02, "A", 99.0, 1),  # same cluster name, but no duplicate
            (4, None, 1.0, "A", 99.0, 1), (5, 100.0, None, "A", 99.0, 1),
        ],
    )
    got = {r.FeatureNumber: r for r in partners.duplicate_flags(df).collect()}
    assert [got[i].Duplicate_Flag for i in range(1, 6)] == [True, True, False, False, False]
    assert [got[i].Duplicate_Keep_Flag for i in range(1, 6)] == [False, True, False, False, False]


def test_adducts_above_and_below_the_mass(spark):
    step, mass = 21.98194, 400.0
    df = features(
        spark,
        [
            (1, mass, 1.0, "A", 1.0, 1),
            (2, mass + step + 0.0079, 1.0, "B", 1.0, 1),  # 19.75 ppm above
            (3, mass + step + 0.0085, 9.0, "C", 1.0, 1),  # other time
            (4, mass + step - 0.0100, 1.0, "D", 1.0, 1),  # below: only the table-wide window bounds it
            (5, 1000.0, 30.0, "E", 1.0, 1),  # the largest mass: window of 0.02
        ],
    )
    pairs = {(r.FeatureNumber, r.adduct_FeatureNumber) for r in partners.adduct_pairs(df).collect()}
    assert pairs == {(1, 2), (1, 4)}
    got = {r.FeatureNumber: r for r in partners.adduct_flags(df).collect()}
    assert got[1].has_Na_adduct and got[2].is_Na_adduct and got[4].is_Na_adduct and not got[3].is_Na_adduct
    assert got[1].is_Formate_adduct is None  # not searched in this polarity


def test_unknown_mode_has_no_adduct_flags(spark):
    df = features(spark, [(1, 100.0, 1.0, "A", 1.0, 1), (2, 121.98194, 1.0, "A", 1.0, 1)]).withColumn("IonMode", F.lit("Odd"))
    assert all(r.has_Na_adduct is None and r.is_Formate_adduct is None for r in partners.adduct_flags(df).collect())
    esi = df.withColumn("IonMode", F.lit("Esi+"))
    assert {r.FeatureNumber for r in partners.adduct_flags(esi).where("has_Na_adduct").collect()} == {1}


def test_final_filter_drops_the_undecided(spark):
    t, f, n = True, False, None
    cases = [(f, f, f, f), (t, f, f, f), (f, t, f, f), (f, f, t, f), (f, f, t, t), (n, f, f, f), (f, n, f, f), (f, f, n, t)]
    names = ["FalseSampleFeature_Flag", "BelowSpike_Flag", "Duplicate_Flag", "Duplicate_Keep_Flag"]
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cases)], "i int, " + ", ".join(f"{c} boolean" for c in names)
    )
    assert sorted(r.i for r in quality.final_filter(df).collect()) == [0, 4, 7]


def test_compound_list(spark):
    names = ["Caffeine 2", "Caffeine 10 x", "123.4@5", None, "abc", "Tea x 1"]
    df = spark.createDataFrame([("E1", n) for n in names] + [("E2", "Caffeine 3")], "ExpID string, Compound string")
    assert sorted(map(tuple, unique_compounds(df).collect())) == [("E1", "Caffeine"), ("E1", "Tea x"), ("E2", "Caffeine")]


def test_parameters_are_checked():
    for bad in ({"adduct_error": 0}, {"duplicate_error": -1}, {"cross_rt": -1}):
        try:
            Params(**bad)
        except ValueError:
            continue
        raise AssertionError(bad)
