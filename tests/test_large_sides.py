"""Pairs of features whose table is small as a file and large in memory."""

import pytest

from ionsift.operators import modes, partners

TYPES = "FeatureNumber long, ExpID string, IonMode string, Mass double, RetentionTime double, Compound string, Score double"


def table(spark, folder):
    """Two features of a dataset an adduct apart, and a partner in the other polarity, in a small file."""
    rows = [
        (1, "A", "Positive", 200.0, 5.0, "Tea", 1.0),
        (2, "A", "Positive", 221.98194, 5.0, "Salt", 1.0),
        (3, "A", "Negative", 200.0, 5.5, "Tea", 1.0),
    ]
    spark.createDataFrame(rows, TYPES).write.parquet(folder)
    return spark.read.parquet(folder)


def joins(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line and "cell" in line]


@pytest.mark.parametrize(
    "query, found", [(partners.adduct_pairs, (1, 2)), (modes.cross_mode_match, (1, 3))], ids=["adduct_pairs", "cross_mode_match"]
)
def test_no_side_of_the_pairs_is_broadcast(spark, tmp_path, query, found):
    got = query(table(spark, str(tmp_path / "features")))
    plain = joins(got)
    other = [c for c in got.columns if c.endswith("_FeatureNumber")][0]
    assert [tuple(r) for r in got.select("FeatureNumber", other).collect()] == [found]
    assert plain and all("SortMergeJoin" in line for line in plain)
