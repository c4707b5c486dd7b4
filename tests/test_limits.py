"""What a run refuses, keeps apart, widens or cleans up; expressions over very many samples."""

import time

import pytest
from pyspark.sql import functions as F

from ionsift import session
from ionsift.fixtures import ABUNDANCE, FEATURES, fixture
from ionsift.operators import replicates, scoring, wide
from ionsift.operators.ingest import prepare_files
from ionsift.params import FEATURE, MEASURES, SAMPLE, Params
from ionsift.plans.process import process
from tests.test_runs import SMALL, export


def test_two_files_of_one_dataset_are_refused(spark, tmp_path):
    paths = [export(tmp_path, name, "E1", "Positive") for name in ("a.txt", "b.txt")]
    with pytest.raises(ValueError, match="E1_Positive"):
        prepare_files(spark, paths)
    alone = prepare_files(spark, paths[:1])
    other = prepare_files(spark, [paths[0], export(tmp_path, "c.txt", "E2", "Positive")])
    key = lambda r: str(r)
    same = other.abundance.where("ExpID = 'E1'").collect()
    assert sorted(same, key=key) == sorted(alone.abundance.collect(), key=key)


def test_very_many_samples_stay_flat(spark):
    cells = [F.lit(float(i % 7)).alias(f"S{i}_subMedAbun") for i in range(5000)]
    rows = spark.range(3).select(
        F.lit("E").alias("ExpID"), F.lit("Tea").alias("Compound"), F.col("id").cast("double").alias("Mass"), *cells
    )
    start = time.time()
    got = scoring.avg_log_abundance(scoring.sample_presence(rows)).collect()
    assert time.time() - start < 60
    assert [r.SampleN for r in got] == [5000] * 3
    assert got[0].log10_avgAbun == pytest.approx(sum([0, 0.30103, 0.4771213, 0.60206, 0.69897, 0.7781513]) / 6, abs=2e-3)


def test_unknown_sample_ends_the_run(spark):
    rows = spark.createDataFrame([("E", "P", 1, s, 1.0) for s in ("S1", "S2")], "ExpID string, IonMode string, FeatureNumber long, SampleDetail string, v double")
    rows = rows.select(*SAMPLE, *[F.col("v").alias(m) for m in MEASURES])
    assert wide.wide_measures(rows, ["S1", "S2"]).count() == 1
    with pytest.raises(Exception, match="sample not in the list of samples: S2"):
        wide.wide_measures(rows, ["S1"]).collect()


def test_missed_bracket_is_opened(spark):
    values = [float(v) for v in range(1, 200)]
    rows = spark.createDataFrame([("E", "P", 1, "S", v) for v in values], "ExpID string, IonMode string, FeatureNumber long, SampleDetail string, _v double")
    large = rows.select(*SAMPLE).distinct().selectExpr("*", "199L AS _n", "0D AS _lo", "3D AS _hi")
    assert replicates._all_medians(rows, large, SAMPLE, True).collect()[0]._exact == 100.0


def test_clusters_form_on_final_labels_when_prefiltered(spark):
    features = spark.createDataFrame(
        [("E", "Negative", 1, 300.0001, 2.0, "Alpha", 40.0, 1), ("E", "Negative", 2, 300.0002, 2.0, "Beta", 45.0, 1)],
        "ExpID string, IonMode string, FeatureNumber long, Mass double, RetentionTime double, Compound string, Score double, Frequency long",
    )
    rows = [("E", "Negative", i, "MS1", s, "1", v) for i in (1, 2) for s, v in (("Blank", 1.0), ("S1", 1000.0))]
    abundance = spark.createDataFrame(rows, "ExpID string, IonMode string, FeatureNumber long, ModeDetail string, SampleDetail string, Rep string, volume double")
    for early, kept in ((True, [2]), (False, [1, 2])):
        params = Params(prefilter=early)
        assert sorted(r.FeatureNumber for r in process(features, abundance, params).filtered(params).collect()) == kept


def test_one_machine_only_without_a_shared_folder():
    assert session._one_machine("local") and session._one_machine("local[4]")
    assert not any(session._one_machine(m) for m in ("local-cluster[2,1,1024]", "yarn", "spark://h:7077"))


def test_run_folder_is_removed(spark):
    from pathlib import Path

    with session.run_folder(spark) as folder:
        table = session.settle(spark.range(5))
        assert table.count() == 5 and table.inputFiles()[0].startswith(folder.replace("file:/", "file:///"))
        path = Path(folder.replace("file:", ""))
        assert path.exists()
    assert not path.exists()


def test_modes_of_one_fixture_are_not_mixed(spark):
    flags = process(fixture(spark, SMALL, FEATURES), fixture(spark, SMALL, ABUNDANCE), Params()).flags
    assert flags.select(*FEATURE).distinct().count() == flags.count()
