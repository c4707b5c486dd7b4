"""Files in, tables out: readers, numbering, melting, the whole run, writers, plans."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ionsift.fixtures import ABUNDANCE, FEATURES, fixture
from ionsift.operators.ingest import already_long, prepare_files
from ionsift.operators.skew import number_rows, with_group
from ionsift.operators.wide import columns_like, melt_measures, sample_columns, split_measure_name, wide_measures
from ionsift.params import CONTRACT, FEATURE, MEASURES, Params
from ionsift.plans import run
from ionsift.plans.process import process
from ionsift.sources import readers, writers

SMALL = "/root/testdata/sf0.001"

EXPORT = """# exported table
Mass\tRetention Time\tCompound\tAnnotations\tFrequency\t{mode}
300.5\t2.5\tTea Esi+ 1\t[db, overall=95.5, x]\t3\t10\t12\t100\t110
100.25\t1.5\tCaffeine #2\tnothing\t-\t1\t0\tNA\t55
300.5\t2.0\tMilk\toverall=80, a, b\t2\t-\t5\t20\t22
NA\t1.0\tNoMass\tx\t1\t1\t1\t50\t60
"""
SAMPLES = ["MB01_1", "MB02_1", "S1_1", "S1_2"]


def export(folder, name, exp, mode):
    path = folder / name
    text = EXPORT.format(mode="\t".join(f"{exp}_{mode}_MS1_{s}" for s in SAMPLES))
    path.write_text(text if name.endswith("txt") else text.replace("\t", ",").replace("[db, overall=95.5, x]", '"[db, overall=95.5, x]"').replace("overall=80, a, b", '"overall=80, a, b"'))
    return str(path)


def test_prepare_files(spark, tmp_path):
    paths = [
        export(tmp_path, "a.txt", "E1", "Positive"), export(tmp_path, "b.csv", "E1", "Negative"),
        export(tmp_path, "c.txt", "E2", "Positive"),
    ]
    got = prepare_files(spark, paths)
    features = {(r.ExpID, r.IonMode, r.FeatureNumber): r for r in got.features.collect()}
    assert len(features) == 12
    for exp, mode in (("E1", "Positive"), ("E1", "Negative"), ("E2", "Positive")):
        one = [features[exp, mode, i] for i in range(1, 5)]
        assert [r.Compound for r in one] == ["Caffeine #2", "Milk", "Tea", "NoMass"]  # by mass, then time, missing last
        assert [r.Score for r in one] == [None, None, 95.5, None] and [r.Frequency for r in one] == [None, 2, 3, 1]
    long = [r for r in got.abundance.collect() if (r.ExpID, r.IonMode, r.FeatureNumber) == ("E1", "Positive", 1)]
    assert {(r.SampleDetail, r.Rep, r.volume) for r in long} == {("Blank", "1", None), ("S1", "1", None), ("S1", "2", 55.0)}
    assert len(long) == 4 and got.long().columns == CONTRACT
    assert got.long().count() == 48


def test_same_header_one_scan(spark, tmp_path):
    for d in ("x", "y"):
        (tmp_path / d).mkdir()
    paths = [export(tmp_path / d, "a.txt", "E1", "Positive") for d in ("x", "y")]
    tables = readers.read_tables(spark, paths)
    assert len(tables) == 1 and tables[0].select("source").distinct().count() == 2
    with pytest.raises(ValueError):
        readers.delimiter("table.xlsx")


def test_lookup_file(spark, tmp_path):
    path = tmp_path / "lookup.tsv"
    path.write_text("INPUT\tDATA_SOURCES\tTOXCAST_% ACTIVE\t2nd name\nA\t10\t-\tx\nB\t-\t0\ty\n")
    df = readers.read_lookup(spark, str(path))
    assert df.columns == ["INPUT", "DATA_SOURCES", "TOXCAST___ACTIVE", "X2nd_name"]
    assert [tuple(r) for r in df.orderBy("INPUT").collect()] == [("A", "10", None, "x"), ("B", None, "0", "y")]


def test_old_file_names(spark):
    df = spark.createDataFrame([("E_$Positive$_Filtered_2018-01-05.csv",), ("plain.csv",)], "n string")
    out = df.select(*[f(F.col("n")) for f in (readers.mode_in_name, readers.name_without_mode, readers.name_stem)]).collect()
    assert tuple(out[0]) == ("Positive", "E_Filtered_2018-01-05.csv", "E_$Positive$_Filtered")
    assert tuple(out[1]) == (None, "plain.csv", None)


def test_names_with_other_parts(spark):
    df = spark.createDataFrame([("a_b_c_d_e_f",), ("a_b_c_d",)], "n string")
    got = [tuple(r) for r in split_measure_name(df, "n").orderBy("n").collect()]
    assert got == [("a_b_c_d", "a", "b", "c", "d", None), ("a_b_c_d_e_f", "a", "b", "c", "d", "e")]
    wide = spark.createDataFrame([(1, 2.0, 3.0)], "id int, my_note double, E_P_M_S_1 double")
    assert sample_columns(wide) == ["E_P_M_S_1"] and columns_like(wide, "NOTE") == ["my_note"]


def test_pivot_undoes_melt(spark, rows):
    rnd = random.Random(3)
    cols = [f"E_P_M_S{i}_1" for i in range(4)]
    wide = spark.createDataFrame([(i, *[float(rnd.randrange(2, 99)) for _ in cols]) for i in range(20)], "FeatureNumber long, " + ", ".join(f"{c} double" for c in cols))
    long = melt_measures(wide, ()).select(*FEATURE, "SampleDetail", *[F.col("volume").alias(m) for m in MEASURES])
    back = wide_measures(long, [f"S{i}" for i in range(4)])
    assert rows(back, "FeatureNumber", *[f"S{i}_MedAbun" for i in range(4)]) == rows(wide, "FeatureNumber", *cols)


def test_numbering_with_hot_source_and_copies(spark):
    data = [("hot", float(i % 3), i % 2) for i in range(900)] + [("b", 1.0, 0), ("b", None, 0), (None, 5.0, 0), ("b", 0.5, 0)]
    df = spark.createDataFrame(data, "source string, m double, x int").repartition(5)
    got = number_rows(df, ["source"], [F.col("m").asc_nulls_last(), F.col("x")], "n").collect()
    hot = sorted((r.n, r.m, r.x) for r in got if r.source == "hot")
    assert [h[0] for h in hot] == list(range(1, 901)) and [h[1:] for h in hot] == sorted(h[1:] for h in hot)
    assert sorted((r.n, r.m) for r in got if r.source == "b") == [(1, 0.5), (2, 1.0), (3, None)]
    assert [r.n for r in got if r.source is None] == [1]


def test_group_values_with_hot_and_missing_keys(spark, rows):
    data = [("hot", i) for i in range(500)] + [(None, i) for i in range(300)] + [("a", 1)]
    df = spark.createDataFrame(data, "k string, v long")
    cut = with_group(df, ["k"], ["v"], 20, top=F.max("v"))
    assert rows(cut) == rows(with_group(df, ["k"], ["v"], 10**6, top=F.max("v")))
    assert {(r.k, r.top) for r in cut.collect()} == {("hot", 499), (None, 299), ("a", 1)}


def small_input(spark):
    return fixture(spark, SMALL, FEATURES), fixture(spark, SMALL, ABUNDANCE)


def test_run_does_not_depend_on_task_size_or_layout(spark, rows):
    features, abundance = small_input(spark)
    one = process(features, abundance, Params())
    other = process(features.repartition(7), abundance.repartition(5, "SampleDetail"), Params(rows_per_task=2))
    assert rows(one.filtered(Params())) == rows(other.filtered(Params()))
    assert rows(one.long) == rows(other.long)


def test_experiments_do_not_mix(spark, rows):
    features, abundance = small_input(spark)
    both = process(features, abundance, Params()).wide.where("ExpID = 'EXP0'")
    alone = process(features.where("ExpID = 'EXP0'"), abundance.where("ExpID = 'EXP0'"), Params()).wide
    assert rows(both.select(*alone.columns)) == rows(alone)


def test_prefilter_and_injections(spark):
    features, abundance = small_input(spark)
    pre = process(features, abundance, Params(prefilter=True)).flags
    assert pre.where("FalseSampleFeature_Flag OR BelowSpike_Flag").count() == 0 and pre.count() > 0
    reps = process(features, abundance, Params(collapse_reps=False, output_wide=False, paired=False))
    assert reps.wide is None and all("-" in r[0] for r in reps.long.select("SampleDetail").distinct().collect())


def test_files_to_charts(spark, tmp_path):
    paths = [export(tmp_path, "a.txt", "E1", "Positive"), export(tmp_path, "b.txt", "E1", "Negative")]
    params = Params(output_raw=True, blank_ratio=1.5)
    result = run.process_files(spark, paths, params)
    assert result.flags.count() == 8
    out = writers.write_run(result, str(tmp_path / "out"), params, run_date=datetime.date(2020, 1, 2))
    assert set(out) == {"raw_flagged", "filtered"}
    back = spark.read.csv(out["raw_flagged"], header=True)
    assert back.count() == 8 and {"run_date", "ExpID", "IonMode"} <= set(back.columns)
    joined, compounds = run.joined_and_listed(result, params)
    assert sorted(r.Compound for r in compounds.collect()) == ["NA@1", "Tea"]  # a label made of a missing mass
    lookup = tmp_path / "lookup.tsv"
    lookup.write_text(
        "INPUT\tDATA_SOURCES\tTOXCAST % ACTIVE\tEXPOCAST_MEDIAN_EXPOSURE_PREDICTION_MG/KG-BW/DAY\tPreferred_Name\tDTXSID\n"
        "Tea\t10\t5\t0.001\tt1\tD1\nTea\t4\t9\t0.1\tt2\tD2\n"
    )
    table = readers.read_lookup(spark, str(lookup))
    scores, charts = run.scored_and_charted(joined, table, params)
    # "NA@1" has no candidate: it stays in the table without a score.
    assert {r.DTXSID for r in scores.collect()} == {"D1", "D2", None}
    assert charts.count() == 4 * scores.where("ToxPiScore IS NOT NULL").count()
    assert charts.where("page IS NULL").count() == 0
    path = writers.write_joined(joined, str(tmp_path / "out"))
    assert spark.read.csv(path, header=True).count() == joined.count()
    writers.write_compounds(compounds, str(tmp_path / "out"))
    writers.write_scores(scores, str(tmp_path / "out"))
    long_params = Params(output_wide=False)
    kinds = writers.write_run(run.process_files(spark, paths, long_params), str(tmp_path / "long"), long_params, fmt="parquet")
    assert set(kinds) == {"filtered", "filtered_wide"}


def test_long_input_needs_no_adapter(spark, tmp_path, rows):
    prepared = prepare_files(spark, [export(tmp_path, "a.txt", "E1", "Positive")])
    again = already_long(prepared.long())
    assert rows(again.features) == rows(prepared.features) and rows(again.abundance) == rows(prepared.abundance)


def test_plans(spark):
    """No nested loops, no Python, no single-task shuffle, only the needed columns scanned."""
    features, abundance = small_input(spark)
    result = process(features, abundance, Params(), ["AF", "AO", "RF", "RO"])
    for df in (result.filtered(Params()), result.long):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "Python", "LocalTableScan"):
            assert bad not in plan, bad
    plan = result.long._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in plan and "l_extendedprice" not in plan
