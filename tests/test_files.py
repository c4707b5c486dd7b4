"""Readers and writers: quotes, line breaks, comments, headers, types, several files of a dataset, rejects, repeated runs."""

import csv
import datetime
import io
import random

import pytest
from pyspark.sql import functions as F

from ionsift import round_trips
from ionsift.functions.text import unique_names
from ionsift.operators.ingest import prepare_files
from ionsift.params import Params
from ionsift.sources import readers, records, types, writers


def cells(df):
    names = [c for c in df.columns if c not in ("source", "_bad")]
    return sorted((tuple(r) for r in df.select(*[F.col(f"`{c}`") for c in names]).collect()), key=repr)


@pytest.fixture
def small_blocks(spark):
    """Splits of a few bytes, so that records run over the borders of blocks."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quoted_cells(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('name,x,"note, long"\n"a ""b"", c",1.5,x\n"two\nlines",2,"# no comment"\n5" nail,3,a"b\n# gone, "all\n\n"",,""""\n')
    df = readers.read_cells(spark, str(path))
    assert df.columns == ["name", "x", "note, long", "source", "_bad"]
    assert cells(df) == sorted(
        [('a "b", c', "1.5", "x"), ("two\nlines", "2", "# no comment"), ('5" nail', "3", 'a"b'), ("", None, '"')], key=repr
    )
    table = readers.read_table(spark, str(path))
    assert table.where("x IS NULL").first()["name"] is None and "_bad" not in table.columns


@pytest.mark.parametrize("seed", range(4))
def test_records_over_block_borders(spark, tmp_path, small_blocks, seed):
    """What a whole-file parser reads, from files cut in blocks of a few bytes."""
    rng = random.Random(seed)
    pieces = ["a", "b c", '"', '""', ",", "\n", "\r\n", "#", " # x", "é", "long text without anything in it", ""]
    paths, want = [], []
    for k in range(3):
        rows = [["".join(rng.choices(pieces, k=rng.randrange(5))) for _ in range(3)] for _ in range(40)]
        rows = [[f"r{i}", *r] for i, r in enumerate(rows)]
        text = io.StringIO()
        writer = csv.writer(text, lineterminator=rng.choice(["\n", "\r\n"]) if k else "\n")
        writer.writerow(["id", "x", "y", "z"])
        writer.writerows(rows if k < 2 else [[c.replace("\n", " ").replace("\r", " ") for c in r] for r in rows])
        path = tmp_path / f"f{k}.csv"
        path.write_bytes(text.getvalue().encode())
        paths.append(str(path))
        want += [tuple(c or None for c in r) for r in csv.reader(io.StringIO(text.getvalue(), newline=""))][1:]
    assert cells(readers.read_cells(spark, paths)) == sorted(want, key=repr)


def test_comments_behind_cells(spark, tmp_path, small_blocks):
    path = tmp_path / "a.csv"
    rows = "".join(f'k{i},"in # quotes, {i}" # open " quote\n# "more\n"x\n# kept, {i}",y#z\n' for i in range(30))
    path.write_text("a,b # header\n" + rows)
    got = cells(readers.read_cells(spark, str(path), records.TRAILING_COMMENTS))
    want = [(f"k{i}", f"in # quotes, {i}") for i in range(30)] + [(f"x\n# kept, {i}", "y") for i in range(30)]
    assert sorted((a, b.strip()) for a, b in got) == sorted(want)


def test_states_of_a_line(spark):
    """Where a line leaves a reader, by a walk over its characters."""

    def walk(line, inside, sep=","):
        start, i = not inside, 0
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"':
                    if line[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        inside = False
                start = False
            elif c == '"' and start:
                inside = True
            else:
                start = c == sep
            i += 1
        return int(inside)

    rng = random.Random(1)
    lines = ["".join(rng.choices('",ab', k=rng.randrange(9))) for _ in range(400)]
    table = spark.createDataFrame(list(enumerate(lines)), "i long, value string").withColumn("segs", F.split("value", '"'))
    rows = table.select("value", records._walk(0, ",", False)["s"].alias("f0"), records._walk(1, ",", False)["s"].alias("f1")).collect()
    assert all((r.f0, r.f1) == (walk(r.value, False), walk(r.value, True)) for r in rows)


def test_quote_that_is_never_closed(spark, tmp_path, monkeypatch):
    path = tmp_path / "a.csv"
    path.write_text('a,b\n1,"x\n' + "2,y\n" * 200)
    assert cells(readers.read_cells(spark, str(path)))[0][0] == "1"
    monkeypatch.setattr(records, "LONGEST", 100)
    with pytest.raises(ValueError, match="quote"):
        readers.read_cells(spark, str(path))


def test_headers_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿id,"two\nlines",x\n1,2,3\n'.encode())
    (tmp_path / "b.csv").write_text("# note\n\nid,x\n1,2\n4,5,6\n7\n")
    (tmp_path / "c.csv").write_text("id,x\n8,9\n")
    (tmp_path / "empty.csv").write_text("")
    paths = [str(tmp_path / f"{n}.csv") for n in ("a", "b", "c", "empty")]
    found = {tuple(x.names): x for x in readers.layouts(spark, paths)}
    assert set(found) == {("id", "two\nlines", "x"), ("id", "x")}
    both = found["id", "x"]
    assert len(both.sources) == 2 and cells(both.cells()) == [("1", "2"), ("4", "5"), ("7", None), ("8", "9")]
    assert sorted(r._bad for r in both.cells().where("_bad IS NOT NULL").collect()) == ["4,5,6", "7"]
    with pytest.raises(ValueError, match="one header"):
        readers.read_cells(spark, paths)


def test_names_that_clash():
    assert unique_names(["A_b", "A_b", "a_B", "X", "A_b_2", ""]) == ["A_b", "A_b_3", "a_B_4", "X", "A_b_2", "X_2"]
    rng = random.Random(2)
    for _ in range(200):
        names = ["".join(rng.choices(["a", "A", "_2", "_3"], k=rng.randrange(4))) for _ in range(8)]
        new = unique_names(names)
        assert len({n.lower() for n in new}) == 8 and unique_names(new) == new
        assert all(n == (m or "X") for k, (m, n) in enumerate(zip(names, new)) if (m or "X").lower() not in [(x or "X").lower() for x in names[:k]])


def test_types_of_columns(spark):
    rows = [("1", "1.5", "T", "2020-02-29", None, "1", "x"), (" -2", "1e3", "false", "1999-01-01", None, "T", "")]
    df = spark.createDataFrame(rows, "l string, d string, b string, day string, none string, mixed string, t string")
    got = {r["column"]: (r["type"], r["n_values"], r["n_missing"]) for r in types.inferred_types(df).collect()}
    assert got == {
        "l": ("long", 2, 0), "d": ("double", 2, 0), "b": ("boolean", 2, 0), "day": ("date", 2, 0), "none": ("boolean", 0, 2),
        "mixed": ("text", 2, 0), "t": ("text", 2, 0),
    }
    out = types.typed(df.withColumn("n", F.lit(5)))
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "double", "boolean", "date", "boolean", "string", "string", "int"]
    assert tuple(out.orderBy("l").first()) == (-2, 1000.0, False, datetime.date(1999, 1, 1), None, "T", "", 5)
    assert {r["type"] for r in types.inferred_types(df.limit(0)).collect()} == {"boolean"}
    plan = types.inferred_types(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


EXPORT = "Mass,Retention Time,Compound,Annotations,Frequency,{samples}\n{rows}"


def one_file(folder, name, samples, masses):
    rows = "\n".join(f"{m},1.0,C{m},x,1," + ",".join(str(10 + k) for k in range(len(samples))) for m in masses)
    (folder / name).write_text(EXPORT.format(samples=",".join(samples), rows=rows))


def test_several_files_of_a_dataset(spark, tmp_path):
    a, b = "E1_Positive_M_S1_1", "E1_Positive_M_S2_1"
    one_file(tmp_path, "1.csv", [a, "E2_Negative_M_S1_1"], [3.5, 2.5])
    one_file(tmp_path, "2.csv", [b, a], [1.5, 9.5, 4.5])
    one_file(tmp_path, "3.csv", [a, "E2_Negative_M_S1_1"], [7.5])
    paths = [str(tmp_path / "*.csv")]
    with pytest.raises(ValueError, match="E1_Positive"):
        prepare_files(spark, paths)
    got = prepare_files(spark, paths, shared_datasets=True)
    features = sorted((r.ExpID, r.FeatureNumber, r.Mass) for r in got.features.collect())
    first = [(1, 2.5), (2, 3.5), (3, 1.5), (4, 4.5), (5, 9.5), (6, 7.5)]
    assert features == [("E1", n, m) for n, m in first] + [("E2", n, m) for n, m in [(1, 2.5), (2, 3.5), (3, 7.5)]]
    long = sorted((r.ExpID, r.FeatureNumber, r.SampleDetail) for r in got.abundance.collect())
    assert [x[1:] for x in long if x[0] == "E1"] == [(1, "S1"), (2, "S1"), (3, "S1"), (3, "S2"), (4, "S1"), (4, "S2"), (5, "S1"), (5, "S2"), (6, "S1")]
    assert got.long().where("Mass IS NULL").count() == 0


def test_a_repeated_run_replaces_its_own_folders(spark, tmp_path):
    def run(day, rows, mode="replace"):
        df = spark.createDataFrame(rows, "ExpID string, IonMode string, v string, n int")
        return writers.write_table(df, str(tmp_path), "kind", datetime.date(2020, 1, day), mode=mode, null_text="NA")

    run(1, [("007", "Positive", ' "a", b ', 1), ("E2", "Negative", "", 2), ("E2", "Negative", None, 3)])
    run(2, [("007", "Positive", "x", 4)])
    run(1, [("007", "Positive", "two\nlines", 5), (None, "Positive", "y", 6)])
    run(1, [("007", "Positive", "two\nlines", 5), (None, "Positive", "y", 6)])
    schema = "v string, n int, run_date date, ExpID string, IonMode string"
    got = sorted(tuple(map(str, r)) for r in writers.read_result(spark, str(tmp_path), "kind", schema, "NA").collect())
    one, two = "2020-01-01", "2020-01-02"
    assert got == sorted(
        [("two\nlines", "5", one, "007", "Positive"), ("", "2", one, "E2", "Negative"), ("None", "3", one, "E2", "Negative"),
         ("x", "4", two, "007", "Positive"), ("y", "6", one, "None", "Positive")]
    )
    with pytest.raises(Exception, match="already exists"):
        run(1, [("007", "Positive", "x", 1)], mode="errorifexists")


def test_blanks_and_quotes_are_written_as_they_are(spark, tmp_path):
    df = spark.createDataFrame([(' "a", b ', None), ("", "x\ny")], "v string, w string")
    path = writers.write_table(df, str(tmp_path), "kind", datetime.date(2020, 1, 1))
    text = "".join(p.read_text() for p in (tmp_path / "kind").rglob("*.csv"))
    assert '" ""a"", b "' in text and '"x\ny"' in text and path.endswith("kind")


def test_lookup_records_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "l.tsv"
    path.write_text("INPUT\tA b\tA.b\nx\t1\t-\ny\tmany\t2\nz\t3\nw\t4\t5\t6\nv\t \t7.5\nu\t-\tq\n")
    got = readers.checked_lookup(spark, str(path), ("A_b", "A_b_2"))
    assert sorted(tuple(r) for r in got.rows.collect()) == [("v", None, 7.5), ("x", 1.0, None)]
    assert got.rows.columns == ["INPUT", "A_b", "A_b_2"]
    assert sorted((r.reason, r.record) for r in got.rejected.collect()) == [("A_b", "y\tmany\t2"), ("A_b_2", "u\t-\tq"), ("cells", "w\t4\t5\t6"), ("cells", "z\t3")]
    assert got.counts == {"A_b": 1, "A_b_2": 1, "cells": 2}
    with pytest.raises(ValueError, match="no column"):
        readers.checked_lookup(spark, str(path), ("gone",))


def test_old_files_are_told_by_their_names(spark, tmp_path):
    for mode in ("Positive", "Esi-"):
        (tmp_path / f"E 1_${mode}$_Filtered_2018-01-05.csv").write_text("a\n1\n")
    got = sorted(tuple(r) for r in readers.old_files(spark, str(tmp_path / "*.csv")).select("mode", "pair", "stem", "record").collect())
    assert got == [(m, "E 1_Filtered_2018-01-05.csv", f"E 1_${m}$_Filtered", "1") for m in ("Esi-", "Positive")]


@pytest.mark.parametrize("name", list(round_trips.QUERIES))
def test_round_trips_equal_their_sql(spark, name):
    from tests_compare import compare, connect

    sf = "/root/testdata/sf0.001"
    problem, rows = compare(spark, connect(sf), name, sf)
    assert problem is None and rows > 0
