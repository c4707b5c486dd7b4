import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from ionsift.llm import quality, registry  # noqa: E402
from tests.llm.conftest import ODD, SMALL  # noqa: E402
from tests.llm.test_duplicates import brute_cut, brute_groups  # noqa: E402
from tests.llm.test_text import normal  # noqa: E402
from tests.llm.test_tokens import check_packing  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SMALL)
        if len(out) < 4:
            assert result.dtypes == docs.dtypes
        result.write.parquet(str(folder / name))
        after = spark.read.parquet(str(folder / name))
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def test_quality_stage_drops_what_the_rules_reject(spark, stages):
    before, after = stages[0]
    judged = quality.judged(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    kept = {r.doc_id for r in judged.where("kept").collect()}
    assert {r.doc_id for r in after} == kept
    assert {r.doc_id: r.text for r in before if r.doc_id in kept} == {r.doc_id: r.text for r in after}


def test_line_stage_removes_lines_only(stages):
    before, after = stages[1]
    new = {r.doc_id: r for r in after}
    assert set(new) == {r.doc_id for r in before}
    left = [normal(x) for r in after for x in r.text.split("\n") if normal(x)]
    assert len(left) == len(set(left))
    for r in before:
        lines = iter(r.text.split("\n"))
        assert new[r.doc_id].text == "" or all(line in lines for line in new[r.doc_id].text.split("\n"))
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text) and new[r.doc_id].source == r.source


def test_near_stage_keeps_one_of_each_group(stages):
    before, after = stages[2]
    groups = brute_groups([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == {r.doc_id for r in before if groups.root(r.doc_id) == r.doc_id}


def test_passage_stage_cuts_what_brute_force_cuts(stages):
    before, after = stages[3]
    want = brute_cut([(r.doc_id, r.text) for r in before])
    for r in after:
        n, removed, _, _ = want[r.doc_id]
        assert n - removed - 3 * 2 * max(1, removed) <= len(r.text.encode()) <= n - removed
        assert r.n_chars == len(r.text)


def test_packing_stage_holds_every_id(stages):
    before, after = stages[4]
    assert check_packing(after, [(r.doc_id, r.text) for r in before]) < 0.05


def test_stages_take_odd_rows(spark, docs):
    rows = docs(ODD).withColumn("extra", F.lit(1)).withColumn("salt", F.lit("s"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, rows, SMALL)
        assert out.dtypes == rows.dtypes
        out.collect()
        assert stage(spark, rows.limit(0), SMALL).count() == 0


def test_native_queries_run_no_python(spark):
    for name in ("op1_document_fingerprints", "op2_quality_rules"):
        plan = registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan), name
