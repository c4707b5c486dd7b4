"""A whole run in order: files, both modes, compound list, scores, chart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ionsift.operators.chart import score_chart_table
from ionsift.operators.compounds import unique_compounds
from ionsift.operators.ingest import Prepared, prepare_files
from ionsift.operators.modes import join_modes
from ionsift.operators.scoring import priority_scores
from ionsift.params import Params
from ionsift.plans.process import Processed, process
from ionsift.session import settle


def process_prepared(prepared: Prepared, params: Params = Params(), samples: list[str] | None = None) -> Processed:
    """Process what ``prepare_files`` or ``already_long`` gives."""
    return process(settle(prepared.features), prepared.abundance, params, samples)


def process_files(spark: SparkSession, paths: list[str], params: Params = Params()) -> Processed:
    """All exports of a run at once; experiments and modes are told apart by columns."""
    return process_prepared(prepare_files(spark, paths, params), params)


def joined_and_listed(result: Processed, params: Params = Params()) -> tuple[DataFrame | None, DataFrame]:
    """The joined table of paired modes (if wanted) and the compounds to look up."""
    if not params.paired:
        return None, unique_compounds(result.filtered(params))
    wide = result.filtered(params) if params.output_wide else result.filtered_wide()
    joined = settle(join_modes(settle(wide), params))
    return joined, unique_compounds(joined)


def scored_and_charted(
    joined: DataFrame, lookup: DataFrame, params: Params = Params()
) -> tuple[DataFrame, DataFrame]:
    """The priority table and the chart rows, once the lookup result is there."""
    scores = settle(priority_scores(joined, lookup, params))
    return scores, score_chart_table(scores, params)
