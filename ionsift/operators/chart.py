"""The tables behind the score charts: one sector per indicator, nine charts to a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionsift.operators.scoring import SCORE
from ionsift.operators.skew import balanced_join, heavy_keys, number_rows, with_group
from ionsift.params import Params
from ionsift.session import settle_and_watch


def weight_sectors(params: Params = Params()) -> list[tuple[str, float, float, float, float]]:
    """(indicator, weight, end, start, middle) of each sector, in chart order."""
    out, end = [], 0.0
    for name, weight in params.weights:
        start, end = end, end + weight
        out.append((name, weight, end, start, start + (end - start) / 2))
    return out


def pi_melt(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per indicator with its height and sector; the sectors enter as constants."""
    cells = []
    for name, weight, end, start, middle in weight_sectors(params):
        cells += [F.lit(name), F.col(name), F.lit(weight), F.lit(end), F.lit(start), F.lit(middle)]
    rest = [c for c in scored.columns if c not in dict(params.weights)]
    stacked = F.stack(F.lit(len(params.weights)), *cells).alias("sub_Pi", "height", "weight", "w", "wm", "wt")
    return scored.select(*rest, stacked)


def chart_pages(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """Position and page of each scored chemical, best first, names breaking ties."""
    chemicals = (
        scored.where(F.col(SCORE).isNotNull()).groupBy("ExpID", "Chemical").agg(F.max(SCORE).alias(SCORE))
    )
    numbered = number_rows(
        chemicals, ["ExpID"], [F.col(SCORE).desc_nulls_last(), F.col("Chemical").asc_nulls_last()], "position"
    )
    return numbered.withColumn("page", F.ceil(F.col("position") / params.page_size).cast("long"))


def pi_geometry(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """Chart rows of every scored chemical: sector, height, and the total of its rows."""
    sectors, seen = settle_and_watch(pi_melt(scored.where(F.col(SCORE).isNotNull()), params))
    return with_group(
        sectors,
        ["ExpID", "Chemical"],
        ["sub_Pi", "IonMode", "Mass", "DTXSID"],
        params.rows_per_task,
        seen["rows"],
        ToxPi=F.sum(F.col("height") * F.col("weight")),
    )


def score_chart_table(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """``pi_geometry`` with the page each chemical is drawn on."""
    pages = chart_pages(scored, params).select("ExpID", "Chemical", "page")
    rows = ["sub_Pi", "IonMode", "Mass", "DTXSID"]
    geometry = pi_geometry(scored, params)
    counts = geometry.groupBy("ExpID", "Chemical").agg(F.count(F.lit(1)).alias("_n"))
    heavy = heavy_keys(counts, ["ExpID", "Chemical"], "_n", params.rows_per_task)
    return balanced_join(geometry, pages, ["ExpID", "Chemical"], heavy, rows)
