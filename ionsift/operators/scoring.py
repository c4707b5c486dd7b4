"""Indicators, weighted score and ranking of candidate chemicals, per experiment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionsift.functions.nulls import max_if_complete, text_or_na
from ionsift.functions.text import named
from ionsift.operators.lookup import chem_classify, chem_lookup
from ionsift.operators.skew import balanced_join, heavy_keys, join_on, with_dataset, with_group
from ionsift.operators.wide import columns_like
from ionsift.params import Params
from ionsift.session import settle, settle_and_watch

# What each indicator is the rescaled form of.
INDICATOR_SOURCE = {
    "Pi_Bioactivity": "Tox21_Activities",
    "Pi_Exposure": "ExposureCategory",
    "Pi_Abundance": "log10_avgAbun",
    "Pi_Frequency": "SampleN",
}
SCORE = "ToxPiScore"
# Rank letters of the best, a lesser and an unscored candidate.
BEST, LESSER, UNSCORED = "α", "β", "γ"


def _cells(df: DataFrame) -> Column:
    """A row's cells as one array, so that expressions stay flat however many samples there are."""
    cells = [F.col(f"`{c}`").cast("double") for c in columns_like(df, "subMed")]
    return F.array(*cells) if cells else F.array().cast("array<double>")


def sample_presence(joined: DataFrame, params: Params = Params(), at_most: int | None = None) -> DataFrame:
    """Named rows with the number of measured cells over all rows of the same name and mass.

    ``at_most`` here and below is a known bound on the rows, which spares a look at the size of the groups.
    """
    rows = joined.where(named(F.col("Compound")))
    present = rows.withColumn("_present", F.size(F.filter(_cells(rows), lambda c: c.isNotNull())))
    by = [c for c in ("IonMode", "RetentionTime", "Score") if c in rows.columns]
    return with_group(
        present, ["ExpID", "Compound", "Mass"], by, params.rows_per_task, at_most, SampleN=F.sum("_present")
    ).drop("_present")


def avg_log_abundance(rows: DataFrame) -> DataFrame:
    """Mean log10 of a row's positive cells; rows without any are dropped, cells too."""
    logs = F.transform(F.filter(_cells(rows), lambda c: c > 0), lambda c: F.log10(c))
    mean = F.aggregate(logs, F.lit(0.0), lambda a, x: a + x, lambda a: F.try_divide(a, F.size(logs)))
    return (
        rows.withColumn("log10_avgAbun", mean)
        .where(F.col("log10_avgAbun").isNotNull())
        .drop(*columns_like(rows, "subMed"))
    )


def pi_normalise(rows: DataFrame, datasets: int | None = None) -> DataFrame:
    """Rescale the four indicators to 0..1 over the experiment.

    One aggregate with one row per experiment gives all minima and maxima; a constant indicator
    is NULL. ``datasets`` is a known bound on the experiments, which spares a look at their number.
    """
    bounds = rows.groupBy("ExpID").agg(
        *[f(s).alias(f"_{name}_{p}") for p, s in INDICATOR_SOURCE.items() for name, f in (("lo", F.min), ("hi", F.max))]
    )
    if datasets is None:
        bounds, seen = settle_and_watch(bounds)
        datasets = seen["rows"]
    with_bounds = with_dataset(rows, bounds, ["ExpID"], datasets)
    scaled = {
        p: F.try_divide(F.col(s) - F.col(f"_lo_{p}"), F.col(f"_hi_{p}") - F.col(f"_lo_{p}"))
        for p, s in INDICATOR_SOURCE.items()
    }
    return with_bounds.withColumns(scaled).drop(*[c for c in bounds.columns if c != "ExpID"])


def weighted_score(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """The weighted sum of the indicators, NULL if any is NULL, and the candidate's full name."""
    weights = dict(params.weights)
    terms = [F.col(p) * weights[p] for p in INDICATOR_SOURCE]
    return rows.withColumns(
        {
            SCORE: reduce(lambda a, b: a + b, terms),
            "Chemical": F.concat("Compound", F.lit(": "), "Preferred_Name"),
        }
    )


def best_candidate(rows: DataFrame, params: Params = Params(), at_most: int | None = None) -> DataFrame:
    """The best rows per chemical, ties kept; all rows where a score is missing."""
    best = with_group(
        rows, ["ExpID", "Chemical"], ["IonMode", "Mass", "DTXSID"], params.rows_per_task, at_most,
        _best=max_if_complete(F.col(SCORE)),
    )
    return best.where(F.col("_best").isNull() | (F.col(SCORE) == F.col("_best"))).drop("_best")


def rank_letter(rows: DataFrame, params: Params = Params(), at_most: int | None = None) -> DataFrame:
    """Best, lesser or unscored within the compound, appended to the classification (``NA`` without one)."""
    best = with_group(
        rows, ["ExpID", "Compound"], ["IonMode", "Mass", "DTXSID"], params.rows_per_task, at_most, _best=F.max(SCORE)
    )
    return _lettered(best, F.col("_best")).drop("_best")


def score_columns(rows: DataFrame) -> list[str]:
    out = ["ExpID", "IonMode", "Compound", "Chemical"]
    for text in ("Name", "Mass"):
        out += [c for c in columns_like(rows, text) if c not in out]
    return out + ["DTXSID", *INDICATOR_SOURCE, SCORE, "Category", "Compound_Classification"]


def scored_candidates(joined: DataFrame, lookup: DataFrame, params: Params = Params()) -> DataFrame:
    """Named, measured rows with every candidate and its score.

    Rows are reduced to their two numbers before they meet the candidates. Both sides and the
    joined rows are read again by the group steps after it, hence settled.
    """
    # Where rows are few, all of them, no experiment and no group is large. The table is one that was written.
    n = joined.count()
    rows, seen = settle_and_watch(avg_log_abundance(sample_presence(joined, params, n)), experiments=F.approx_count_distinct("ExpID"))
    classified = settle(chem_classify(lookup, params))
    matched = settle(chem_lookup(rows, classified, params, seen["rows"]))
    # Twice the estimate: the bound only decides how the experiments' bounds are joined.
    scored = weighted_score(pi_normalise(matched, 2 * (seen["experiments"] or 0)), params)
    return scored.select(*score_columns(scored))


def best_with_letter(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """``best_candidate`` and ``rank_letter`` from one grouping of the rows and one join back.

    Rows are combined by compound and chemical, and the few groups then to chemicals and to compounds. The best score of a
    compound is the same before and after lesser candidates go, since the best one stays. ``scored`` is read twice.
    """
    keys = ["ExpID", "Compound", "Chemical"]
    groups, seen = settle_and_watch(
        scored.groupBy(*keys).agg(
            max_if_complete(F.col(SCORE)).alias("_complete"), F.max(SCORE).alias("_any"), F.count(F.lit(1)).alias("_n")
        ),
        most=F.max("_n"),
    )
    chemicals = groups.groupBy("ExpID", "Chemical").agg(max_if_complete(F.col("_complete")).alias("_best"))
    compounds = groups.groupBy("ExpID", "Compound").agg(F.max("_any").alias("_top"))
    bounds = join_on(groups.select(*keys), chemicals, ["ExpID", "Chemical"], null_safe=True)
    bounds = join_on(bounds, compounds, ["ExpID", "Compound"], null_safe=True)
    heavy = heavy_keys(groups, keys, "_n", params.rows_per_task, seen["most"] or 0)
    rows = balanced_join(scored, bounds, keys, heavy, ["IonMode", "Mass", "DTXSID"], null_safe=True)
    best = rows.where(F.col("_best").isNull() | (F.col(SCORE) == F.col("_best")))
    return _lettered(best, F.col("_top")).drop("_best", "_top")


def _lettered(rows: DataFrame, top: Column) -> DataFrame:
    letter = F.when(F.col(SCORE).isNull(), UNSCORED).when(F.col(SCORE) == top, BEST).otherwise(LESSER)
    return rows.withColumn("alpha_beta", letter).withColumn(
        "Class", F.concat(text_or_na(F.col("Compound_Classification")), "alpha_beta")
    )


def priority_scores(joined: DataFrame, lookup: DataFrame, params: Params = Params()) -> DataFrame:
    """The priority table: best candidates with score, class and rank letter."""
    return best_with_letter(settle(scored_candidates(joined, lookup, params)), params)
