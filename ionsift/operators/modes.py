"""Putting the two polarities of an experiment together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionsift.functions.nulls import is_true, zero_to_null
from ionsift.operators.partners import polarity
from ionsift.operators.ranges import MASS_CELL, Match, matching_pairs, window_hits, with_bounds
from ionsift.operators.skew import balanced_join, heavy_keys, join_on, with_dataset, with_group
from ionsift.operators.wide import columns_like
from ionsift.params import DATASET, FEATURE, POSITIVE_MODES, Params
from ionsift.session import settle_and_watch


def mode_pairs(features: DataFrame) -> DataFrame:
    """The datasets of an experiment that belong together, the positive one first."""
    catalog = features.select(*DATASET).distinct()
    other = catalog.select("ExpID", F.col("IonMode").alias("match_IonMode"))
    return join_on(catalog, other, ["ExpID"], "inner").where(
        F.col("IonMode").isin(*POSITIVE_MODES) & (F.col("IonMode") != F.col("match_IonMode"))
    )


def paired_only(features: DataFrame) -> DataFrame:
    """Features of the experiments that were measured in both polarities."""
    both = (
        features.select("ExpID", polarity(F.col("IonMode")).alias("_p"))
        .distinct()
        .groupBy("ExpID")
        .agg(F.count("_p").alias("_n"))
        .where(F.col("_n") == 2)
    )
    # One row per experiment, counted first: the count decides how it is joined.
    kept = with_dataset(features, both.withColumnRenamed("_n", "_both"), ["ExpID"], both.count())
    return kept.where(F.col("_both").isNotNull()).drop("_both")


def _match(params: Params) -> Match:
    return Match("0D", f"{params.cross_mass}D", params.cross_rt, params.duplicate_error)


def _scale(match: Match):
    return lambda mass: F.expr(f"{match.axis(mass, around_zero=True)} / {MASS_CELL}D")


# Only features with the same name can match, so the name is part of the grid cell.
SAME = ["ExpID", "Compound"]


def _side(df: DataFrame, name: str) -> DataFrame:
    """The features of one polarity that can take part in a match."""
    return df.where(
        (polarity(F.col("IonMode")) == name)
        & F.col("Compound").isNotNull()
        & F.col("Mass").isNotNull()
        & F.col("RetentionTime").isNotNull()
    )


def cross_mode_match(features: DataFrame, params: Params = Params()) -> DataFrame:
    """Every positive feature with the negative ones of the same name, mass and time."""
    match = _match(params)
    scale = _scale(match)
    pos = _side(features, "Positive").withColumnsRenamed({"Mass": "a_mass", "RetentionTime": "a_rt"})
    pos = with_bounds(pos.select(*FEATURE, "Compound", "Score", "a_mass", "a_rt"), b=match.partners_above("a_mass"))
    pos = pos.withColumns({"axis_low": scale("b_low"), "axis_high": scale("b_high")}).where("axis_low <= axis_high")
    neg = _side(features, "Negative").select(
        *SAME,
        F.col("FeatureNumber").alias("match_FeatureNumber"),
        F.col("IonMode").alias("match_IonMode"),
        F.col("Score").alias("match_Score"),
        F.col("Mass").alias("b_mass"),
        F.col("RetentionTime").alias("b_rt"),
        scale("Mass").alias("axis"),
    )
    pairs = matching_pairs(
        pos, neg, SAME, match, ["IonMode", "FeatureNumber", "Score"],
        ["match_FeatureNumber", "match_IonMode", "match_Score"], params.rows_per_task,
    )
    return pairs.select(
        *FEATURE, "Compound", "Score",
        F.col("a_mass").alias("Mass"), F.col("a_rt").alias("RetentionTime"),
        "match_FeatureNumber", "match_IonMode", "match_Score",
        F.col("b_mass").alias("match_Mass"), F.col("b_rt").alias("match_RetentionTime"),
        F.expr("abs(b_mass - a_mass) / a_mass * 1e6D").alias("ppm_error"),
    )


def unique_mode_flags(features: DataFrame, params: Params = Params()) -> DataFrame:
    """``unique_mode``: the feature has no partner in the other polarity.

    Both directions are asked in one sweep; matches are not listed, so a name carried by very
    many features costs no more than a sort of them.
    """
    match = _match(params)
    scale = _scale(match)
    positive = F.col("own") == "Positive"
    keyed = features.withColumn("own", polarity(F.col("IonMode")))
    place = [*SAME, "Mass", "RetentionTime", "own"]
    places, seen = settle_and_watch(
        keyed.where(F.col("own").isNotNull()).groupBy(*place).agg(F.count(F.lit(1)).alias("n")), copies=F.max("n")
    )
    known = places.dropna(subset=["Compound", "Mass", "RetentionTime"])
    asked = with_bounds(known, above=match.partners_above("Mass"), below=match.partners_below("Mass"))
    windows = asked.select(
        *SAME,
        "Mass",
        "RetentionTime",
        "own",
        F.when(positive, F.lit("Negative")).otherwise("Positive").alias("side"),
        F.when(positive, F.col("above_low")).otherwise(F.col("below_low")).alias("low"),
        F.when(positive, F.col("above_high")).otherwise(F.col("below_high")).alias("high"),
    ).withColumns({"axis_low": scale("low"), "axis_high": scale("high")})
    targets = known.select(
        *SAME, F.col("own").alias("side"), F.col("Mass").alias("mass"), "RetentionTime", scale("Mass").alias("axis")
    )
    hits = window_hits(
        windows, targets, SAME + ["side"], params.cross_rt, ["Mass", "RetentionTime", "own"],
        rows_per_task=params.rows_per_task, at_most=seen["rows"],
    )
    heavy = heavy_keys(places, place, "n", params.rows_per_task, seen["copies"] or 0)
    found = hits.select(*place, F.lit(True).alias("_found"))
    marked = balanced_join(keyed, found, place, heavy, ["FeatureNumber"])
    return marked.withColumn("unique_mode", ~is_true(F.col("_found"))).drop("_found", "own")


def cross_mode_union(marked: DataFrame) -> DataFrame:
    """Both polarities stacked: common columns and measures, with the flag seen-in-both.

    Adduct flags of the other polarity are NULL. ``marked`` holds both polarities and the
    ``unique_mode`` flag.
    """
    picked = ["Compound", "IonMode", "Mass", "RetentionTime", "Score"]
    for text in ("MeanAbun", "Med", "StdAbun", "CV", "adduct"):
        picked += [c for c in columns_like(marked, text) if c not in picked]
    return marked.select(
        "ExpID", *[F.col(f"`{c}`") for c in picked], is_true(~F.col("unique_mode")).alias("BothModes_Flag")
    )


def stack_modes(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Two tables with different columns as one, missing columns NULL."""
    return positive.unionByName(negative, allowMissingColumns=True)


def hit_counts():
    """Rows seen in one mode only, plus those seen in both counted once, by the positive one."""
    return F.count_if(~F.col("BothModes_Flag") | F.col("IonMode").isin(*POSITIVE_MODES))


def compound_hits(joined: DataFrame) -> DataFrame:
    """Hits per compound of an experiment; a compound only counted elsewhere is left out."""
    return (
        joined.groupBy("ExpID", "Compound").agg(hit_counts().alias("N_CompoundHits")).where(F.col("N_CompoundHits") > 0)
    )


def join_modes(processed: DataFrame, params: Params = Params()) -> DataFrame:
    """The joined table of all experiments that were measured in both polarities."""
    marked = unique_mode_flags(paired_only(processed), params)
    joined, seen = settle_and_watch(cross_mode_union(marked))
    counted = with_group(
        joined,
        ["ExpID", "Compound"],
        ["IonMode", "Mass", "RetentionTime", "Score"],
        params.rows_per_task,
        seen["rows"],
        N_CompoundHits=hit_counts(),
    )
    return zero_to_null(counted)
