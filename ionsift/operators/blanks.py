"""Blank subtraction, and the per-feature counts taken from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionsift.functions.nulls import clamp0, is_true
from ionsift.functions.text import rep_digits
from ionsift.operators.skew import balanced_join, heavy_keys, join_on, part_key, repeat, spread, with_dataset
from ionsift.params import DATASET, FEATURE, Params

BLANK = "Blank"


def blank_levels(stats: DataFrame) -> DataFrame:
    """One row per feature: its blank mean and median, and how many samples it was measured in.

    A blank row without values counts as level 0; no blank row at all leaves the level NULL.
    """
    blank = F.col("SampleDetail") == BLANK
    return stats.groupBy(*FEATURE).agg(
        F.max(F.when(blank, F.coalesce("MeanAbun", F.lit(0.0)))).alias("Blank_avgvol"),
        F.max(F.when(blank, F.coalesce("MedAbun", F.lit(0.0)))).alias("Blank_medvol"),
        F.count_if(~is_true(blank)).alias("_samples"),
    )


def _subtract(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "subMeanAbun": clamp0(F.col("MeanAbun") - F.col("Blank_avgvol")),
            "subMedAbun": clamp0(F.col("MedAbun") - F.col("Blank_medvol")),
        }
    )


def blank_subtract_in_parts(stats: DataFrame, params: Params = Params()) -> tuple[DataFrame, DataFrame | None]:
    """``blank_subtract`` still laid out by feature and part, and the table of heavy features.

    With heavy features the result keeps the part number ``_part``, so that a later join per
    feature finds the rows already in place. ``stats`` is read twice: settle it first.
    """
    levels = blank_levels(stats)
    heavy = heavy_keys(levels, FEATURE, "_samples", params.rows_per_task)
    samples = spread(stats.where(F.col("SampleDetail") != BLANK), heavy, FEATURE, [F.col("SampleDetail")])
    joined = join_on(repeat(levels, heavy, FEATURE), samples, FEATURE + part_key(heavy))
    # Levels without a sample row: the blank-only features, and parts that drew no row.
    kept = joined.where(F.col("SampleDetail").isNotNull() | (F.col("_samples") == 0)).drop("_samples")
    return _subtract(kept), heavy


def blank_subtract(stats: DataFrame, params: Params = Params()) -> DataFrame:
    """Every non-blank sample row next to its feature's blank, minus that blank.

    A feature seen in the blank only stays once, without a sample. The join has one row per
    feature on one side; a feature with very many samples is cut into parts.
    """
    return blank_subtract_in_parts(stats, params)[0].drop("_part")


def present_in_samples(
    blanked: DataFrame, params: Params = Params(), sample_counts: DataFrame | None = None
) -> DataFrame:
    """Number of samples each feature is present in, and whether that is too few.

    In fraction mode the count is held against the dataset's number of samples, blank included.
    """
    counts = blanked.groupBy(*FEATURE).agg(F.coalesce(F.sum("SampleFeature"), F.lit(0)).alias("PresentInSamples"))
    return _too_few(counts, params, sample_counts)


def _too_few(counts: DataFrame, params: Params, sample_counts: DataFrame | None) -> DataFrame:
    if not params.min_samples_is_fraction:
        return counts.withColumn("FalseSampleFeature_Flag", F.col("PresentInSamples") < params.min_samples)
    if sample_counts is None:
        raise ValueError("fraction mode needs the number of samples per dataset")
    # One row per dataset, counted first: the count decides how it is joined.
    shared = with_dataset(counts, sample_counts, DATASET, sample_counts.count())
    return shared.withColumn(
        "FalseSampleFeature_Flag", F.col("PresentInSamples") / F.col("n_samples") <= params.min_samples
    ).drop("n_samples")


def spike_flag(blanked: DataFrame, params: Params = Params()) -> DataFrame:
    """Features that exceed their blank by the wanted factor in too few samples."""
    return _not_above(blanked.groupBy(*FEATURE).agg(_above_blank(params)), params)


def _above_blank(params: Params):
    ratio = F.col("MedAbun") / (F.col("Blank_medvol") + 1)
    return F.count_if(ratio >= params.blank_ratio).alias("SumSpikeThreshold")


def _not_above(counts: DataFrame, params: Params) -> DataFrame:
    return counts.withColumn("BelowSpike_Flag", F.col("SumSpikeThreshold") < params.min_significant_samples)


def sample_flags(blanked: DataFrame, params: Params = Params(), sample_counts: DataFrame | None = None) -> DataFrame:
    """Presence and blank-ratio flags of each feature from one aggregation."""
    counts = blanked.groupBy(*FEATURE).agg(
        F.coalesce(F.sum("SampleFeature"), F.lit(0)).alias("PresentInSamples"), _above_blank(params)
    )
    return _not_above(_too_few(counts, params, sample_counts), params).select(
        *FEATURE, "FalseSampleFeature_Flag", "BelowSpike_Flag"
    )


def replicate_long(abundance: DataFrame, blanked: DataFrame, params: Params = Params()) -> DataFrame:
    """Single injections minus the blank, for runs that do not collapse replicates."""
    blanks = blanked.groupBy(*FEATURE).agg(
        F.max("Blank_avgvol").alias("Blank_avgvol"),
        F.max("Blank_medvol").alias("Blank_medvol"),
        F.coalesce(F.sum("Count"), F.lit(0)).alias("_n"),
    )
    rows = abundance.where(F.col("SampleDetail") != BLANK)
    heavy = heavy_keys(blanks, FEATURE, "_n", params.rows_per_task)
    joined = balanced_join(rows, blanks.drop("_n"), FEATURE, heavy, ["SampleDetail", "Rep", "volume"])
    measured = joined.withColumns({"MeanAbun": F.col("volume"), "MedAbun": F.col("volume")})
    digits = rep_digits(F.col("Rep"))
    return _subtract(measured).withColumns(
        {
            "Rep": digits,
            "SampleDetail": F.concat(
                F.replace("SampleDetail", F.lit(" "), F.lit(".")), F.lit("-"), F.coalesce(digits, F.lit("NA"))
            ),
        }
    )
