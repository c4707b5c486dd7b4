"""From prepared rows to flagged, labelled and filtered features, all datasets in one run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionsift.operators.blanks import blank_subtract_in_parts, replicate_long, sample_flags
from ionsift.operators.partners import partner_flags
from ionsift.operators.quality import final_filter, relabel, score_mass_flags
from ionsift.operators.replicates import replicate_summary, sample_counts
from ionsift.operators.skew import join_on, part_key, repeat, spread
from ionsift.operators.wide import sample_names, wide_measures
from ionsift.params import FEATURE, Params
from ionsift.session import settle

FEATURE_FLAGS = [
    "FalseSampleFeature_Flag", "BelowSpike_Flag", "NegMassDefect_Flag", "MissingScore_Flag",
    "LowScore_Flag", "WeakMatch_Flag", "Duplicate_Flag", "Duplicate_Keep_Flag",
]


def flag_columns(params: Params) -> list[str]:
    return FEATURE_FLAGS + [f"{v}_{name}_adduct" for name in params.adduct_names for v in ("is", "has")]


def all_flags(features: DataFrame, from_samples: DataFrame, params: Params = Params()) -> DataFrame:
    """Every flag of every feature that has sample rows, next to the feature's columns.

    With ``prefilter`` only features that pass the sample flags are searched for partners, under
    their final label, and the others are left out.
    """
    searched = features
    if params.prefilter:
        passing = from_samples.where(~F.col("FalseSampleFeature_Flag") & ~F.col("BelowSpike_Flag"))
        searched = join_on(features, passing.select(*FEATURE), FEATURE, "left_semi")
    rated = score_mass_flags(searched, params)
    flagged = partner_flags(relabel(rated) if params.prefilter else rated, params)
    return join_on(flagged, from_samples, FEATURE, "inner")


@dataclass
class Processed:
    """The result tables of a run; all are lazy except what they are built from."""

    flags: DataFrame
    long: DataFrame
    wide: DataFrame | None

    def raw_flagged(self, params: Params) -> DataFrame:
        return self.wide if params.output_wide else self.long

    def filtered(self, params: Params) -> DataFrame:
        return final_filter(self.raw_flagged(params))

    def filtered_wide(self) -> DataFrame:
        return final_filter(self.wide)


def long_columns(params: Params) -> list[str]:
    return FEATURE + [
        "SampleDetail", "MedAbun", "MeanAbun", "subMeanAbun", "subMedAbun",
        "Mass", "RetentionTime", "Compound", "Score",
    ] + flag_columns(params)


def processed_long(rows: DataFrame, flags: DataFrame, heavy: DataFrame | None, params: Params = Params()) -> DataFrame:
    """Sample rows with their feature and flags; joined on identity only, label decided last."""
    joined = join_on(rows, repeat(flags, heavy, FEATURE), FEATURE + part_key(heavy))
    return relabel(joined).select(*long_columns(params))


def processed_wide(rows: DataFrame, flags: DataFrame, samples: list[str], params: Params = Params()) -> DataFrame:
    """One row per feature: its columns, the measures of each sample, its flags."""
    measures = wide_measures(rows, samples)
    joined = join_on(flags, measures, FEATURE, "inner")
    own = set(FEATURE)
    return relabel(joined).select(
        "FeatureNumber", "ExpID", "IonMode", "Compound", "Mass", "RetentionTime", "Score",
        *[F.col(f"`{c}`") for c in measures.columns if c not in own],
        *flag_columns(params),
    )


def process(
    features: DataFrame, abundance: DataFrame, params: Params = Params(), samples: list[str] | None = None
) -> Processed:
    """The whole run for any number of experiments and modes.

    Replicate statistics and the flags are each read by several branches, so they are written
    once; sample rows are shuffled by feature and every later join finds them in place.
    """
    stats = replicate_summary(abundance, params)
    blanked, heavy = blank_subtract_in_parts(stats, params)
    counts = sample_counts(stats) if params.min_samples_is_fraction else None
    from_samples = sample_flags(blanked, params, counts)
    if params.prefilter:
        from_samples = settle(from_samples)
    flags = settle(all_flags(features, from_samples, params))

    rows = blanked
    if not params.collapse_reps:
        rows = spread(replicate_long(abundance, blanked, params), heavy, FEATURE, [F.col("SampleDetail")])
    wide = None
    if params.output_wide or params.paired:
        samples = samples if samples is not None else sample_names(rows)
        wide = processed_wide(rows, flags, samples, params)
    return Processed(flags, processed_long(rows, flags, heavy, params), wide)
