
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ionsift import fixtures as fx  # noqa: E402
from ionsift import oracle, round_trips  # noqa: E402
from ionsift.functions.nulls import null_tokens, zero_to_null  # noqa: E402
from ionsift.functions.text import rough_name  # noqa: E402
from ionsift.operators import chart, lookup, modes, partners, quality, scoring, wide  # noqa: E402
from ionsift.operators.blanks import (  # noqa: E402
    blank_subtract, present_in_samples, replicate_long, spike_flag,
)
from ionsift.operators.compounds import unique_compounds  # noqa: E402
from ionsift.operators.ingest import feature_number, prepare, score_extract  # noqa: E402
from ionsift.operators.replicates import replicate_stats, replicate_summary, sample_counts  # noqa: E402
from ionsift.params import FEATURE, Params  # noqa: E402
from ionsift.plans.process import Processed, process, flag_columns  # noqa: E402
from ionsift.session import settle  # noqa: E402

PARAMS = Params()
SAMPLES = oracle.SAMPLES
SMOKE = "/root/testdata/sf0.001"


def _abundance(spark: SparkSession, d: str) -> DataFrame:
    return fx.fixture(spark, d, fx.ABUNDANCE)


def _features(spark: SparkSession, d: str) -> DataFrame:
    return fx.fixture(spark, d, fx.FEATURES)


def _summary(spark: SparkSession, d: str) -> DataFrame:
    return settle(replicate_summary(_abundance(spark, d), PARAMS))


def _blanked(spark: SparkSession, d: str) -> DataFrame:
    return blank_subtract(_summary(spark, d), PARAMS)


def _processed(spark: SparkSession, d: str, params: Params = PARAMS, samples: list[str] = SAMPLES) -> Processed:
    return process(_features(spark, d), _abundance(spark, d), params, samples)


def _both_modes(spark: SparkSession, d: str, measures: bool = True) -> DataFrame:
    """Every feature in both polarities, with the measures of its feature number."""
    both = fx.fixture(spark, d, fx.POSITIVE).unionByName(fx.fixture(spark, d, fx.NEGATIVE))
    if not measures:
        return both
    cells = wide.wide_measures(_blanked(spark, d), SAMPLES).drop("ExpID", "IonMode")
    return settle(both.join(cells, "FeatureNumber"))


def _marked(spark: SparkSession, d: str) -> DataFrame:
    return modes.unique_mode_flags(_both_modes(spark, d), PARAMS)


def _joined(spark: SparkSession, d: str) -> DataFrame:
    return settle(modes.join_modes(_both_modes(spark, d), PARAMS))


def _lookup(spark: SparkSession, d: str) -> DataFrame:
    return fx.fixture(spark, d, fx.LOOKUP)


def _measured(spark: SparkSession, d: str) -> DataFrame:
    return settle(scoring.avg_log_abundance(scoring.sample_presence(_joined(spark, d), PARAMS)))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    classified = settle(lookup.chem_classify(_lookup(spark, d), PARAMS))
    return lookup.chem_lookup(_measured(spark, d), classified, PARAMS)


def _scaled(spark: SparkSession, d: str) -> DataFrame:
    return scoring.pi_normalise(settle(_candidates(spark, d)))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return settle(scoring.weighted_score(_scaled(spark, d), PARAMS))


def _best(spark: SparkSession, d: str) -> DataFrame:
    return settle(scoring.best_candidate(_scored(spark, d), PARAMS))


def _priority(spark: SparkSession, d: str) -> DataFrame:
    return scoring.priority_scores(_joined(spark, d), _lookup(spark, d), PARAMS)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Floating-point sums to six digits, for the comparison."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _split_metadata(spark: SparkSession, d: str) -> DataFrame:
    named = wide.unite(_abundance(spark, d), "filename", wide.PARTS)
    return wide.split_measure_name(named, "filename").select(*wide.PARTS, "volume")


def _annotated(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(oracle.ANNOTATION_INPUT, features=_features(spark, d))


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return fx.fixture(spark, d, oracle.NULL_TOKEN_INPUT.replace("FROM lineitem", "FROM {lineitem}"))


def _cv(spark: SparkSession, d: str) -> DataFrame:
    rows = replicate_summary(_abundance(spark, d), Params(replicate_cv=0.5))
    return rows.select(*FEATURE, "SampleDetail", "CVThresholdFlag", "SampleFeature")


def _fraction(spark: SparkSession, d: str) -> DataFrame:
    stats = _summary(spark, d)
    params = Params(min_samples=0.6, min_samples_is_fraction=True)
    return present_in_samples(blank_subtract(stats, params), params, sample_counts(stats))


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    rows = _features(spark, d).select("ExpID", "Mass", "RetentionTime", "Compound", "Frequency", "Score")
    return feature_number(rows, ["ExpID"]).drop("Frequency", "Score")


def _all_flags(spark: SparkSession, d: str) -> DataFrame:
    columns = ["Mass", "RetentionTime", "Compound", "Score", "Frequency"]
    return _processed(spark, d).flags.select(*FEATURE, *columns, *flag_columns(PARAMS))


def _adducts(spark: SparkSession, d: str, mode: str) -> DataFrame:
    names = [name for m, name, _ in PARAMS.adducts if m == mode]
    flagged = partners.adduct_flags(_features(spark, d), PARAMS).where(F.col("IonMode") == mode)
    return flagged.select(*FEATURE, *[f"{verb}_{n}_adduct" for n in names for verb in ("is", "has")])


def _heights(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(
        chart.pi_melt(_priority(spark, d).where("ToxPiScore IS NOT NULL"), PARAMS), "height"
    ).select("ExpID", "IonMode", "Chemical", "Mass", "DTXSID", "sub_Pi", "height", "weight", "w", "wm", "wt")


def _geometry(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(chart.pi_geometry(settle(_priority(spark, d)), PARAMS), "height", "ToxPi").select(
        "ExpID", "IonMode", "Chemical", "Mass", "DTXSID", "sub_Pi", "height", "weight", "w", "wm", "wt", "ToxPi"
    )


def _chart_table(spark: SparkSession, d: str) -> DataFrame:
    rows = chart.score_chart_table(settle(_priority(spark, d)), PARAMS)
    return _rounded(rows, "height", "ToxPi").select(
        "ExpID", "IonMode", "Chemical", "Mass", "DTXSID", "sub_Pi", "height", "weight", "w", "wm", "wt", "ToxPi", "page"
    )


EARLY = Params(prefilter=True)
INJECTIONS = Params(collapse_reps=False)
PLACE = ["ExpID", "IonMode", "Compound", "Mass", "RetentionTime"]
CANDIDATE = [
    "Preferred_Name", "DTXSID", "Category", "Compound_Classification", "ExposureCategory", "Tox21_Activities",
]
SCORED = ["ExpID", "IonMode", "Compound", "Chemical", "Mass", "DTXSID", "ToxPiScore"]
PI = list(scoring.INDICATOR_SOURCE)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feature_table": lambda s, d: quality.feature_table(_features(s, d)),
    "replicate_stats": lambda s, d: replicate_stats(_abundance(s, d)),
    "sample_feature": lambda s, d: replicate_summary(_abundance(s, d), PARAMS),
    "cv_flag": _cv,
    "blank_subtract": _blanked,
    "present_in_samples": lambda s, d: present_in_samples(_blanked(s, d), PARAMS),
    "present_fraction": _fraction,
    "spike_flag": lambda s, d: spike_flag(_blanked(s, d), PARAMS),
    "replicate_long": lambda s, d: replicate_long(_abundance(s, d), _blanked(s, d), PARAMS),
    "melt_measures": lambda s, d: wide.melt_measures(fx.fixture(s, d, fx.WIDE), PARAMS.blank_names, list(fx.WIDE_COLUMNS)),
    "split_metadata": _split_metadata,
    "null_tokens": lambda s, d: null_tokens(_tokens(s, d)),
    "score_extract": lambda s, d: score_extract(_annotated(s, d)),
    "feature_number": _numbered,
    "halogen_flag": lambda s, d: quality.halogen_flag(_features(s, d)),
    "score_mass_flags": lambda s, d: quality.score_mass_flags(_features(s, d), PARAMS),
    "compound_label": lambda s, d: quality.relabel(quality.score_mass_flags(_features(s, d), PARAMS)).select(
        *FEATURE, "Compound"
    ),
    "rough_name": lambda s, d: _features(s, d).select(*FEATURE, "Compound", rough_name(F.col("Compound")).alias("Roughname")),
    "duplicate_keep": lambda s, d: partners.duplicate_keep(_features(s, d)),
    "duplicate_flags": lambda s, d: partners.duplicate_flags(_features(s, d), PARAMS).select(
        *FEATURE, "Duplicate_Flag", "Duplicate_Keep_Flag"
    ),
    "adduct_pairs": lambda s, d: partners.adduct_pairs(_features(s, d), PARAMS),
    "adduct_flags_positive": lambda s, d: _adducts(s, d, "Positive"),
    "adduct_flags_negative": lambda s, d: _adducts(s, d, "Negative"),
    "all_flags": _all_flags,
    "processed_long": lambda s, d: _processed(s, d).long,
    "wide_pivot": lambda s, d: wide.wide_measures(_blanked(s, d), SAMPLES),
    "filtered_features": lambda s, d: _processed(s, d).filtered(PARAMS),
    "filtered_long": lambda s, d: _processed(s, d).filtered(Params(output_wide=False)),
    "prefiltered_features": lambda s, d: _processed(s, d, EARLY).filtered(EARLY),
    "replicate_wide": lambda s, d: _processed(s, d, INJECTIONS, oracle.REP_SAMPLES).wide,
    "prepare": lambda s, d: prepare(fx.fixture(s, d, fx.EXPORT), PARAMS).long(),
    "score_chart_table": _chart_table,
    "unique_compounds": lambda s, d: unique_compounds(_features(s, d)),
    "mode_pairs": lambda s, d: modes.mode_pairs(_both_modes(s, d, measures=False)),
    "cross_mode_match": lambda s, d: modes.cross_mode_match(_both_modes(s, d, measures=False), PARAMS),
    "unique_mode_flags": lambda s, d: _marked(s, d).select(*FEATURE, "unique_mode"),
    "cross_mode_union": lambda s, d: modes.cross_mode_union(_marked(s, d)),
    "compound_hits": lambda s, d: modes.compound_hits(modes.cross_mode_union(_marked(s, d))),
    "zero_to_null": lambda s, d: zero_to_null(_blanked(s, d)).select(
        *FEATURE, "SampleDetail", "NAbun", "MedAbun", "SampleFeature", "subMeanAbun", "subMedAbun",
        "ReplicateThresholdFlag",
    ),
    "joined_modes": lambda s, d: modes.join_modes(_both_modes(s, d), PARAMS),
    "source_ratio": lambda s, d: lookup.source_ratio(_lookup(s, d), PARAMS).select(
        "INPUT", "DTXSID", "DATA_SOURCES", "DataSourceRatio"
    ),
    "chem_classify": lambda s, d: lookup.chem_classify(_lookup(s, d), PARAMS).select(
        "INPUT", "Preferred_Name", "DTXSID", "DataSourceRatio", "Category", "Category_Number",
        "Compound_Classification", "ExposureCategory", "Tox21_Activities",
    ),
    "sample_presence": lambda s, d: scoring.sample_presence(_joined(s, d), PARAMS).select(*PLACE, "SampleN"),
    "avg_log_abundance": lambda s, d: _rounded(_measured(s, d), "log10_avgAbun").select(*PLACE, "log10_avgAbun"),
    "chem_lookup": lambda s, d: _rounded(_candidates(s, d), "log10_avgAbun").select(
        *PLACE, "SampleN", "log10_avgAbun", *CANDIDATE
    ),
    "pi_normalise": lambda s, d: _rounded(_scaled(s, d), *PI).select(
        "ExpID", "IonMode", "Compound", "Mass", "DTXSID", *PI
    ),
    "weighted_score": lambda s, d: _rounded(_scored(s, d), "ToxPiScore").select(*SCORED),
    "best_candidate": lambda s, d: _rounded(_best(s, d), "ToxPiScore").select(*SCORED),
    "rank_letter": lambda s, d: scoring.rank_letter(_best(s, d), PARAMS).select(
        "ExpID", "IonMode", "Compound", "Mass", "DTXSID", "alpha_beta", "Class"
    ),
    "priority_scores": lambda s, d: _rounded(_priority(s, d), *PI, "ToxPiScore"),
    "pi_melt": _heights,
    "pi_geometry": _geometry,
    "chart_pages": lambda s, d: _rounded(chart.chart_pages(settle(_priority(s, d)), PARAMS), "ToxPiScore"),
}


# The text operators are an extra that may be taken away with their folder and the pipeline file.
try:
    from ionsift.llm import registry as text_operators
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("ionsift.llm"):
        raise
    text_operators = None
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not (missing.name or "").startswith("ionsift.llm"):
        raise
    corpus_pipeline = None


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the filtered feature table of the whole processing run."""
    return QUERIES["filtered_features"](spark, SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = QUERIES | round_trips.QUERIES
    if text_operators:
        found.update(text_operators.QUERIES)
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle.oracle() | round_trips.SQL
    if text_operators:
        found.update(text_operators.SQL)
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
