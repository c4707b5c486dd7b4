"""Run parameters and the fixed tables of the domain."""

from __future__ import annotations

from dataclasses import dataclass

# Identity columns of a dataset and of a feature.
DATASET = ["ExpID", "IonMode"]
FEATURE = DATASET + ["FeatureNumber"]
SAMPLE = FEATURE + ["SampleDetail"]

# The columns every prepared input has.
CONTRACT = [
    "FeatureNumber", "ExpID", "IonMode", "ModeDetail", "SampleDetail", "Rep", "volume",
    "Mass", "RetentionTime", "Compound", "Score", "Frequency",
]

# Per-feature columns and the four measures of a processed sample.
FEATURE_COLUMNS = FEATURE + ["Mass", "RetentionTime", "Compound", "Score", "Frequency"]
MEASURES = ["MeanAbun", "MedAbun", "subMeanAbun", "subMedAbun"]

# Labels of the two polarities.
POSITIVE_MODES = ("Positive", "Pos", "Esi+")
NEGATIVE_MODES = ("Negative", "Neg", "Esi-")

# Ion masses searched per polarity, as (polarity, name, mass).
ADDUCTS = (
    ("Positive", "Na", 21.98194),
    ("Positive", "Ammonium", 17.02655),
    ("Negative", "Formate", 44.0409),
)

# Text tokens that mean "no value" in delimited input.
NULL_TOKENS = ("", "NA", "-", "0")

# Indicator columns in chart order with their weights.
INDICATOR_WEIGHTS = (
    ("Pi_Bioactivity", 2.0),
    ("Pi_Abundance", 1.0),
    ("Pi_Exposure", 1.0),
    ("Pi_Frequency", 2.0),
)


@dataclass(frozen=True)
class Params:
    """All thresholds and switches of a run; defaults are the documented ones."""

    blank_names: tuple[str, ...] = ("MB01", "MB02", "MB03")
    output_wide: bool = True
    output_raw: bool = False
    paired: bool = True
    collapse_reps: bool = True
    prefilter: bool = False

    replicate_fraction: float = 0.8
    replicate_cv: float | None = None

    min_samples: float = 1
    min_samples_is_fraction: bool = False
    blank_ratio: float = 3
    min_significant_samples: int = 1

    adduct_ppm: bool = True
    adduct_error: float = 20
    adduct_rt: float = 0.05
    duplicate_ppm: bool = True
    duplicate_error: float = 10
    duplicate_rt: float = 0.05
    cross_mass: float = 0.005
    cross_rt: float = 1.0

    low_score: float = 90
    weak_score: float = 50

    adducts: tuple[tuple[str, str, float], ...] = ADDUCTS
    weights: tuple[tuple[str, float], ...] = INDICATOR_WEIGHTS
    page_size: int = 9
    rows_per_task: int = 100_000

    def __post_init__(self):
        for name in ("adduct_error", "duplicate_error", "cross_mass"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be above 0")
        for name in ("adduct_rt", "duplicate_rt", "cross_rt"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be below 0")

    @property
    def adduct_names(self) -> list[str]:
        return list(dict.fromkeys(name for _, name, _ in self.adducts))
