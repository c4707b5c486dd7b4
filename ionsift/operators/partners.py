"""Ion partners and duplicates among the features of a dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionsift.functions.nulls import is_true
from ionsift.functions.text import rough_name
from ionsift.operators.ranges import MASS_CELL, TIME_CELL, Match, matching_pairs, time_cell, window_hits, with_bounds
from ionsift.operators.skew import balanced_join, heavy_keys, join_on, with_dataset, with_group
from ionsift.params import DATASET, FEATURE, NEGATIVE_MODES, POSITIVE_MODES, Params
from ionsift.session import settle, settle_and_watch

POINT = DATASET + ["Mass", "RetentionTime"]
POLARITIES = {"Positive": POSITIVE_MODES, "Negative": NEGATIVE_MODES}


def polarity(mode: Column) -> Column:
    """One name per polarity; an unknown mode has none."""
    out = F.lit(None).cast("string")
    for name, labels in POLARITIES.items():
        out = F.when(mode.isin(*labels), F.lit(name)).otherwise(out)
    return out


@dataclass
class Places:
    """Distinct places in mass and time, all the searches need.

    Copies of a feature are one row ``table`` from here on, with their number ``n``. ``tops``
    has the largest mass of each dataset.
    """

    table: DataFrame
    rows: int
    most_copies: int
    tops: DataFrame
    datasets: int
    top: float

    def with_half(self, df: DataFrame, ppm: bool, error: float) -> DataFrame:
        """Attach the half width ``half`` of the mass window, which in ppm mode follows the
        largest mass of the dataset."""
        if not ppm:
            return df.withColumn("half", F.lit(error / 1000))
        attached = with_dataset(df, self.tops, DATASET, self.datasets)
        return attached.withColumn("half", F.nullif(F.col("_top") * error * 1e-6, F.lit(0.0))).drop("_top")

    def known(self) -> DataFrame:
        return self.table.where(F.col("Mass").isNotNull() & F.col("RetentionTime").isNotNull())


def _places(features: DataFrame) -> Places:
    table, seen = settle_and_watch(
        features.groupBy(*POINT).agg(F.count(F.lit(1)).alias("n")), copies=F.max("n"), top=F.max("Mass")
    )
    tops = table.groupBy(*DATASET).agg(F.max("Mass").alias("_top"))
    # One small job: the number of datasets decides how their row is attached.
    return Places(table, seen["rows"], seen["copies"] or 0, tops, tops.count(), seen["top"] or 0.0)


def _adduct_array(adducts, params: Params) -> Column:
    """The adducts of a row's polarity as an array, empty for an unknown mode."""
    kind = "array<struct<adduct:int,delta:double>>"
    number = params.adduct_names.index
    out = F.array().cast(kind)
    for name, labels in POLARITIES.items():
        own = [F.struct(F.lit(number(a)).alias("adduct"), F.lit(float(m)).alias("delta")) for p, a, m in adducts if p == name]
        if own:
            out = F.when(F.col("IonMode").isin(*labels), F.array(*own).cast(kind)).otherwise(out)
    return out


def _match(params: Params) -> Match:
    return Match("delta", "half", params.adduct_rt, params.adduct_error if params.adduct_ppm else None)


def _pairs(features: DataFrame, places: Places, adducts, params: Params) -> DataFrame:
    match = _match(params)
    slim = features.select(*FEATURE, "Mass", "RetentionTime")
    table = places.with_half(slim, params.adduct_ppm, params.adduct_error)
    a = table.withColumnRenamed("Mass", "a_mass").withColumnRenamed("RetentionTime", "a_rt")
    a = a.withColumn("_x", F.explode(_adduct_array(adducts, params))).select(
        *FEATURE, "a_mass", "a_rt", "half", "_x.adduct", "_x.delta"
    )
    scale = lambda mass: F.expr(f"{match.axis(mass, around_zero=False)} / {MASS_CELL}D")
    a = with_bounds(a, b=match.partners_above("a_mass"))
    a = a.withColumns({"axis_low": scale("b_low"), "axis_high": scale("b_high")})
    a = a.where("axis_low <= axis_high")
    b = table.select(
        *DATASET,
        F.col("FeatureNumber").alias("adduct_FeatureNumber"),
        F.col("Mass").alias("b_mass"),
        F.col("RetentionTime").alias("b_rt"),
        scale("Mass").alias("axis"),
    )
    pairs = matching_pairs(
        a, b, DATASET, match, ["FeatureNumber", "adduct", "delta", "half"], ["adduct_FeatureNumber"],
        params.rows_per_task, places.rows * max(places.most_copies, 1) * max(len(adducts), 1),
    )
    return pairs.where(F.col("FeatureNumber") != F.col("adduct_FeatureNumber"))


def adduct_pairs(features: DataFrame, params: Params = Params()) -> DataFrame:
    """Every pair of features of a dataset whose masses differ by an adduct of its polarity."""
    names = F.array(*[F.lit(n) for n in params.adduct_names])
    return _pairs(features, _places(features), params.adducts, params).select(
        *FEATURE,
        F.col("a_mass").alias("Mass"),
        F.col("a_rt").alias("RetentionTime"),
        names[F.col("adduct")].alias("adduct"),
        "adduct_FeatureNumber",
        F.col("b_mass").alias("adduct_Mass"),
        F.col("b_rt").alias("adduct_RetentionTime"),
    )


def _adduct_tags(params: Params) -> list[str]:
    """The flag columns; a hit's ``tag`` is a position in this list."""
    return [f"{verb}_{name}_adduct" for name in params.adduct_names for verb in ("is", "has")]


def _adduct_hits(places: Places, params: Params) -> DataFrame:
    """(place, tag) for every place with a partner; a tag names the flag column it sets.

    Where an adduct's mass is within the window's half width (``close``), which depends on the
    dataset's largest mass, windows lie around the feature itself and shrink with its mass; such an adduct has a scale
    of its own on which its windows are again one to two cells long. The sweep does not count the feature itself.
    """
    is_tag, has_tag = (F.col("adduct") * 2).alias("tag"), (F.col("adduct") * 2 + 1).alias("tag")
    match, p = _match(params), params.adduct_error * 1e-6

    def scaled(mass: str) -> Column:
        clear = f"{mass} / half"
        return F.expr(f"(CASE WHEN scale = 0 THEN {clear} ELSE ln(delta + {mass} * {p}D) / {p}D END) / {MASS_CELL}D")

    # Without a relative bound all windows are as long as ``half`` says.
    close = "x.delta <= half" if params.adduct_ppm else "false"
    points = places.with_half(places.known(), params.adduct_ppm, params.adduct_error)
    points = points.withColumn("_all", _adduct_array(params.adducts, params))
    asked = points.withColumn("_x", F.explode("_all")).select(*POINT, "half", "_x.adduct", "_x.delta")
    asked = asked.withColumn("scale", F.expr(f"IF({close.replace('x.', '')}, adduct + 1, 0)"))
    asked = with_bounds(asked, above=match.partners_above("Mass"), below=match.partners_below("Mass"))
    ends = lambda tag, way: F.struct(
        tag, F.col(f"{way}_low").alias("low"), F.col(f"{way}_high").alias("high")
    )
    windows = (
        asked.withColumn("_w", F.explode(F.array(ends(has_tag, "above"), ends(is_tag, "below"))))
        .select(*POINT, "half", "delta", "scale", "_w.tag", "_w.low", "_w.high")
        .withColumns({"axis_low": scaled("low"), "axis_high": scaled("high"), "axis": scaled("Mass")})
    )
    scales = f"concat(array(named_struct('scale', 0, 'delta', 0D)), transform(filter(_all, x -> {close}), x -> named_struct('scale', x.adduct + 1, 'delta', x.delta)))"
    targets = (
        points.withColumn("_s", F.explode(F.expr(scales)))
        .select(*POINT, "n", "half", "_s.scale", "_s.delta")
        .select(*DATASET, "scale", F.col("Mass").alias("mass"), "RetentionTime", "n", scaled("Mass").alias("axis"))
    )
    hits = window_hits(
        windows, targets, [*DATASET, "scale"], params.adduct_rt, ["Mass", "RetentionTime", "tag"],
        rows_per_task=params.rows_per_task, at_most=places.rows, own_axis="axis",
    )
    return hits.drop("scale")


def _duplicate_hits(places: Places, params: Params) -> DataFrame:
    """Places with a duplicate, without listing pairs.

    Cells are narrower than the tolerances: two features in one cell are duplicates of each
    other. Only a feature alone in its cell has to look into the cells around it.
    """
    match = Match("0D", "half", params.duplicate_rt, params.duplicate_error if params.duplicate_ppm else None)
    scale = lambda mass: F.expr(f"{match.axis(mass, around_zero=True)} / {TIME_CELL}D")
    by = DATASET + (["RetentionTime"] if params.duplicate_rt == 0 else [])
    points = places.with_half(places.known(), params.duplicate_ppm, params.duplicate_error)
    placed = points.withColumns(
        {
            "axis": scale("Mass"),
            "own_cell": F.floor(scale("Mass")),
            "own_rcell": time_cell(F.col("RetentionTime"), params.duplicate_rt),
        }
    ).where(F.col("axis").isNotNull())
    cell = by + ["own_cell", "own_rcell"]
    counted = with_group(
        placed, cell, ["Mass", "RetentionTime"], params.rows_per_task, places.rows, members=F.sum("n")
    )
    if places.rows > params.rows_per_task:
        counted = settle(counted)
    alone = counted.where(F.col("members") == 1)
    alone = with_bounds(alone, above=match.partners_above("Mass"), below=match.partners_below("Mass"))
    windows = alone.withColumns(
        {"low": F.least("above_low", "below_low"), "high": F.greatest("above_high", "below_high")}
    ).withColumns({"axis_low": scale("low"), "axis_high": scale("high")})
    targets = placed.select(*DATASET, F.col("Mass").alias("mass"), "RetentionTime", "axis")
    around = window_hits(
        windows,
        targets,
        DATASET,
        params.duplicate_rt,
        ["Mass", "RetentionTime"],
        skip_cell=(F.col("cell") == F.col("own_cell")) & (F.col("rcell") == F.col("own_rcell")),
        rows_per_task=params.rows_per_task,
        at_most=places.rows,
    )
    together = counted.where(F.col("members") > 1).select(*POINT)
    return together.unionByName(around)


def _with_tags(
    features: DataFrame, places: Places, hits: DataFrame, tags: list[str], params: Params
) -> DataFrame:
    """Turn (place, tag) into one boolean column per tag on the features of the place."""
    flags = hits.groupBy(*POINT).agg(*[F.bool_or(F.col("tag") == i).alias(t) for i, t in enumerate(tags)])
    heavy = heavy_keys(places.table, POINT, "n", params.rows_per_task, places.most_copies)
    joined = balanced_join(features, flags, POINT, heavy, ["FeatureNumber"])
    return joined.withColumns({t: is_true(F.col(t)) for t in tags})


def _own_polarity_only(flagged: DataFrame, params: Params) -> DataFrame:
    """Adducts of the other polarity were not searched: their flags are NULL."""
    out = {}
    for name in params.adduct_names:
        labels = [m for p, a, _ in params.adducts if a == name for m in POLARITIES.get(p, ())]
        for verb in ("is", "has"):
            tag = f"{verb}_{name}_adduct"
            out[tag] = F.when(F.col("IonMode").isin(*labels), F.col(tag)) if labels else F.lit(None).cast("boolean")
    return flagged.withColumns(out)


def adduct_flags(features: DataFrame, params: Params = Params()) -> DataFrame:
    """``is_<adduct>_adduct`` and ``has_<adduct>_adduct`` for all adducts in one search."""
    places = _places(features)
    hits = _adduct_hits(places, params)
    return _own_polarity_only(_with_tags(features, places, hits, _adduct_tags(params), params), params)


def duplicate_keep(duplicates: DataFrame) -> DataFrame:
    """The one feature kept per cluster of rough name and time to 0.1.

    Best score first (missing counts as 0), then most observations, then lowest number; a
    cluster whose best has no observation count keeps none. An aggregate, not a ranking window,
    so a cluster of any size is combined before the shuffle.
    """
    best = F.max(
        F.struct(F.coalesce("Score", F.lit(0.0)).alias("s"), F.col("Frequency").alias("f"), (-F.col("FeatureNumber")).alias("i"))
    )
    return (
        duplicates.groupBy(
            *DATASET, rough_name(F.col("Compound")).alias("Roughname"), F.bround("RetentionTime", 1).alias("RT")
        )
        .agg(best.alias("best"))
        .where(F.col("best.f").isNotNull())
        .select(*DATASET, (-F.col("best.i")).alias("FeatureNumber"), "Roughname", "RT")
    )


def _with_keep(flagged: DataFrame) -> DataFrame:
    flagged = settle(flagged)
    kept = duplicate_keep(flagged.where("Duplicate_Flag")).select(*FEATURE, F.lit(True).alias("Duplicate_Keep_Flag"))
    return join_on(flagged, kept, FEATURE).withColumn("Duplicate_Keep_Flag", is_true(F.col("Duplicate_Keep_Flag")))


def duplicate_flags(features: DataFrame, params: Params = Params()) -> DataFrame:
    """``Duplicate_Flag`` and ``Duplicate_Keep_Flag`` of every feature."""
    places = _places(features)
    hits = _duplicate_hits(places, params).withColumn("tag", F.lit(0))
    return _with_keep(_with_tags(features, places, hits, ["Duplicate_Flag"], params))


def partner_flags(features: DataFrame, params: Params = Params()) -> DataFrame:
    """Adduct and duplicate flags together, brought back to the features by one join."""
    places = _places(features)
    tags = _adduct_tags(params) + ["Duplicate_Flag"]
    duplicates = _duplicate_hits(places, params).withColumn("tag", F.lit(len(tags) - 1))
    hits = _adduct_hits(places, params).unionByName(duplicates)
    return _with_keep(_own_polarity_only(_with_tags(features, places, hits, tags, params), params))
