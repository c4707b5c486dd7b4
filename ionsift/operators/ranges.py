"""Search for partners in a mass and time window, without a native range join.

Two questions are answered, both exactly:

* ``matching_pairs`` lists partners: windows and points meet in grid cells by an equi-join and
  the exact test decides.
* ``window_hits`` only asks *whether* a window holds a point, which is all the flags need. It
  lists no pairs: in each cell the points are swept in mass order with a running best time, so a
  crowded cell costs a sort of its rows, not their product.

Both use the same grid. Mass cells are narrower than any window, so a window has at most one of
its two mass bounds inside a given cell. Time cells are narrower than the tolerance, so in a
window's own time cell every point is close enough, and in another cell only the nearest one
(the running maximum or minimum) needs the exact test.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ionsift.operators.skew import balanced_join, heavy_keys, join_on
from ionsift.session import settle

MASS_CELL = 0.9
TIME_CELL = 0.999
GRID = 1024  # quantiles at which a crowded lane can be cut
# Half steps of the last binary digit tried on each side of a computed bound.
NEARBY = 6


@dataclass(frozen=True)
class Interval:
    """Guessed ends of an interval, and the tests that hold from the low, up to the high end.

    All four are SQL text; the tests speak of a mass ``x``.
    """

    low: str
    high: str
    low_test: str
    high_test: str


@dataclass(frozen=True)
class Match:
    """When does feature b lie ``delta`` above feature a?

    ``delta`` and ``half``, the half width of the mass window, are SQL text (a column or a
    number), since they can differ per row. With ``ppm`` set, the deviation relative to a's mass
    must not exceed it; the deviation is signed, so it bounds pairs from above only (from both
    sides when ``delta`` is 0).
    """

    delta: str
    half: str
    rt_tolerance: float
    ppm: float | None = None

    def _near(self, a: str, b: str) -> str:
        """Relative deviation is small enough."""
        if self.ppm is None:
            return "true"
        return f"try_divide(abs({b} - {a}) - {self.delta}, {a}) * 1e6D <= {self.ppm}D"

    def _least(self) -> str:
        return f"({self.delta} - {self.half})"

    def _most(self) -> str:
        return f"({self.delta} + {self.half})"

    def pair_test(self, a_mass: str, a_rt: str, b_mass: str, b_rt: str) -> Column:
        gap = f"({b_mass} - {a_mass})"
        return F.expr(
            f"{gap} >= {self._least()} AND {gap} <= {self._most()} AND {self._near(a_mass, b_mass)} "
            f"AND abs({a_rt} - {b_rt}) <= {float(self.rt_tolerance)}D"
        )

    # The mass test, for one side fixed, holds on an interval of the other side. These give a
    # close guess of its two ends and the test on each side of the fixed mass.

    def partners_above(self, a: str) -> Interval:
        """The b masses that match a."""
        low, high = f"{a} + {self._least()}", f"{a} + {self._most()}"
        if self.ppm is not None:
            far = f"({self.delta} + {a} * {self.ppm * 1e-6}D)"
            low, high = f"greatest({low}, {a} - {far})", f"least({high}, {a} + {far})"
        return Interval(
            low,
            high,
            f"x - {a} >= {self._least()} AND (x >= {a} OR {self._near(a, 'x')})",
            f"x - {a} <= {self._most()} AND (x <= {a} OR {self._near(a, 'x')})",
        )

    def partners_below(self, b: str) -> Interval:
        """The a masses that match b."""
        low, high = f"{b} - {self._most()}", f"{b} - {self._least()}"
        if self.ppm is not None:
            low = f"greatest({low}, ({b} - {self.delta}) / (1 + {self.ppm * 1e-6}D))"
            high = f"least({high}, ({b} + {self.delta}) / (1 - {self.ppm * 1e-6}D))"
        return Interval(
            low,
            high,
            f"{b} - x <= {self._most()} AND (x >= {b} OR {self._near('x', b)})",
            f"{b} - x >= {self._least()} AND (x <= {b} OR {self._near('x', b)})",
        )

    def axis(self, mass: str, around_zero: bool) -> str:
        """A rising scale of mass on which every window is about 1 to 2 long.

        For ``delta`` 0 a relative window grows with the mass, hence logarithmic up to the mass
        where ``half`` takes over; otherwise windows are between one and two ``half`` long.
        """
        if not around_zero or self.ppm is None:
            return f"({mass} / {self.half})"
        turn = f"({self.half} / {self.ppm * 1e-6}D)"
        return (
            f"(CASE WHEN {mass} < {turn} THEN ln({mass} / {turn}) / log1p({self.ppm * 1e-6}D) "
            f"ELSE ({mass} - {turn}) / {self.half} END)"
        )


def _add(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns that are computed once: a later step sees values, not their long formulas."""
    row = ", ".join(f"'{name}', {sql}" for name, sql in columns.items())
    return df.select(*df.columns, F.expr(f"inline(array(named_struct({row})))"))


def with_bounds(df: DataFrame, **intervals: Interval) -> DataFrame:
    """Add ``<name>_low`` and ``<name>_high``, the exact ends of each interval.

    A guess is off by a few last digits at most: of the masses around it, the first (for a high
    end the last) that passes the test is taken, so that comparing masses with the bound and
    applying the test itself always agree.
    """
    start, found = {}, {}
    for name, i in intervals.items():
        for end, guess, test, pick in (
            ("low", i.low, i.low_test, "array_min"),
            ("high", i.high, i.high_test, "array_max"),
        ):
            g = f"_{name}_{end}"
            start[g] = guess
            start[f"{g}_step"] = f"pow(2D, floor(log2(abs({guess}))) - 53)"
            tried = f"transform(sequence(-{NEARBY}, {NEARBY}), i -> {g} + i * {g}_step)"
            found[f"{name}_{end}"] = f"{pick}(filter({tried}, x -> {test}))"
    return _add(_add(df, start), found).drop(*start)


def time_cell(rt: Column, tolerance: float) -> Column:
    """Time cells; with tolerance 0 there is one, and time itself joins the keys."""
    return F.floor(rt / (TIME_CELL * tolerance)) if tolerance > 0 else F.lit(0).cast("long")


def _time_cells(rt: Column, tolerance: float) -> Column:
    if tolerance == 0:
        return F.array(F.lit(0).cast("long"))
    return F.sequence(time_cell(rt - tolerance * 1.001, tolerance), time_cell(rt + tolerance * 1.001, tolerance))


def matching_pairs(
    windows: DataFrame,
    points: DataFrame,
    by: list[str],
    match: Match,
    carry_left: list[str],
    carry_right: list[str],
    rows_per_task: int = 100_000,
    at_most: int | None = None,
) -> DataFrame:
    """All (window feature, point) pairs that match, as an equi-join on grid cells.

    ``windows``: ``by``, ``a_mass``, ``a_rt``, ``axis_low``/``axis_high`` and ``carry_left``, which
    holds what ``match`` refers to; ``points``: ``by``, ``b_mass``, ``b_rt``, ``axis`` and
    ``carry_right``. Every point lies in one cell, so a pair is found once, and the result is as
    large as the number of true pairs. A cell many windows look at is cut into parts. Neither side
    is broadcast: both have a row per feature or more, however small the file they were computed from.
    """
    left = (
        windows.where(F.col("axis_low").isNotNull() & F.col("axis_high").isNotNull() & F.col("a_rt").isNotNull())
        .withColumn("cell", F.explode(F.sequence(F.floor("axis_low"), F.floor("axis_high"))))
        .withColumn("rcell", F.explode(_time_cells(F.col("a_rt"), match.rt_tolerance)))
        .select(*by, "cell", "rcell", *carry_left, "a_mass", "a_rt")
    )
    right = points.select(
        *by,
        F.floor("axis").alias("cell"),
        time_cell(F.col("b_rt"), match.rt_tolerance).alias("rcell"),
        *carry_right,
        "b_mass",
        "b_rt",
    )
    place = by + ["cell", "rcell"]
    heavy = heavy_keys(
        left.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")), place, "_n", rows_per_task, at_most
    )
    met = balanced_join(left, right, place, heavy, carry_left, "inner", both_large=True)
    return met.where(match.pair_test("a_mass", "a_rt", "b_mass", "b_rt")).drop("cell", "rcell")


def window_hits(
    windows: DataFrame,
    points: DataFrame,
    by: list[str],
    rt_tolerance: float,
    identity: list[str],
    skip_cell: Column | None = None,
    rows_per_task: int = 100_000,
    at_most: int | None = None,
    own_axis: str | None = None,
) -> DataFrame:
    """``by`` and ``identity`` of every window that holds at least one point.

    ``windows``: ``by``, ``identity`` (with ``RetentionTime``, the window's centre in time),
    ``low``/``high``, and ``axis_low``/``axis_high`` (the bounds in cell units); ``points``:
    ``by``, ``mass``, ``RetentionTime``, ``axis``. ``skip_cell`` leaves out cells of a window by
    the columns ``cell`` and ``rcell``. ``at_most`` is a known bound on the number of points.

    With ``own_axis``, the axis of the window's own point, that point does not count: ``points`` then has the
    number ``n`` of features at each, ``identity`` has ``Mass``, and a window needs a feature besides its own.
    """
    centre = F.col("RetentionTime")
    key = by
    if rt_tolerance == 0:
        key = by + ["_rt_key"]
        windows, points = windows.withColumn("_rt_key", centre), points.withColumn("_rt_key", centre)
    place = key + ["cell", "rcell"]
    many = at_most is None or at_most > rows_per_task

    # Equal masses in a cell matter only by their number and their earliest and latest time:
    # combined before the shuffle, so copies of a point cost one row.
    number = F.col("n") if own_axis else F.lit(1).cast("long")
    occupied = (
        points.where(F.col("axis").isNotNull() & centre.isNotNull())
        .select(*key, F.floor("axis").alias("cell"), time_cell(centre, rt_tolerance).alias("rcell"), "mass", number.alias("n"), centre)
        .groupBy(*place, "mass")
        .agg(F.max(centre).alias("latest"), F.min(centre).alias("earliest"), F.sum("n").alias("n"))
    )
    if many:
        occupied = settle(occupied)

    # A window looks at a cell upwards to its upper bound, or downwards to its lower bound; the
    # latter is the same sweep over negated masses.
    looking = (
        windows.where((F.col("low") <= F.col("high")) & centre.isNotNull())
        .withColumns({"_from": F.floor("axis_low"), "_to": F.floor("axis_high")})
        .withColumn("cell", F.explode(F.sequence("_from", "_to")))
        .withColumn("rcell", F.explode(_time_cells(centre, rt_tolerance)))
    )
    if skip_cell is not None:
        looking = looking.where(~skip_cell)
    if many:  # windows that look into an empty cell go no further
        looking = join_on(looking, occupied.select(*place), place, "left_semi")
    down = F.col("cell") == F.col("_from")
    inf = F.lit(float("inf"))
    whole = ~down & (F.col("cell") < F.col("_to"))
    side = F.signum(F.col("rcell") - time_cell(centre, rt_tolerance)).cast("byte")
    own = F.lit(0).cast("long")
    if own_axis:
        inside = (F.col("low") <= F.col("Mass")) & (F.col("Mass") <= F.col("high"))
        own = F.when((side == 0) & (F.floor(own_axis) == F.col("cell")) & inside, F.lit(1).cast("long")).otherwise(own)
    looking = looking.select(
        *place,
        F.when(down, F.lit(-1)).otherwise(1).cast("byte").alias("way"),
        F.when(down, -F.col("low")).when(whole, inf).otherwise(F.col("high")).alias("pos"),
        F.struct(*identity, side.alias("side"), own.alias("_self")).alias("w"),
        F.lit(None).cast("double").alias("latest"),
        F.lit(None).cast("double").alias("earliest"),
        F.lit(None).cast("long").alias("n"),
    )
    ways = F.array(F.lit(-1).cast("byte"), F.lit(1).cast("byte"))
    swept = occupied.withColumn("way", F.explode(ways)).select(
        *place,
        "way",
        (F.col("mass") * F.col("way")).alias("pos"),
        F.lit(None).cast(looking.schema["w"].dataType).alias("w"),
        "latest",
        "earliest",
        "n",
    )
    answers = _swept(looking.unionByName(swept), place + ["way"], many, rows_per_task)

    own_time = F.col("w.RetentionTime")
    found = (
        F.when(F.col("w.side") < 0, F.abs(own_time - F.col("best_latest")) <= rt_tolerance)
        .when(F.col("w.side") > 0, F.abs(own_time - F.col("best_earliest")) <= rt_tolerance)
        .otherwise(F.col("best_n") > F.col("w._self"))
    )
    return answers.where(found).select(*by, *[F.col(f"w.{c}").alias(c) for c in identity]).distinct()


_BEST = {"best_latest": F.max, "best_earliest": F.min, "best_n": F.sum}
_OF = {"best_latest": "latest", "best_earliest": "earliest", "best_n": "n"}


def _both(name: str, one: str, other: str) -> Column:
    """Two partial answers as one; a missing one says nothing."""
    if name == "best_n":
        return F.coalesce(F.col(one), F.lit(0)) + F.coalesce(F.col(other), F.lit(0))
    return F.greatest(one, other) if name == "best_latest" else F.least(one, other)


def _sliced(rows: DataFrame, lane: list[str], rows_per_task: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows with the ``slice`` of their lane, and the crowded lanes (None if there is none).

    A lane with more rows than a task's share, points and windows together, is cut at quantiles of
    its positions into as many slices as its count asks for; equal positions stay together.
    """
    crowded = heavy_keys(rows.groupBy(*lane).agg(F.count(F.lit(1)).alias("_n")), lane, "_n", rows_per_task)
    if crowded is None:
        return rows.withColumn("slice", F.lit(0)), None
    finite = F.when(F.col("pos") < float("inf"), F.col("pos"))
    steps = ", ".join(f"{i / GRID!r}D" for i in range(1, GRID))
    quantiles = F.expr(f"percentile_approx(_pos, array({steps}), {10 * GRID})").alias("_grid")
    cut = join_on(rows, F.broadcast(crowded), lane, "inner", null_safe=True).withColumn("_pos", finite)
    n = f"least(_parts, {GRID})"
    picked = f"transform(sequence(1, {n} - 1), i -> _grid[CAST(i * {GRID} / {n} AS INT) - 1])"
    # One row per crowded lane, at most MAX_HEAVY as ``heavy_keys`` has it.
    bounds = cut.groupBy(*lane, "_parts").agg(quantiles).selectExpr(*lane, f"coalesce(array_distinct({picked}), array()) AS _cuts")
    placed = join_on(rows, F.broadcast(settle(bounds)), lane, "left", null_safe=True)
    before = F.expr("size(filter(_cuts, c -> c < pos))")
    return placed.withColumn("slice", F.coalesce(F.when(F.col("_cuts").isNotNull(), before), F.lit(0))).drop("_cuts"), crowded


def _swept(rows: DataFrame, lane: list[str], many: bool, rows_per_task: int) -> DataFrame:
    """Every window (``w``) with the best times and the number of points at or before its ``pos`` in its lane.

    What lies in earlier slices of a crowded lane is added from a table with one row per slice;
    windows over a whole crowded cell (``pos`` infinite) take the lane's total and stay out of the sweep.
    """
    crowded, parts = None, []
    if many:
        rows, crowded = _sliced(settle(rows), lane, rows_per_task)
        parts = ["slice"]
    asks = F.col("w").isNotNull()
    sweep = Window.partitionBy(*lane, *parts).orderBy("pos").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = {name: _BEST[name](_OF[name]).over(sweep) for name in _BEST}
    wanted = [*lane, "w", *_BEST]
    if crowded is None:
        return rows.withColumns(running).where(asks).select(*wanted)
    rows = join_on(rows, F.broadcast(crowded), lane, "left", null_safe=True)
    over_all = asks & F.col("_parts").isNotNull() & (F.col("pos") == float("inf"))
    per_slice = rows.where(F.col("_parts").isNotNull()).groupBy(*lane, "slice").agg(
        *[_BEST[name](_OF[name]).alias(name) for name in _BEST]
    )
    earlier = Window.partitionBy(*lane).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*lane)
    # One row per slice of a crowded lane, at most about 2 * MAX_HEAVY in all.
    known = settle(
        per_slice.select(
            *lane,
            "slice",
            *[_BEST[name](name).over(earlier).alias(f"_before_{name}") for name in _BEST],
            *[_BEST[name](name).over(everything).alias(f"_all_{name}") for name in _BEST],
        )
    )
    before = known.select(*lane, "slice", *[f"_before_{name}" for name in _BEST])
    swept = rows.where(~over_all).withColumns(running).where(asks)
    swept = join_on(swept, F.broadcast(before), [*lane, "slice"], "left", null_safe=True)
    swept = swept.withColumns({name: _both(name, name, f"_before_{name}") for name in _BEST})
    totals = known.select(*lane, *[F.col(f"_all_{name}").alias(name) for name in _BEST]).distinct()
    whole = join_on(rows.where(over_all), F.broadcast(totals), lane, "inner", null_safe=True)
    return swept.select(*wanted).unionByName(whole.select(*wanted))
