"""Quality rules: fixed base rules, then a decision list learned from labelled statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.llm.common import let
from ionsift.llm.syncmers import words
from ionsift.session import settle

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
_HAS_WORD = r"[^\x20\x09-\x0D]"

# What the learned list may test, from the statistics of a document.
FEATURES = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "word_length": "IF(n_words > 0, word_chars / n_words, 0D)",
    "symbol_share": "IF(word_chars > 0, n_symbols / word_chars, 0D)",
    "dup_line_share": "IF(n_lines > 0, n_dup_lines / n_lines, 0D)",
    "repeat_share": "IF(n_words > 0, n_repeat_words / n_words, 0D)",
}


@dataclass(frozen=True)
class Learning:
    """How a list is learned; none of it hangs on the size of the input."""

    steps: int = 40  # thresholds tried for a statistic: its quantiles in the rows under the rule, and in the bad ones of them
    conditions: int = 3  # of a rule, at most
    rules: int = 8  # of the list, at most
    precision: float = 0.9  # a rule must reach this on rows that it was not grown on
    support: int = 5  # and reject at least so many of them that are labelled bad


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def repeat_words(word: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows that stand twice or more in the text, the first included."""

    def of_windows(h: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            again = F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1))))

            def of_places(p: Column) -> Column:
                gaps = F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))))
                return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

            def of_repeats(r: Column) -> Column:
                # Places of windows by a merge of sorted arrays, so that long texts of repeats stay n log n.
                tagged = F.array_sort(
                    F.concat(
                        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))),
                        F.transform(r, lambda x: F.struct(x.alias("h"), F.lit(-1).alias("i"))),
                    )
                )
                return let(tagged, lambda t: let(_marked(t), of_places))

            return let(again, of_repeats)

        none = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(none, F.lit(0).cast("long")).otherwise(let(F.array_sort(h), of_sorted))

    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(window)])
        )

    return F.when(F.size(word) <= window, F.lit(0).cast("long")).otherwise(let(hashes(word), of_windows))


def _marked(tagged: Column) -> Column:
    """Ascending places whose hash occurs twice or more in the sorted array of (hash, place)."""
    twice = F.filter(
        tagged,
        lambda x, i: (x["i"] >= 0)
        & (
            ((F.get(tagged, i - 1)["i"] >= 0) & (F.get(tagged, i - 1)["h"] == x["h"]))
            | (F.get(tagged, i + 1)["h"] == x["h"])
        ),
    )
    return F.array_sort(F.transform(twice, lambda x: x["i"]))


def statistics(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``n_lines``.

    One row per input row; a NULL text has no word. ``n_lines`` counts lines with a word. With ``carry`` the text
    and the ``rest`` of the row go along.
    """
    text = F.col("text")
    lines = let(
        F.filter(F.split(text, "\n"), lambda x: x.rlike(_HAS_WORD)),
        lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")),
    )
    of_words = let(
        words(text),
        lambda w: F.struct(
            F.size(w).alias("n"), F.char_length(F.array_join(w, "")).alias("chars"), repeat_words(w).alias("repeat")
        ),
    )
    along = ["text", "rest"] if carry else []
    held = common.texts(docs, id_col, text_col, carry).select(
        "doc_id", *along, of_words.alias("w"), lines.alias("l"), F.regexp_count(text, F.lit(SYMBOLS)).alias("symbols")
    )
    return held.select(
        "doc_id",
        F.col("w.n").cast("long").alias("n_words"),
        F.col("w.chars").cast("long").alias("word_chars"),
        F.col("symbols").cast("long").alias("n_symbols"),
        F.col("l.dup").cast("long").alias("n_dup_lines"),
        F.col("w.repeat").cast("long").alias("n_repeat_words"),
        F.col("l.n").cast("long").alias("n_lines"),
        *along,
    )


BASE_FAILED = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"


Barred = frozenset[tuple[str, bool]]


def _cuts(under: DataFrame, model: Learning) -> dict[str, list[float]]:
    """Thresholds to try: quantiles of each statistic, finer towards both ends, of all rows and of the bad ones."""
    even = [(i + 0.5) / model.steps for i in range(model.steps)]
    tails = [x for k in range(2, 12) for x in (2.0**-k / model.steps, 1 - 2.0**-k / model.steps)]
    shares = ", ".join(map(repr, sorted([0.0, *even, *tails, 1.0])))
    pick = "approx_percentile({}, array({}), 10000) AS {}".format
    rows = under.selectExpr(
        *[pick(x, shares, f"a_{f}") for f, x in FEATURES.items()],
        *[pick(f"IF(bad = 1, {x}, NULL)", shares, f"b_{f}") for f, x in FEATURES.items()],
    ).first()
    return {f: sorted({*(rows[f"a_{f}"] or []), *(rows[f"b_{f}"] or [])}) for f in FEATURES}


def _best(under: DataFrame, model: Learning, barred: Barred) -> tuple[Condition | None, int]:
    """The condition whose addition gains most, and the good rows left under it.

    Three jobs: quantiles of the rows under the rule, their histogram over the quantiles of each statistic (at most
    so many rows each, whatever the number of labelled rows), and the values on both sides of the
    chosen cut, which is moved halfway between the last good row and the first bad one.
    """
    cuts = _cuts(under, model)
    pairs = ", ".join(f"'{f}', {_bucket(f, cuts[f])}" for f in FEATURES)
    counts = (
        under.selectExpr("bad", f"stack({len(FEATURES)}, {pairs}) AS (feature, bucket)")
        .groupBy("feature", "bucket")
        .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
        .collect()
    )
    best, gain = None, 0.0
    for f in FEATURES:
        own = {r["bucket"]: (r["bad"], r["good"]) for r in counts if r["feature"] == f}
        all_bad, all_good = (sum(x[i] for x in own.values()) for i in (0, 1))
        if not all_bad:
            continue
        before = math.log2(all_bad / (all_bad + all_good))
        low_bad = low_good = 0
        for k, cut in enumerate(cuts[f]):
            bad, good = own.get(k, (0, 0))
            low_bad, low_good = low_bad + bad, low_good + good
            for above, p, n in ((False, low_bad, low_good), (True, all_bad - low_bad, all_good - low_good)):
                worth = p * (math.log2(p / (p + n)) - before) if p else 0.0
                if worth > gain + 1e-9 and (f, above) not in barred:
                    best, gain = Condition(f, above, cut), worth
    if best is None:
        return None, 0
    best = _halfway(under, best)
    return best, under.where(best.sql()).agg(F.sum(1 - F.col("bad"))).first()[0] or 0


def _halfway(under: DataFrame, condition: Condition) -> Condition:
    """The cut moved to the middle between the nearest good row outside the condition and the bad row next to that one."""
    x, cut = f"({FEATURES[condition.feature]})", f"{condition.threshold!r}D"
    if condition.above:
        good = under.selectExpr(f"max(IF(bad = 0 AND {x} <= {cut}, {x}, NULL))").first()[0]
        next_bad = None if good is None else under.selectExpr(f"min(IF(bad = 1 AND {x} > {good!r}D, {x}, NULL))").first()[0]
    else:
        good = under.selectExpr(f"min(IF(bad = 0 AND {x} > {cut}, {x}, NULL))").first()[0]
        next_bad = None if good is None else under.selectExpr(f"max(IF(bad = 1 AND {x} < {good!r}D, {x}, NULL))").first()[0]
    if good is None or next_bad is None:
        return condition
    middle = good + (next_bad - good) / 2
    # Neighbouring numbers have no middle: the good row stays outside.
    middle = good if condition.above and middle >= next_bad else next_bad if not condition.above and middle >= good else middle
    return Condition(condition.feature, condition.above, middle)


def _bucket(feature: str, cuts: list[float]) -> str:
    """The number of cuts below a statistic."""
    if not cuts:
        return "0"
    values = ", ".join(f"{c!r}D" for c in cuts)
    return f"size(filter(array({values}), c -> ({FEATURES[feature]}) > c))"


def _counts(table: DataFrame, rules: list[Rule]) -> list[tuple[int, int]]:
    """Bad and good rows under each rule."""
    sums = []
    for k, rule in enumerate(rules):
        under = F.expr(" AND ".join(c.sql() for c in rule))
        sums += [F.sum(F.when(under, F.col("bad")).otherwise(0)).alias(f"p{k}")]
        sums += [F.sum(F.when(under, 1 - F.col("bad")).otherwise(0)).alias(f"n{k}")]
    row = table.agg(*sums).first()
    return [(row[f"p{k}"] or 0, row[f"n{k}"] or 0) for k in range(len(rules))]


def learn(labelled: DataFrame, model: Learning = Learning()) -> list[Rule]:
    """A decision list for bad rows (``bad`` 1) from statistics, by sequential covering.

    Two thirds of the rows (by a hash of doc_id) grow a rule: condition by condition, the one with the
    largest information gain, until no good row is left under it. The other third prunes it: of
    its beginnings the one with the best balance of bad and good rows stays, if it reaches
    ``precision`` and ``support``. Rows under the rule are then taken out and the next rule is grown; a rule that
    fails is set aside, and the next one begins with another statistic or side.
    Only histograms and counts of fixed size reach the driver. Without rows or without a bad one the list is empty.
    """
    table = settle(labelled.withColumn("prunes", F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 2))
    rules: list[Rule] = []
    barred: Barred = frozenset()
    while len(rules) < model.rules:
        left = table
        for rule in rules:
            left = left.where("NOT (" + " AND ".join(c.sql() for c in rule) + ")")
        grown, under = (), left.where("NOT prunes")
        while len(grown) < model.conditions:
            condition, good = _best(under, model, barred if not grown else frozenset())
            if condition is None:
                break
            grown += (condition,)
            under = under.where(condition.sql())
            if not good:
                break
        if not grown:
            break
        beginnings = [grown[: k + 1] for k in range(len(grown))]
        scored = _counts(left.where("prunes"), beginnings)
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in scored]
        k = max(range(len(grown)), key=lambda j: (worth[j], -j))
        p, n = scored[k]
        if p < model.support or p < model.precision * (p + n):
            barred |= {(grown[0].feature, grown[0].above)}
            continue
        rules.append(beginnings[k])
        barred = frozenset()
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: false where a rule rejects, in the list's order, else true."""
    says = None
    for rule in rules:
        test = F.expr(" AND ".join(c.sql() for c in rule))
        says = F.when(test, F.lit(False)) if says is None else says.when(test, F.lit(False))
    return F.lit(True) if says is None else says.otherwise(F.lit(True))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    model: Learning = Learning(),
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """Statistics of every row with ``base_failed`` and ``kept``.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad); NULLs say nothing, and a document
    labelled more than once is bad if any label says so. The list is learned from the labelled rows that pass the
    base rules, since only those ask for a verdict. Texts are read once: the statistics are written and learned from
    and judged as a narrow table (with ``carry`` beside the whole rows, so nothing is joined back). Rows with a NULL text have no word and fail; repeated rows are judged each; an
    empty table gives no row; other columns are ignored.
    """
    table = settle(statistics(docs, id_col, text_col, carry))
    known = (
        labels.where("quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad"))
    )
    narrow = table.drop("text", "rest").where(f"NOT {BASE_FAILED}")
    rules = learn(narrow.join(known, "doc_id"), model)
    failed = F.expr(BASE_FAILED)
    return table.select("*", failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (common.read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return judged(docs, labels).drop("n_lines")
