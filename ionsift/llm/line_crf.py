"""Document quality from lines: a linear-chain conditional random field over neighbouring-line features."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.llm.hashing import mix, slices, word_hashes
from ionsift.session import settle

# Bounds of the fit: labelled rows that it may use (those of least id hash), and lines of them together. Rows
# come in the order of the hash; one that would pass the bound of lines is left out of the fit.
ROWS = 8_000
LINES = 40_000
THRESHOLD = 0.3
CUTS = 12  # cuts of a line feature, at its quantiles in the fitted lines
RIDGE = 0.3
ROUNDS = 60  # of the optimiser, at most

_U = np.uint64
_BYTE = np.arange(256)
_BLANK = (_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D))
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_ASCII_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122))
_LEAD = _BYTE >= 0xC0
_POINT = (_BYTE & 0xC0) != 0x80
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_SYMBOL = np.isin(_BYTE, list(b"#*$%&|<>{}[]\\^~_=+@/"))
_SHOUT = np.isin(_BYTE, list(b"!?"))
_STOP = np.isin(_BYTE, list(b".,;:"))
_END = np.isin(_BYTE, list(b".!?"))
FEATURES = (
    "log_chars", "log_words", "word_length", "letters", "upper", "digits", "symbols", "shouts", "stops", "distinct",
    "same_as_before", "said_before", "starts_upper", "ends_sentence",
)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the lines of several texts, the lines' lengths in characters, and where each text's lines start.

    Lines without a word are left out; a text without any has one line that is all zeros and of length 1.
    """
    n_texts = len(offsets) - 1
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.unique(np.concatenate([breaks, offsets[:-1]]))
    starts = starts[starts < len(data)] if len(data) else np.zeros(0, np.int64)
    edges = np.append(starts, len(data))

    def count(kind: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind[data], out=sums[1:])
        return sums[edges[1:]] - sums[edges[:-1]]

    solid = count(_POINT & ~_BLANK)
    words, bounds = word_hashes(data, edges) if len(starts) else (np.zeros(0, _U), np.zeros(1, np.int64))
    n_words = np.diff(bounds)
    owner = np.searchsorted(offsets, starts, "right") - 1
    line_of = np.repeat(np.arange(len(starts)), n_words)
    # Words that a line has already, words equal to the one before, and three words that the text has already.
    first = _first(words ^ mix(line_of.astype(_U), 3))
    distinct = np.bincount(line_of, first, len(starts))
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (line_of[1:] == line_of[:-1])
    again = np.bincount(line_of, same, len(starts))
    triple = np.zeros(len(words), bool)
    if len(words) > 2:
        text_of = owner[line_of]
        rolled = words[:-2] * _U(0x9E3779B97F4A7C15) + words[1:-1] * _U(0xC2B2AE3D27D4EB4F) + words[2:] * _U(0x165667B19E3779F9)
        whole = text_of[:-2] == text_of[2:]
        triple[:-2] = ~_first(mix(rolled) ^ mix(text_of[:-2].astype(_U), 4)) & whole
    said = np.bincount(line_of, triple, len(starts))
    full = np.flatnonzero(n_words > 0)
    solid, n_words = solid[full], n_words[full].astype(float)
    ascii_letters = count(_ASCII_LETTER)[full]
    blank = _BLANK[data]
    # The first and the last byte of a line that is no blank.
    place = np.flatnonzero(~blank)
    head = data[place[np.searchsorted(place, edges[:-1][full])]] if len(full) else np.zeros(0, np.uint8)
    tail = data[place[np.searchsorted(place, edges[1:][full]) - 1]] if len(full) else np.zeros(0, np.uint8)
    share = lambda kind: count(kind)[full] / np.maximum(solid, 1)
    rows = np.column_stack(
        [
            np.log1p(solid), np.log1p(n_words), solid / n_words, share(_ASCII_LETTER | _LEAD),
            count(_UPPER)[full] / np.maximum(ascii_letters, 1), share(_DIGIT), share(_SYMBOL), share(_SHOUT), share(_STOP),
            distinct[full] / n_words, again[full] / n_words, said[full] / n_words, _UPPER[head] | _LEAD[head], _END[tail],
        ]
    ).astype(np.float32)
    of = owner[full]
    lengths = solid.astype(float)
    bare = np.setdiff1d(np.arange(n_texts), of)
    if len(bare):
        of = np.concatenate([of, bare])
        rows = np.concatenate([rows, np.zeros((len(bare), len(FEATURES)), np.float32)])
        lengths = np.concatenate([lengths, np.ones(len(bare))])
        order = np.argsort(of, kind="stable")
        of, rows, lengths = of[order], rows[order], lengths[order]
    return rows, lengths, np.searchsorted(of, np.arange(n_texts + 1))


def _first(keys: np.ndarray) -> np.ndarray:
    """Whether a key stands here for the first time."""
    out = np.zeros(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = True
    return out


def _scan(m: np.ndarray, longest: int) -> np.ndarray:
    """Running products of 2 x 2 matrices (rows of ``m``), each over at least the ``longest`` last ones; scaled.

    Chains lie one after another. The matrix at the start of a chain has equal rows, so what stands before it drops out.
    """
    step = 1
    while step < longest:
        left, right = m[:-step], m[step:]
        new = np.empty_like(right)
        for i in range(2):
            for j in range(2):
                new[:, 2 * i + j] = left[:, 2 * i] * right[:, j] + left[:, 2 * i + 1] * right[:, 2 + j]
        new /= new.sum(axis=1, keepdims=True)
        m = np.concatenate([m[:step], new])
        step *= 2
    return m


class Chains:
    """Forward and backward sums of chains of lines with two labels, all chains at once."""

    def __init__(self, bounds: np.ndarray):
        keep = np.diff(bounds) > 0
        self.first, self.last = bounds[:-1][keep], bounds[1:][keep] - 1
        self.n = int(bounds[-1]) if len(bounds) else 0
        self.longest = int(np.diff(bounds).max()) if len(bounds) > 1 else 0

    def run(self, emission: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Probability of label 1 of each line, expected number of each pair of neighbouring labels, log of the total."""
        if not self.n:
            return np.zeros(0), np.zeros((2, 2)), 0.0
        high = np.maximum(emission, 0.0)
        weight = np.column_stack([np.exp(-high), np.exp(emission - high)])
        move = np.exp(transition)
        step = (move[None] * weight[:, None, :]).reshape(-1, 4)
        forth = step.copy()
        forth[self.first] = np.tile(weight[self.first], 2)
        alpha = _scan(forth, self.longest)[:, :2]
        alpha = alpha / alpha.sum(axis=1, keepdims=True)
        back = np.ones((self.n, 4))
        back[:-1] = step[1:].reshape(-1, 2, 2).transpose(0, 2, 1).reshape(-1, 4)
        back[self.last] = 1.0
        beta = _scan(back[::-1], self.longest)[::-1, :2]
        beta = beta / beta.sum(axis=1, keepdims=True)
        both = alpha * beta
        p = both[:, 1] / both.sum(axis=1)
        inner = np.ones(self.n, bool)
        inner[self.first] = False
        into = np.flatnonzero(inner)
        pair = alpha[into - 1][:, :, None] * step[into].reshape(-1, 2, 2)
        total = np.log(weight[self.first].sum(axis=1)).sum() + np.log(pair.sum(axis=(1, 2))).sum() + high.sum()
        pair = pair * beta[into][:, None, :]
        return p, (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0), float(total)


@dataclass
class Model:
    """Cuts of the line features, weights of own, previous and next line, transitions, and the scale of the result."""

    cuts: list[np.ndarray]
    own: np.ndarray  # feature x bin
    before: np.ndarray
    after: np.ndarray
    edge: np.ndarray  # no line before, no line after, any line
    transition: np.ndarray
    slope: float = 0.0
    level: float = 0.0

    def binned(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(self.cuts)])

    def emission(self, bins: np.ndarray, chains: Chains) -> np.ndarray:
        f = np.arange(bins.shape[1])
        out = self.own[f, bins].sum(axis=1) + self.edge[2]
        before, after = self.before[f, bins].sum(axis=1), self.after[f, bins].sum(axis=1)
        shifted = np.append(0.0, before[:-1])
        shifted[chains.first] = self.edge[0]
        out += shifted
        shifted = np.append(after[1:], 0.0)
        shifted[chains.last] = self.edge[1]
        return out + shifted

    def marginals(self, bins: np.ndarray, chains: Chains) -> np.ndarray:
        return chains.run(self.emission(bins, chains), self.transition)[0]

    def quality(self, rows: np.ndarray, lengths: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Share of each text that lies in good lines: their probabilities weighted by length."""
        p = self.marginals(self.binned(rows), Chains(bounds))
        sums = lambda x: np.diff(np.append(0.0, np.cumsum(x))[bounds])
        return sums(p * lengths) / sums(lengths)

    def scores(self, rows: np.ndarray, lengths: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.quality(rows, lengths, bounds) + self.level)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _least(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int = ROUNDS, memory: int = 8) -> np.ndarray:
    """The minimum of a smooth convex function by limited-memory quasi-Newton steps."""
    value, slope = f(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, used = -slope, []
        for s, y in reversed(steps):
            a = (s @ q) / (s @ y)
            used.append(a)
            q = q - a * y
        if steps:
            s, y = steps[-1]
            q = q * ((s @ y) / (y @ y))
        else:
            q = q / max(1.0, np.abs(slope).sum())
        for (s, y), a in zip(steps, reversed(used)):
            q = q + s * (a - (y @ q) / (s @ y))
        fall, size = slope @ q, 1.0
        while size > 1e-8:
            new_value, new_slope = f(x + size * q)
            if new_value <= value + 1e-4 * size * fall:
                break
            size /= 2
        else:
            return x
        s, y = size * q, new_slope - slope
        done = value - new_value < 1e-5 * max(1.0, abs(value))
        x, value, slope = x + s, new_value, new_slope
        if s @ y > 1e-10:
            steps = [*steps, (s, y)][-memory:]
        if done:
            break
    return x


def fitted(rows: np.ndarray, lengths: np.ndarray, bounds: np.ndarray, good: np.ndarray) -> Model:
    """A field from lines of labelled texts (``good`` 1 or 0 for each).

    Labels belong to texts, not to lines. So lines first get their text's label and are judged one
    by one, without transitions; lines of bad texts that look like those of good texts then count as good
    (the least likely line of a text stays bad), and the whole field with its transitions is fitted to that.
    Last, the share of good text is put on the scale of the labels by a logistic curve.
    """
    shares = np.arange(1, CUTS + 1) / (CUTS + 1)
    cuts = [np.unique(np.quantile(rows[:, f].astype(float), shares)) for f in range(rows.shape[1])]
    shape = (rows.shape[1], CUTS + 1)
    model = Model(cuts, np.zeros(shape), np.zeros(shape), np.zeros(shape), np.zeros(3), np.zeros((2, 2)))
    bins, chains = model.binned(rows), Chains(bounds)
    text_of = np.repeat(np.arange(len(good)), np.diff(bounds))
    label = good[text_of].astype(float)
    cell = (bins + np.arange(shape[0]) * shape[1]).ravel()
    size = shape[0] * shape[1]
    inner = np.ones(len(rows), bool)
    inner[chains.first] = False
    into = np.flatnonzero(inner)

    def load(x: np.ndarray) -> None:
        model.own, model.before, model.after = (x[k * size : (k + 1) * size].reshape(shape) for k in range(3))
        model.edge = x[3 * size : 3 * size + 3]
        model.transition = np.array([[0.0, x[-2]], [x[-1], 0.0]])

    def summed(d: np.ndarray) -> np.ndarray:
        return np.bincount(cell, np.repeat(d, shape[0]), size)

    def loss(labels: np.ndarray, free: bool) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
        y = labels.astype(int)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[into - 1], y[into]), 1.0)

        def f(x: np.ndarray) -> tuple[float, np.ndarray]:
            load(x)
            emission = model.emission(bins, chains)
            p, expected, total = chains.run(emission, model.transition)
            d = p - labels
            before, after = np.append(d[1:], 0.0), np.append(0.0, d[:-1])
            before[chains.last] = 0.0
            after[chains.first] = 0.0
            moves = (expected - seen) if free else np.zeros((2, 2))
            slope = np.concatenate(
                [summed(d), summed(before), summed(after), [d[chains.first].sum(), d[chains.last].sum(), d.sum()],
                 [moves[0, 1], moves[1, 0]]]
            )
            value = total - (emission * labels).sum() - (seen * model.transition).sum()
            penalty = np.full(len(x), RIDGE)
            penalty[-3] = 1e-3  # the weight of any line
            return value + 0.5 * (penalty * x * x).sum(), slope + penalty * x

        return f

    x = _least(loss(label, False), np.zeros(3 * size + 5), ROUNDS // 2)
    load(x)
    p = model.marginals(bins, chains)
    least = np.minimum.reduceat(p, chains.first)[text_of]
    label = np.where((label == 1) | ((p > 0.5) & (p > least)), 1.0, 0.0)
    load(_least(loss(label, True), x))
    share = model.quality(rows, lengths, bounds)
    model.slope, model.level = _curve(share, good.astype(float))
    return model


def _curve(share: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and level of the logistic curve from share to label."""
    x = np.column_stack([share, np.ones(len(share))])
    ridge = np.array([1e-2, 1e-4])

    def f(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x @ w
        value = np.logaddexp(0, z).sum() - (good * z).sum() + 0.5 * (ridge * w * w).sum()
        return value, x.T @ (_sigmoid(z) - good) + ridge * w

    slope, level = _least(f, np.zeros(2), 200)
    return max(float(slope), 0.0), float(level)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a NULL id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5


def _sample_work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line features of labelled texts; of a text with more lines than the bound only their number."""
    for batch in batches:
        for a, b, data, offsets in slices(batch.column(1)):
            rows, lengths, bounds = line_features(data, offsets)
            n = np.diff(bounds)
            cells = [
                np.column_stack([rows[i:j], lengths[i:j]]).astype(np.float32).tobytes() if j - i <= LINES else None
                for i, j in zip(bounds[:-1], bounds[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(n, pa.int64()), pa.array(cells, pa.binary())],
                names=["doc_id", "good", "n", "lines"],
            )


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model | None, float]:
    """A model from labelled rows that are not held out, and the share of good ones among them.

    At most ``ROWS`` rows with ``LINES`` lines together, those of least id hash, so the choice is the same on every run. Labels, language,
    source and ids are not among the features. Without both labels there is no model.
    """
    known = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("good"))
        .where(remainder(F.col("doc_id")) != 0)
    )
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")).first()
    prior = ((seen["good"] or 0) + 1) / (seen["n"] + 2)
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(ROWS)
    # At most ROWS ids, hence the broadcast.
    texts = docs.join(F.broadcast(some), "doc_id").select("doc_id", "text", "good")
    found = settle(texts.mapInArrow(_sample_work, "doc_id long, good int, n long, lines binary"))
    sizes = found.select("doc_id", "n", F.xxhash64("doc_id").alias("h")).groupBy("doc_id", "h").agg(F.sum("n").alias("n")).collect()
    chosen, lines = [], 0
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if lines + r["n"] <= LINES:
            chosen.append(r["doc_id"])
            lines += r["n"]
    picked = found.sparkSession.createDataFrame([(i,) for i in chosen], "doc_id long")
    rows = found.join(F.broadcast(picked), "doc_id").select("doc_id", "good", "lines").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["lines"])))
    if len({r["good"] for r in rows}) < 2:
        return None, prior
    cells = [np.frombuffer(bytes(r["lines"]), np.float32).reshape(-1, len(FEATURES) + 1) for r in rows]
    table = np.concatenate(cells)
    bounds = np.append(0, np.cumsum([len(c) for c in cells]))
    good = np.array([r["good"] for r in rows])
    return fitted(table[:, :-1], table[:, -1].astype(float), bounds, good), prior


def _score_work(model: Model | None, prior: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                score = model.scores(*line_features(data, offsets)) if model else np.full(b - a, prior)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return work


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from a score of 0.3): one row per input row.

    Whole texts are read once, in a map over the rows; about one MB of text, or one longer text, is held at a time. Every
    line with a word is labelled good or bad given its neighbours, and the probabilities of good, weighted by
    length, make the document's score. A NULL, empty or blank text is one line without a feature;
    repeated rows are scored each; labels that are missing or of one kind only give every text their share;
    an empty table gives no row; other columns are ignored.
    """
    plain = common.texts(docs, id_col, text_col)
    model, prior = fit(plain, labels)
    found = plain.mapInArrow(_score_work(model, prior), "doc_id long, score double, predicted int")
    return found.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def op12_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(*(common.read_table(spark, sf_dir, t) for t in ("documents", "labels")))
