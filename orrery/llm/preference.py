"""Document quality from preference pairs (Bradley-Terry).

A document's strength is a weighted sum of its features; of two documents the
stronger is preferred with probability sigma(difference of strengths). A pair
of one document labelled 1 and one labelled 0 is a preference; the weights
minimise the logistic loss on the feature differences of pairs, with a small
ridge, by Newton steps. The threshold is a quantile of the strengths: as many
of the labelled documents lie above it as are labelled 1. A score is the
probability that the document is preferred to one at the threshold.

Features say how a text is written, not what or in which language: shares of
adjacent character classes, word lengths, repeated words and lines.

The fit takes every labelled row. Ranked by the hash of their ids, the rows of
each label are dealt out to groups of at most SIDE of either label; a group
pairs each of its rows ROUNDS times and the pairs' differences are written
once. A Newton step is one scan of them that sums gradient and curvature in
its tasks. The quantile (it weighs each label by its count of all rows) is
found by counting ranges of strengths.

Defined results: a null or empty text has the features 0 and a score like any
other; a null label or one that is neither 0 nor 1 teaches nothing; an id
labelled twice teaches each label; without rows of both labels every score is
0.5; equal texts have equal scores; an empty table gives no rows; other
columns of any name pass through within ``row``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery import config
from orrery.llm.common import chunks, code_points, ship, written
from orrery.llm.hashing import Powers, stretch_hashes, words
from orrery.operators.joins import bounded_broadcast
from orrery.operators.numbering import global_row_number

#: Rows of one label that a group of pairs holds at most.
SIDE = 20_000
#: Strengths looked at one by one; of more, ranges are counted.
FEW = 50_000
RANGES = 4096
ROUNDS = 4
RIDGE = 1e-2
STEPS = 12
SEED = 42

#: Character classes: lower, upper and other letters, digits, blanks, line
#: ends, sentence punctuation, other punctuation, symbols, the rest.
CLASSES = 10
_POWERS = Powers()
_TABLE: list[np.ndarray] = []


def _class(c: int) -> int:
    if c in (10, 13):
        return 5
    if c in (9, 11, 12, 32):
        return 4
    if chr(c) in ".,;:!?":
        return 6
    if chr(c) in "#*$%&|<>":
        return 8
    kind = unicodedata.category(chr(c))
    return {"Ll": 0, "Lu": 1, "Nd": 3}.get(kind, {"L": 2, "M": 2, "P": 7, "S": 8}.get(kind[0], 9))


def classes() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.fromiter(map(_class, range(0x110000)), np.uint8, 0x110000))
    return _TABLE[0]


def _repeats(points: np.ndarray, begin: np.ndarray, end: np.ndarray, own: np.ndarray,
             n: int) -> list[np.ndarray]:
    """Per text, of its stretches: the share that is not the first of its
    kind, the share of the commonest, and of those equal to the one before."""
    total = np.maximum(np.bincount(own, minlength=n), 1)
    h = stretch_hashes(points, begin, end, _POWERS)
    order = np.lexsort((h, own))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (own[order][1:] != own[order][:-1])
    size = np.diff(np.append(np.flatnonzero(new), len(h)))
    most = np.zeros(n)
    np.maximum.at(most, own[order][new], size)
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
    return [1 - np.bincount(own[order][new], minlength=n) / total,
            most / total, np.bincount(own[again], minlength=n) / total]


def features(texts: list[str]) -> np.ndarray:
    """A row of features for each text."""
    n = len(texts)
    points, starts = code_points(texts)
    kind = classes()[points]
    length = np.diff(starts) - 1
    own = np.repeat(np.arange(n), np.diff(starts))
    # Class pairs; the zero after each text counts as the end of its last line.
    kind = np.where(np.isin(np.arange(len(points)), starts[1:] - 1), np.uint8(5), kind)
    pair = own[1:] * CLASSES ** 2 + kind[:-1].astype(np.int64) * CLASSES + kind[1:]
    same = own[1:] == own[:-1]
    pairs = np.bincount(pair[same], minlength=n * CLASSES ** 2).reshape(n, -1)
    shares = np.sqrt(pairs / np.maximum(length, 1)[:, None])
    begin, end = words(points)
    text = own[begin]
    count = np.bincount(text, minlength=n)
    size = (end - begin).astype(float)
    mean = np.bincount(text, size, n) / np.maximum(count, 1)
    spread = np.sqrt(np.maximum(np.bincount(text, size ** 2, n) / np.maximum(count, 1)
                                - mean ** 2, 0))
    edge = np.flatnonzero(kind == 5)
    first = np.concatenate([[0], edge[:-1] + 1]) if len(edge) else edge
    full = edge > first
    line = _repeats(points, first[full], edge[full], own[first[full]], n)
    lines = np.bincount(own[first[full]], minlength=n)
    return np.column_stack([
        shares, np.log1p(count), mean, spread, np.log1p(lines),
        np.log1p(count / np.maximum(lines, 1)), *_repeats(points, begin, end, text, n),
        line[0], line[1]])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch["text"].to_pylist()]
        for a, b in chunks(texts):
            x = features(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch["quality"].slice(a, b - a), batch["place"].slice(a, b - a),
                 pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32),
                                          x.ravel())],
                names=["quality", "place", "x"])


def _sigma(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


class Ranking:
    """Weights of the features and the threshold."""

    def __init__(self, weights: np.ndarray | None, threshold: float) -> None:
        self.weights, self.threshold = weights, threshold

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return _sigma(x @ self.weights - self.threshold)


def _pairs(good: np.ndarray, bad: np.ndarray, seed: int) -> np.ndarray:
    """Differences of pairs: every row stands in ROUNDS of them or more."""
    rng = np.random.default_rng(seed)
    n = max(len(good), len(bad))
    i = np.concatenate([np.resize(rng.permutation(len(good)), n) for _ in range(ROUNDS)])
    j = np.concatenate([np.resize(rng.permutation(len(bad)), n) for _ in range(ROUNDS)])
    return good[i] - bad[j]


def _sums(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What pairs add to the gradient and the curvature."""
    p = _sigma(-(d @ w))  # of the pair going the other way
    return d.T @ p, (d * (p * (1 - p))[:, None]).T @ d


def _newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], n: int,
            width: int) -> np.ndarray:
    """Weights of ``n`` pairs from their sums at given weights."""
    ridge = RIDGE * n
    w = np.zeros(width)
    for _ in range(STEPS):
        gradient, curve = sums(w)
        step = np.linalg.solve(curve + ridge * np.eye(width), gradient - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _quantile(entries: Iterable[tuple[float, int, float]], target: float, start: float = 0.0,
              before: float | None = None, after: float | None = None) -> float:
    """The middle of the first strength whose summed weight reaches ``target``
    and the next one (of the last two, if there is none). ``entries`` are
    (strength, rows, weight of each) in order; ``start`` is the weight below
    them, ``before`` and ``after`` are the strengths next to them."""
    entries = list(entries)
    for at, (s, rows, weight) in enumerate(entries):
        if start + rows * weight >= target or at + 1 == len(entries):
            inside = min(max(int(np.ceil((target - start) / weight)), 1), rows)
            if inside < rows:
                return s
            if at + 1 < len(entries):
                return (s + entries[at + 1][0]) / 2
            if after is not None:
                return (s + after) / 2
            last = s if rows > 1 else entries[at - 1][0] if at else before
            return (s + (s if last is None else last)) / 2
        start += rows * weight
    raise ValueError("no strengths")


def fit(good: np.ndarray, bad: np.ndarray, share: float) -> Ranking:
    """From features of rows labelled 1 and 0, and the share of label 1."""
    if not len(good) or not len(bad):
        return Ranking(None, 0.0)
    scale = np.maximum(np.concatenate([good, bad]).std(axis=0), 1e-9)
    d = _pairs(good, bad, SEED) / scale
    w = _newton(lambda w: _sums(d, w), len(d), d.shape[1]) / scale
    entries = [(s, 1, share / len(good)) for s in (good @ w).tolist()] + \
        [(s, 1, (1 - share) / len(bad)) for s in (bad @ w).tolist()]
    return Ranking(w, _quantile(sorted(entries, key=lambda e: e[0]), 1 - share - 1e-12))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _dealt(rows: DataFrame, n: dict[int, int], side: int) -> DataFrame:
    """``rows`` with their group: as many groups as the commoner label needs,
    each with rows of both labels. Of a label with fewer rows than groups each
    row goes to several."""
    groups = -(-max(n.values()) // side)
    ranked = global_row_number(rows, ["quality", "place", "x"], "at")
    own = F.col("at") - 1 - F.when(F.col("quality") == 1, n[0]).otherwise(0)
    some = F.when(F.col("quality") == 1, min(groups, n[1])).otherwise(min(groups, n[0]))
    return ranked.select("quality", "x", "at", F.explode(F.sequence(
        own % some, F.lit(groups - 1).cast("bigint"), some.cast("bigint"))).alias("g"),
        own.alias("own")).filter((some < groups) | (F.col("g") == F.col("own") % groups)) \
        .select("g", "quality", "x", "at")


def _pair_rows(group: pa.Table) -> pa.Table:
    group = group.sort_by("at")
    x = _matrix(group["x"].combine_chunks())
    label = group["quality"].to_numpy()
    d = _pairs(x[label == 1], x[label == 0], SEED + group["g"][0].as_py())
    return pa.table({"d": pa.ListArray.from_arrays(
        np.arange(0, d.size + 1, d.shape[1], dtype=np.int32), d.ravel())})


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, mean, squares around it) of the features of a task's rows."""
    n, mean, squares = 0, 0.0, 0.0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch["x"])
            n, mean, squares = _joined((n, mean, squares), (
                len(x), x.mean(axis=0), ((x - x.mean(axis=0)) ** 2).sum(axis=0)))
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tolist()]),
                                          pa.array([squares.tolist()])],
                                         names=["n", "mean", "squares"])


def _joined(a: tuple, b: tuple) -> tuple:
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + gap ** 2 * (a[0] * b[0] / n)


def _threshold(strengths: DataFrame, weight: dict[int, float], target: float) -> float:
    """``_quantile`` of (quality, s), counting ranges until few rows are left."""
    row = strengths.agg(F.min("s").alias("low"), F.max("s").alias("high"),
                        F.count(F.lit(1)).alias("rows")).first()
    low, high, rows, start, before, after = row.low, row.high, row.rows, 0.0, None, None
    inside = strengths
    while rows > FEW and low < high:
        share = (F.col("s") - F.lit(low)) / F.lit(high - low)
        counted = inside.groupBy(F.least(F.floor(share * RANGES), F.lit(RANGES - 1)).alias("b")) \
            .agg(F.count_if(F.col("quality") == 0).alias("n0"),
                 F.count_if(F.col("quality") == 1).alias("n1"),
                 F.min("s").alias("low"), F.max("s").alias("high")).orderBy("b").collect()
        for at, r in enumerate(counted):
            more = r.n0 * weight[0] + r.n1 * weight[1]
            if start + more >= target or at + 1 == len(counted):
                break
            start += more
        before = counted[at - 1].high if at else before
        after = counted[at + 1].low if at + 1 < len(counted) else after
        low, high, rows = r.low, r.high, r.n0 + r.n1
        inside = strengths.filter(F.col("s").between(low, high))
    entries = inside.groupBy("s", "quality").count().orderBy("s", F.desc("quality")).collect()
    return _quantile([(r.s, r["count"], weight[r.quality]) for r in entries], target, start,
                     before, after)


def learn(docs: DataFrame, labels: DataFrame, side: int = SIDE) -> Ranking:
    """A ranking from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    ship(docs.sparkSession)
    known = labels.filter("doc_id is not null and quality in (0, 1)") \
        .select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality"))
    labelled = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    known = bounded_broadcast(known, sum(labelled.values()), config.BROADCAST_MAX_KEY_ROWS)
    rows = written(
        docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id"))
        .select("quality", F.xxhash64("doc_id").alias("place"), "text")
        .mapInArrow(_rows, "quality int, place bigint, x array<double>"), "preference")
    n = {r.quality: r["count"] for r in rows.groupBy("quality").count().collect()}
    if len(n) < 2:
        return Ranking(None, 0.0)
    spread = [(r.n, np.array(r["mean"]), np.array(r.squares)) for r in rows.mapInArrow(
        _spread, "n bigint, mean array<double>, squares array<double>").collect()]
    total, _, squares = reduce(_joined, spread)
    scale = np.maximum(np.sqrt(squares / total), 1e-9)
    pairs = written(_dealt(rows, n, side).groupBy("g").applyInArrow(
        _pair_rows, "d array<double>"), "preference-pairs")

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gradient, curve = np.zeros(len(w)), np.zeros((len(w), len(w)))
            for batch in batches:
                if batch.num_rows:
                    more = _sums(_matrix(batch["d"]) / scale, w)
                    gradient, curve = gradient + more[0], curve + more[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([gradient.tolist()]), pa.array([curve.ravel().tolist()])],
                names=["gradient", "curve"])

        parts = pairs.mapInArrow(task, "gradient array<double>, curve array<double>").toArrow()
        return (_matrix(parts["gradient"].combine_chunks()).sum(axis=0),
                _matrix(parts["curve"].combine_chunks()).sum(axis=0).reshape(len(w), len(w)))

    w = _newton(sums, pairs.count(), len(scale)) / scale

    def strength(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch["quality"], pa.array(_matrix(batch["x"]) @ w)], names=["quality", "s"])

    share = labelled[1] / (labelled[0] + labelled[1])
    return Ranking(w, _threshold(
        written(rows.select("quality", "x").mapInArrow(strength, "quality int, s double"),
                "preference-strengths"),
        {0: (1 - share) / n[0], 1: share / n[1]}, 1 - share - 1e-12))


def rank(docs: DataFrame, model: Ranking) -> DataFrame:
    """(row, score, predicted) of ``docs`` (row, text)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            score = [np.zeros(0)] + [shared.value.score(features(texts[a:b]))
                                     for a, b in chunks(texts)]
            score = np.concatenate(score)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["row", "score", "predicted"])

    row = docs.schema["row"].dataType.simpleString()
    return docs.select("row", "text").mapInArrow(run, f"row {row}, score double, predicted int")
