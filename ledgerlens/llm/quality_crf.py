"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad.  A line's evidence is a vector of its own
figures (shares of symbols, bars, capitals, repeated words, ...) and of the
lines before and after it; transition weights tie neighbours together.  The
forward-backward marginals of "good", weighted by line length, give a
document's share of good text, and a logistic curve fitted on the same sample
turns that share into the score.

Forward and backward messages are prefix products of 2x2 matrices.  A
document's first matrix has equal rows, so a product that reaches it forgets
what lies before; all documents of a block are then one scan of
log2(longest document's lines) vectorised rounds, also for a text of a million
lines.

Fitting reads a bounded sample (``SAMPLE`` labelled documents of each class,
those with the least id hashes, and ``SAMPLE_LINES`` lines in all) in one task;
scoring is map only and covers every line of every text.  Documents whose
crc32(doc_id) mod 5 is 0 are held out and never fitted on.  Labels are of
documents: the lines of good documents count as good, and those of bad ones as
bad unless a first model without transitions finds them good.

Defined cases: a null or empty text is one line of length 0, whose marginal is
the share; a document with only such lines weighs them equally.  A null id is
the empty id text (held out).  Rows of one id are scored each on its own text; of
rows sharing a labelled id one is fitted on, with the least label.  Without
labels of both classes all weights are 0 and every score is 0.5.  Further
columns of the input play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import text_of
from ledgerlens.llm.tasks import map_task

#: Labelled documents of each class that are fitted on at most, and their lines.
SAMPLE, SAMPLE_LINES = 4000, 200_000
#: A document is predicted good from this score on (fixed by the query).
THRESHOLD = 0.3
#: One of so many documents is held out (fixed by the query).
FOLDS = 5
STEPS, RATE, RIDGE = 80, 0.3, 1e-4

SCORES = "doc_id long, held_out boolean, score double, predicted int, good_share double, n_lines long"

#: Bytes of text whose lines are held at a time (one whole text at least).
BLOCK_BYTES = 2 << 20

# Byte classes.
_SYMBOL, _BAR, _UPPER, _LOWER, _BANG, _DIGIT, _STOP, _OTHER, _WIDE, _SPACE = range(10)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[ord(c) for c in "#*$%&<>"]] = _SYMBOL
_CLASS[ord("|")] = _BAR
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[[ord("!"), ord("?")]] = _BANG
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[ord(c) for c in ".,;:"]] = _STOP
_CLASS[128:] = _WIDE

#: Own figures of a line that its neighbours see too.
_SHARED = 8
_FEATURES = 1 + 13 + 2 * _SHARED + 2


@dataclass(frozen=True)
class Model:
    """Weights for "bad": of a line's figures, of its first line, of the four steps; and the curve."""

    weights: tuple[float, ...]
    start: float
    steps: tuple[float, float, float, float]
    slope: float
    offset: float


BLANK = Model((0.0,) * _FEATURES, 0.0, (0.0,) * 4, 0.0, 0.0)


@dataclass
class Lines:
    """The lines of a block of documents: figures, lengths, and each document's first line."""

    figures: np.ndarray
    length: np.ndarray
    first: np.ndarray
    count: np.ndarray


# ------------------------------------------------------------------ figures


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BLOCK_BYTES``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
        yield start, stop
        start = stop


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def _repeats(data: np.ndarray, space: np.ndarray, cuts: np.ndarray, starts: np.ndarray):
    """Words of each line, and those equal to the word before them in it."""
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts] = True
    edge[1:-1] |= space[:-1]
    word = np.flatnonzero(edge[:-1] & ~space)
    line = np.searchsorted(starts, word, "right") - 1
    if not len(word):
        return line, np.zeros(0, bool)
    stop = np.sort(np.concatenate([np.flatnonzero(space), cuts[1:]]))
    end = stop[np.searchsorted(stop, word, "right")]
    power = np.cumprod(np.full(len(data) + 1, 0x9E3779B97F4A7C15, np.uint64))
    inverse = np.cumprod(np.full(len(data) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])])
    hashed = (sums[end] - sums[word]) * inverse[word]
    same = np.zeros(len(word), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (line[1:] == line[:-1])
    return line, same


def lines_of(texts: pa.Array) -> Lines:
    data, ends = _bytes_of(texts)
    breaks = np.flatnonzero(data == 10)
    count = 1 + np.diff(np.searchsorted(breaks, ends))
    first = np.cumsum(count) - count
    n = int(count.sum())
    last = np.zeros(n, bool)
    last[first + count - 1] = True
    head = np.zeros(n, bool)
    head[first] = True
    stop, start = np.empty(n, np.int64), np.empty(n, np.int64)
    stop[last], stop[~last] = ends[1:], breaks
    start[head], start[~head] = ends[:-1], breaks + 1

    kinds = _CLASS[data]
    counts = np.empty((10, n))
    for k in range(10):
        sums = np.concatenate([[0], np.cumsum(kinds == k)])
        counts[k] = sums[stop] - sums[start]
    # Code points: bytes that don't continue a character.
    sums = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    length = (sums[stop] - sums[start]).astype(float)

    line, same = _repeats(data, kinds == _SPACE, ends, start)
    words = np.bincount(line, minlength=n).astype(float)
    repeats = np.bincount(line[same], minlength=n).astype(float)
    solid = np.maximum(1, counts[:_SPACE].sum(0))
    per_word = np.maximum(1, words)
    letters = np.maximum(1, counts[_UPPER] + counts[_LOWER])
    closed = np.zeros(n, bool)
    some = stop > start
    closed[some] = np.isin(data[stop[some] - 1], [ord(c) for c in ".!?"])
    own = np.stack(
        [
            counts[_SYMBOL] / solid,
            counts[_BAR] / per_word,
            counts[_UPPER] / letters,
            counts[_BANG] / per_word,
            repeats / per_word,
            counts[_DIGIT] / solid,
            counts[_OTHER] / solid,
            np.minimum(words, 40) / 40,
            counts[_STOP] / per_word,
            counts[_WIDE] / solid,
            solid / per_word / 20,
            closed,
            words == 0,
        ],
        1,
    )
    own = np.minimum(own, 1)
    before, after = np.zeros((n, _SHARED)), np.zeros((n, _SHARED))
    before[1:], after[:-1] = own[:-1, :_SHARED], own[1:, :_SHARED]
    before[head], after[last] = 0, 0
    figures = np.concatenate([np.ones((n, 1)), own, before, after, head[:, None], last[:, None]], 1)
    return Lines(figures, length, first, count)


# ------------------------------------------------------------------ forward-backward


def _scaled(m: np.ndarray) -> np.ndarray:
    return m / m.max((1, 2), keepdims=True)


def _products(m: np.ndarray, longest: int) -> np.ndarray:
    """Products of each matrix with all before it, as far as ``longest`` of them."""
    m, reach = _scaled(m), 1
    while reach < longest:
        joined = m.copy()
        joined[reach:] = np.einsum("nij,njk->nik", m[:-reach], m[reach:])
        m, reach = _scaled(joined), 2 * reach
    return m


def marginals(model: Model, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """P(bad) of every line; P(state, next state) of every line and its follower (last ones: unused)."""
    n = len(lines.figures)
    evidence = np.clip(lines.figures @ np.array(model.weights), -30, 30)
    step = np.exp(np.array(model.steps).reshape(2, 2))
    into = np.stack([np.ones(n), np.exp(evidence)], 1)
    m = step[None] * into[:, None, :]
    m[lines.first] = (np.array([1.0, np.exp(model.start)]) * into[lines.first])[:, None, :]
    longest = int(lines.count.max())
    forward = _products(m, longest).sum(1)
    # Backward: the same scan over the reversed, transposed followers.
    follower = np.empty_like(m)
    follower[:-1] = m[1:]
    follower[lines.first + lines.count - 1] = 1.0
    backward = _products(follower[::-1].transpose(0, 2, 1), longest)[::-1].sum(1)
    both = forward * backward
    bad = both[:, 1] / both.sum(1)
    pairs = np.zeros((n, 2, 2))
    pairs[:-1] = forward[:-1, :, None] * m[1:] * backward[1:, None, :]
    pairs[:-1] /= pairs[:-1].sum((1, 2), keepdims=True)
    return bad, pairs


def good_share(lines: Lines, bad: np.ndarray) -> np.ndarray:
    """Length-weighted mean marginal of "good" of each document."""
    weight = np.add.reduceat(lines.length, lines.first)
    empty = np.repeat(weight == 0, lines.count)
    length = np.where(empty, 1.0, lines.length)
    good = np.add.reduceat(length * (1 - bad), lines.first)
    return np.clip(good / np.add.reduceat(length, lines.first), 0, 1)


def _curve(share: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * share + offset, -500, 500)))


# ------------------------------------------------------------------ fitting


def _climb(gradient, size: int) -> np.ndarray:
    """Adam ascent from 0; ``gradient`` of the mean log-likelihood."""
    at, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, STEPS + 1):
        g = gradient(at) - RIDGE * at
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        at = at + RATE * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return at


def train(lines: Lines, bad_docs: np.ndarray) -> Model:
    """The field's weights and the score's curve from documents of known class."""
    x, n = lines.figures, len(lines.figures)
    of_bad = np.repeat(bad_docs, lines.count).astype(float)
    # Both classes weigh alike, however rare one is.
    weight = np.where(of_bad == 1, 0.5 / max(1, of_bad.sum()), 0.5 / max(1, n - of_bad.sum()))

    alone = _climb(lambda w: x.T @ (weight * (of_bad - 1 / (1 + np.exp(-np.clip(x @ w, -30, 30))))), _FEATURES)
    label = of_bad * (x @ alone > 0)
    # A bad document has its worst line bad at least.
    worst = np.maximum.reduceat(x @ alone, lines.first)
    label = np.maximum(label, of_bad * (x @ alone >= np.repeat(worst, lines.count)))

    inner = np.ones(n, bool)
    inner[lines.first + lines.count - 1] = False
    follows = np.flatnonzero(inner)
    y = label.astype(int)
    seen = np.zeros((n, 2, 2))
    seen[follows, y[follows], y[follows + 1]] = 1

    def field(v: np.ndarray) -> Model:
        return Model(tuple(v[:_FEATURES]), float(v[_FEATURES]), tuple(v[_FEATURES + 1 :]), 0.0, 0.0)

    def gradient(v: np.ndarray) -> np.ndarray:
        bad, pairs = marginals(field(v), lines)
        off = weight * (label - bad)
        steps = np.einsum("n,nij->ij", weight[follows], seen[follows] - pairs[follows])
        return np.concatenate([x.T @ off, [off[lines.first].sum()], steps.ravel()])

    model = field(_climb(gradient, _FEATURES + 5))
    share = good_share(lines, marginals(model, lines)[0])
    good = 1.0 - bad_docs
    each = np.where(good == 1, 0.5 / max(1, good.sum()), 0.5 / max(1, len(good) - good.sum()))
    curve = np.stack([share - 0.5, np.ones(len(share))], 1)
    a, b = _climb(lambda v: curve.T @ (each * (good - _curve(curve @ v, 1.0, 0.0))), 2)
    return Model(model.weights, model.start, model.steps, float(a), float(b - 0.5 * a))


def train_batches(batches) -> Iterator[pa.RecordBatch]:
    """One row with the model from the sample's rows (``text``, ``quality``)."""
    parts, labels, total = [], [], 0
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            if total < SAMPLE_LINES:
                part = lines_of(batch.column("text").slice(a, b - a))
                parts.append(part)
                labels.append(1 - batch.column("quality").slice(a, b - a).to_numpy(zero_copy_only=False))
                total += len(part.length)
    if not parts:
        return
    bad = np.concatenate(labels).astype(float)
    if bad.min() == bad.max():
        return
    shift = np.cumsum([0, *(len(p.length) for p in parts[:-1])])
    lines = Lines(
        np.concatenate([p.figures for p in parts]),
        np.concatenate([p.length for p in parts]),
        np.concatenate([p.first + s for p, s in zip(parts, shift)]),
        np.concatenate([p.count for p in parts]),
    )
    model = train(lines, bad)
    row = {
        "weights": [list(model.weights)],
        "start": [model.start],
        "steps": [list(model.steps)],
        "slope": [model.slope],
        "offset": [model.offset],
    }
    yield pa.RecordBatch.from_pydict(row)


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def sample_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, quality`` of the labelled documents to fit on, at most ``SAMPLE`` of each class."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    one = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    least = [
        one.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for c in (0, 1)
    ]
    chosen = least[0].unionByName(least[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = texts.join(chosen, "doc_id")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    found = found.withColumn("nth", nth).where(F.col("nth") <= 1)
    order = F.xxhash64("doc_id")
    return found.repartition(1).sortWithinPartitions(order, "doc_id").select("text", F.col("quality").cast("int"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    schema = "weights array<double>, start double, steps array<double>, slope double, offset double"
    row = sample_of(docs, labels).mapInArrow(map_task(train_batches), schema).first()
    if row is None:
        return BLANK
    return Model(tuple(row.weights), row.start, tuple(row.steps), row.slope, row.offset)


# ------------------------------------------------------------------ scoring


def score_batches(batches, model: dict) -> Iterator[pa.RecordBatch]:
    model = Model(**model)
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            rows = batch.slice(a, b - a)
            lines = lines_of(rows.column("text"))
            share = good_share(lines, marginals(model, lines)[0])
            score = _curve(share, model.slope, model.offset)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("held_out"),
                    pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                    pa.array(share),
                    pa.array(lines.count.astype(np.int64)),
                ],
                ["doc_id", "held_out", "score", "predicted", "good_share", "n_lines"],
            )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score and prediction of every document, with its share of good text and its lines."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        text_of().alias("text"),
    )
    return rows.mapInArrow(map_task(score_batches, model=vars(model)), SCORES)


def label_batches(batches, model: dict) -> Iterator[pa.RecordBatch]:
    model = Model(**model)
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            rows = batch.slice(a, b - a)
            lines = lines_of(rows.column("text"))
            bad, _ = marginals(model, lines)
            row = np.repeat(np.arange(len(lines.count)), lines.count)
            number = np.arange(len(row)) - np.repeat(lines.first, lines.count)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(row)),
                    pa.array(number.astype(np.int64)),
                    pa.array(lines.length.astype(np.int64)),
                    pa.array(1 - bad),
                ],
                ["doc_id", "line", "n_chars", "good"],
            )


def label_lines(docs: DataFrame, model: Model) -> DataFrame:
    """P(good) of every line, numbered from 0 within its document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    schema = "doc_id long, line long, n_chars long, good double"
    return rows.mapInArrow(map_task(label_batches, model=vars(model)), schema)
