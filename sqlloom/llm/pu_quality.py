"""Quality scores by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are documents labelled good; unlabelled text is everything without a label. With
class prior p the risk p*R+(positives) + max(0, R-(unlabelled) - p*R-(positives)) is minimised for a
small network over features of form (character classes, word and line statistics, repetition). The
prior is the share of good rows among labelled ones; without labelled bad rows it is estimated from
the scores (see ``prior_from_scores``).

Learning takes a bounded sample of rows (``POSITIVES``, ``UNLABELLED``: those with the smallest hash
of their id) whose id is in a learning fold; features are computed by the executors and only the
sample's features come to the driver. Scoring covers every row and whole texts.

Defined cases: null and empty texts have the features of an empty text and a score like any other;
repeated rows are scored apart; without a trusted positive every score is the prior (0.5 if unknown);
a document labelled more than once is positive only if all its labels are; an empty table gives no
rows; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sqlloom.llm.common import BLANKS, Words, arrow_batch, is_held_out, may_learn, pieces, separators

POSITIVES = 6_000
UNLABELLED = 12_000
HIDDEN = 24
STEPS = 1_500
BATCH = 512
RATE = 5e-3
DECAY = 1e-4
THRESHOLD = 0.7
LENIENCE = 4.0  # a text reaches the threshold down to this far on the bad side of the margin

LINE_ENDS = separators([(0x0A, 0x0A), (0x0D, 0x0D)])
#: Classes of byte values, by the characters that stand for them; others follow below.
CLASSES = [" \t", "\n\r", ".", ",", ";:!?", "'\"`", "()[]{}", "|", "#$%&*@^~", "+=_<>/\\", "-"]


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for number, characters in enumerate(CLASSES, 1):
        table[list(characters.encode())] = number
    n = len(CLASSES)
    for number, (low, high) in enumerate([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)], n + 1):
        table[low : high + 1] = number
    return table


CLASS_OF = _class_table()
N_CLASSES = int(CLASS_OF.max()) + 1


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _distinct(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each document."""
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    return np.bincount(d[new], minlength=n)


def features(texts: pa.Array) -> np.ndarray:
    """One row of features a text."""
    n = len(texts)
    words, lines = Words(texts, BLANKS), Words(texts, LINE_ENDS)
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    sizes = np.diff(words.bounds)
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + n + 1] if n else np.zeros(1, np.int64)
    data = raw.buffers()[2]
    whole = np.frombuffer(data, np.uint8)[int(offsets[0]) : int(offsets[-1])] if data is not None and sizes.sum() else np.zeros(0, np.uint8)
    owner = np.repeat(np.arange(n), sizes)
    classes = np.bincount(owner * N_CLASSES + CLASS_OF[whole], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    same = np.zeros(len(whole), bool)
    same[1:] = (whole[1:] == whole[:-1]) & (owner[1:] == owner[:-1])
    n_words, n_lines = words.counts, lines.counts
    length = (words.end - words.start).astype(np.float64)
    total = np.bincount(words.doc, length, n)
    squares = np.bincount(words.doc, length**2, n)
    mean = _ratio(total, n_words)
    last = CLASS_OF[words.bytes[words.end - 1]] if len(words.end) else np.zeros(0, np.int64)
    odd_end = np.bincount(words.doc[(last >= 8) & (last <= 10)], minlength=n)
    short = np.bincount(words.doc[length <= 3], minlength=n)
    line_length = np.bincount(lines.doc, (lines.end - lines.start).astype(np.float64), n)
    columns = [
        _ratio(classes, sizes[:, None]),
        np.column_stack(
            [
                np.log1p(n_words),
                mean,
                np.sqrt(np.maximum(_ratio(squares, n_words) - mean**2, 0)),
                _ratio(short, n_words),
                _ratio(odd_end, n_words),
                _ratio(_distinct(words.doc, words.hash, n), n_words),
                _ratio(_distinct(lines.doc, lines.hash, n), n_lines),
                np.log1p(n_lines),
                np.log1p(_ratio(line_length, n_lines)),
                _ratio(np.bincount(owner[same], minlength=n), sizes),
                _ratio(classes[:, 3], n_words),
                _ratio(classes[:, 4], n_words),
            ]
        ),
    ]
    return np.concatenate(columns, axis=1)


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return _forward(self.weights, self.standard(x))[1]

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.center) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.margin(x) + LENIENCE + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


def _forward(w: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ w[0] + w[1])
    return hidden, hidden @ w[2] + x @ w[3] + w[4][0]


def prior_from_scores(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: the smallest ratio, over score thresholds that keep
    at least a tenth of the positives, of the shares of unlabelled and positive rows above it."""
    edges = np.quantile(positive, np.linspace(0, 0.9, 46))
    ratio = [(unlabelled >= t).mean() / (positive >= t).mean() for t in edges]
    return float(np.clip(min(ratio), 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int = 7) -> Model:
    """Minimise the non-negative risk by Adam. Where the unlabelled part minus its positive share
    turns negative, the step goes up that part's gradient instead (the correction of the method)."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(1), np.ones(1), [], 0.5 if prior is None else prior)
    if prior is None:
        first = fit(positive, unlabelled, 0.5, seed)
        prior = prior_from_scores(first.margin(positive), first.margin(unlabelled))
    both = np.concatenate([positive, unlabelled])
    model = Model(both.mean(0), both.std(0) + 1e-9, [], prior)
    p, u = model.standard(positive), model.standard(unlabelled)
    rng = np.random.default_rng(seed)
    d = p.shape[1]
    w = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(d), np.zeros(1)]
    w[2] += rng.normal(0, 0.1, HIDDEN)
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    average = [np.zeros_like(x) for x in w]
    for step in range(1, STEPS + 1):
        x = np.concatenate([p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]])
        hidden, g = _forward(w, x)
        s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        # Sigmoid losses: sigma(-g) for positive, sigma(g) for negative; both are bounded.
        rest = s[BATCH:].mean() - prior * s[:BATCH].mean()
        steep = s * (1 - s) / BATCH
        slope_p, slope_u = -prior * steep[:BATCH], np.zeros(BATCH)
        part_p, part_u = -prior * steep[:BATCH], steep[BATCH:]
        slope = np.concatenate([slope_p + part_p, slope_u + part_u]) if rest >= 0 else -np.concatenate([part_p, part_u])
        back = np.outer(slope, w[2]) * (1 - hidden**2)
        grads = [x.T @ back, back.sum(0), hidden.T @ slope, x.T @ slope, np.array([slope.sum()])]
        for i, grad in enumerate(grads):
            grad = grad + DECAY * w[i]
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad**2
            w[i] = w[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
            if step > STEPS // 2:
                average[i] += w[i] / (STEPS - STEPS // 2)
    return Model(model.center, model.scale, average, prior)


def _with_features(rows: DataFrame, extra: str) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(extra, pa.int32()), ("x", pa.list_(pa.float64()))])
        for batch in batches:
            for part in pieces(batch, "text"):
                yield arrow_batch(schema, **{extra: part.column(extra), "x": list(features(part.column("text")))})

    return rows.select(extra, "text").mapInArrow(compute, f"{extra} int, x array<double>")


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """The model from the learning folds; ``positives`` and ``unlabelled`` bound the sample."""
    known = labels.where(F.col("quality").isNotNull() & may_learn("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    rows = docs.where(may_learn("doc_id")).select("doc_id", "text")
    # The ids first: only those of the sample are joined to texts.
    ids = rows.select("doc_id").distinct().join(known, "doc_id", "left").withColumn("good", F.coalesce("good", F.lit(-1)))
    prior = ids.agg(F.avg(F.when(F.col("good") >= 0, F.col("good"))), F.count(F.when(F.col("good") == 0, 1))).first()
    good = ids.where("good = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives)
    other = ids.where("good = -1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(unlabelled)
    chosen = good.unionByName(other)  # at most positives + unlabelled rows
    sample = rows.join(F.broadcast(chosen), "doc_id").withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))).where("n = 1")
    got = _with_features(sample, "good").toPandas()
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, 1))
    mark = got["good"].to_numpy()
    order = np.lexsort(x.T[::-1]) if len(x) else []  # the same sample gives the same model
    x, mark = x[order], mark[order]
    share = float(np.clip(prior[0], 0.02, 0.98)) if prior[1] else None
    return fit(x[mark == 1], x[mark == -1], share)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score of every row's whole text."""
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    names = docs.columns

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                values = pa.array(model.score(features(part.column("text"))), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, values], names=[*names, column])

    return docs.mapInArrow(compute, schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = learn(docs, labels)
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
