"""Quality classifier: a linear-chain conditional random field over lines (operator 1).

Each line of a document is good or bad. Its potential adds up weights of binned features
of the line and of the lines next to it; neighbours' labels are tied by a 2 x 2 table. The
document's quality is the mean of the lines' forward-backward marginals, weighted by their
length, put on the labels' scale by a logistic curve.

The model learns from at most `sample_docs` labelled documents, chosen by a hash of their
id (a documented bound; the labels of a document stand for all its lines). Spark computes
their features; only small codes come to the driver. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .hashing import IS_SPACE, POWERS, U, pieces, prefix_sums, scramble

THRESHOLD = 0.7
LETTER, UPPER, DIGIT, SPACE, POINT, SYMBOL, BAR = range(7)
CLASS = np.full(256, SYMBOL, np.int64)
CLASS[128:] = LETTER
CLASS[[*range(97, 123)]] = LETTER
CLASS[[*range(65, 91)]] = UPPER
CLASS[[*range(48, 58)]] = DIGIT
CLASS[IS_SPACE] = SPACE
CLASS[[ord(c) for c in ".,;:'\"-()?"]] = POINT
CLASS[ord("|")] = BAR
#: The bins of each feature: values up to the first cut are bin 0, and so on.
CUTS = [
    np.array([0, 3, 5, 6, 7, 8, 9]),  # log2 of the length
    np.array([0, 0.05, 0.15, 0.5]),  # upper case among letters
    np.array([0, 0.02, 0.1]),  # digits
    np.array([0, 0.01, 0.05, 0.2]),  # symbols
    np.array([0, 0.02, 0.1]),  # bars
    np.array([0, 0.01, 0.03, 0.08]),  # sentence points
    np.array([2, 4, 5, 6, 8, 12]),  # bytes a word
    np.array([0, 0.05, 0.3, 0.8]),  # word triples that recur in the document
    np.array([0.5]),  # ends with a point
    np.array([0.5]),  # starts with upper case
    np.array([0.5]),  # a single word
]
WIDTH = max(len(c) for c in CUTS) + 1
FEATURES = len(CUTS)


def line_codes(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text: bin of each feature for each line, and the lines' lengths in bytes.
    An empty text is one empty line."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        for _, raws in pieces(texts):
            data = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
            ends = np.flatnonzero(data == 10)
            starts = np.concatenate([[0], ends[:-1] + 1])
            length = ends - starts
            lines = len(ends)
            line_at = np.repeat(np.arange(lines), length + 1)
            kinds = CLASS[data]
            count = np.bincount(line_at * 7 + kinds, minlength=7 * lines).reshape(-1, 7).astype(float)
            count[:, SPACE] -= 1
            doc_ends = np.cumsum([len(r) + 1 for r in raws])
            bounds = np.concatenate([[0], np.searchsorted(ends, doc_ends - 1) + 1])
            doc_at = np.repeat(np.arange(len(raws)), np.diff(bounds))
            edge = np.flatnonzero(np.diff(np.concatenate([[True], IS_SPACE[data]]).astype(np.int8)))
            word_from, word_to = edge[0::2], edge[1::2]
            sums, (_, down) = prefix_sums(data), POWERS.get(len(data) + 1)
            words = scramble((sums[word_to] - sums[word_from]) * down[word_from])
            word_line = line_at[word_from] if len(word_from) else np.empty(0, int)
            n_words = np.bincount(word_line, minlength=lines)
            again = np.zeros(len(words))
            if len(words) > 2:
                triple = scramble((words[:-2] * U(3) + words[1:-1]) * U(5) + words[2:] + doc_at[word_line[:-2]].astype(U) * U(0x9E3779B97F4A7C15))
                _, where, times = np.unique(triple, return_inverse=True, return_counts=True)
                again[:-2] = times[where] > 1
            recur = np.bincount(word_line, again, minlength=lines)
            filled = np.maximum(length - count[:, SPACE], 1)
            letters = np.maximum(count[:, LETTER] + count[:, UPPER], 1)
            last = CLASS[data[np.maximum(ends - 1, 0)]]
            values = [
                np.log2(length + 1),
                count[:, UPPER] / letters,
                count[:, DIGIT] / filled,
                count[:, SYMBOL] / filled,
                count[:, BAR] / filled,
                count[:, POINT] / filled,
                filled / np.maximum(n_words, 1),
                recur / np.maximum(n_words, 1),
                (last == POINT) & (length > 0),
                (CLASS[data[starts]] == UPPER) & (length > 0),
                n_words == 1,
            ]
            codes = np.stack([np.searchsorted(c, v) for c, v in zip(CUTS, values, strict=True)], axis=1).astype(np.uint8)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                yield codes[a:b], length[a:b]


def with_neighbours(codes: np.ndarray) -> np.ndarray:
    """Columns of weights for each line: own bins, the previous line's, the next one's. The
    last bin of a block of weights stands for no neighbour."""
    own = codes.astype(np.int64) + np.arange(FEATURES) * WIDTH
    size = FEATURES * WIDTH
    none = np.full((1, FEATURES), -1)
    before = np.concatenate([none, own[:-1]])
    after = np.concatenate([own[1:], none])
    return np.concatenate([own, np.where(before < 0, 3 * size, size + before), np.where(after < 0, 3 * size + 1, 2 * size + after)], axis=1)


N_WEIGHTS = 3 * FEATURES * WIDTH + 2


@dataclass
class Model:
    weights: np.ndarray
    ties: np.ndarray  # ties[from, to]
    scale: float
    shift: float

    def lines(self, potentials: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Marginals of good for the lines of several documents in turn."""
        forward, backward = messages(potentials, sizes, self.ties)
        return 1 / (1 + np.exp(-np.clip(forward + backward, -50, 50)))

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, lines and good lines of each text."""
        codes, lengths = zip(*line_codes(texts), strict=True)
        sizes = np.array([len(c) for c in codes])
        potentials = np.concatenate([self.weights[with_neighbours(c)].sum(axis=1) for c in codes])
        good, weight = self.lines(potentials, sizes), np.concatenate(lengths) + 1.0
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        share = np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at)
        return self.scaled(share), sizes, np.add.reduceat((good >= 0.5).astype(np.int64), at)

    def scaled(self, share: np.ndarray) -> np.ndarray:
        share = np.clip(share, 1e-4, 1 - 1e-4)
        return 1 / (1 + np.exp(-(self.scale * np.log(share / (1 - share)) + self.shift)))


def messages(potentials: np.ndarray, sizes: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of good that reach each line with its own potential from before, and from
    after. All documents step together, the longest first."""
    order = np.argsort(-sizes, kind="stable")
    start = (np.cumsum(sizes) - sizes)[order]
    live = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")  # documents with more than t lines
    forward, backward = potentials.copy(), np.zeros(len(potentials))
    pass_on = lambda x, m: np.logaddexp(x + m[1, 1], m[0, 1]) - np.logaddexp(x + m[1, 0], m[0, 0])
    for t in range(1, len(live)):
        at = start[: live[t]] + t
        forward[at] += pass_on(forward[at - 1], ties)
    turned = ties.T
    for t in range(len(live) - 1, 0, -1):
        at = start[: live[t]] + t
        backward[at - 1] = pass_on(potentials[at] + backward[at], turned)
    return forward, backward


def fit(codes: list[np.ndarray], lengths: list[np.ndarray], labels: np.ndarray, rounds: int = 120, rate: float = 0.1, decay: float = 1e-4, least: float = 0.02) -> Model:
    """Gradient ascent (Adam) on the mean log likelihood of the lines' labels; classes weigh
    the same. Then a logistic curve from documents' shares of good to their labels."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(N_WEIGHTS), np.zeros((2, 2)), 0.0, 10.0 if not len(labels) or labels[0] else -10.0)
    cols = np.concatenate([with_neighbours(c) for c in codes])
    sizes = np.array([len(c) for c in codes])
    y = np.repeat(labels, sizes).astype(float)
    doc_weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) / sizes
    w_line = np.repeat(doc_weight, sizes)
    first = np.zeros(len(y), bool)
    first[np.cumsum(sizes) - sizes] = True
    params, m, v = np.zeros(N_WEIGHTS + 4), np.zeros(N_WEIGHTS + 4), np.zeros(N_WEIGHTS + 4)
    model = Model(params[:N_WEIGHTS], params[N_WEIGHTS:].reshape(2, 2), 1.0, 0.0)
    pairs = np.flatnonzero(~first)
    for step in range(1, rounds + 1):
        model.weights, model.ties = params[:N_WEIGHTS], params[N_WEIGHTS:].reshape(2, 2)
        pot = model.weights[cols].sum(axis=1)
        forward, backward = messages(pot, sizes, model.ties)
        good = 1 / (1 + np.exp(-np.clip(forward + backward, -50, 50)))
        grad = np.zeros_like(params)
        grad[:N_WEIGHTS] = np.bincount(cols.ravel(), np.repeat((y - good) * w_line, cols.shape[1]), minlength=N_WEIGHTS)
        if len(pairs):  # what the table expects of two lines in a row
            a, b = forward[pairs - 1], pot[pairs] + backward[pairs]
            joint = np.stack([np.zeros_like(a) + model.ties[0, 0], b + model.ties[0, 1], a + model.ties[1, 0], a + b + model.ties[1, 1]])
            joint = np.exp(joint - joint.max(axis=0))
            joint /= joint.sum(axis=0)
            seen = np.stack([(1 - y[pairs]), np.zeros(len(pairs)), np.zeros(len(pairs)), y[pairs]])
            grad[N_WEIGHTS:] = ((seen - joint) * w_line[pairs]).sum(axis=1)
        grad -= decay * params
        grad[N_WEIGHTS:] -= least * params[N_WEIGHTS:]  # labels of lines are the document's, so ties are held back
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        params = params + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model.weights, model.ties = params[:N_WEIGHTS], params[N_WEIGHTS:].reshape(2, 2)
    good = model.lines(model.weights[cols].sum(axis=1), sizes)
    weight = np.concatenate(lengths) + 1.0
    at = np.cumsum(sizes) - sizes
    share = np.clip(np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at), 1e-4, 1 - 1e-4)
    odds = np.log(share / (1 - share))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton's steps, with a little decay
        p = 1 / (1 + np.exp(-np.clip(a * odds + b, -50, 50)))
        h = p * (1 - p) + 1e-9
        g = np.array([((labels - p) * odds).sum() - 0.01 * (a - 1), (labels - p).sum() - 0.01 * b])
        hess = np.array([[(h * odds * odds).sum() + 0.01, (h * odds).sum()], [(h * odds).sum(), h.sum() + 0.01]])
        step = np.linalg.solve(hess, g)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
    model.scale, model.shift = float(max(a, 0.05)), float(b)
    return model


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_docs: int = 4000) -> Model:
    """Learns from labelled documents that aren't held out. A document with several labels
    has the least; null labels and labels without a document are left out."""
    chosen = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).filter("id is not null and y is not null").groupBy("id").agg(F.min("y").alias("y"))
    chosen = chosen.filter(~held_out("id")).orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    # At most sample_docs rows: a bound on what is broadcast and on what comes back.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("text", F.col("y").cast("long").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes, lengths = zip(*line_codes(batch.column(0).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes() for c in codes]), pa.array([x.astype(np.int64).tobytes() for x in lengths]), batch.column(1)], ["codes", "lengths", "y"])

    got = rows.mapInArrow(run, "codes binary, lengths binary, y long").collect()
    got.sort(key=lambda r: (bytes(r[0]), bytes(r[1]), r[2]))  # the same model whatever the order of tasks
    codes = [np.frombuffer(r[0], np.uint8).reshape(-1, FEATURES) for r in got]
    return fit(codes, [np.frombuffer(r[1], np.int64) for r in got], np.array([int(r[2] > 0) for r in got]))


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with four more columns: _score (0 to 1), _predicted (1 from THRESHOLD on),
    _n_lines, _n_good_lines.

    A text's score depends on the text alone. Null counts as empty, and an empty text is one
    empty line. Without labelled rows, or with one label only, all scores are alike: that
    label's side. Null ids, repeated rows and other columns are passed on; an empty table
    gives an empty result.
    """
    @F.pandas_udf("score double, lines long, good long")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            if len(s):
                score, lines, good = model.score(s.tolist())
                yield pd.DataFrame({"score": score, "lines": lines.astype("int64"), "good": good})
            else:
                yield pd.DataFrame({"score": np.empty(0), "lines": np.empty(0, np.int64), "good": np.empty(0, np.int64)})

    small_batches(docs.sparkSession)
    out = docs.withColumn("_crf", scored(F.coalesce(F.col(text_col), F.lit(""))))
    return out.select(*docs.columns, F.col("_crf.score").alias("_score"), (F.col("_crf.score") >= THRESHOLD).cast("int").alias("_predicted"), F.col("_crf.lines").alias("_n_lines"), F.col("_crf.good").alias("_n_good_lines"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = classify(docs.select("doc_id", "text"), train(docs, labels))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"), F.col("_n_lines").alias("n_lines"), F.col("_n_good_lines").alias("n_good_lines"))
