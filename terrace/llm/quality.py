"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; everything else is unlabelled web text. The model minimises the
non-negative unbiased risk  prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))  with the logistic loss, where the class prior
is estimated from the labelled rows.

The risk of the unlabelled part is taken over every document: rounds on a drawn sample follow its gradient, corrected at a few
places by the loss and gradient over all rows, which executors sum up from the rows' bins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stage, text_runs, with_text_columns

SAMPLE = 20_000  # positives that teach, and unlabelled rows on which the rounds between two passes over all rows are made
PASSES = 4  # over all unlabelled rows
UNIT = 1 << 20  # sums over all rows are of whole multiples of 1 / UNIT, so that they are the same however rows are dealt
CHARACTERS = 128  # hash buckets of character frequencies
BINS = 10  # quantile bins of each measure
BLOCK = 4096  # rows whose weights are looked up together
THRESHOLD = 0.3
WORD = re.compile(r"\S+").findall
SENTENCE_END = tuple(".!?")


def measures(text: str | None) -> np.ndarray:
    """Measures of a whole text, without looking at ids, sources or labels. NULL is the empty text."""
    text = text or ""
    n = len(text)
    words = WORD(text)
    m = len(words)
    if not m:
        return np.zeros(20 + CHARACTERS)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_codes = codes[codes < 128]
    counts = np.bincount(ascii_codes, minlength=128)
    buckets = np.bincount(codes % CHARACTERS, minlength=CHARACTERS) / n
    letters = counts[65:91].sum() + counts[97:123].sum() + (n - len(ascii_codes))
    digits = counts[48:58].sum()
    spaces = counts[32] + counts[9:14].sum()
    symbols = n - letters - digits - spaces
    lines = [x for x in text.split("\n") if x]
    often = Counter(words)
    line_often = Counter(lines)
    pairs = Counter(zip(words, words[1:], strict=False))
    shapes = text.split()
    own = [
        np.log1p(n), np.log1p(m), np.log1p(len(lines)), (n - spaces) / m, letters / n, digits / n, symbols / n, counts[65:91].sum() / max(letters, 1),
        len(often) / m, often.most_common(1)[0][1] / m, sum(c for c in line_often.values() if c > 1) / max(len(lines), 1),
        sum(len(x) * c for x, c in line_often.items() if c > 1) / n, pairs.most_common(1)[0][1] / (m - 1) if m > 1 else 0.0, len(pairs) / max(m - 1, 1),
        sum(w[-1] in ".,;:!?" for w in shapes) / m, sum(w[0].isupper() for w in shapes) / m, sum(not any(map(str.isalnum, w)) for w in often) / len(often),
        sum(x.endswith(SENTENCE_END) for x in lines) / max(len(lines), 1), max(map(len, often)) / 32, counts[46] / m,
    ]
    return np.concatenate([own, buckets])


@dataclass
class Model:
    """Bin edges of each measure, and one weight per bin."""

    edges: np.ndarray  # measures x (BINS - 1)
    weights: np.ndarray  # measures x BINS
    bias: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.bias + sum(self.weights[j][np.searchsorted(self.edges[j], x[:, j])] for j in range(x.shape[1]))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


Whole = Callable[[np.ndarray, float], tuple[float, np.ndarray, float]]


def cut_points(measured: np.ndarray) -> np.ndarray:
    """Inner quantiles of each measure: measures x (BINS - 1)."""
    return np.stack([np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1]) for x in measured.T])


def bins(edges: np.ndarray, measured: np.ndarray) -> np.ndarray:
    """The bin of every measure of every row, a byte each."""
    out = np.empty(measured.shape, np.uint8)
    for j, cuts in enumerate(edges):
        out[:, j] = np.searchsorted(cuts, measured[:, j])
    return out


class Places:
    """Rows of bins, a byte per measure. Works through blocks of rows or single measures, so that no wide copy of all rows is made."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.columns = rows, np.ascontiguousarray(rows.T)
        self.first = np.arange(rows.shape[1], dtype=np.int32) * BINS

    def weights(self, w: np.ndarray) -> np.ndarray:
        """The sum of the weights of each row's bins."""
        blocks = range(0, len(self.rows), BLOCK)
        return np.concatenate([w[self.rows[i : i + BLOCK] + self.first].sum(axis=1) for i in blocks])

    def totals(self, values: np.ndarray, start: int = 0) -> np.ndarray:
        """The sum of a value per row over the rows of each bin of each measure, from the row ``start`` on."""
        return np.concatenate([np.bincount(c[start:], values, BINS) for c in self.columns])


def fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 600, rate: float = 0.03, decay: float = 2e-4,
    edges: np.ndarray | None = None, whole: Whole | None = None,
) -> Model:
    """Minimise the non-negative risk by full-batch Adam over one-hot quantile bins.

    ``whole`` gives, at weights and bias, the mean loss of calling all unlabelled rows good and its gradient. It is asked
    ``PASSES`` times in the second half of the rounds; from there on ``unlabelled`` only tells how that gradient changes.
    """
    edges = cut_points(np.vstack([positive, unlabelled])) if edges is None else edges
    width, n = len(edges), len(positive)
    place = Places(np.concatenate([bins(edges, positive), bins(edges, unlabelled)]))
    slots = width * BINS
    w, bias = np.zeros(slots), float(np.log(prior / (1 - prior)))
    first, second, fb, sb = np.zeros(slots), np.zeros(slots), 0.0, 0.0
    passes = {rounds // 2 + i * (rounds // 2) // PASSES + 1 for i in range(PASSES)} if whole else set()
    shift, shift_bias, level = np.zeros(slots), 0.0, 0.0  # from the drawn rows to all of them
    for step in range(1, rounds + 1):
        g = place.weights(w) + bias
        p = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
        loss_minus = np.logaddexp(0, g)
        if step in passes:
            loss, slope, slope_bias = whole(w, bias)
            shift = slope - place.totals(p[n:], n) / (len(g) - n)
            shift_bias = slope_bias - p[n:].mean()
            level = loss - loss_minus[n:].mean() - shift @ w - shift_bias * bias
        pull = np.zeros(len(g))
        negative_risk = loss_minus[n:].mean() + level + shift @ w + shift_bias * bias - prior * loss_minus[:n].mean()
        if negative_risk >= 0:
            sign = 1
            pull[:n] = prior * (p[:n] - 1 - p[:n]) / n
        else:  # the estimate went below zero: step back from over-fitting
            sign = -1
            pull[:n] = prior * p[:n] / n
        pull[n:] = sign * p[n:] / (len(g) - n)
        grad = place.totals(pull) + sign * shift + decay * w
        gb = pull.sum() + sign * shift_bias
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        fb, sb = 0.9 * fb + 0.1 * gb, 0.999 * sb + 0.001 * gb**2
        fix1, fix2 = 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (first / fix1) / (np.sqrt(second / fix2) + 1e-8)
        bias -= rate * (fb / fix1) / (np.sqrt(sb / fix2) + 1e-8)
    return Model(edges, w.reshape(width, BINS), bias, prior)


def binned(docs: DataFrame, edges: np.ndarray, text: str = "text") -> DataFrame:
    """``b``: the bins of every row's whole text, a byte each."""
    shipped = docs.sparkSession.sparkContext.broadcast(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_runs(batches, "t"):
            rows = bins(shipped.value, np.stack([measures(t) for t in texts]))
            yield pa.record_batch([pa.array([r.tobytes() for r in rows], pa.binary())], names=["b"])

    return docs.select(F.col(text).alias("t")).mapInArrow(run, "b binary")


def whole_loss(rows: DataFrame, width: int) -> Whole:
    """Mean loss of calling the rows of ``binned`` good, and its gradient, in one pass that sums within tasks first."""
    slots = width * BINS

    def whole(w: np.ndarray, bias: float) -> tuple[float, np.ndarray, float]:
        shipped = rows.sparkSession.sparkContext.broadcast((w, bias))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, bias = shipped.value
            total = np.zeros(slots + 3, np.int64)
            for batch in batches:
                for start in range(0, len(batch), BLOCK):
                    raw = b"".join(batch.column(0).slice(start, BLOCK).to_pylist())
                    place = np.frombuffer(raw, np.uint8).reshape(-1, width) + np.arange(width, dtype=np.int32) * BINS
                    g = w[place].sum(axis=1) + bias
                    p = np.rint(UNIT / (1 + np.exp(-np.clip(g, -40, 40))))
                    total[:slots] += np.bincount(place.ravel(), np.repeat(p, width), slots).astype(np.int64)
                    total[slots:] += [int(p.sum()), int(np.rint(np.logaddexp(0, g) * UNIT).sum()), len(g)]
            yield pa.record_batch([pa.array(np.arange(slots + 3)), pa.array(total)], names=["slot", "value"])

        sums = dict(rows.mapInArrow(run, "slot bigint, value bigint").groupBy("slot").agg(F.sum("value")).collect())
        shipped.unpersist()
        total = np.array([sums[i] for i in range(slots + 3)], float)
        mean = total / (total[-1] * UNIT)
        return float(mean[slots + 1]), mean[:slots], float(mean[slots])

    return whole


def _measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_runs(batches, "t"):
            yield pa.record_batch([part.column(0), pa.array([measures(t) for t in texts], pa.list_(pa.float64()))], names=["k", "x"])

    cols = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return cols.mapInArrow(run, f"k {cols.schema['k'].dataType.simpleString()}, x array<double>")


def _matrix(rows: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as a matrix, without a Python object per number."""
    return rows.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1 if len(rows) else 0)


def _drawn(keys: DataFrame, n: int, most: int, seed: int) -> DataFrame:
    """About ``most`` of ``n`` distinct keys, drawn by hash: the same ones wherever the rows lie."""
    share = min(1.0, most / max(n, 1))
    unit = (F.xxhash64("k", F.lit(seed)) / F.lit(float(1 << 63)) + 1) / 2
    return keys.where(unit < share) if share < 1 else keys


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    label_key: str = "doc_id", sample: int = SAMPLE,
) -> Model | None:
    """Fit on about ``sample`` trusted positives, drawn by hash of the key, and all documents as unlabelled rows.

    Bins, and the rounds between the passes over all documents, come from about ``sample`` of them, drawn likewise. ``docs``
    and ``labels`` hold the rows that may teach; each row of ``docs`` is one unlabelled document. A document with conflicting
    labels counts as not good; rows with a NULL key or label teach nothing. The prior is the share of good among all labelled keys, with a positive and a negative
    added. None where there is no positive or no unlabelled document.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(label_key).isNotNull()).groupBy(F.col(label_key).alias("k")).agg(F.min(label).alias("good"))
    total, good = known.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0))).first()
    ids = docs.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct()
    n = ids.count()
    if not good or not n:
        return None

    def rows(keys: DataFrame) -> np.ndarray:
        """Measures of at most about ``sample`` documents, one row per key."""
        chosen = docs.withColumnRenamed(key, "k").select("k", text).join(F.broadcast(keys), "k", "left_semi")
        drawn = _measured(chosen, "k", text).groupBy("k").agg(F.min("x").alias("x")).toArrow()
        return _matrix(drawn.sort_by("k")["x"])

    positive = rows(_drawn(known.where("good = 1").select("k"), int(good), sample, 1))
    unlabelled = rows(_drawn(ids, n, sample, 2))
    if not len(positive) or not len(unlabelled):
        return None
    edges = cut_points(np.vstack([positive, unlabelled]))
    everything = stage(binned(docs.where(F.col(key).isNotNull()), edges, text), "quality-bins")
    return fit(positive, unlabelled, (int(good) + 1) / (total + 2), edges=edges, whole=whole_loss(everything, len(edges)))


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` (0 to 1) and ``predicted`` (1 at ``THRESHOLD`` or more) of every row, repeated rows included.

    NULL and empty texts are scored as texts without words. Without a model every score is 0.5.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for part, texts in text_runs(batches, "t"):
            values = model.scores(np.stack([measures(t) for t in texts])) if model else np.full(len(texts), 0.5)
            yield pa.record_batch([part.column(0), pa.array(values)], names=["k", "score"])

    cols = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = cols.schema["k"].dataType.simpleString()
    scored = cols.mapInArrow(run, f"k {kind}, score double").withColumnRenamed("k", key)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def with_scores(docs: DataFrame, model: Model | None, text: str = "text", score: str = "_score") -> DataFrame:
    """All columns of ``docs`` and the column ``score``, which must be none of them."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shipped.value
        return lambda texts: [pa.array(model.scores(np.stack([measures(t) for t in texts])) if model else np.full(len(texts), 0.5))]

    return with_text_columns(docs, text, {score: "double"}, start)
