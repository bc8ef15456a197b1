"""Quality classifier: Naive Bayes support vectors.

A text's features are indicators of word and word-shape n-grams, hashed into
``BINS`` bins.  Each indicator is scaled by its class log-count ratio, rows
are brought to unit length, and a linear hinge-loss model is fitted by dual
coordinate descent; its weights are interpolated with their mean magnitude.
The fit uses at most ``PER_CLASS`` labelled rows of each class (the first
fifth of them calibrates the score); scoring is one pass over all texts
without a shuffle, with a broadcast of ``BINS`` weights.

Edge cases: a null text is empty, and empty texts get the score of the bias
alone; null labels and labels other than 0 and 1 are not learned from;
repeated rows count as often as they come; without rows of one class every
score is the smoothed share of label 1; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import crc_mod, type_of
from panelspark.llm.linear_svm import dual_coordinate_descent, labelled_sample

BITS = 18
BINS = 1 << BITS
PER_CLASS = 3000
MIN_DF, ALPHA, BETA, C = 3, 1.0, 0.9, 1.0
CACHE_ENTRIES = 250_000
BATCH = 512

_SHAPES = (regex.compile(r"\p{Lu}"), regex.compile(r"\p{Ll}|\p{Lo}"), regex.compile(r"\p{N}"))
_RUN = regex.compile(r"(.)\1{2,}")


def shape(token: str) -> str:
    """Letters by case, digits as 0, other characters as they are; runs of
    three or more become two."""
    for rx, to in zip(_SHAPES, "Aa0"):
        token = rx.sub(to, token)
    return _RUN.sub(r"\1\1", token)


class Codes(dict):
    """Token bytes -> word hash above shape hash, kept up to a bound."""

    def __missing__(self, token: bytes) -> int:
        text = token.decode("utf-8", "replace")
        code = (xxhash.xxh32_intdigest(text.lower()) << 32) | xxhash.xxh32_intdigest(shape(text))
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        if len(token) <= 64:
            self[token] = code
        return code


_CODES = Codes()


def _bins(salt: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(parts[0].shape, np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    for p in parts:
        h = (h ^ p) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


def features(text: str | None) -> np.ndarray:
    """Distinct bins of the n-grams of a text."""
    tokens = (text or "").encode("utf-8", "replace").split()
    if not tokens:
        return np.zeros(0, dtype=np.int32)
    code = np.fromiter(map(_CODES.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    word, form = code >> np.uint64(32), code & np.uint64(0xFFFFFFFF)
    # a word followed by itself is one and the same bigram, whatever the word
    after = np.where(word[1:] == word[:-1], np.uint64(0), word[1:])
    first = np.where(word[1:] == word[:-1], np.uint64(0), word[:-1])
    return np.unique(np.concatenate([
        _bins(1, word), _bins(2, first, after), _bins(3, form), _bins(4, form[:-1], form[1:]),
        _bins(5, form[:-2], form[1:-1], form[2:])]))


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # per bin: model weight times log-count ratio
    ratio: np.ndarray   # per bin: log-count ratio
    bias: float
    slope: float
    middle: float
    constant: float | None = None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        margins = np.empty(len(texts))
        for i, t in enumerate(texts):
            x = features(t)
            r = self.ratio[x]
            norm = float(np.sqrt(r @ r))
            margins[i] = self.bias + (float(self.weight[x].sum()) / norm if norm else 0.0)
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (margins - self.middle), -30, 30)))


def fit(rows: list[np.ndarray], label: np.ndarray) -> Model:
    """Model from feature bins and labels 0 and 1."""
    n1 = int(label.sum())
    n0 = label.size - n1
    if not n0 or not n1:
        empty = np.zeros(BINS, dtype=np.float32)
        return Model(empty, empty, 0.0, 1.0, 0.0, (n1 + 1) / (label.size + 2))
    calibrate = np.arange(label.size) % 5 == 0
    if min(label[~calibrate].sum(), (1 - label[~calibrate]).sum()) < 2:
        calibrate[:] = False
    train = np.flatnonzero(~calibrate)
    counts = [np.bincount(np.concatenate([rows[i] for i in train if label[i] == y]), minlength=BINS) for y in (0, 1)]
    p, q = (c + ALPHA for c in counts[::-1])
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[counts[0] + counts[1] < MIN_DF] = 0.0
    ratio = ratio.astype(np.float32)

    def row(i):
        x = rows[i][ratio[rows[i]] != 0]
        v = ratio[x].astype(np.float64)
        norm = np.sqrt(v @ v) or 1.0
        return np.append(x, BINS), np.append(v / norm, 1.0)  # the last feature is the bias

    y = np.where(label > 0, 1.0, -1.0)
    each = np.where(label > 0, label.size / (2 * n1), label.size / (2 * n0)) * C
    w = dual_coordinate_descent([row(i) for i in train], y[train], BINS + 1, each[train])
    used = ratio != 0
    mean = np.abs(w[:-1][used]).mean() if used.any() else 0.0
    weight = np.where(used, (1 - BETA) * mean + BETA * w[:-1], 0.0) * ratio
    model = Model(weight.astype(np.float32), ratio, float(w[-1]), 1.0, 0.0)
    held = np.flatnonzero(calibrate) if calibrate.any() else train
    slope, middle = _platt(np.array([_margin(model, rows[i]) for i in held]), label[held])
    return Model(model.weight, ratio, model.bias, slope, middle)


def _margin(model: Model, x: np.ndarray) -> float:
    r = model.ratio[x]
    norm = float(np.sqrt(r @ r))
    return model.bias + (float(model.weight[x].sum()) / norm if norm else 0.0)


def _platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and middle of a logistic curve, both classes of equal weight and
    with smoothed targets, by Newton's method."""
    n1, n0 = max(1, int(label.sum())), max(1, int((1 - label).sum()))
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    each = np.where(label > 0, 0.5 / n1, 0.5 / n0)
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = each * (p - target), each * p * (1 - p)
        ga, gb = g @ margin + 1e-4 * a, g.sum()
        haa, hab, hbb = h @ (margin * margin) + 1e-4, h @ margin, h.sum() + 1e-9
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 5.0 / max(abs(da), abs(db), 1e-9))
        a, b = a - step * da, b - step * db
        if max(abs(da), abs(db)) < 1e-6:
            break
    if not np.isfinite(a) or a <= 0:
        return 1.0, 0.0
    return float(a), float(-b / a)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", mod: int = 3, held: int = 1,
          per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on label rows whose crc32(id) mod ``mod`` is not ``held``."""
    sample = labelled_sample(docs, labels, label_col, crc_mod(F.col(id_col), mod) != held, per_class, id_col, text_col)

    def run(batches):
        for b in batches:
            bins = [features(t).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.binary()), b.column(1)], ["bins", "label"])

    got = sample.mapInArrow(run, "bins binary, label int").toArrow()
    rows = [np.frombuffer(x, dtype=np.int32) for x in got.column("bins").to_pylist()]
    label = np.array(got.column("label").to_pylist(), dtype=np.int64)
    order = sorted(range(len(rows)), key=lambda i: (label[i], rows[i].tobytes()))  # the same fit in any task order
    mixed = np.random.default_rng(3).permutation(len(order))
    order = [order[i] for i in mixed]
    return fit([rows[i] for i in order], label[order])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, score)`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH):
                b = whole.slice(i, BATCH)
                s = shared.value.scores(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], [id_col, "score"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, f"`{id_col}` {type_of(docs, id_col)}, score double")
