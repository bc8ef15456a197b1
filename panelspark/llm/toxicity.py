"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel of two spans is the sum over common subsequences of three
characters, each occurrence weighted by ``DECAY`` to the power of the
characters it skips (at most ``MAX_SKIP``), divided by what the spans' lengths
allow.  An insult with inserted, masked or missing characters therefore keeps
most of its subsequences.  Spans are the words of a sentence without inner
marks, and runs of single letters joined ("i d i o t").

A labelled text is a bag of sentences and a sentence a bag of spans: all spans
of clean rows are negative, and the witnesses of toxic rows are positive: spans
that share an opening which is in far more toxic rows than clean ones, and in
more than chance allows.  The negatives nearest to the margin are mined again each round.
``LANDMARKS`` spans approximate the kernel (Nystroem), a linear SVM is fitted
by dual coordinate descent, and since it is linear in the landmarks it folds
into one weight per character triple: scoring looks up triples, once for each
distinct word of a batch.  A text scores as its worst span.

The fit uses at most ``PER_CLASS`` rows of each class, a third of them for the
threshold; equal spans are held once, and kernel weights only for triples that
a landmark has.  Scoring is one pass without a shuffle.

Edge cases: a null or blank text has no span and the least score; null labels
are not learned from; without rows of both classes every score is the smoothed
share of label 1; repeated rows are scored alike; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import crc_mod, slices, type_of
from panelspark.llm.linear_svm import dual_coordinate_descent, labelled_sample

PER_CLASS = 2500
DECAY, MAX_SKIP, LANDMARKS, C = 0.6, 2, 144, 2.0
NEGATIVES, ROUNDS, ODDS = 6_000, 3, 25
LONGEST = 40           # longer words are cut into overlapping spans of this length
CACHE_ENTRIES = 250_000
BATCH = 512
GATHERED = 1 << 21     # weights that a step looks up together
# Digits and signs that stand for letters inside a word.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_MARKS = regex.compile(r"[^\p{L}]+")
_SPELLED = regex.compile(r"(?<![\p{L}\p{N}])\p{L}(?:[^\p{L}\p{N}]{1,3}\p{L}(?![\p{L}\p{N}])){3,}")
_ALNUM = regex.compile(r"[\p{L}\p{N}]")
SKIPS = [(a, b) for a in range(1, MAX_SKIP + 2) for b in range(1, MAX_SKIP + 3 - a)]  # steps to the 2nd and 3rd


def span(token: str) -> str:
    """A word without marks, stand-ins replaced if it is mostly letters."""
    token = token.strip(".,;:!?\"'()[]«»…")
    if not token.isalpha():
        if 3 * sum(map(str.isalpha, token)) >= 2 * len(token):
            token = token.translate(STAND_INS)
        token = _MARKS.sub("", token)
    return token


def _cut(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    return [word[i:i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def tokens(text: str | None) -> set[str]:
    """Distinct raw words of a text, and its spelled-out words joined."""
    low = (text or "").lower()
    found = set(low.split())
    for m in _SPELLED.finditer(low):
        found.add("".join(_ALNUM.findall(m.group())))
    return found


def _codes(words: list[str], alphabet: np.ndarray) -> np.ndarray:
    """Characters of words of equal length, each with its two end marks, as
    small numbers; 0 stands for characters without weight."""
    n = len(words[0])
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), n)
    inner = alphabet[np.minimum(points, alphabet.size - 1)]
    ends = np.ones((len(words), 1), dtype=np.int64)
    return np.hstack([ends, inner, ends * 2])


def _by_length(words: list[str]):
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    return groups.values()


def _size(n: int) -> float:
    """Length of the feature vector of n characters, occurrences apart."""
    total = sum(max(0, n - a - b) * DECAY ** (2 * (a + b - 2)) for a, b in SKIPS)
    return float(np.sqrt(total)) or 1.0


@dataclass
class Spans:
    """Triple scorer: weights per character triple over a small alphabet."""

    alphabet: np.ndarray  # code point -> small number
    letters: int
    weight: np.ndarray    # one row per triple; one column per output
    row: np.ndarray | None = None  # row of each of the letters ** 3 triples, if not its own number

    def values(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.weight.shape[1]), dtype=np.float32)
        for group in _by_length(words):
            step = max(1, min(4096, GATHERED // (self.weight.shape[1] * (len(words[group[0]]) + 2))))
            for k in range(0, len(group), step):
                part = group[k:k + step]
                c = _codes([words[i] for i in part], self.alphabet)
                total = np.zeros((len(part), self.weight.shape[1]), dtype=np.float32)
                n = c.shape[1]
                for a, b in SKIPS:
                    if n <= a + b:
                        continue
                    at = (c[:, :n - a - b] * self.letters + c[:, a:n - b]) * self.letters + c[:, a + b:]
                    if self.row is not None:
                        at = self.row[at]
                    total += self.weight[at].sum(axis=1) * np.float32(DECAY ** (a + b - 2))
                out[part] = total / np.float32(_size(n))
        return out


def _alphabet(words) -> tuple[np.ndarray, int]:
    """Numbers from 3 for the characters of ``words`` (at most 120)."""
    chars = [c for c, _ in Counter("".join(words)).most_common(120) if ord(c) < 0x3000]
    table = np.zeros(0x3001, dtype=np.int64)
    for i, c in enumerate(chars):
        table[ord(c)] = i + 3
    return table, len(chars) + 3


def landmark_spans(words: list[str]) -> Spans:
    """Scorer whose outputs are the kernel values with each landmark."""
    alphabet, letters = _alphabet(words)
    own = [list(_triples(_codes([w], alphabet)[0], letters)) for w in words]
    found = np.unique(np.concatenate([at for parts in own for _, at in parts] or [np.zeros(0, dtype=np.int64)]))
    found = found[~_with_other(found, letters)]
    row = np.zeros(letters ** 3, dtype=np.int32)  # row 0 is without weight
    row[found] = np.arange(1, found.size + 1)
    weight = np.zeros((found.size + 1, len(words)), dtype=np.float32)
    for j, (w, parts) in enumerate(zip(words, own)):
        for skip, at in parts:
            np.add.at(weight[:, j], row[at], np.float32(DECAY ** skip / _size(len(w) + 2)))
    weight[0] = 0
    return Spans(alphabet, letters, weight, row)


def _triples(c: np.ndarray, letters: int):
    """The triples of a word's codes, by how many characters they skip."""
    n = c.size
    for a, b in SKIPS:
        if n > a + b:
            yield a + b - 2, (c[:n - a - b] * letters + c[a:n - b]) * letters + c[a + b:]


def _with_other(triple: np.ndarray, letters: int) -> np.ndarray:
    return (triple // letters ** 2 == 0) | (triple // letters % letters == 0) | (triple % letters == 0)


@dataclass
class Model:
    spans: Spans | None
    bias: float
    slope: float
    middle: float
    constant: float | None = None

    def worst(self, words: list[str]) -> np.ndarray:
        return self.spans.values(words)[:, 0] + np.float32(self.bias)


def _gapped(word: str, rng: np.random.Generator) -> list[str]:
    """Variants of an insult: a character put in, and one left out."""
    out = []
    if len(word) >= 4:
        i = int(rng.integers(1, len(word)))
        out.append(word[:i] + "xqzh"[int(rng.integers(4))] + word[i:])
    if len(word) >= 6:
        i = int(rng.integers(1, len(word) - 1))
        out.append(word[:i] + word[i + 1:])
    return out


def fit(bags: list[list[str]], label: np.ndarray) -> Model:
    """Model from each row's distinct spans and labels 0 and 1."""
    n1 = int(label.sum())
    if not n1 or n1 == label.size:
        return Model(None, 0.0, 1.0, 0.0, (n1 + 1) / (label.size + 2))
    rng = np.random.default_rng(11)
    fitted = np.arange(label.size) % 3 > 0 if min(n1, label.size - n1) >= 60 else np.ones(label.size, dtype=bool)
    pos = [bags[i] for i in np.flatnonzero(fitted & (label > 0)) if bags[i]]
    neg = [bags[i] for i in np.flatnonzero(fitted & (label == 0)) if bags[i]]
    witness, clean = _witnesses(pos, neg)
    hard = [clean[i] for i in rng.permutation(len(clean))[:NEGATIVES // 2]]
    model = None
    for _ in range(ROUNDS):
        ranked = [w for w, _ in sorted(witness.items(), key=lambda x: (-x[1], x[0])) if len(w) > 2]
        if not ranked or not hard:
            break
        # the best supported witnesses, then those least like one another, then negatives
        top = LANDMARKS // 3
        marks = ranked[:top] + _spread_out(ranked[top:600], top) + hard[:LANDMARKS - 2 * top]
        model = _svm(ranked, witness, hard, marks, rng)
        values = model.worst(clean) if clean else np.zeros(0)
        order = np.argsort(-values, kind="stable")[:NEGATIVES // 2]
        easy = rng.permutation(len(clean))[:NEGATIVES // 2]
        hard = list(dict.fromkeys([*(clean[i] for i in order), *(clean[i] for i in easy)]))
    if model is None:
        return Model(None, 0.0, 1.0, 0.0, (n1 + 1) / (label.size + 2))
    rest = ~fitted if not fitted.all() else fitted
    top = {y: np.sort([model.worst(bags[i]).max() if bags[i] else -9.0 for i in np.flatnonzero(rest & (label == y))])
           for y in (0, 1)}
    low, high = np.quantile(top[0], 0.998), np.quantile(top[1], 0.02)
    if high <= low:  # the classes overlap: the least balanced error
        cuts = np.unique(np.concatenate([top[0], top[1]]))
        errors = [2 * (top[0] >= t).mean() + (top[1] < t).mean() for t in cuts]  # clean texts weigh more
        best = int(np.argmin(errors))
        model.middle, model.slope = float(cuts[max(best - 1, 0):best + 1].mean()), 4.0
    else:
        # nearer to the clean texts, so that gapped insults stay above it
        model.middle, model.slope = float(low + 0.25 * (high - low)), float(8.0 / max(high - low, 0.1))
    return model


def _witnesses(pos: list[list[str]], neg: list[list[str]]) -> tuple[Counter, list[str]]:
    """Spans of toxic rows that, as a whole or by their opening, are ``ODDS``
    times as frequent in toxic rows as in clean ones and in more toxic rows
    than chance allows, with their own row counts; and all spans of clean rows.
    Copies of a row count once."""
    def openings(bags):
        copies: dict[tuple[int, ...], list[list[str]]] = {}
        for b in bags:
            copies.setdefault(_copy_of(b), []).append(b)
        return copies, ({o for b in own for w in b for o in _openings(w)} for own in copies.values())

    copies, each = openings(pos)
    toxic, n1 = Counter(o for own in each for o in own), max(1, len(copies))
    copies, each = openings(neg)  # of the clean rows only what is in toxic ones
    plain, n0 = Counter(o for own in each for o in own if o in toxic), max(1, len(copies))
    # per opening: at least this many toxic rows, or chance finds some among so many
    least = max(2, int(np.ceil(np.log(0.02 / max(1, len(toxic))) / np.log(min(n1 / (n1 + n0), 0.7)))))
    least = min(least, max(2, n1 // 4))
    good = {o: k for o, k in toxic.items() if k >= least and k * n0 >= ODDS * plain[o] * n1}
    out = Counter()
    for w in {w for b in pos for w in b}:
        if plain[w + "$"] * ODDS * n1 <= toxic[w + "$"] * n0:
            k = max(good.get(o, 0) for o in _openings(w))
            if k:
                out[w] = toxic[w + "$"]
    return out, sorted({w for b in neg for w in b}.difference(out))


def _openings(word: str) -> list[str]:
    """A span as a whole, marked by its end, and its openings."""
    return [word + "$", *(word[:n] for n in range(4, min(len(word), 12) + 1))]


def _copy_of(bag: list[str]) -> tuple[int, ...]:
    """The three least word hashes of a row: alike for copies of it."""
    return tuple(sorted(map(xxhash.xxh64_intdigest, bag))[:3])


def _spread_out(words: list[str], k: int) -> list[str]:
    """Greedy choice: each next word is the one least like those chosen."""
    if len(words) <= k:
        return words
    values = landmark_spans(words).values(words)
    like = values[:, 0].copy()
    chosen = [0]
    while len(chosen) < k:
        i = int(np.argmin(like))
        chosen.append(i)
        like = np.maximum(like, values[:, i])
    return [words[i] for i in chosen]


def _svm(ranked: list[str], witness: Counter, hard: list[str], marks: list[str], rng) -> Model:
    base = landmark_spans(marks)
    gaps = [g for w in ranked[:1500] for g in _gapped(w, rng)]
    words = ranked + gaps + hard
    k_mm = base.values(marks).astype(np.float64)
    value, vector = np.linalg.eigh((k_mm + k_mm.T) / 2)
    keep = value > 1e-3
    whiten = vector[:, keep] / np.sqrt(value[keep])  # Nystroem map: kernel values -> features
    x = np.hstack([base.values(words) @ whiten, np.ones((len(words), 1))])
    y = np.r_[np.ones(len(ranked) + len(gaps)), -np.ones(len(hard))]
    many = np.r_[[min(witness[w], 20) for w in ranked], np.full(len(gaps), 0.5), np.ones(len(hard))]
    idx = np.arange(x.shape[1])
    w = dual_coordinate_descent([(idx, r) for r in x], y, x.shape[1], C * many, epochs=40)
    folded = base.weight @ (whiten @ w[:-1]).astype(np.float32)
    return Model(Spans(base.alphabet, base.letters, folded[base.row][:, None]), float(w[-1]), 1.0, 0.0)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", mod: int = 5, held: int = 0,
          per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on label rows whose crc32(id) mod ``mod`` is not ``held``."""
    sample = labelled_sample(docs, labels, label_col, crc_mod(F.col(id_col), mod) != held, per_class, id_col, text_col)

    def run(batches):
        for b in batches:
            bags = [sorted({s for t in tokens(x) for s in _cut(span(t)) if len(s) > 2}) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(bags, pa.list_(pa.string())), b.column(1)], ["spans", "label"])

    got = sample.mapInArrow(run, "spans array<string>, label int").toArrow()
    label = np.array(got.column("label").to_pylist(), dtype=np.int64)
    once: dict[str, str] = {}  # equal spans of all rows are one string
    bags = [[once.setdefault(s, s) for s in bag]
            for part in slices(got.to_batches()) for bag in part.column(0).to_pylist()]
    del got, once
    order = sorted(range(len(bags)), key=lambda i: (label[i], bags[i]))
    order = [order[i] for i in np.random.default_rng(3).permutation(len(order))]
    return fit([bags[i] for i in order], label[order])


_SEEN: dict[str, float] = {}
_SEEN_FOR: list = [None]


def text_scores(model: Model, texts: list[str | None], cache: dict[str, float]) -> np.ndarray:
    """Score of each text, by its worst span; ``cache`` keeps words' values."""
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    bags = [tokens(t) for t in texts]
    new = set().union(*bags).difference(cache) if bags else set()
    if len(cache) + len(new) > CACHE_ENTRIES:
        cache.clear()
        new = set().union(*bags)
    owner, words = [], []
    for t in new:
        for s in _cut(span(t)):
            if len(s) > 2:
                owner.append(t)
                words.append(s)
    cache.update(dict.fromkeys(new, -9.0))
    if words:
        for t, v in zip(owner, model.worst(words).tolist()):
            if v > cache[t]:
                cache[t] = v
    worst = np.array([max(map(cache.__getitem__, b), default=-9.0) for b in bags])
    return 1.0 / (1.0 + np.exp(-np.clip(model.slope * (worst - model.middle), -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: bool = False) -> DataFrame:
    """``(<id_col>, score)`` for every row; with ``keep`` the columns of
    ``docs`` and ``__score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(texts):
        model = shared.value
        if _SEEN_FOR[0] is not model:
            _SEEN.clear()
            _SEEN_FOR[0] = model
        for i in range(0, len(texts), BATCH):
            yield pa.array(text_scores(model, texts.slice(i, BATCH).to_pylist(), _SEEN), pa.float64())

    text = F.col(text_col).cast("string").alias("__text")
    if keep:  # only texts go to Python, the rows stay in the JVM
        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            return pa.concat_arrays([pa.array([], pa.float64()), *scores(texts)])

        return docs.withColumn("__score", scored(text))

    def run(batches):
        for whole in batches:
            done = 0
            for s in scores(whole.column(1)):
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(done, len(s)), s], [id_col, "score"])
                done += len(s)

    return docs.select(F.col(id_col), text).mapInArrow(run, f"`{id_col}` {type_of(docs, id_col)}, score double")
