"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of ``PASSAGE`` words and weighted by
TF-IDF, the document frequencies counted over all passages of the corpus.  A
randomised SVD of the benchmark's TF-IDF passages (range finder with power
iterations; every product with the matrix is a distributed pass over the
passages that returns sums of fixed size) gives latent directions, as many as
a block has passages; corpus words outside the benchmark have no coordinate in
that space.  One pass over the corpus compares the latent vector of each
stretch of a text with those of the items.  An item is proposed where their
cosine reaches the least one that a stretch with ``LIKELY`` of the item's words
can have: the weight of its ``LIKELY`` most frequent words, less what the part
of the item outside the space could add (the product of the lengths).  So no
item that can be verified is lost.  An item of which the space leaves out more
than ``OUTSIDE`` of its length (fewer directions than passages) has no useful
bound; the exact addition for such items are lists of their rarer words.  Every
window of two passages around which ``LIKELY`` of a proposed item's words stand
is a candidate.  The candidate windows
of a text and item are verified on the words, the highest latent cosine first,
until one holds: the longest common subsequence of the item and the text
around the window must cover ``SURE`` of the item, or ``LIKELY`` of it while
the answer (the ``answer`` column, else the item's last sentence) is there too:
paraphrases keep both, a shared phrase does not.

The benchmark is taken in blocks of about ``BLOCK`` passages, each against all
texts; what is broadcast for a block (its words, lists and vectors, term vectors
of at most ``CELLS`` numbers) is bounded by that and by the longest item.  The
corpus is never shuffled.

Edge cases: null and empty texts and items match nothing; items without words
are left out; repeated items are reported by their own ids, repeated rows as
often as they come; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import slices, type_of

PASSAGE = 16
EXTRA, POWER = 16, 2
SURE, LIKELY, ANSWER = 0.75, 0.6, 0.6
BLOCK = 1024        # benchmark passages per pass over the corpus, on average
CELLS = 1 << 24     # numbers in the term vectors of a block; beyond, fewer directions
OUTSIDE = 0.01      # share of an item's length outside the space, up to which cosines propose it
_BLANKED = bytes(32 if b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128 else b for b in range(256))
SIGNATURE = 0.3     # share of an item's words that must be met among its rarer ones
SPAN = 768          # least number of words of a text that are counted together


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII marks separate them."""
    return (text or "").lower().encode("utf-8", "replace").translate(_BLANKED).split()


def _last_sentence(text: str) -> list[bytes]:
    parts = [t for p in text.replace("\n", ".").replace("?", ".").replace("!", ".").split(".") if (t := tokens(p))]
    if len(parts) > 1:
        return parts[-1]
    return parts[0][-max(1, len(parts[0]) // 3):] if parts else []


def lcs(pattern: list[bytes], text: list[bytes]) -> int:
    """Length of the longest common subsequence, bits for the pattern's words."""
    where: dict[bytes, int] = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    rest = full
    for w in text:
        hit = rest & where.get(w, 0)
        if hit:
            rest = ((rest + hit) | (rest - hit)) & full
    return len(pattern) - rest.bit_count()


@dataclass
class Items:
    """One block of benchmark items."""

    ids: list
    words: list[list[bytes]]
    answers: list[list[bytes]]
    term: dict[bytes, int]        # word -> term number
    size: int                     # number of terms
    passages: list[tuple[int, np.ndarray]]  # item, term numbers

    @staticmethod
    def of(rows: list[tuple]) -> Items:
        kept = [(i, t, a) for i, t, a in rows if tokens(t)]
        words = [tokens(t) for _, t, _ in kept]
        seen = sorted({w for ws in words for w in ws})
        term = {w: n for n, w in enumerate(seen)}
        passages = []
        for n, ws in enumerate(words):
            cuts = list(range(0, max(1, len(ws) - PASSAGE // 2), PASSAGE))
            for a, b in zip(cuts, [*cuts[1:], len(ws)]):
                passages.append((n, np.array([term[w] for w in ws[a:b]], dtype=np.int32)))
        answers = [tokens(a) or _last_sentence(t) for _, t, a in kept]
        return Items([i for i, _, _ in kept], words, answers, term, len(seen), passages)


@dataclass
class Index:
    items: Items
    vectors: np.ndarray   # term -> weight times latent directions
    queries: np.ndarray   # latent passage vectors
    item: np.ndarray      # passage -> item
    weight: np.ndarray | None = None  # term -> weight; without weights no item is held by the space

    def __post_init__(self):
        self.norm = np.sqrt((self.queries ** 2).sum(axis=1))
        self.first = np.searchsorted(self.item, np.arange(len(self.items.words) + 1))
        own = [np.array([self.items.term[w] for w in ws], dtype=np.int64) for ws in self.items.words]
        self.sets = [np.unique(t, return_counts=True) for t in own]
        self.need = np.array([np.ceil(LIKELY * t.size - 1e-6) for t in own], dtype=np.int64)
        self.reach = 2 * PASSAGE + 2 * max((t.size for t in own), default=0)
        self._latent()
        self._signatures(own)

    def _latent(self) -> None:
        """Latent vectors of the items that the space holds, and their bounds.

        ``q`` has weight times occurrences for each of an item's terms, ``x``
        the weight of each term of a stretch.  With ``r`` the part of ``q``
        outside the space, ``q.x`` is the latent product plus ``r.x``, which is
        at most ``|r||x|``.  A stretch with ``need`` of the item's words has a
        ``q.x`` of at least the sum of the ``need`` least squared weights."""
        self.held = np.zeros(0, dtype=np.int64)
        if self.weight is None or not self.sets or not self.weight.all():
            return
        directions = self.vectors / self.weight[:, None]
        least = np.array([np.sort(np.repeat(self.weight[t].astype(np.float64) ** 2, c))[:k].sum()
                          for (t, c), k in zip(self.sets, self.need)])
        held, whole, outside = [], [], []
        part = max(1, (1 << 22) // self.weight.size)
        for i in range(0, len(self.sets), part):
            own = self.sets[i:i + part]
            q = np.zeros((self.weight.size, len(own)), dtype=np.float32)
            for k, (t, c) in enumerate(own):
                q[t, k] = c * self.weight[t]
            latent, length = directions.T @ q, np.linalg.norm(q, axis=0).astype(np.float64)
            r = np.linalg.norm(q - directions @ latent, axis=0).astype(np.float64)
            good = r <= OUTSIDE * length
            held.append(i + np.flatnonzero(good))
            whole.append(latent[:, good])
            outside.append((r + 1e-4 * length)[good])  # more than single precision loses
        self.held, self.whole = np.concatenate(held), np.concatenate(whole, axis=1)
        self.outside, self.floor = np.concatenate(outside), least[self.held]

    def _signatures(self, own: list[np.ndarray]) -> None:
        """Postings term -> (item, times) of the rarer words of each item that
        the space does not hold.

        A verified item has at least ``LIKELY`` of its words around a window.
        So at most ``miss`` of them are absent, and of any ``miss + least`` of
        its words at least ``least`` are there: no item is lost, whichever
        words are taken.  The words that the fewest items have make the
        shortest lists."""
        shared = np.bincount(np.concatenate([t for t, _ in self.sets]) if own else np.zeros(0, dtype=np.int64),
                             minlength=len(self.items.term))
        self.least = np.array([min(n, max(1, int(SIGNATURE * t.size))) for t, n in zip(own, self.need)],
                              dtype=np.int64)
        terms, items, times = [], [], []
        for n in np.setdiff1d(np.arange(len(own)), self.held).tolist():
            t = own[n]
            rare = t[np.lexsort((t, shared[t]))][:t.size - self.need[n] + self.least[n]]
            u, c = np.unique(rare, return_counts=True)
            terms.append(u)
            items.append(np.full(u.size, n))
            times.append(c)
        flat = np.concatenate(terms) if terms else np.zeros(0, dtype=np.int64)
        order = np.argsort(flat, kind="stable")
        self.start = np.searchsorted(flat[order], np.arange(len(self.items.term) + 1))
        self.post_item = np.concatenate(items)[order] if items else np.zeros(0, dtype=np.int64)
        self.post_times = np.concatenate(times)[order] if times else np.zeros(0, dtype=np.int64)

    def hits(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """(item, cosine, share of the item's words, share of its answer)."""
        words = tokens(text)
        if not words or not self.items.words:
            return []
        ids = np.fromiter(map(self.items.term.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        at = np.flatnonzero(ids >= 0)
        if not at.size:
            return []
        out = []
        for n in self._likely(ids, at):
            # every window with enough of the item's words around it, the nearest first
            windows = self._windows(n, ids, at, len(words))
            for w, cos in self._ranked(n, ids, windows):
                told = self._verified(n, words, w)
                if told:
                    out.append((n, cos, *told))
                    break
        return out

    def _likely(self, ids: np.ndarray, at: np.ndarray) -> list[int]:
        """Items proposed for one stretch of the text or more, by cosine or by
        list; stretches overlap by what is compared around a window."""
        span = max(SPAN, 2 * self.reach)
        found: set[int] = set()
        for a in range(0, ids.size, span - self.reach):
            low, high = np.searchsorted(at, (a, a + span))
            if low < high:
                u = np.unique(ids[at[low:high]])
                found.update(self._near(u))
                if self.post_item.size:
                    found.update(self._listed(u))
            if a + span >= ids.size:
                break
        return sorted(found)

    def _near(self, terms: np.ndarray) -> list[int]:
        """Held items whose latent cosine to a stretch with these terms is at
        least the least one that a stretch with enough of their words can have
        (both sides times the lengths of the two vectors)."""
        if not self.held.size:
            return []
        product = self.vectors[terms].sum(axis=0) @ self.whole
        length = float(np.sqrt((self.weight[terms].astype(np.float64) ** 2).sum()))
        return self.held[product + self.outside * length >= self.floor].tolist()

    def _listed(self, terms: np.ndarray) -> list[int]:
        """Items not held that have enough words of their signature among these terms."""
        sizes = self.start[terms + 1] - self.start[terms]
        ends = np.cumsum(sizes)
        if not ends[-1]:
            return []
        post = np.arange(ends[-1]) + np.repeat(self.start[terms] - ends + sizes, sizes)
        met = np.bincount(self.post_item[post], self.post_times[post], self.least.size)
        return np.flatnonzero(met >= self.least).tolist()

    def _windows(self, n: int, ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Windows around which enough words of item ``n`` stand, each counted
        at most as often as the item has it."""
        terms, times = self.sets[n]
        where = np.minimum(np.searchsorted(terms, ids[at]), terms.size - 1)
        mine = terms[where] == ids[at]
        position, where = at[mine], where[mine]
        if position.size < self.need[n]:
            return np.zeros(0, dtype=np.int64)
        m = len(self.items.words[n])
        w = np.arange(-(-size // PASSAGE))
        low = np.searchsorted(position, w * PASSAGE - m)
        high = np.searchsorted(position, (w + 2) * PASSAGE + m)
        w = np.flatnonzero(high - low >= self.need[n])
        enough = []
        for i in range(0, w.size, 4096):
            lo, hi = low[w[i:i + 4096]], high[w[i:i + 4096]]
            first, last = lo[0], hi[-1]
            met = np.zeros((last - first + 1, terms.size), dtype=np.int32)
            met[np.arange(1, last - first + 1), where[first:last]] = 1
            np.cumsum(met, axis=0, out=met)
            count = np.minimum(met[hi - first] - met[lo - first], times).sum(axis=1)
            enough.append(w[i:i + 4096][count >= self.need[n]])
        return np.concatenate(enough) if enough else np.zeros(0, dtype=np.int64)

    def _ranked(self, n: int, ids: np.ndarray, windows: np.ndarray) -> list[tuple[int, float]]:
        """Windows with their best latent cosine to a passage of item ``n``."""
        if not windows.size:
            return []
        queries = self.queries[self.first[n]:self.first[n + 1]]
        norm = self.norm[self.first[n]:self.first[n + 1]]
        cosine = np.zeros(windows.size)
        for k, w in enumerate(windows):
            own = ids[w * PASSAGE:(w + 2) * PASSAGE]
            x = self.vectors[own[own >= 0]].sum(axis=0)
            size = float(np.sqrt((x ** 2).sum()))
            if size > 0 and norm.size and norm.max() > 0:
                cosine[k] = max(0.0, float((queries @ x / np.maximum(norm, 1e-12)).max()) / size)
        order = np.lexsort((windows, -cosine))
        return [(int(windows[k]), float(cosine[k])) for k in order]

    def _verified(self, n: int, words: list[bytes], w: int) -> tuple[float, float] | None:
        """Shares of item ``n`` and of its answer around window ``w``."""
        pattern, answer = self.items.words[n], self.items.answers[n]
        m = len(pattern)
        around = words[max(0, w * PASSAGE - m):(w + 2) * PASSAGE + m]
        share = lcs(pattern, around) / m
        if share < LIKELY:
            return None
        told = lcs(answer, around) / len(answer)
        return (share, told) if share >= SURE or told >= ANSWER else None


def _frequencies(docs: DataFrame, items: Items, text_col: str) -> tuple[np.ndarray, int]:
    """Corpus passages with each term, and all corpus passages."""
    term, size = docs.sparkSession.sparkContext.broadcast(items.term), items.size

    def run(batches):
        count, total = np.zeros(size, dtype=np.int64), 0
        get = term.value.get
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                words = tokens(t)
                total += -(-len(words) // PASSAGE)
                ids = np.fromiter(map(get, words, repeat(-1)), dtype=np.int64, count=len(words))
                at = np.flatnonzero(ids >= 0)
                if at.size:
                    count += np.bincount(np.unique(at // PASSAGE * size + ids[at]) % size, minlength=size)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some]), pa.array(np.r_[total, count[some]])], ["t", "n"])

    got = (docs.select(F.col(text_col).cast("string")).mapInArrow(run, "t bigint, n bigint")
           .groupBy("t").agg(F.sum("n").alias("n")).toArrow())
    count, total = np.zeros(size, dtype=np.int64), 0
    for t, n in zip(got.column("t").to_pylist(), got.column("n").to_pylist()):
        if t < 0:
            total = n
        else:
            count[t] = n
    return count, total


def randomised_svd(rows: DataFrame, size: int, rank: int) -> np.ndarray:
    """Leading right singular vectors (size x rank) of the sparse matrix whose
    ``rows(terms array<int>, weights array<float>)`` are spread over Spark."""
    spark = rows.sparkSession
    width = min(size, rank + EXTRA)
    basis = np.random.default_rng(5).standard_normal((size, width)).astype(np.float32)

    def product(matrix: np.ndarray) -> np.ndarray:
        """A'(A matrix): one distributed pass, one sum per partition."""
        shared = spark.sparkContext.broadcast(matrix)

        def run(batches):
            m = shared.value
            out = np.zeros(m.shape, dtype=np.float32)
            for b in batches:
                for t, v in zip(b.column(0), b.column(1)):
                    t, v = t.values.to_numpy(), v.values.to_numpy()
                    out[t] += v[:, None] * (v @ m[t])
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["z"])

        total = np.zeros(matrix.shape, dtype=np.float64)
        for r in rows.mapInArrow(run, "z binary").toLocalIterator():
            total += np.frombuffer(r["z"], dtype=np.float32).reshape(matrix.shape)
        shared.unpersist()
        return total

    for _ in range(1 + POWER):
        basis = np.linalg.qr(product(basis))[0].astype(np.float32)
    small = basis.T.astype(np.float64) @ product(basis)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(-value)[:rank]
    top = top[value[top] > 1e-6 * max(float(value.max(initial=0.0)), 1e-12)]
    return (basis @ vector[:, top]).astype(np.float32)


def build(docs: DataFrame, items: Items, text_col: str = "text", rank: int | None = None) -> Index:
    spark = docs.sparkSession
    count, total = _frequencies(docs, items, text_col)
    idf = np.log1p(total / (1 + count)).astype(np.float32)   # frequent terms weigh little, none nothing
    sparse, owner = [], []
    for n, ids in items.passages:
        terms, tf = np.unique(ids, return_counts=True)
        sparse.append((terms, (tf * idf[terms]).astype(np.float32)))
        owner.append(n)
    if not sparse:
        return Index(items, np.zeros((items.size, 1), np.float32), np.zeros((0, 1), np.float32),
                     np.zeros(0, int))
    parts = -(-len(sparse) // 5000)
    rows = spark.createDataFrame([(t.tolist(), [float(x) for x in v]) for t, v in sparse],
                                 "terms array<int>, weights array<float>").repartition(parts)
    directions = randomised_svd(rows, items.size, rank or max(1, min(len(sparse), CELLS // items.size - EXTRA)))
    vectors = directions * idf[:, None]
    queries = np.stack([(v[:, None] * directions[t]).sum(axis=0) for t, v in sparse])
    return Index(items, np.ascontiguousarray(vectors), queries.astype(np.float32), np.array(owner), idf)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).cast("string").alias("t"),
                            answer.alias("a")).where("t is not null")
    n_words = F.size(F.split("t", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    passages = rows.agg(F.sum(F.ceil(n_words / PASSAGE))).first()[0] or 0
    n = -(-passages // BLOCK)
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("t", "i"), F.lit(n)) == b)
        yield Items.of(sorted(map(tuple, part.collect()), key=lambda r: (r[0] is None, r[0], r[1])))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", rank: int | None = None) -> DataFrame:
    """One row per text and benchmark item found in it: ``(<id_col>,
    <item_col>, similarity, words_share, answer_share)``."""
    schema = (f"`{id_col}` {type_of(docs, id_col)}, `{item_col}` {type_of(benchmark, item_col)}, "
              "similarity double, words_share double, answer_share double")
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(build(docs, items, text_col, rank))
        item_type = out.schema[item_col].dataType

        def run(batches, shared=shared):
            from pyspark.sql.pandas.types import to_arrow_type

            index = shared.value
            for b in slices(batches):
                rows, found = [], []
                for r, t in enumerate(b.column(1).to_pylist()):
                    for hit in index.hits(t):
                        rows.append(r)
                        found.append(hit)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows, pa.int64())),
                     pa.array([index.items.ids[h[0]] for h in found], to_arrow_type(item_type)),
                     *(pa.array([h[k] for h in found], pa.float64()) for k in (1, 2, 3))],
                    [id_col, item_col, "similarity", "words_share", "answer_share"])

        rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def _clean(shared):
    """Whether no item of the broadcast index is found, by text.  Only texts go
    to Python and only flags come back: the rows stay in the JVM."""

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        index, keep = shared.value, []
        for i in range(0, len(texts), 512):
            keep += [not index.hits(t) for t in texts.slice(i, 512).to_pylist()]
        return pa.array(keep, pa.bool_())

    return clean


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", rank: int | None = None) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark item is found."""
    whole = docs  # frequencies are those of all rows, for every block
    for items in _blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(build(whole, items, text_col, rank))
        docs = docs.where(_clean(shared)(F.col(text_col).cast("string")))
    return docs
