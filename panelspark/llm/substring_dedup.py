"""Removal of word windows that occur more than once, by recompression.

Every text is a sequence of word names.  A round renames it twice: a maximal
run of one symbol becomes the name of (symbol, length), then each symbol is
dealt to a left or a right class and a left one followed by a right one becomes
the name of the pair.  A name is a hash of what it stands for, so all tasks
give the same names without a dictionary, and equal word sequences get equal
symbols but at their rims.  How far a symbol depends on its neighbours is kept
as its *context*: the words that fix it wherever they stand.  A window of
``window`` words therefore holds the same symbols of the top level, those with
their context inside it, wherever it stands; it takes the one of the least
name as its anchor (a lower level where it holds none: runs longer than the
window, rims of odd texts; single words in the end).  Equal windows take equal
anchors, so only windows whose anchor's context occurs twice can be repeated.

1. Contexts are counted (one pre-aggregated shuffle of 8-byte keys); those
   found twice go into a bounded bit filter (``bitfilter``).
2. Each text writes its anchors that hit the filter, with the digest of the
   *span* of all consecutive windows that share the anchor.
3. Spans found twice are repeated as a whole.  Where one anchor has several
   different spans (the rims of a repeat), one window after the other is
   compared by its 128-bit digest, one copy of each span.
4. The words of repeated windows go.  Only texts with an anchor found twice
   move; copies of a whole text are told by their digest.

Digests are 128 bits of the words themselves; a collision of the shorter names
costs a comparison, never a wrong result.

Edge cases: a null or blank text has no words; texts shorter than a window stay
whole; repeated rows and null ids are rows like any other, each row has its
result; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import bitfilter
from panelspark.llm.bitfilter import mix
from panelspark.llm.common import slices, stored, type_of

WINDOW, ROUNDS = 35, 3
CHUNK_BYTES = 1 << 20   # text parsed together
_EDGE = np.uint64(0)    # the symbol between two texts
_SALTS = mix(np.arange(1, 65, dtype=np.uint64))  # one for each round's classes
_BYTE_HASH = mix(np.arange(1, 32 * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True  # fixed values: the blanks of the contracts


def _taken_apart(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts: ``(bytes, start, end, text, name)``.  ``bytes``
    has one space behind each word, the others per word: its place there, the
    number of its text, and its name, a sum of hashes of its bytes by place."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    blank = _BLANK[raw]
    begin = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    ends = np.flatnonzero(blank & np.append(False, ~blank[:-1]))
    size = ends - begin
    start = np.cumsum(size + 1) - size - 1
    keep = ~blank
    keep[ends] = True
    joined = raw[keep]
    joined[start + size] = 32
    first = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    text = np.searchsorted(first, begin, "right")
    inner = raw[~blank]
    at = np.cumsum(size) - size
    place = np.arange(inner.size, dtype=np.int32) - np.repeat(at.astype(np.int32), size)
    value = _BYTE_HASH[((place & 31) << 8) | inner]
    name = mix(np.add.reduceat(value, at)) if at.size else np.zeros(0, dtype=np.uint64)
    name[name == _EDGE] = 1
    return joined, start, start + size, text, name


def _name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = mix(mix(a + np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xD6E8FEB86659FD93)))
    out[out == _EDGE] = 1
    return out


def _round(sym: np.ndarray, lo: np.ndarray, hi: np.ndarray, number: int):
    """One round of naming runs, then pairs; ``[lo, hi)`` is each symbol's context."""
    n = sym.size
    first = np.ones(n, dtype=bool)
    first[1:] = (sym[1:] != sym[:-1]) | (sym[1:] == _EDGE)
    start = np.flatnonzero(first)
    end = np.append(start[1:], n)
    length = end - start
    s = sym[start]
    run = length > 1
    s[run] = _name(s[run], length[run].astype(np.uint64))
    # a run ends where its neighbours differ: both belong to its context
    lo, hi = lo[np.maximum(start - 1, 0)], hi[np.minimum(end, n - 1)]
    side = mix(s + _SALTS[number]) >> np.uint64(63)
    inner = s != _EDGE
    left, right = inner & (side == 0), inner & (side == 1)
    pair = np.zeros(s.size, dtype=bool)
    pair[:-1] = left[:-1] & right[1:]
    head = np.ones(s.size, dtype=bool)
    head[1:] = ~pair[:-1]
    at = np.flatnonzero(head)
    out, both = s[at], pair[at]
    out[both] = _name(s[at[both]], s[at[both] + 1])
    # a left symbol looks at the next one, a right one at the one before
    new_lo = np.where(right[at], lo[np.maximum(at - 1, 0)], lo[at])
    new_hi = np.where(left[at], hi[np.minimum(at + 1, s.size - 1)], hi[at])
    return out, new_lo, new_hi


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the least value in each range ``[lo, hi)``, the first of equal ones."""
    size = hi - lo
    tables = [np.arange(values.size, dtype=np.int32)]
    while 2 << (len(tables) - 1) <= size.max(initial=1):
        t, step = tables[-1], 1 << (len(tables) - 1)
        a, b = t[:-step], t[step:]
        tables.append(np.where(values[b] < values[a], b, a))
    out = np.empty(size.size, dtype=np.int32)
    power = np.frexp(size.astype(np.float64))[1] - 1
    for k, t in enumerate(tables):
        own = np.flatnonzero(power == k)
        a, b = t[lo[own]], t[hi[own] - (1 << k)]
        out[own] = np.where(values[b] < values[a], b, a)
    return out


def anchors(sym: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> np.ndarray:
    """``(start, n, lo, hi)`` rows: ``n`` consecutive windows from ``start`` on
    share the anchor with context ``[lo, hi)``.  ``sym`` holds the names of the
    words with ``0`` before, between and behind texts."""
    n = sym.size
    edges = np.cumsum(sym == _EDGE)
    todo = np.arange(max(0, n - window + 1), dtype=np.int32)
    todo = todo[(edges[todo + window - 1] == edges[todo]) & (sym[todo] != _EDGE)]
    level = (sym, np.arange(n, dtype=np.int32), np.arange(1, n + 1, dtype=np.int32))
    levels = [level]
    for r in range(rounds):
        level = _round(*level, r)
        levels.append(level)
    found = []
    for s, lo, hi in reversed(levels):
        if not todo.size:
            break
        use = np.flatnonzero((s != _EDGE) & (hi - lo <= window))
        lo, hi, rank = lo[use], hi[use], mix(s[use])
        a, b = np.searchsorted(lo, todo, "left"), np.searchsorted(hi, todo + window, "right")
        has = b > a
        if has.any():
            best = _least(rank, a[has], b[has])
            found.append(np.stack([todo[has], lo[best], hi[best]]))
        todo = todo[~has]
    if not found:
        return np.zeros((0, 4), dtype=np.int64)
    at, lo, hi = np.concatenate(found, axis=1).astype(np.int64)
    if len(found) > 1:
        order = np.argsort(at, kind="stable")
        at, lo, hi = at[order], lo[order], hi[order]
    new = np.ones(at.size, dtype=bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return np.stack([at[first], np.diff(np.append(first, at.size)), lo[first], hi[first]], axis=1)


def _chunks(texts):
    """Lists of encoded texts of about ``CHUNK_BYTES`` together."""
    part, size = [], 0
    for text in texts:
        part.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(part[-1]) + 1
        if size >= CHUNK_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


class _Parsed:
    """The anchors of a chunk of texts and the bytes of their words.  Words and
    edges share one numbering: an edge before each text and behind the last."""

    def __init__(self, chunk: list[bytes], window: int, rounds: int):
        joined, start, end, text, name = _taken_apart(chunk)
        self.sizes = np.bincount(text, minlength=len(chunk))
        self.first = np.cumsum(self.sizes + 1) - self.sizes  # number of each text's first word
        at = np.arange(text.size) + text + 1
        sym = np.zeros(text.size + len(chunk) + 1, dtype=np.uint64)
        self.start, self.end = np.zeros(sym.size, dtype=np.int64), np.zeros(sym.size, dtype=np.int64)
        sym[at], self.start[at], self.end[at] = name, start, end
        self.text = joined.tobytes()
        self.rows = anchors(sym, window, rounds)
        body, h = self.text, xxhash.xxh64_intdigest
        a, b = self.start[self.rows[:, 2]].tolist(), self.end[self.rows[:, 3] - 1].tolist()
        self.keys = np.fromiter((h(body[i:j]) for i, j in zip(a, b)), dtype=np.uint64, count=len(a)).view(np.int64)

    def words(self, t: int) -> bytes:
        """The words of text ``t``, joined by one space."""
        a, n = int(self.first[t]), int(self.sizes[t])
        return self.text[self.start[a]:self.end[a + n - 1]] if n else b""


def _shared_keys(rows: DataFrame, window: int, rounds: int) -> DataFrame:
    def run(batches):
        for batch in slices(batches):
            for chunk in _chunks(batch.column(0).to_pylist()):
                keys, n = np.unique(_Parsed(chunk, window, rounds).keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])

    return (rows.select("text").mapInArrow(run, "key bigint, n bigint")
            .groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"))


_RECS = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("key", pa.int64()), ("span", pa.binary())]))


def _hits(rows: DataFrame, id_type: str, filt, window: int, rounds: int) -> DataFrame:
    """Per text: ``row`` (unique), ``id``, digest and count of its words,
    ``kept_sha256`` of all of them; ``words`` and ``recs`` only where one of
    its anchors hits the filter."""
    shared = rows.sparkSession.sparkContext.broadcast(filt)

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            done = 0
            for chunk in _chunks(batch.column(1).to_pylist()):
                p = _Parsed(chunk, window, rounds)
                found = shared.value.hits(p.keys)
                hit, keys = p.rows[found], p.keys[found]
                owner = np.searchsorted(p.first, hit[:, 0], "right") - 1
                cut = np.searchsorted(owner, np.arange(len(chunk) + 1)).tolist()
                a = p.start[hit[:, 0]].tolist()
                b = p.end[hit[:, 0] + hit[:, 1] + window - 2].tolist()
                span = [xxhash.xxh3_128_digest(p.text[i:j]) for i, j in zip(a, b)]
                start, size, key = (hit[:, 0] - p.first[owner]).tolist(), hit[:, 1].tolist(), keys.tolist()
                out = {k: [] for k in ("digest", "n_words", "kept_sha256", "words", "recs")}
                for t in range(len(chunk)):
                    text = p.words(t)
                    own = range(cut[t], cut[t + 1])
                    out["digest"].append(xxhash.xxh3_128_digest(text))
                    out["n_words"].append(int(p.sizes[t]))
                    out["kept_sha256"].append(sha256(text).hexdigest())
                    out["words"].append(text if own else None)
                    out["recs"].append([{"start": start[i], "n": size[i], "key": key[i], "span": span[i]}
                                        for i in own] if own else None)
                ids = batch.column(0).slice(done, len(chunk))
                done += len(chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + len(chunk)), pa.int64()), ids, pa.array(out["digest"], pa.binary()),
                     pa.array(out["n_words"], pa.int64()), pa.array(out["kept_sha256"], pa.string()),
                     pa.array(out["words"], pa.binary()), pa.array(out["recs"], _RECS)],
                    ["row", "id", "digest", "n_words", "kept_sha256", "words", "recs"])
                row += len(chunk)

    return rows.select("id", "text").mapInArrow(
        run, f"row bigint, id {id_type}, digest binary, n_words bigint, kept_sha256 string, words binary, "
             "recs array<struct<start:int,n:int,key:bigint,span:binary>>")


def _window_digests(rows: DataFrame, window: int) -> DataFrame:
    """``rows(row, words, spans)`` -> one row per window of the spans."""

    def run(batches):
        for batch in slices(batches):
            row, words, spans = (batch.column(i).to_pylist() for i in range(3))
            for r, text, own in zip(row, words, spans):
                ends = np.flatnonzero(np.frombuffer(text + b" ", dtype=np.uint8) == 32)
                size = np.array([s["n"] for s in own])
                at = np.repeat(np.array([s["start"] for s in own]) - np.cumsum(size) + size, size) + np.arange(size.sum())
                first = np.append(0, ends + 1)[at].tolist()
                last = ends[at + window - 1].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(at.size, r, dtype=np.int64)),
                     pa.array([xxhash.xxh3_128_digest(text[i:j]) for i, j in zip(first, last)], pa.binary()),
                     pa.array(at.astype(np.int32)),
                     pa.array(np.repeat(np.array([s["sure"] for s in own]), size))],
                    ["row", "digest", "at", "sure"])

    return rows.select("row", "words", "spans").mapInArrow(run, "row bigint, digest binary, at int, sure boolean")


def _cut(rows: DataFrame, id_type: str, window: int) -> DataFrame:
    """``rows(id, words, n_words, spans)`` -> the result without the words of the spans."""

    def run(batches):
        for batch in slices(batches):
            texts, n, spans = (batch.column(i).to_pylist() for i in (1, 2, 3))
            removed, kept = [], []
            for text, size, own in zip(texts, n, spans):
                gone = np.zeros(size + 1, dtype=np.int64)
                for s in own or ():
                    gone[s["start"]] += 1
                    gone[s["start"] + s["n"] - 1 + window] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                removed.append(int(size - stay.sum()))
                kept.append(b" ".join(w for w, k in zip(text.split(), stay.tolist()) if k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
                ["id", "n_words", "n_removed", "kept_sha256", "kept"])

    return rows.select("id", "words", "n_words", "spans").mapInArrow(
        run, f"id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string, kept binary")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 rounds: int = ROUNDS) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256, kept)`` per row; ``kept`` (UTF-8,
    words joined by one space) is null where nothing was removed."""
    id_type = type_of(docs, id_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = stored(_shared_keys(rows, window, rounds), "repeat-keys")
    filt = bitfilter.build(shared, shared.count())
    texts = stored(_hits(rows, id_type, filt, window, rounds), "repeat-texts")
    hit = texts.where("recs is not null")
    recs = hit.select("row", F.explode("recs").alias("r")).select("row", "r.*")

    spans = stored(recs.groupBy("key", "span").agg(F.count(F.lit(1)).alias("c"),
                                                   F.min(F.struct("row", "start", "n")).alias("rep")), "repeat-spans")
    several = spans.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
    lists = (spans.join(several, "key").select("rep.*", (F.col("c") > 1).alias("sure"))
             .groupBy("row").agg(F.collect_list(F.struct("start", "n", "sure")).alias("spans")))
    windows = stored(_window_digests(hit.select("row", "words").join(lists, "row"), window), "repeat-windows")
    again = (windows.groupBy("digest").agg(F.count(F.lit(1)).alias("m"), F.max("sure").alias("known"))
             .where("m > 1 or known").select("digest"))
    rims = windows.where("not sure").join(again, "digest").select("row", F.col("at").alias("start"), F.lit(1).alias("n"))

    copied = hit.groupBy("digest").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("digest")
    copies = stored(hit.select("row", "digest").join(copied, "digest").select("row"), "repeat-copies")
    whole = (recs.join(copies, "row", "left_anti").join(spans.where("c > 1").select("key", "span"), ["key", "span"])
             .select("row", "start", "n"))
    gone = (whole.unionByName(rims).groupBy("row")
            .agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    none = F.lit(None).cast("binary")
    cut = _cut(hit.join(copies, "row", "left_anti").join(gone, "row"), id_type, window)
    empty = hit.join(copies, "row", "left_semi").select(
        "id", "n_words", F.col("n_words").alias("n_removed"), F.lit(sha256(b"").hexdigest()).alias("kept_sha256"),
        F.lit(b"").alias("kept"))
    zero = F.lit(0).cast("bigint").alias("n_removed")
    same = ["id", "n_words", zero, "kept_sha256", none.alias("kept")]
    return (cut.unionByName(empty).unionByName(texts.where("recs is null").select(*same))
            .unionByName(hit.join(copies, "row", "left_anti").join(gone, "row", "left_anti").select(*same)))
