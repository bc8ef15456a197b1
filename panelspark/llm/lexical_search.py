"""Ranked lexical search by pipelined term partitioning.

The terms of the items are dealt to owners by document frequency, the rarest
first.  Bundles of items travel from owner to owner: each stage cogroups a
bundle's sparse accumulators (item, document, score so far) with the posting
lists of its owner, adds integer contributions and sends on what can still be
among the best.  After the last owner each item's best documents are selected.

Documents are indexed in shards of at most ``SHARD_DOCS`` rows and about
``SHARD_BYTES`` of text, so that a bundle visits an owner shard by shard and
every group is of bounded size; a posting list is packed by shard.

What can still be among the best is exact.  A shard keeps, per term, the
highest term frequency and the least ratio of length to frequency, which bound
the term's contribution there.  A first run follows only each shard's ``k``
best documents by the rarest terms to their full scores; the score that ``k``
of those reach (by a histogram that Spark adds up) is a floor for the item.
The second run starts from every document and drops an accumulator only if its
score and the bounds of the owners ahead stay under the floor.

Items are taken in blocks of ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` terms
(an item with more terms is a block of its own); only a block's terms are
broadcast.

Edge cases: null and termless texts are not counted and never found; items
without terms, or whose terms no document has, give no rows; rows that repeat
are ranked each; a null document id stands behind the others of its score; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import stored, type_of

TOP, STAGES, BUNDLE = 50, 4, 256
SHARD_DOCS, SHARD_BYTES = 2048, 1 << 24
BLOCK_ITEMS, BLOCK_TERMS = 1024, 1 << 17
# ASCII letters (lower-cased) and digits and all other scripts
# make terms, any other ASCII character parts them.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class _Known(dict):
    def __missing__(self, term: bytes) -> int:
        return -1


class Block:
    """The items of one block: numbered terms, and each bundle's item terms."""

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        self.ids, self.bundle = [i for i, _ in items], BUNDLE
        self.number = _Known()
        for _, ts in items:
            for t in ts:
                self.number.setdefault(t, len(self.number))
        own = [np.array([self.number[t] for t in ts], dtype=np.int64) for _, ts in items]
        # flat (item in bundle, term) pairs of each bundle, by term
        self.pairs = []
        for b in range(0, len(own), BUNDLE):
            part = own[b:b + BUNDLE]
            item = np.repeat(np.arange(len(part)), [x.size for x in part])
            term = np.concatenate(part)
            order = np.argsort(term, kind="stable")
            self.pairs.append((len(part), item[order], term[order]))

    def weigh(self, n: int, total: int, df: dict[int, int], stages: int) -> None:
        """Weights and owners; owners hold equal numbers of postings, rarest terms first."""
        size = len(self.number)
        self.n, self.total = n, total
        self.df = np.array([df.get(t, 0) for t in range(size)], dtype=np.int64)
        self.weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in self.df], np.int64)
        order = np.argsort(self.df, kind="stable")
        before = np.cumsum(self.df[order]) - self.df[order]
        self.owner = np.empty(size, dtype=np.int64)
        self.owner[order] = np.minimum(stages - 1, before * stages // max(1, int(self.df.sum())))


def item_blocks(items: DataFrame, item_col: str, text_col: str):
    """Blocks of items with terms; only one block is held at a time."""
    part, seen = [], set()
    for row in items.select(F.col(item_col), F.col(text_col).cast("string")).toLocalIterator():
        own = list(dict.fromkeys(terms(row[1])))
        if not own:
            continue
        if part and (len(part) >= BLOCK_ITEMS or len(seen | set(own)) > BLOCK_TERMS):
            yield Block(part)
            part, seen = [], set()
        part.append((row[0], own))
        seen |= set(own)
    if part:
        yield Block(part)


def _index(docs: DataFrame, id_col: str, text_col: str, block: Block) -> DataFrame:
    """Packed posting lists ``(shard, tid, docs, tfs)`` and, under ``tid`` -1,
    what a shard knows of itself: ids, lengths and the bounds of its terms."""
    number = docs.sparkSession.sparkContext.broadcast(dict(block.number))
    known: list[_Known] = []
    id_type = type_of(docs, id_col)

    def shard(name: int, ids: list, texts: list[list[bytes]], lookup: _Known):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        flat = [w for t in texts for w in t]
        tid = np.fromiter(map(lookup.__getitem__, flat), dtype=np.int64, count=len(flat))
        doc = np.repeat(np.arange(len(texts)), sizes)
        used = tid >= 0
        key, tf = np.unique(tid[used] * SHARD_DOCS + doc[used], return_counts=True)
        tid, doc = key // SHARD_DOCS, key % SHARD_DOCS
        first = np.flatnonzero(np.r_[True, tid[1:] != tid[:-1]]) if tid.size else np.zeros(0, np.int64)
        cut = np.append(first, tid.size)
        top = np.maximum.reduceat(tf, first) if tid.size else tf
        least = np.minimum.reduceat(sizes[doc] / tf, first) if tid.size else np.zeros(0)
        d, f = doc.astype("<u2"), tf.astype("<u4")
        rows = first.size
        docs_ = [None] + [d[cut[i]:cut[i + 1]].tobytes() for i in range(rows)]
        tfs = [None] + [f[cut[i]:cut[i + 1]].tobytes() for i in range(rows)]
        none = [None] * rows
        return pa.RecordBatch.from_arrays([
            pa.array([name] * (rows + 1), pa.int64()),
            pa.array(np.r_[-1, tid[first]].astype(np.int32)),
            pa.array(docs_, pa.binary()), pa.array(tfs, pa.binary()),
            pa.array([sizes.astype("<i8").tobytes()] + none, pa.binary()),
            pa.array([ids] + none, out.field("ids").type),
            pa.array([tid[first].astype("<i4").tobytes()] + none, pa.binary()),
            pa.array([top.astype("<i8").tobytes()] + none, pa.binary()),
            pa.array([least.astype("<f8").tobytes()] + none, pa.binary()),
            pa.array([int((sizes > 0).sum())] + none, pa.int64()),
            pa.array([int(sizes.sum())] + none, pa.int64())], schema=out)

    def run(batches):
        if not known:
            known.append(_Known(number.value))
        name = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(terms(text))
                size += len(text or "")
                if len(ids) == SHARD_DOCS or size >= SHARD_BYTES:
                    yield shard(name, ids, texts, known[0])
                    name, ids, texts, size = name + 1, [], [], 0
        if ids:
            yield shard(name, ids, texts, known[0])

    schema = (f"shard bigint, tid int, docs binary, tfs binary, sizes binary, ids array<{id_type}>, tids binary, "
              "top binary, least binary, n_docs bigint, n_terms bigint")
    from pyspark.sql.pandas.types import to_arrow_schema
    out = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def bucket(scores: np.ndarray) -> np.ndarray:
    """Histogram bucket of a positive score; 64 buckets to each power of two."""
    part, power = np.frexp(scores.astype(np.float64))
    return power.astype(np.int64) * 64 + ((part - 0.5) * 128).astype(np.int64)


def bucket_floor(number: int) -> int:
    return math.ceil((0.5 + number % 64 / 128) * 2.0 ** (number // 64))


class _Stage:
    """What an owner does with a bundle in one shard."""

    def __init__(self, block: Block, stage: int, floor: np.ndarray | None, k: int, last: bool):
        self.block, self.stage, self.floor, self.k, self.last = block, stage, floor, k, last

    def ahead(self, bundle: int, info: dict, stage: int) -> np.ndarray:
        """Per item, the most that the owners from ``stage`` on can add in this shard."""
        b = self.block
        tid = np.frombuffer(info["tids"], "<i4").astype(np.int64)
        top, least = np.frombuffer(info["top"], "<i8"), np.frombuffer(info["least"], "<f8")
        most = np.zeros(b.df.size)
        m = 49 / top + 50 * (b.n / b.total) * least * (1 - 1e-9)  # least length norm per occurrence
        most[tid] = b.weight[tid] * (1e9 / (1000 + 20 * m) + 1)
        size, item, term = b.pairs[bundle]
        return np.bincount(item, weights=most[term] * (b.owner[term] >= stage), minlength=size) * (1 + 1e-9) + 1

    def add(self, bundle: int, left: pa.Table | None, right: pa.Table):
        """``(info, acc)``: scores by item and document after this owner."""
        b = self.block
        tids = right.column("tid").to_numpy()
        info = {c: right.column(c)[int(np.flatnonzero(tids == -1)[0])].as_py()
                for c in ("sizes", "ids", "tids", "top", "least")}
        n = np.frombuffer(info["sizes"], "<i8")
        m = 50 + 50 * n * b.n // b.total
        size, item, term = b.pairs[bundle]
        acc = np.zeros((size, n.size), dtype=np.int64)
        if left is not None and left.num_rows:
            row = {c: np.frombuffer(left.column(c)[0].as_py(), kind)
                   for c, kind in (("items", "<u2"), ("at", "<u2"), ("scores", "<i8"))}
            acc[row["items"], row["at"]] = row["scores"]
        alive = acc > 0
        docs, tfs = right.column("docs"), right.column("tfs")
        for r in np.flatnonzero(tids >= 0):
            t = tids[r]
            at = np.frombuffer(docs[int(r)].as_py(), "<u2").astype(np.int64)
            tf = np.frombuffer(tfs[int(r)].as_py(), "<u4").astype(np.int64)
            own = item[np.searchsorted(term, t, "left"):np.searchsorted(term, t, "right")]
            acc[own[:, None], at] += b.weight[t] * (1_000_000_000 * tf // (1000 * tf + 20 * m[at]))
        if self.floor is None:  # first run: documents come in with the rarest terms only
            if self.stage:
                acc[~alive] = 0
            elif n.size > self.k:
                least = np.partition(acc, n.size - self.k, axis=1)[:, n.size - self.k]
                acc[acc < least[:, None]] = 0
        else:
            floor = self.floor[bundle * b.bundle:bundle * b.bundle + size]
            closed = self.ahead(bundle, info, self.stage) < floor  # nothing new can reach the floor
            acc[closed[:, None] & ~alive] = 0
            rest = 0 if self.last else self.ahead(bundle, info, self.stage + 1)[:, None]
            acc[acc + rest < floor[:, None]] = 0
        return info, acc

    def start(self):
        def run(key, right):
            return self.result(key, None, right)
        return run

    def visit(self):
        def run(key, left, right):
            return self.result(key, left, right)
        return run

    def result(self, key, left: pa.Table | None, right: pa.Table) -> pa.Table:
        bundle, shard = key[0].as_py(), key[1].as_py()
        info, acc = self.add(bundle, left, right)
        if not self.last:
            item, at = np.nonzero(acc)
            blobs = [item.astype("<u2").tobytes(), at.astype("<u2").tobytes(), acc[item, at].astype("<i8").tobytes()]
            rows = int(item.size > 0)
            return pa.table([pa.array([bundle] * rows, pa.int32()), pa.array([shard] * rows, pa.int64()),
                             *(pa.array([x] * rows, pa.binary()) for x in blobs)],
                            names=["bundle", "shard", "items", "at", "scores"])
        if self.floor is None:
            item, at = np.nonzero(acc)
            pair, n = np.unique(np.stack([item + bundle * self.block.bundle, bucket(acc[item, at])]), axis=1, return_counts=True)
            return pa.table([pa.array(pair[0].astype(np.int32)), pa.array(pair[1].astype(np.int32)),
                             pa.array(n.astype(np.int64))], names=["item", "bucket", "n"])
        out: list[list] = [[], [], []]
        for i, scores in enumerate(acc):
            at = np.flatnonzero(scores)
            if at.size > self.k:
                least = np.partition(scores[at], at.size - self.k)[at.size - self.k]
                at = at[scores[at] >= least]
            best = sorted(((-int(scores[j]), info["ids"][j] is None, info["ids"][j]) for j in at),
                          key=lambda x: x[:2] + ((0,) if x[1] else (x[2],)))[:self.k]
            out[0] += [i + bundle * self.block.bundle] * len(best)
            out[1] += [x[2] for x in best]
            out[2] += [-x[0] for x in best]
        kind = right.schema.field("ids").type.value_type
        return pa.table([pa.array(out[0], pa.int32()), pa.array(out[1], kind), pa.array(out[2], pa.int64())],
                        names=["item", "doc", "score"])


def _travel(index: DataFrame, block: Block, id_type: str, floor: np.ndarray | None, k: int, stages: int) -> DataFrame:
    """One run of all bundles through the owners."""
    spark = index.sparkSession
    bundles = list(range(len(block.pairs)))
    where = sorted({(int(t), b, int(block.owner[t])) for b, (_, _, term) in enumerate(block.pairs) for t in term})
    route = F.broadcast(spark.createDataFrame(where, "tid int, bundle int, owner int"))  # at most BLOCK_TERMS a bundle
    info = index.where("tid = -1").withColumn("bundle", F.explode(F.array(*[F.lit(b) for b in bundles])))
    lists = index.where("tid >= 0").join(route, "tid")
    cols = ["bundle", "shard", "tid", "docs", "tfs", "sizes", "ids", "tids", "top", "least"]
    carried = None
    for s in range(stages):
        last = s == stages - 1
        right = lists.where(F.col("owner") == s).select(cols).unionByName(info.select(cols)).groupBy("bundle", "shard")
        step = _Stage(block, s, floor, k, last)
        schema = ("bundle int, shard bigint, items binary, at binary, scores binary" if not last else
                  "item int, bucket int, n bigint" if floor is None else f"item int, doc {id_type}, score bigint")
        if carried is None:
            carried = right.applyInArrow(step.start(), schema)
        else:
            carried = carried.groupBy("bundle", "shard").cogroup(right).applyInArrow(step.visit(), schema)
    return carried


def _floors(histogram: DataFrame, items: int, k: int) -> np.ndarray:
    """Per item, a score that at least ``k`` documents reach; 1 where fewer are known."""
    out = np.ones(items, dtype=np.int64)
    left = np.full(items, k)
    rows = histogram.groupBy("item", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pylist()
    for r in sorted(rows, key=lambda r: (r["item"], -r["bucket"])):
        if left[r["item"]] > 0:
            left[r["item"]] -= min(r["n"], left[r["item"]])
            if left[r["item"]] == 0:
                out[r["item"]] = max(1, bucket_floor(r["bucket"]))
    return out


def _ranked_block(docs: DataFrame, block: Block, id_col: str, text_col: str, item_type: str, k: int,
                  stages: int) -> DataFrame | None:
    spark = docs.sparkSession
    index = stored(_index(docs, id_col, text_col, block), "lexical-index")
    n, total = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not n:
        return None
    df = {r["tid"]: r["df"] for r in index.where("tid >= 0").groupBy("tid")
          .agg(F.sum(F.octet_length("docs") / 2).cast("bigint").alias("df")).toArrow().to_pylist()}
    block.weigh(n, total, df, stages)
    id_type = type_of(docs, id_col)
    floor = _floors(_travel(index, block, id_type, None, k, stages), len(block.ids), k)
    found = stored(_travel(index, block, id_type, floor, k, stages), "lexical-found")
    # each shard sends at most k rows an item; parts are ranked before the whole
    parts = max(1, math.isqrt(index.where("tid = -1").count()))
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    some = (found.withColumn("part", F.pmod(F.xxhash64("doc", "score"), F.lit(parts)))
            .withColumn("r", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
            .where(F.col("r") <= k))
    best = (some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= k))
    names = spark.createDataFrame([(i, x) for i, x in enumerate(block.ids)], f"item int, item_id {item_type}")
    return best.join(F.broadcast(names), "item").select(  # at most BLOCK_ITEMS rows
        "item_id", "rank", F.col("doc").alias("doc_id"), "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", stages: int = STAGES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents."""
    item_type = type_of(items, item_col)
    out = None
    for block in item_blocks(items, item_col, item_text_col):
        part = _ranked_block(docs, block, id_col, text_col, item_type, k, stages)
        if part is not None:
            part = stored(part, "lexical-ranked")
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame(
            [], f"item_id {item_type}, rank int, doc_id {type_of(docs, id_col)}, score bigint")
    return out
