"""SimHash near-duplicates over a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints that differ
in at most ``max_bits`` bits differ in at most that many bytes, so at least
``8 - max_bits`` positional bytes are equal: the guaranteed minimum of the
count filter.  One posting list per single byte value would hold a 256th of
all fingerprints, so the index keeps lists per *group* of positional bytes:
of five equal bytes, three lie in the same half of the eight, hence the eight
3-byte groups of the two halves lose no pair.  Within a list the equal
positional bytes of a pair are tallied, pairs below the minimum go, and the
rest are verified by their bit distance.

Lists longer than ``block`` are keyed anew by every group of
``8 - max_bits`` bytes that contains theirs, so that only the remaining bytes
vary; in a list that is still long, the neighbours of a fingerprint are looked
up by flipping bits, which takes a time in proportion to the list.  A list
yields star edges (one per member), never its pairs.

Edge cases: a null text is empty; a text without words has fingerprint zero
and links like any other; a null id keeps its row and takes the least id of
its component, or null where no member has one; repeated rows are equal
fingerprints; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelspark.llm.common import slices, stored, type_of
from panelspark.llm.components import components

SHINGLE, MAX_BITS, BLOCK = 3, 3, 2048
EXACT_IDS = 1 << 18  # dropped ids that may be broadcast themselves
FILTER_WORDS = 1 << 20  # words of 64 bits in the filter of more dropped ids
SEED = 42  # fixed value: the seed of the shingle hash


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one text."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only, both
    if not ws:
        return 0
    join, h = b" ".join, xxhash.xxh64_intdigest
    grams = zip(*(ws[i:] for i in range(shingle))) if len(ws) >= shingle else (ws,)
    hashes = np.fromiter((h(join(g), SEED) for g in grams), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, hashes.size, 8192):  # bounded memory for very long texts
        part = hashes[i:i + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > hashes.size).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` per row of ``docs``."""

    def run(batches):
        for b in slices(batches):
            fps = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {type_of(docs, id_col)}, fp bigint")


def _key(fp: Column, code: int, group: tuple[int, ...]) -> Column:
    """Group code above the group's positional bytes, as one long."""
    key = F.lit(code).cast("bigint")
    for p in group:
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fp, 8 * (7 - p)).bitwiseAND(F.lit(255)))
    return key


def half_groups(minimum: int) -> list[tuple[int, ...]]:
    """Groups of which ``minimum`` equal bytes out of eight must hold one."""
    size = -(-minimum // 2)
    return [g for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for g in combinations(half, size)]


def _close(a: np.ndarray, b: np.ndarray, minimum: int, max_bits: int) -> np.ndarray:
    x = a[:, None] ^ b[None, :]
    # the tally of equal bytes first; only pairs that reach the minimum are verified
    near = (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=2, dtype=np.uint8) >= minimum
    near[near] = np.bitwise_count(x[near]) <= max_bits
    return near


def list_stars(fps: np.ndarray, minimum: int, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(root, members) of the link components within one posting list."""
    left, out = np.unique(fps.astype(np.int64).view(np.uint64)), []
    if left.size < 2:
        return out
    flips = None
    varying = np.bitwise_or.reduce(left ^ left[0])
    bits = [np.uint64(1) << np.uint64(i) for i in range(64) if int(varying) >> i & 1]
    n_flips = sum(_choose(len(bits), k) for k in range(1, max_bits + 1))
    if left.size > max(BLOCK, n_flips // 4):
        flips = np.array([np.bitwise_or.reduce(np.array(c, dtype=np.uint64))
                          for k in range(1, max_bits + 1) for c in combinations(bits, k)], dtype=np.uint64)
    while left.size:
        front, left, members = left[:1], left[1:], []
        root = front
        while front.size and left.size:
            hit = np.zeros(left.size, dtype=bool)
            for i in range(0, front.size, 128):
                if flips is None:
                    for j in range(0, left.size, 4096):
                        hit[j:j + 4096] |= _close(front[i:i + 128], left[j:j + 4096], minimum, max_bits).any(axis=0)
                else:
                    near = (front[i:i + 128, None] ^ flips[None, :]).ravel()
                    at = np.searchsorted(left, near)
                    at[at == left.size] = 0
                    hit[at[left[at] == near]] = True
            front, left = left[hit], left[~hit]
            if front.size:
                members.append(front)
        if members:
            out.append((root, np.concatenate(members)))
    return out


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _stars(lists: DataFrame, minimum: int, max_bits: int) -> DataFrame:
    def run(batches):
        for b in batches:
            roots, ends = [], []
            for fps in b.column(0):
                for root, members in list_stars(fps.values.to_numpy(), minimum, max_bits):
                    ends.append(members.view(np.int64))
                    roots.append(np.repeat(root.view(np.int64), members.size))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (roots, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in flat], ["a", "b"])

    return lists.mapInArrow(run, "a bigint, b bigint")


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``fp`` whose components
    are those of all links at ``max_bits`` differing bits or fewer."""
    minimum = 8 - max_bits
    if not 1 <= minimum <= 7:
        raise ValueError("max_bits must be from 1 to 7")
    groups = half_groups(minimum)
    fp = F.col("fp")
    postings = distinct.select("fp", F.explode(F.array(
        *[_key(fp, i, g) for i, g in enumerate(groups)])).alias("key"))
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = postings.join(sizes, "key")
    short = sized.where(F.col("n") <= block).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    finer = list(combinations(range(8), minimum))
    rekeyed = F.array_compact(F.array(*[
        F.when(F.array_contains(F.array(*[F.lit(i) for i, g in enumerate(groups) if set(g) <= set(f)]),
                                F.shiftright("key", 8 * len(groups[0])).cast("int")),
               _key(fp, j, f)) for j, f in enumerate(finer)]))
    long = (sized.where(F.col("n") > block).select("fp", F.explode(rekeyed).alias("key")).distinct()
            .groupBy("key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))
    return _stars(short.select("fps"), minimum, max_bits).unionByName(
        _stars(long.select("fps"), minimum, max_bits))


def label_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``fps(id, fp)`` -> one row per distinct fingerprint:
    ``(fp, component_id, label)``; label is the least fingerprint reachable."""
    distinct = stored(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct", rows=fps.count())
    labels = components(links(distinct, max_bits, block))
    labelled = distinct.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    linked = labelled.join(labels.select(F.col("label").alias("l")).distinct(),
                           F.col("label") == F.col("l"), "left_semi")
    best = linked.groupBy("label").agg(F.min("least").alias("best")).withColumnRenamed("label", "l")
    return labelled.join(best, F.col("label") == F.col("l"), "left").select(
        "fp", F.coalesce("best", "least").alias("component_id"), "label")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``(id, fp, component_id)`` per row; component_id is the least id
    reachable over links of at most ``max_bits`` differing bits."""
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    labels = label_fingerprints(fps, max_bits, block)
    return fps.join(labels.select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Keep one row of each component: the one with the least id.  Of repeated
    rows with that id one stays in each component that it leads; a component
    without ids keeps one row."""
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    n = fps.count()
    labels = stored(label_fingerprints(fps, max_bits), "simhash-labels", rows=n)
    member = fps.join(labels, "fp")
    ids = stored(member.groupBy("id").agg(F.count(F.lit(1)).alias("n"),
                                          F.max(F.col("id") == F.col("component_id")).alias("keep")),
                 "simhash-ids", rows=n)
    once = ids.where("id is not null and n = 1 and not keep").select("id")
    odd = ids.where("id is not null and n > 1")
    # texts stay where they are, at any size: few dropped and repeated ids are
    # broadcast; of more, only rows that a bounded filter of them hits are joined
    rare = once.unionByName(odd.select("id"))
    hit = docs.where(F.col(id_col).isNotNull())
    gone, lead = rare.withColumnRenamed("id", "__id"), odd.where("keep").select(F.col("id").alias("__id"))
    if rare.count() <= EXACT_IDS:
        plain, lead = hit.join(F.broadcast(gone), F.col(id_col) == F.col("__id"), "left_anti"), F.broadcast(lead)
    else:
        miss, hit = _parted(hit, id_col, rare)
        plain = miss.unionByName(hit.join(gone, F.col(id_col) == F.col("__id"), "left_anti"))
    repeated = hit.join(lead, F.col(id_col) == F.col("__id"), "left_semi")
    if odd.limit(1).count():
        heads = labels.select(F.col("fp").alias("__fp"), F.col("component_id").alias("__component"),
                              F.col("label").alias("__label"))
        led = (_with_fp(repeated, text_col, shingle).join(heads, "__fp")
               .where(F.col(id_col) == F.col("__component")))
        plain = plain.unionByName(led.dropDuplicates([id_col, "__label"]).select(docs.columns))
    if ids.where("id is null").limit(1).count():
        bare = docs.where(F.col(id_col).isNull())
        keys = stored(fingerprints(bare.select(F.lit(0).alias("z"), text_col).dropDuplicates([text_col]),
                                   "z", text_col, shingle).select("fp").distinct()
                      .join(labels.where("component_id is null"), "fp"), "simhash-bare")
        chosen = keys.groupBy("label").agg(F.min("fp").alias("fp"))
        one = _with_fp(bare, text_col, shingle).join(chosen.select(F.col("fp").alias("__fp")), "__fp", "left_semi")
        plain = plain.unionByName(one.dropDuplicates(["__fp"]).select(docs.columns))
    return plain


def _parted(docs: DataFrame, id_col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` whose id is surely not among ``ids(id)``, and the others.  The
    filter is a table of at most ``FILTER_WORDS`` words of 64 bits, broadcast
    whatever the size; beyond its bits more rows count among the others."""
    words = 1 << 10
    while words < min(FILTER_WORDS, ids.count()):
        words *= 2

    def at(c):  # a hash of the id: bits 0 to 5 name the bit, the others the word
        h = F.xxhash64(F.lit(words), c)
        return F.pmod(F.shiftright(h, 6), F.lit(words)), F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))

    word, bit = at(F.col("id"))
    held = stored(ids.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits")), "simhash-filter")
    word, bit = at(F.col(id_col))
    seen = docs.join(F.broadcast(held), word == F.col("__word"), "left")
    hit = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return seen.where(~hit).select(docs.columns), seen.where(hit).select(docs.columns)


def _with_fp(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    def run(batches):
        for b in slices(batches):
            fps = [fingerprint(t, shingle) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps, pa.int64())], [*b.schema.names[:-1], "__fp"])

    rows = docs.withColumn("__text", F.col(text_col).cast("string"))
    return rows.mapInArrow(run, StructType([*docs.schema.fields, StructField("__fp", LongType())]))
