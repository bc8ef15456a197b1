"""Phrase collocations counted in quotient filters.

Words that occur often enough to be part of a candidate are numbered, so an
n-gram packs into one number.  An invertible permutation of the packed bits
(odd multiplications and shifts) spreads the n-grams evenly; the high bits are
the quotient, the low ones the remainder, kept in full.  A counting quotient
filter stores, in order, how many entries each quotient has, their remainders
in as few bytes as they need, and a one-byte counter with an escape list.
Nothing is lost: quotient and remainder give the number back.

Each task turns a bounded part of its text into such filters, one per range of
quotients; Spark shuffles them by range, and each range merges its sorted
filters into one.  The number of ranges follows the number of words, so a
merge is of bounded size at any corpus size, and a frequent phrase is one entry
per filter.

Counts go by length.  A phrase of ``min_count`` occurrences has only parts of
as many, so pairs are counted of frequent words only, and triples only where
both pairs are frequent (a bounded bit filter; it errs on the side of
counting).  Only the ``DICTIONARY`` most frequent words are numbered and
broadcast; phrases with a frequent word outside (or a word of more than
``WORD_BYTES`` bytes) are counted as strings, in the same way otherwise.

Edge cases: a null text is empty, a null language is ``und``; repeated rows
count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import bitfilter
from panelspark.llm.common import stored

MIN_COUNT, SHARE, TOP = 10, 50, 2000
DICTIONARY, WORD_BYTES = 1 << 19, 64
CHUNK_BYTES = 1 << 23    # text taken apart together
FLUSH = 1 << 22          # n-grams in one shard's filters
RANGE = 1 << 21          # n-grams (with repeats) per range of quotients
PART = 50_000            # candidates ranked together
TABLE_WORDS = 1 << 19    # different words a task counts before it hands them on
# The characters that end a piece, and the blanks between words.
ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"
_END, _PAD, _OTHER = -2, -3, -1
_TABLE = bytes(10 if c in ENDS else 32 if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of the texts with a line feed after each piece; empty ones are padding."""
    return b"\n".join(texts).translate(_TABLE).replace(b"\n", b" \n ").split(b" ")


def _chunks(batches):
    """(language, texts) of at most about ``CHUNK_BYTES``; a batch is (lang, text)."""
    for batch in batches:
        held: dict[str, tuple[list, list]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part, size = held.setdefault(lang, ([], [0]))
            part.append(text.encode("utf-8", "surrogatepass"))
            size[0] += len(part[-1])
            if size[0] >= CHUNK_BYTES:
                yield lang, part
                del held[lang]
        for lang, (part, _) in held.items():
            yield lang, part


# -- the filter ---------------------------------------------------------------

class Permutation:
    """A bijection of the numbers below ``2**bits``."""

    def __init__(self, bits: int):
        self.bits, self.mask = bits, np.uint64((1 << bits) - 1)
        self.shift = np.uint64((bits + 1) // 2)
        odd = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]
        self.odd = [np.uint64(x % (1 << bits) | 1) for x in odd]
        self.back = [np.uint64(pow(int(x), -1, 1 << bits)) for x in self.odd]

    def there(self, x: np.ndarray) -> np.ndarray:
        for m in self.odd:
            x = (x * m) & self.mask
            x = x ^ (x >> self.shift)
        return x

    def home(self, x: np.ndarray) -> np.ndarray:
        for m in reversed(self.back):
            x = x ^ (x >> self.shift)  # shifts half the bits or more: its own inverse
            x = (x * m) & self.mask
        return x


def pack_filter(values: np.ndarray, counts: np.ndarray, low: int, bits: int) -> dict:
    """The filter of sorted different ``values``, which share all but their
    ``low`` low bits, out of ``bits``."""
    slots = min(low, max(0, int(values.size).bit_length() - 1))  # about one entry a slot
    rest = low - slots
    inner = values & np.uint64((1 << low) - 1)
    used = np.bincount((inner >> np.uint64(rest)).astype(np.int64), minlength=1 << slots)
    width = -(-rest // 8)
    part = (inner & np.uint64((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    big = np.flatnonzero(counts >= 255)
    return {"slots": slots, "used": used.astype("<u2").tobytes(), "rest": part.tobytes(),
            "few": np.minimum(counts, 255).astype(np.uint8).tobytes(),
            "many": np.concatenate([big, counts[big]]).astype("<i8").tobytes()}


def unpack_filter(f: dict, high: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """``(values, counts)`` of a filter whose values share the high bits ``high``."""
    rest = low - f["slots"]
    width = -(-rest // 8)
    used = np.frombuffer(f["used"], "<u2")
    counts = np.frombuffer(f["few"], np.uint8).astype(np.int64)
    part = np.zeros((counts.size, 8), dtype=np.uint8)
    part[:, :width] = np.frombuffer(f["rest"], np.uint8).reshape(counts.size, width)
    slot = np.repeat(np.arange(used.size, dtype=np.uint64), used)
    values = (np.uint64(high) << np.uint64(low)) | (slot << np.uint64(rest)) | part.view("<u8").ravel()
    at, many = np.frombuffer(f["many"], "<i8").reshape(2, -1)
    counts[at] = many
    return values, counts


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted filter of several: equal values add their counts."""
    values, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.add.reduceat(counts, first)


# -- counting -----------------------------------------------------------------

class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        return _OTHER


class Dictionary:
    """Numbers of the frequent words of each language, told apart by number."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.rows = rows
        self.bits = max(1, len(rows).bit_length())

    def lookups(self) -> dict[str, _Words]:
        out: dict[str, _Words] = {}
        for i, (lang, word) in enumerate(self.rows):
            own = out.setdefault(lang, _Words({b"": _PAD, b"\n": _END}))
            own[word.encode("utf-8", "surrogatepass")] = i
        return out


def _numbers(part: list[bytes], own: _Words) -> np.ndarray:
    flat = tokens(part)
    n = np.fromiter(map(own.__getitem__, flat), dtype=np.int64, count=len(flat))
    return n[n != _PAD]


def word_counts(rows: DataFrame) -> DataFrame:
    """``(lang, word, n)``; the row of a null word counts all words of the language."""

    def run(batches):
        def handed(held):
            keys = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()),
                 pa.array([None if k[1] is None else k[1].decode("utf-8", "surrogatepass") for k in keys], pa.string()),
                 pa.array([k[2] for k in keys], pa.int64())], ["lang", "word", "n"])

        held: dict[str, Counter] = {}
        for lang, part in _chunks(batches):
            own = held.setdefault(lang, Counter())
            own.update(tokens(part))
            del own[b""], own[b"\n"]
            own[None] = 0
            own[None] = sum(own.values())
            if sum(map(len, held.values())) >= TABLE_WORDS:
                yield handed(held)
                held = {}
        yield handed(held)

    return (rows.mapInArrow(run, "lang string, word string, n bigint")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def _grams(ids: np.ndarray, size: int, bits: int, pairs: bitfilter.BitFilter | None) -> np.ndarray:
    """Packed n-grams of numbered words; of three words only where both pairs are frequent."""
    a, b = ids[:-1], ids[1:]
    both = (a >= 0) & (b >= 0)
    pair = (a << bits) | b
    if size == 2:
        return pair[both].view(np.uint64)
    at = np.flatnonzero(both)
    both[at[~pairs.hits(pair[at])]] = False
    at = np.flatnonzero(both[:-1] & both[1:])
    return ((pair[at] << bits) | ids[at + 2]).view(np.uint64)


def gram_counts(rows: DataFrame, words: Dictionary, size: int, total: int, min_count: int,
                pairs: bitfilter.BitFilter | None = None) -> DataFrame:
    """``(packed, lang, w1 .. wn, n)`` of the n-grams of numbered words with
    ``min_count`` occurrences or more."""
    bits = size * words.bits
    spread = Permutation(bits)
    top = min(bits, max(0, (total // RANGE).bit_length()))  # bits that name a range
    low = bits - top
    shared = rows.sparkSession.sparkContext.broadcast((words, pairs))

    def filters(grams: np.ndarray):
        values, counts = np.unique(spread.there(grams), return_counts=True)
        ranges = (values >> np.uint64(low)).astype(np.int64)
        first = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])) if values.size else []
        cut = np.append(first, values.size).astype(np.int64)
        out = [pack_filter(values[i:j], counts[i:j], low, bits) for i, j in zip(cut[:-1], cut[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(ranges[cut[:-1]].astype(np.int32) if len(out) else [], pa.int32()),
             pa.array([f["slots"] for f in out], pa.int32()),
             *(pa.array([f[k] for f in out], pa.binary()) for k in ("used", "rest", "few", "many"))],
            ["range", "slots", "used", "rest", "few", "many"])

    def run(batches):
        words, pairs = shared.value
        lookups, held, n = words.lookups(), [], 0
        for lang, part in _chunks(batches):
            if lang in lookups:
                held.append(_grams(_numbers(part, lookups[lang]), size, words.bits, pairs))
                n += held[-1].size
            if n >= FLUSH:
                yield filters(np.concatenate(held))
                held, n = [], 0
        if n:
            yield filters(np.concatenate(held))

    def merged(key, table):
        high, rows = key[0].as_py(), table.to_pylist()
        values, counts = merge([unpack_filter(f, high, low) for f in rows])
        often = counts >= min_count
        packed, counts = spread.home(values[often]), counts[often]
        words = shared.value[0]
        mask = np.uint64((1 << words.bits) - 1)
        parts = [(packed >> np.uint64(words.bits * (size - 1 - i)) & mask).tolist() for i in range(size)]
        return pa.table([pa.array(packed.view(np.int64)), pa.array([words.rows[i][0] for i in parts[0]], pa.string()),
                         *(pa.array([words.rows[i][1] for i in p], pa.string()) for p in parts),
                         pa.array(counts)], names=["packed", "lang", *names, "n"])

    names = [f"w{i + 1}" for i in range(size)]
    sent = rows.mapInArrow(run, "range int, slots int, used binary, rest binary, few binary, many binary")
    return sent.groupBy("range").applyInArrow(
        merged, f"packed bigint, lang string, {', '.join(n + ' string' for n in names)}, n bigint")


def _spark_hash(lang: str, word: bytes) -> int:
    """``xxhash64(lang, word)`` of Spark."""
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42))


def other_counts(rows: DataFrame, words: Dictionary, others: bitfilter.BitFilter, min_count: int) -> DataFrame:
    """``(lang, w1, w2, w3, n)`` of the phrases of two and three frequent words
    of which one at least has no number; counted as strings."""
    shared = rows.sparkSession.sparkContext.broadcast((words, others))

    def handed(held: Counter):
        keys = list(held)
        cols = [pa.array([k[0] for k in keys], pa.string())]
        cols += [pa.array([k[i].decode("utf-8", "surrogatepass") if len(k) > i else None for k in keys], pa.string())
                 for i in (1, 2, 3)]
        return pa.RecordBatch.from_arrays([*cols, pa.array(list(held.values()), pa.int64())],
                                          ["lang", "w1", "w2", "w3", "n"])

    def run(batches):
        words, others = shared.value
        lookups, held = words.lookups(), Counter()
        for lang, part in _chunks(batches):
            flat = [t for t in tokens(part) if t]
            own = lookups.get(lang, _Words({b"\n": _END}))
            n = np.fromiter(map(own.__getitem__, flat), dtype=np.int64, count=len(flat))
            at = np.flatnonzero(n == _OTHER)
            keys = np.fromiter((_spark_hash(lang, flat[i]) for i in at.tolist()), dtype=np.uint64, count=at.size)
            tail = np.zeros(n.size, dtype=bool)
            tail[at[others.hits(keys.view(np.int64))]] = True
            usable = (n >= 0) | tail
            for size in (2, 3):
                m = max(0, n.size - size + 1)
                ok, odd = np.ones(m, dtype=bool), np.zeros(m, dtype=bool)
                for i in range(size):
                    ok &= usable[i:i + m]
                    odd |= tail[i:i + m]
                held.update((lang, *flat[i:i + size]) for i in np.flatnonzero(ok & odd).tolist())
            if len(held) >= TABLE_WORDS:
                yield handed(held)
                held = Counter()
        yield handed(held)

    return (rows.mapInArrow(run, "lang string, w1 string, w2 string, w3 string, n bigint")
            .groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# -- scores -------------------------------------------------------------------

def _score(a: str, left: str, right: str) -> Column:
    big = lambda c: f"CAST({c} AS DECIMAL(15, 0))"
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({big(a)} * {big(a)})) div ({big(left)} * {big(right)})")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 share: int = SHARE, top: int = TOP, dictionary: int = DICTIONARY) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counted = stored(word_counts(rows).where((F.col("n") >= min_count) | F.col("word").isNull()), "words")
    totals = counted.where("word is null").select("lang", "n")
    often = counted.where("word is not null")
    total = totals.agg(F.sum("n")).first()[0] or 0
    floor = _dictionary_floor(often, min_count, dictionary)
    numbered = (F.col("n") >= floor) & (F.octet_length("word") <= WORD_BYTES)
    words = Dictionary([(r["lang"], r["word"]) for r in  # at most ``dictionary`` short words
                        often.where(numbered).select("lang", "word").toArrow().to_pylist()])
    # as many rows for any corpus, a bounded broadcast: see _dictionary_floor
    pair = stored(gram_counts(rows, words, 2, total, min_count), "pairs")
    held = bitfilter.build(pair.select(F.col("packed").alias("key")), pair.count())
    triple = stored(gram_counts(rows, words, 3, total, min_count, held), "triples")
    two, three = pair.select("lang", "w1", "w2", "n"), triple.select("lang", "w1", "w2", "w3", "n")
    rest = often.where(~numbered)
    n_rest = rest.count()
    if n_rest:
        tail = bitfilter.build(rest.select(F.xxhash64("lang", "word").alias("key")), n_rest)
        odd = stored(other_counts(rows, words, tail, min_count), "other-phrases")
        two = two.unionByName(odd.where("w3 is null").drop("w3"))
        three = three.unionByName(odd.where("w3 is not null"))

    one = lambda w, n: often.select("lang", F.col("word").alias(w), F.col("n").alias(n))
    part = lambda a, b, n: two.select("lang", F.col("w1").alias(a), F.col("w2").alias(b),
                                      F.col("n").alias(n))
    longer = (three.select("lang", "w1", "w2", "n")
              .unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
              .groupBy("lang", "w1", "w2").agg(F.max("n").alias("longest")))
    pairs = (two.withColumnRenamed("n", "a").join(longer, ["lang", "w1", "w2"], "left")
             .where(F.col("longest").isNull() | (100 * F.col("longest") < share * F.col("a")))
             .join(one("w1", "l"), ["lang", "w1"]).join(one("w2", "r"), ["lang", "w2"])
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r",
                     _score("a", "l", "r").alias("score")))
    cuts = (three.withColumnRenamed("n", "a").join(part("w2", "w3", "r1"), ["lang", "w2", "w3"])
            .join(part("w1", "w2", "l2"), ["lang", "w1", "w2"])
            .join(one("w1", "l1"), ["lang", "w1"]).join(one("w3", "r2"), ["lang", "w3"])
            .withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")}))
    second = F.col("s2") < F.col("s1")
    pick = lambda x, y: F.when(second, F.col(y)).otherwise(F.col(x))
    triples = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", pick("l1", "l2").alias("l"),
                          pick("r1", "r2").alias("r"), pick("s1", "s2").alias("score"))
    scored = stored(pairs.unionByName(triples), "collocations")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # a language may hold most candidates: parts of bounded size are ranked
    # first, again and again, until what is left is ranked as a whole
    n, before = scored.count(), None
    while n > 2 * PART and n != before:
        some = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(n // PART + 1)))
        some = some.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
        scored = stored(some.where(F.col("_place") <= top).drop("_part", "_place"), "collocations")
        n, before = scored.count(), n
    return (scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
            .where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def _dictionary_floor(often: DataFrame, min_count: int, most: int) -> int:
    """The least count from which on no more than ``most`` words are numbered;
    read off a histogram of at most a few hundred steps."""
    step = F.floor(F.log2("n") * 8).cast("int")
    rows = sorted(((r["s"], r["least"], r["c"]) for r in often.groupBy(step.alias("s"))
                   .agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("c")).toArrow().to_pylist()), reverse=True)
    floor, held = None, 0
    for _, least, c in rows:
        held += c
        if held > most:
            break
        floor = least
    return min_count if not rows else floor if floor is not None else rows[0][1] + (1 << 62)
