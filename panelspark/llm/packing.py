"""Token-id packing into fixed-length rows.

Every text is tokenized whole (byte-level BPE ranks of a public vocabulary);
a document longer than ``length`` is split losslessly into pieces.  Pieces are
dealt by a hash of the id into blocks of about ``BLOCK_TOKENS`` tokens, and
each block is packed on its own by best-fit decreasing: pieces from longest to
shortest go to the open row with the least capacity that holds them, found by
descending a segment tree over capacities.  A block is bounded whatever the
corpus size, a hot document only adds pieces, and the number of blocks grows
with the tokens, so no task sees an unbounded group.

Every output row holds ``input_ids`` (little-endian uint16, or uint32 for a
vocabulary beyond 65,536, padded with ``pad_id`` to ``length``), the number of
tokens, cumulative segment lengths, position ids that restart at each segment
(packed likewise) and the segments' source: id, piece and offset.

Edge cases: null and empty texts have no token and no segment; documents of
exactly ``length`` tokens fill a row; equal lengths go by id and piece; rows
with the same id (or none) are packed each on their own; an empty table gives
no rows.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import stored, type_of

LENGTH, PAD_ID = 2048, 50_256
BLOCK_TOKENS = 1 << 20
CACHE_ENTRIES = 400_000
BATCH = 256


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class CapacityTree:
    """Rows by free capacity: a segment tree of counts over 0..size, searched
    for the least capacity that is at least a given number."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        i = capacity + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, row) of a row with the least capacity >= ``least``."""
        i = least + self.leaves
        if not self.count[i]:
            while i & 1 or not self.count[i + 1]:  # up, until a filled sibling to the right
                i >>= 1
                if i <= 1:
                    return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        while i:
            self.count[i] -= 1
            i >>= 1
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers; ``lengths`` are at most ``length``.  Equal
    lengths keep their order."""
    tree, rows = CapacityTree(length), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        got = tree.take(n)
        if got is None:
            rows.append([i])
            free, row = length - n, len(rows) - 1
        else:
            rows[got[1]].append(i)
            free, row = got[0] - n, got[1]
        if free:
            tree.put(free, row)
    return rows


class Tokens:
    """Words encoded by the ranks, each once and kept up to a bound (ids in
    the little-endian order of the machines that Spark runs on)."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
        self.encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.kind = "H" if max(table.values(), default=0) < 1 << 16 else "I"
        self.split = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text.  Where single spaces part its words, the split
        pattern breaks before each of them, so a word with the space before it
        is encoded on its own (and once); other texts go through the pattern."""
        if not text:
            return b""
        text = text.encode("utf-8", "replace").decode("utf-8")
        first, *rest = text.split(" ")
        get, out = self.cache.get, [self._pieces(first)]
        if rest and (not first or first[-1].isspace()):
            return self._pieces(text)
        for word in rest:
            x = get(word)
            if x is None:
                if not word or word[0].isspace() or word[-1].isspace():
                    return self._pieces(text)
                x = self._ids(" " + word)
                if len(self.cache) >= CACHE_ENTRIES:
                    self.cache.clear()
                if len(word) <= 48:
                    self.cache[word] = x
            out.append(x)
        return b"".join(out)

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self._ids, self.split.findall(text)))

    def _ids(self, text: str) -> bytes:
        return array(self.kind, self.encoding.encode_ordinary(text)).tobytes()


_LOADED: dict[tuple, Tokens] = {}


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
              pattern: str | None = None) -> tuple[DataFrame, str]:
    """``(id, key, n, ids)`` per text with tokens, and the number type of
    ``ids``; ``key`` is a hash of id and text that deals rows to blocks."""
    with open(path or default_path(), encoding="ascii") as f:
        ranks = f.read()
    pattern = pattern or default_pattern()
    kind = {"H": "<u2", "I": "<u4"}[Tokens(ranks, pattern).kind]
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches):
        name = (hash(shared.value[0]), shared.value[1])
        if name not in _LOADED:
            _LOADED[name] = Tokens(*shared.value)
        tok = _LOADED[name]
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH):
                b = whole.slice(i, BATCH)
                ids = [tok.encode(t) for t in b.column(2).to_pylist()]
                width = 2 if tok.kind == "H" else 4
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([len(x) // width for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["id", "key", "n", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
                       F.col(text_col).cast("string").alias("text")).where("text <> ''")
    return rows.mapInArrow(run, f"id {type_of(docs, id_col)}, key bigint, n bigint, ids binary"), kind


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         pad_id: int = PAD_ID, path: str | None = None, pattern: str | None = None,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per packed sequence: ``block, row, n_tokens, input_ids,
    cu_seqlens, position_ids, doc_ids, pieces, offsets``."""
    tokens, kind = tokenized(docs, id_col, text_col, path, pattern)
    tokens = stored(tokens, "tokens")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_tokens))
    id_type = type_of(docs, id_col)
    width = 2 if kind == "<u2" else 4
    # pieces, so that one long text is spread over blocks too
    cut = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / length).cast("int")))
    # rows that repeat id and text share a key: their place in the written file parts them
    place = F.col("_metadata.row_index").alias("place")
    pieces = (tokens.where("n > 0").select("id", "key", place, "ids", cut.alias("piece"))
              .select("id", "key", "piece", "place",
                      F.substring("ids", F.col("piece") * (length * width) + 1, F.lit(length * width)).alias("ids"))
              .withColumn("block", F.pmod(F.xxhash64("key", "piece", "place"), F.lit(blocks))).drop("place"))
    schema = (f"block bigint, row bigint, n_tokens bigint, input_ids binary, cu_seqlens array<int>, "
              f"position_ids binary, doc_ids array<{id_type}>, pieces array<int>, offsets array<bigint>")

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        ids, piece = table.column("id").to_pylist(), table.column("piece").to_pylist()
        data, keys = table.column("ids").to_pylist(), table.column("key").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (keys[i], piece[i]))
        lengths = [len(data[i]) // width for i in order]
        rows = []
        for r, members in enumerate(best_fit_decreasing(lengths, length)):
            own, sizes = [order[m] for m in members], [lengths[m] for m in members]
            n = sum(sizes)
            flat = b"".join(data[i] for i in own) + np.full(length - n, pad_id, dtype=kind).tobytes()
            restart = np.concatenate([*(np.arange(s) for s in sizes), np.zeros(length - n, dtype=np.int64)])
            rows.append({
                "block": block, "row": r, "n_tokens": n, "input_ids": flat,
                "cu_seqlens": np.r_[0, np.cumsum(sizes)].tolist(), "position_ids": restart.astype("<u2").tobytes(),
                "doc_ids": [ids[i] for i in own], "pieces": [piece[i] for i in own],
                "offsets": [piece[i] * length for i in own]})
        return pa.Table.from_pylist(rows, schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema
    out = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)
    if length > 1 << 16:
        raise ValueError("length must fit into 16 bits")
    return pieces.groupBy("block").applyInArrow(run, schema)
