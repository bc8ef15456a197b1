"""BPE encoding and decoding with a contiguous rank array.

The vocabulary file (a public tokenizer with word ends, lower-cased) is read
once on the driver, checked for the parts this operator implements and sent
to the executors as one broadcast of fixed size.  A short word is a row of a
contiguous array that holds its parts and the merge rank of each part with its
right neighbour.  The ranks are scanned for the minimum, the boundary after it
is deleted and the two neighbouring ranks are refreshed; words of one length
go through these rounds together.  Words above ``SHORT`` bytes, where the scan
would be quadratic, take a heap over a linked list that performs the same
merges in the same order.

Edge cases: a null or blank text has no ids and decodes to the empty text;
special strings in a text become their ids; rows repeat as they come; ids of
any type, null included, are passed through.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import type_of

SHORT = 64
CACHE_ENTRIES = 250_000  # words kept per worker process; bounds its memory
# Fixed value: the file's own split pattern, checked when it is read.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NONE = 1 << 62


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder for one vocabulary file (its JSON text)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, norm, pre = spec["model"], spec["normalizer"], spec["pre_tokenizer"]["pretokenizers"]
        if (model["type"] != "BPE" or [n["type"] for n in norm["normalizers"]] != ["NFC", "Replace", "Lowercase"]
                or pre[0]["pattern"] != {"Regex": SPLIT} or spec.get("decoder") is not None
                or model["end_of_word_suffix"] != "</w>"):
            raise ValueError("this vocabulary file needs parts that are not implemented")
        vocab = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.last = np.array([vocab[c + self.end] for c in chars], dtype=np.int64)
        self.merges = {}  # left id, right id -> rank, merged id
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[a + b])
        self.pairs = np.array(sorted(self.merges), dtype=np.int64)
        both = np.array([self.merges[p] for p in self.pairs.tolist()], dtype=np.int64)
        self.pair_rank, self.pair_id = both >> 20, both & 0xFFFFF
        self.split = regex.compile(SPLIT.replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.cache: dict[bytes, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of neighbouring parts; rank NONE: no merge."""
        pair = left << 20 | right
        at = np.searchsorted(self.pairs, pair)
        at[at == self.pairs.size] = 0
        found = self.pairs[at] == pair
        return np.where(found, self.pair_rank[at], NONE), self.pair_id[at]

    def short_words(self, raws: list[bytes]) -> list[bytes]:
        """Ids of words of one and the same length, all held as rows of one
        contiguous array: each round deletes one boundary in every row."""
        m, n = len(raws), len(raws[0])
        raw = np.frombuffer(b"".join(raws), dtype=np.uint8).reshape(m, n)
        ids = self.inner[raw]
        ids[:, -1] = self.last[raw[:, -1]]
        out: list[bytes] = [b""] * m
        row = np.arange(m)
        rank, merged = self.ranks(ids[:, :-1], ids[:, 1:])
        while True:
            parts = ids.shape[1]
            low = rank.min(axis=1) if parts > 1 else np.full(row.size, NONE)
            done = low == NONE
            if done.any():
                flat, size = ids[done].astype("<u4").tobytes(), 4 * parts
                for k, r in enumerate(row[done].tolist()):
                    out[r] = flat[k * size:(k + 1) * size]
                go = ~done
                row, ids, rank, merged = row[go], ids[go], rank[go], merged[go]
            if not row.size:
                return out
            k, i = np.arange(row.size), rank.argmin(axis=1)
            ids[k, i] = merged[k, i]
            # delete the boundary after part i, and its rank
            keep = np.arange(parts - 1)
            ids = np.take_along_axis(ids, keep + (keep > i[:, None]), axis=1)
            keep = np.arange(parts - 2)
            shift = keep + (keep >= i[:, None])
            rank, merged = (np.take_along_axis(x, shift, axis=1) for x in (rank, merged))
            # refresh the ranks on either side of the merged part
            for at, has in ((i - 1, i > 0), (i, i < parts - 2)):
                r, c = k[has], at[has]
                rank[r, c], merged[r, c] = self.ranks(ids[r, c], ids[r, c + 1])

    def _long(self, raw: bytes) -> list[int]:
        """The same merges in the same order, from a heap over a linked list."""
        ids = [*self.inner[list(raw)].tolist()]
        ids[-1] = int(self.last[raw[-1]])
        get, n = self.merges.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i in range(n - 1) if (m := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get(ids[i] << 20 | ids[j]) != m:
                continue
            ids[i], ids[j] = m & 0xFFFFF, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (m := get(ids[a] << 20 | ids[b])) is not None:
                    heapq.heappush(heap, (m, a))
        return [i for i in ids if i >= 0]

    def _learn(self, chunks: set[bytes]) -> None:
        """Put the ids of new runs of non-blank characters into the cache."""
        if len(self.cache) + len(chunks) > CACHE_ENTRIES:
            self.cache.clear()
        parts: dict[bytes, list[bytes]] = {}
        by_length: dict[int, set[bytes]] = {}
        for raw in chunks:
            text = raw.decode("utf-8")
            ws = [text] if text.isalpha() else self.split.findall(text)
            parts[raw] = own = [w.encode("utf-8") for w in ws]
            for w in own:
                by_length.setdefault(len(w), set()).add(w)
        ids: dict[bytes, bytes] = {}
        for n, ws in by_length.items():
            many = list(ws)
            if n > SHORT:
                ids.update((w, np.array(self._long(w), dtype="<u4").tobytes()) for w in many)
            else:
                for i in range(0, len(many), 8192):
                    ids.update(zip(many[i:i + 8192], self.short_words(many[i:i + 8192])))
        get = ids.__getitem__
        for raw, own in parts.items():
            self.cache[raw] = get(own[0]) if len(own) == 1 else b"".join(map(get, own))

    def _pieces(self, text: str | None) -> list:
        """Special ids, and lists of lower-cased runs of non-blank characters."""
        if not text:
            return []
        out = []
        for p in self.cut.split(text) if "<|" in text else (text,):
            if p in self.special:
                out.append(self.special[p])
                continue
            if not p.isascii():
                # lower case goes by single characters: no final form of sigma
                p = unicodedata.normalize("NFC", p).replace("Σ", "σ")
            out.append(p.lower().encode("utf-8").split())
        return out

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """All ids of each text, as little-endian uint32."""
        pieces = [self._pieces(t) for t in texts]
        seen = set()
        for p in pieces:
            for x in p:
                if not isinstance(x, int):
                    seen.update(x)
        cache = self.cache
        if new := {c for c in seen if c not in cache}:
            self._learn(new)
            if any(c not in cache for c in seen):  # the cache was emptied
                self._learn({c for c in seen if c not in cache})
        get = cache.__getitem__
        return [b"".join([x.to_bytes(4, "little") if isinstance(x, int) else b"".join(map(get, x)) for x in p])
                for p in pieces]

    def encode(self, text: str | None) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> str:
        """The tokens, word ends shown, joined by spaces: what the public
        library returns for a file without a decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_LOADED: dict[int, Bpe] = {}


def _worker(source) -> Bpe:
    """One encoder per worker process and vocabulary."""
    key = hash(source.value)
    if key not in _LOADED:
        _LOADED[key] = Bpe(source.value)
    return _LOADED[key]


def _shared(docs: DataFrame, path: str | None):
    with open(path or default_path(), encoding="utf-8") as f:
        text = f.read()
    Bpe(text)  # fails here, not in a task, if the file is not supported
    return docs.sparkSession.sparkContext.broadcast(text)


def _batches(batch: pa.RecordBatch, rows: int = 512):
    """Slices of a batch, so that what is made from it stays small."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           path: str | None = None, decode: bool = False) -> DataFrame:
    """``(id, ids)`` per row, ``ids`` the little-endian uint32 token ids of the
    whole text; with ``decode`` also ``decoded``, made from those ids."""
    source = _shared(docs, path)

    def run(batches):
        bpe = _worker(source)
        for whole in batches:
            for b in _batches(whole):
                ids = bpe.encode_batch(b.column(1).to_pylist())
                cols = [b.column(0), pa.array(ids, pa.binary())]
                if decode:
                    cols.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, ["id", "ids", "decoded"][:len(cols)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {type_of(docs, id_col)}, ids binary" + ", decoded string" * decode)


def decode(encoded: DataFrame, id_col: str = "id", ids_col: str = "ids",
           path: str | None = None) -> DataFrame:
    """``(id, decoded)`` from rows of token ids; null ids decode to ''."""
    source = _shared(encoded, path)

    def run(batches):
        bpe = _worker(source)
        for whole in batches:
            for b in _batches(whole):
                texts = [bpe.decode(x or b"") for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["id", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {type_of(encoded, id_col)}, decoded string")


def token_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  path: str | None = None) -> DataFrame:
    """``(<id_col>, n_tokens, ids_sha256, decoded_sha256)`` of the operator's output."""
    out = encode(docs, id_col, text_col, path, decode=True)
    return out.select(F.col("id").alias(id_col),
                      (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
