"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut by the tokenizer's pattern into pre-tokens, each encoded by itself. The distinct
pre-tokens of a block of texts that a task has not met yet are resolved together:

* First tier: a minimal perfect hash over the vocabulary finds those that are whole tokens. It maps
  n keys to n slots (levels in which keys without a rival stay; a level's table holds the slot of
  each of its places), the slot's token is compared with the pre-token, so strangers are never taken
  for tokens.
* Second tier: the others are merged from bytes, a heap giving the lowest rank and leftmost pair,
  the segments being a linked list.

Decoding joins the bytes of the ids. Both work row by row; the vocabulary is read on the driver
from a path given as a parameter and broadcast (its size is that of one file of ranks).

Defined results: null text is an empty text and has no ids; null ids in ``decode`` give empty bytes,
an id outside the vocabulary is an error; repeated rows and null document ids are kept as they are.
Only the id and text columns are read. Lone surrogates can't occur in Spark's strings.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from delaylens.llm.common import BLOCK_CHARS, arrow_map, blocks_of, splitmix, strings


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank per line), by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: key -> 0..n-1; strangers give -1 or any slot."""

    def __init__(self, keys: np.ndarray, gamma: float = 2.0):
        self.sizes: list[int] = []
        self.slots: list[np.ndarray] = []
        rest, taken = np.asarray(keys, dtype=np.uint64), 0
        while len(rest):
            if len(self.sizes) > 200:
                raise ValueError("keys are not distinct")
            size = max(4, int(gamma * len(rest)))
            at = self._place(rest, len(self.sizes), size)
            single = np.bincount(at, minlength=size) == 1
            # A key's slot is the number of keys that stay before it, over all levels.
            self.slots.append(np.where(single, taken + np.cumsum(single) - 1, -1).astype(np.int32))
            self.sizes.append(size)
            taken += int(single.sum())
            rest = rest[~single[at]]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (splitmix(keys + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int32)
        open_ = np.arange(len(keys))
        for level, (size, slots) in enumerate(zip(self.sizes, self.slots)):
            if not len(open_):
                break
            got = slots[self._place(keys[open_], level, size)]
            out[open_] = got
            open_ = open_[got < 0]
        return out


@lru_cache(maxsize=2)
def _classes() -> tuple[str, str, str]:
    """Letters, numbers and white space of the basic plane as ranges for a character class."""
    import regex

    plane = "".join(chr(c) for c in chain(range(0xD800), range(0xE000, 0x10000)))

    def ranges(kind: str) -> str:
        found = [ord(c) for c in regex.findall(kind, plane)]
        parts, start = [], found[0]
        for a, b in zip(found, [*found[1:], None]):
            if b != a + 1:
                parts.append(f"\\u{start:04x}-\\u{a:04x}")
                start = b
        return "".join(parts)

    return ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\p{White_Space}")


class Splitter:
    """Cuts a text by the pattern.

    The ``regex`` library knows the Unicode classes; texts of the basic plane take an equal pattern
    of the standard library, with the classes spelled out, which is several times faster.
    """

    def __init__(self, pattern: str):
        import regex

        pattern = pattern.strip()
        self.any = regex.compile(re.sub(r"(?<!\\)\\s", r"\\p{White_Space}", pattern).replace(r"\S", r"\P{White_Space}"))
        letters, numbers, space = _classes()
        inside = (("\\p{L}", letters), ("\\p{N}", numbers), ("\\s", space))

        def in_class(m: re.Match) -> str:
            body = m[0]
            for name, members in inside:
                body = body.replace(name, members)
            return body

        plain = re.sub(r"\[[^\]]*\]", in_class, pattern)
        for name, members in inside:
            plain = re.sub(r"(?<!\[)" + re.escape(name), lambda _, members=members: f"[{members}]", plain)
        self.basic = re.compile(plain.replace("\\S", f"[^{space}]"))

    def __call__(self, text: str) -> list[str]:
        in_plane = text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)
        return (self.basic if in_plane else self.any).findall(text)


def pieces(text: str, size: int) -> Iterator[str]:
    """A long text in parts of about ``size`` characters, cut before a space that follows a letter,
    digit or sign: no match of the pattern goes across."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or not text[cut - 1].isspace():
                break
            cut += 1
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


class Encoder:
    """The two-tier lookup of one vocabulary. Ids are little-endian 32-bit integers in bytes.

    What pre-tokens came to is remembered, over the tasks of a worker process too, for ``memo_size`` of
    them at most (about 200 bytes each).
    """

    def __init__(self, tokens: list[bytes], pattern: str, memo_size: int = 600_000):
        import xxhash

        self.split = Splitter(pattern)
        self.tokens = tokens
        self.digest = xxhash.xxh64_intdigest
        self.hash = PerfectHash(self._hashes(tokens))
        self.rank_at = np.zeros(len(tokens), dtype=np.int64)
        self.rank_at[self.hash.find(self._hashes(tokens))] = np.arange(len(tokens))
        self.raw = [r.to_bytes(4, "little") for r in range(len(tokens))]
        # Which neighbours make a token: (left rank, right rank) -> rank.
        ranks = {t: i for i, t in enumerate(tokens)}
        self.bytes = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.pairs = {(left, right): rank for token, rank in ranks.items() for k in range(1, len(token))
                      if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None}
        self.memo: dict[str, bytes] = {}
        self.memo_size = memo_size

    def _hashes(self, keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.digest, keys), dtype=np.uint64, count=len(keys))

    def merge(self, piece: bytes) -> bytes:
        """Merge the bytes of a pre-token by rank: a heap of (rank, left, stop) pairs in one integer
        each, segments as a linked list."""
        n, pair = len(piece), self.pairs.get
        rank = [*map(self.bytes.__getitem__, piece)]  # of the segment that starts here
        bits = n.bit_length()
        mask, shift = (1 << bits) - 1, 2 * bits
        heap = [r << shift | i << bits | i + 2 for i, r in enumerate(map(pair, zip(rank, rank[1:]))) if r is not None]
        heapify(heap)
        end = [*range(1, n + 1)]     # of the segment; 0 once swallowed
        before = [*range(-1, n - 1)]  # start of the segment before
        while heap:
            best = heappop(heap)
            i, stop = best >> bits & mask, best & mask
            right = end[i]
            if not right or right >= n or end[right] != stop:
                continue  # one of the two has changed since
            rank[i] = merged = best >> shift
            end[i], end[right] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := pair((merged, rank[stop]))) is not None:
                    heappush(heap, r << shift | i << bits | end[stop])
            if i and (r := pair((rank[before[i]], merged))) is not None:
                heappush(heap, r << shift | before[i] << bits | stop)
        raw = self.raw
        return b"".join([raw[r] for r, e in zip(rank, end) if e])

    def resolve(self, words: list[str]) -> None:
        """Put the ids of new distinct pre-tokens into the memo."""
        if not words:
            return
        keys = [w.encode("utf-8") for w in words]
        slots = self.hash.find(self._hashes(keys))
        ranks = self.rank_at[slots].tolist()
        for word, key, slot, rank in zip(words, keys, slots.tolist(), ranks):
            self.memo[word] = self.raw[rank] if slot >= 0 and self.tokens[rank] == key else self.merge(key)

    def encode_raw(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text of a block; a text beyond the block size is taken piece by piece."""
        if len(texts) > 1 or len(texts[0] or "") <= BLOCK_CHARS:
            return self._encode([t or "" for t in texts])
        return [b"".join([self._encode([p])[0] for p in pieces(texts[0], BLOCK_CHARS)])]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """As ``encode_raw``, in lists."""
        return [np.frombuffer(x, dtype="<i4").tolist() for x in self.encode_raw(texts)]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = [self.split(t) for t in texts]
        if len(self.memo) > self.memo_size:  # the older half goes
            self.memo = dict(islice(self.memo.items(), len(self.memo) // 2, None))
        self.resolve(list(set().union(*found) - self.memo.keys()))
        look = self.memo.__getitem__
        return [b"".join(map(look, f)) for f in found]


@lru_cache(maxsize=2)
def _encoder(tokens: tuple[bytes, ...], pattern: str) -> Encoder:
    return Encoder(list(tokens), pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           out: str = "ids") -> DataFrame:
    """(id, ids) of every row: the tokens of the whole text as an array of int."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(read_ranks(ranks_path)))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for part in parts:
            for some in blocks_of(part, 1):
                raw = encoder.encode_raw(strings(some.column(1)))
                offsets = np.cumsum([0, *map(len, raw)]) // 4
                values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(raw))])
                ids = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), values)
                yield pa.RecordBatch.from_arrays([some.column(0), ids], names=["id", "ids"])

    return slim.transform(arrow_map, encoded, f"id {id_type}, ids array<int>").toDF(id_col, out)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids in one more column."""
    shared = encoded.sparkSession.sparkContext.broadcast(tuple(read_ranks(ranks_path)))
    at = encoded.columns.index(ids_col)
    schema = StructType([*encoded.schema.fields, StructField(out, BinaryType())])

    def decoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ids are looked up in one array of all tokens; the bytes of a row's tokens lie side by side.
        tokens = pa.array(shared.value, type=pa.large_binary())
        for part in parts:
            column = part.column(at)
            values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            if len(values) and (values.min() < 0 or values.max() >= len(tokens)):
                raise ValueError("an id is not in the vocabulary")
            raw = []
            for a, b in zip(offsets[:-1], offsets[1:]):
                found = tokens.take(pa.array(values[a:b]))
                raw.append(found.buffers()[2].to_pybytes() if b > a else b"")
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, type=pa.binary())],
                                             names=[*part.schema.names, out])

    return encoded.transform(arrow_map, decoded, schema)
