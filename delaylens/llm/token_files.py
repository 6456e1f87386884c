"""Token ids in binary files: one id array per file, document boundaries in Elias-Fano code.

File layout, little-endian: 8 bytes magic, then six 64-bit numbers (documents n, ids m, bytes per
id, low bits l, words of the upper array, words of the lower array), then

* *lower*: the l low bits of each boundary, packed into 64-bit words,
* *upper*: the high parts in unary; boundary i sets bit (boundary_i >> l) + i, in 64-bit words,
* *samples*: for select, the position of every 256th set bit, 64 bits each,
* *doc_ids*: n 64-bit ids of the documents (the smallest 64-bit number stands for null),
* *ids*: m token ids of 2 or 4 bytes, documents one after another.

Boundaries are the ends of the documents in the id array: about 2 + log2(m/n) bits each instead of a
64-bit table. ``Boundaries.select`` finds one without decoding the others.

Documents are dealt to tasks by ranges of their id, sorted, encoded, and written in files of bounded
size through ``pyarrow.fs`` below a folder that all executors share. Every attempt of a task writes
files of its own and the manifest (one row per file) is written once, so a lost executor or a second
attempt leaves at most files that no manifest names.

Defined results: null text is an empty text; an empty text has the end id alone; null ids come
first, as one id; rows that repeat an id are documents of their own, in the order of their text's hash;
no documents give a manifest without rows. Control strings in a text become control tokens, as in the
library. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.common import arrow_map, batches, blocks_of, written
from delaylens.session import scratch_path

MAGIC = b"TOKENEF1"
NULL_ID = -(2**63)
SAMPLE = 256


@dataclass(frozen=True)
class FileParams:
    file_ids: int = 8_000_000    # a file is closed once it has so many ids
    memo_size: int = 400_000     # parts of texts a worker remembers, and twice as many words
    block_chars: int = 4_000_000 # texts that are encoded together: a part that they repeat is looked up once


def pack(ends: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Elias-Fano code of an ascending array: low bits, lower words, upper words, select samples."""
    n = len(ends)
    top = int(ends[-1]) if n else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    ends = ends.astype(np.uint64)
    bits = ((ends[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    high = (ends >> np.uint64(low)).astype(np.int64) + np.arange(n)
    upper = np.zeros((int(high[-1]) + 1 if n else 0), dtype=np.uint8)
    upper[high] = 1
    return low, _words(bits), _words(upper), high[::SAMPLE].astype(np.uint64)


def _words(bits: np.ndarray) -> np.ndarray:
    raw = np.packbits(bits, bitorder="little")
    return np.frombuffer(raw.tobytes() + b"\0" * (-len(raw) % 8), dtype="<u8")


class Boundaries:
    """Reads single boundaries of an Elias-Fano code in place."""

    def __init__(self, n: int, low: int, lower: np.ndarray, upper: np.ndarray, samples: np.ndarray):
        self.n, self.low, self.lower, self.upper, self.samples = n, low, lower, upper, samples

    def _set_bit(self, i: int) -> int:
        """Position of the i-th set bit: from the sample before it, word by word."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        word = at >> 6
        value = int(self.upper[word]) >> (at & 63) << (at & 63)
        while (ones := value.bit_count()) <= left:
            left -= ones
            word += 1
            value = int(self.upper[word])
        for _ in range(left):
            value &= value - 1
        return (word << 6) + (value & -value).bit_length() - 1

    def select(self, i: int) -> int:
        """The i-th boundary, the end of document i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, at = self._set_bit(i) - i, i * self.low
        if self.low:
            word, shift = at >> 6, at & 63
            bits = int(self.lower[word]) >> shift
            if shift + self.low > 64:
                bits |= int(self.lower[word + 1]) << (64 - shift)
            value = value << self.low | bits & (1 << self.low) - 1
        return value

    def all(self) -> np.ndarray:
        """All boundaries at once."""
        if not self.n:
            return np.empty(0, dtype=np.int64)
        upper = np.unpackbits(self.upper.view(np.uint8), bitorder="little")
        high = np.flatnonzero(upper)[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.lower.view(np.uint8), bitorder="little")[: self.n * self.low]
        weights = 1 << np.arange(self.low, dtype=np.int64)
        return (high << self.low) + bits.reshape(self.n, self.low) @ weights


def file_bytes(doc_ids: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """The parts of a file image."""
    low, lower, upper, samples = pack(ends)
    head = np.array([len(ends), len(ids), ids.itemsize, low, len(upper), len(lower)], dtype="<u8")
    return [MAGIC, head.tobytes(), lower.tobytes(), upper.tobytes(), samples.tobytes(),
            doc_ids.astype("<i8").tobytes(), ids.tobytes()]


class TokenFile:
    """A file image: documents by position, without decoding the other boundaries."""

    def __init__(self, data):
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token file")
        n, m, width, low, n_upper, n_lower = (int(x) for x in np.frombuffer(view[8:56], dtype="<u8"))
        at = 56

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            size = count * np.dtype(kind).itemsize
            at += size
            return np.frombuffer(view[at - size : at], dtype=kind)

        lower, upper = take(n_lower, "<u8"), take(n_upper, "<u8")
        self.ends = Boundaries(n, low, lower, upper, take(-(-n // SAMPLE), "<u8"))
        self.doc_ids = take(n, "<i8")
        self.ids = take(m, f"<u{width}")

    def __len__(self) -> int:
        return self.ends.n

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


def _qualified(spark, folder: str) -> str:
    """A folder without scheme lies in Spark's default file system."""
    if "://" in folder or folder.startswith("file:"):
        return folder
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@lru_cache(maxsize=2)
def _tokenizer(raw: str, memo_size: int) -> "WordIds":
    return WordIds(raw, memo_size)


class WordIds:
    """Ids of texts by the tokenizers library, with memos of what lies between white space. The strings
    of control tokens in a text get their ids, as the library does unless told otherwise.

    The tokenizer replaces white space by one space, drops it when it cuts a text, and its
    normalization and cuts don't reach across it; so a text's ids are those of its parts. It also
    lower-cases and cuts between letters and other signs; so a part that is a word of Latin letters,
    perhaps with one stop or comma, has the ids that its model gives the lower-case word, then those of
    the sign. Such words go straight to the model, all other parts through the whole tokenizer.
    """

    def __init__(self, raw: str, memo_size: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[str, bytes] = {}      # part -> ids
        self.plain: dict[str, bytes] = {}     # lower-case word -> ids
        self.memo_size, self.plain_size = memo_size, 2 * memo_size
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        width = np.dtype(self.kind).itemsize
        self.raw = [i.to_bytes(width, "little") for i in range(1 + max(self.tokenizer.get_vocab().values()))]
        # What the shortcut relies on; another kind of tokenizer takes every part as a whole.
        probe = ["été", "Straße", "the", "NIÑO"]
        self.direct = [[t.id for t in self.model.tokenize(w.lower().encode().decode("latin-1").translate(self.letters))] for w in probe] == [
            e.ids for e in self.tokenizer.encode_batch(probe, add_special_tokens=False)]
        self.signs = {x: self.tokenizer.encode(x, add_special_tokens=False).ids for x in ".,"}
        self.signs = {x: np.array(ids, dtype=self.kind).tobytes() for x, ids in self.signs.items()}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of the file's id width."""
        parts = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        if len(self.memo) > self.memo_size:
            self.memo = _newer_half(self.memo)
        self._resolve(set().union(*parts).difference(self.memo))
        look = self.memo.__getitem__
        return [b"".join(map(look, p)) for p in parts]

    def _resolve(self, new: set[str]) -> None:
        """Put the ids of new parts into the memo."""
        if len(self.plain) > self.plain_size:
            self.plain = _newer_half(self.plain)
        plain, rest, memo, signs = self.plain, [], self.memo, self.signs
        known, cut, of_token = self.raw.__getitem__, self.model.tokenize, attrgetter("id")
        if not self.direct:
            rest, new = list(new), set()
        for part in new:
            end = b""
            word = part
            if not part.isalpha():
                word, end = part[:-1], signs.get(part[-1:])
                if end is None or not word.isalpha():
                    rest.append(part)
                    continue
            if word.isascii():
                raw = word = word.lower()
                ids = plain.get(word)
            elif _LATIN.issuperset(word):
                word = word.lower()
                ids = plain.get(word)
                raw = word.encode().decode("latin-1").translate(self.letters) if ids is None else ""
            else:
                rest.append(part)
                continue
            if ids is None:
                ids = plain[word] = b"".join(map(known, map(of_token, cut(raw))))
            memo[part] = ids + end
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            for part, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.memo[part] = np.array(e.ids, dtype=self.kind).tobytes()


#: Letters below the phonetic ones whose lower case is one letter too.
_LATIN = frozenset(map(chr, range(0x250))) - {"\u0130"}


def _newer_half(memo: dict) -> dict:
    return dict(islice(memo.items(), len(memo) // 2, None))


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write bytes as letters: printable ones stand for themselves, the
    others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)}


_MANIFEST = pa.schema([("path", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
                       ("n_ids", pa.int64()), ("n_bytes", pa.int64())])


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 1, p: FileParams = FileParams(),
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all documents and write them in ascending id order; returns the manifest.

    The manifest has a row per file: path, part, seq, n_docs, n_ids, n_bytes, and start (ids in all
    files before it). ``folder`` must be shared by all executors; a new one below the checkpoint
    folder is the default.
    """
    spark = docs.sparkSession
    base = _qualified(spark, (folder or scratch_path(spark, "token-files")).rstrip("/"))
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def files(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = _tokenizer(shared.value, p.memo_size)
        end = np.array([end_id], dtype=tokenizer.kind).tobytes()
        number, width = TaskContext.get().partitionId(), np.dtype(tokenizer.kind).itemsize
        attempt = uuid.uuid4().hex[:12]
        system, root = _filesystem(base)
        system.create_dir(root, recursive=True)
        held: list[bytes] = []
        names: list[int] = []
        size = seq = 0

        def close() -> tuple:
            ends = np.cumsum([len(x) // width for x in held])
            image = file_bytes(np.array(names, dtype=np.int64), ends,
                               np.frombuffer(b"".join(held), dtype=np.dtype(tokenizer.kind).newbyteorder("<")))
            name = f"part-{number:06d}-{seq:05d}-{attempt}.tok"
            with system.open_output_stream(f"{root}/{name}") as out:
                for x in image:
                    out.write(x)
            return f"{base}/{name}", number, seq, len(ends), int(ends[-1]), sum(map(len, image))

        def rows() -> Iterator[tuple]:
            nonlocal held, names, size, seq
            for part in parts:
                for some in blocks_of(part, 1, p.block_chars):
                    coded = tokenizer.encode([t or "" for t in some.column(1).to_pylist()])
                    for doc, ids in zip(some.column(0).to_pylist(), coded):
                        held.append(ids + end)
                        names.append(NULL_ID if doc is None else doc)
                        size += len(held[-1]) // width
                        if size >= p.file_ids:
                            yield close()
                            held, names, size, seq = [], [], 0, seq + 1
            if held:
                yield close()

        yield from batches(rows(), _MANIFEST)

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = slim.repartitionByRange(parts, "id", tie).sortWithinPartitions("id", tie)
    made = written(dealt.transform(arrow_map, files, "path string, part int, seq int, n_docs long, n_ids long, n_bytes long"),
                   "token-manifest")
    # One row per file of ``file_ids`` ids: a running sum over parts, then within a part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = made.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    starts = sums.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (made.join(starts, "part")
            .withColumn("start", F.col("before") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).drop("before"))


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of the files in the manifest."""
    return _documents(manifest, "ids binary", lambda ids: (ids.astype("<u4").tobytes(),), [("ids", pa.binary())])


def read_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): unsigned crc32 of the ids as 32-bit integers."""
    return _documents(manifest, "ids_crc32 long", lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),),
                      [("ids_crc32", pa.int64())])


def _documents(manifest: DataFrame, ddl: str, derive, fields: list) -> DataFrame:
    spark = manifest.sparkSession
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), *fields])

    def documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for part in parts:
                for path, start in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    system, name = _filesystem(path)
                    with system.open_input_stream(name) as f:
                        file = TokenFile(f.read())
                    b = 0
                    for i in range(len(file)):
                        a, b = b, file.ends.select(i)
                        doc = int(file.doc_ids[i])
                        yield (None if doc == NULL_ID else doc, start + a, b - a, *derive(file.ids[a:b]))

        yield from batches(rows(), schema)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A file is a unit of work; files are dealt evenly over the tasks.
    listed = manifest.select("path", "start").repartition(parts, "path")
    return listed.transform(arrow_map, documents, f"doc_id long, start long, n_tokens long, {ddl}")
