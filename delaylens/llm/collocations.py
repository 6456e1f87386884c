"""Phrase collocation mining with weighted acyclic automata.

A text is cut into pieces at stops, commas and line ends, and pieces into words. All phrases of one to
four words within pieces are counted, per language:

* A task takes the texts of a language in shards of bounded size. The phrases of a shard become an
  automaton that reads words: depth by depth, from the sorted phrases of the depth before, each state
  a phrase, its weight the phrase's occurrences. States of a depth are numbered in the order of their
  phrases, so a range of phrases is a range of states at every depth.
* Every automaton is cut at the same phrases into prefix ranges; the parts of a range, of all shards,
  meet in one task, which unions them and sums the weights. The cuts come from a sample of phrases
  (about ``samples`` for each range): a common word or phrase is cut at longer phrases, and a phrase
  itself is one state per shard however common it is.
* Phrases of a high enough weight stay. Their parts are looked up by composition: the parts of a
  range become an automaton of their own, which is followed through the automaton of the counts of
  that range, both a depth at a time. Ranges of many look-ups are dealt over several tasks.

The result is exact at every size; the sample shapes the partitions only. A language's first
``top`` phrases are a report, as the parameter says.

Defined results: null text is empty; a null language is ``und``; repeated rows count each. Pieces and
words hold any characters but those that part them. A text is one part of a shard however long it is.
Only the language and text columns are read. Tables without phrases that are common enough give no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.common import arrow_map, batches, blocks_of, written

#: A-Z become a-z, tabs blanks, and what parts pieces the byte 255, which no UTF-8 text holds.
_BREAK = b"\xff"
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 255 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


@dataclass(frozen=True)
class PhraseParams:
    """Phrases of up to ``words`` words with ``min_count`` occurrences; a candidate goes where a longer
    one holds it and has ``covered`` percent of its occurrences.

    ``shard_bytes`` of text make an automaton; a range stands for about ``range_bytes`` of text (a
    task holds the automata of one range: let it grow with the executors' memory); ``samples`` phrases
    place a range's cut; a task looks up about ``lookups`` parts.
    """

    words: int = 4
    min_count: int = 30
    covered: int = 80
    top: int = 2000
    shard_bytes: int = 16 << 20
    range_bytes: int = 8 << 20
    samples: int = 40
    lookups: int = 200_000


# --------------------------------------------------------------------------- automata
class _Numbers(dict):
    """Numbers of words in the order in which they are met; the break between pieces is 0."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def cut_words(text: str, numbers: _Numbers, chunk: int = 4 << 20) -> Iterator[np.ndarray]:
    """Word numbers of a text, 0 between pieces, a chunk of the text at a time."""
    raw, at = text.encode().translate(_BYTES), 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= chunk else raw.find(b" ", at + chunk)
        end = len(raw) if end < 0 else end
        found = raw[at:end].replace(_BREAK, b" \xff ").split()
        yield np.fromiter(map(numbers.__getitem__, found), dtype=np.int32, count=len(found))
        at = end


def _binary(words: list[bytes]) -> pa.Array:
    return pa.array(words, type=pa.large_binary())


def _planes(a: np.ndarray) -> bytes:
    """Integers as bytes, all lowest bytes first: they compress well."""
    kind = np.dtype("<u4") if not len(a) or a.max() < 1 << 32 else np.dtype("<u8")
    return bytes([kind.itemsize]) + np.ascontiguousarray(a.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    width = raw[0]
    rows = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(rows.T).view(f"<u{width}").ravel().astype(np.int64)


class Automaton:
    """A weighted acyclic automaton over words.

    ``words`` are sorted; at depth d (from 0) state i follows state ``parents[d][i]`` of the depth before
    by the word ``labels[d][i]``, and ``weights[d][i]`` is the weight of the phrase that ends there.
    States of a depth are sorted by (parent, label).
    """

    def __init__(self, words: pa.Array, parents: list[np.ndarray], labels: list[np.ndarray], weights: list[np.ndarray]):
        self.words, self.parents, self.labels, self.weights = words, parents, labels, weights

    def __len__(self) -> int:
        return sum(map(len, self.labels))

    @classmethod
    def of_stream(cls, stream: np.ndarray, numbers: _Numbers, depth: int) -> Automaton:
        """All phrases of a stream of word numbers (0 ends a piece)."""
        words = _binary(list(numbers)[1:])
        order = pc.array_sort_indices(words).to_numpy()
        rank = np.empty(len(words) + 1, dtype=np.int64)
        rank[0], rank[order + 1] = -1, np.arange(len(words))
        stream = np.concatenate([rank[stream], np.full(depth, -1)])
        at = np.flatnonzero(stream >= 0)
        state = np.zeros(len(at), dtype=np.int64)
        parents, labels, weights = [], [], []
        for d in range(depth):
            label = stream[at + d]
            inside = label >= 0
            at, key = at[inside], state[inside] * len(words) + label[inside]
            found, state, count = np.unique(key, return_inverse=True, return_counts=True)
            parents.append(found // max(len(words), 1))
            labels.append(found % max(len(words), 1))
            weights.append(count)
        return cls(words.take(pa.array(order)), parents, labels, weights)

    @classmethod
    def of_phrases(cls, phrases: list[bytes], weights: list[int] | None = None) -> tuple[Automaton, np.ndarray, np.ndarray]:
        """The automaton of distinct phrases (words joined by blanks), and every phrase's depth and state."""
        cut = [p.split(b" ") for p in phrases]
        size = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        coded = _binary([w for p in cut for w in p]).dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        flat = rank[coded.indices.to_numpy()] if len(order) else np.empty(0, dtype=np.int64)
        start = np.cumsum(size) - size
        rows, state = np.arange(len(cut)), np.zeros(len(cut), dtype=np.int64)
        final = np.zeros(len(cut), dtype=np.int64)
        weight = np.ones(len(cut), dtype=np.int64) if weights is None else np.array(weights, dtype=np.int64)
        out: tuple[list, list, list] = ([], [], [])
        for d in range(int(size.max(initial=0))):
            longer = size[rows] > d
            rows, state = rows[longer], state[longer]
            found, state = np.unique(state * len(order) + flat[start[rows] + d], return_inverse=True)
            ends = size[rows] == d + 1
            sums = np.zeros(len(found), dtype=np.int64)
            np.add.at(sums, state[ends], weight[rows[ends]])
            final[rows[ends]] = state[ends]
            for kept, made in zip(out, (found // len(order), found % len(order), sums)):
                kept.append(made)
        return cls(coded.dictionary.take(pa.array(order)), *out), size - 1, final

    def before(self, phrase: tuple[bytes, ...]) -> list[int]:
        """How many states of each depth stand for phrases before this one."""
        out, at, matched = [], 0, True
        for d, (parent, label) in enumerate(zip(self.parents, self.labels)):
            lo = int(np.searchsorted(parent, at))
            if matched and d < len(phrase):
                hi = int(np.searchsorted(parent, at, side="right"))
                word = self._place(phrase[d])
                lo += int(np.searchsorted(label[lo:hi], word[0]))
                matched = word[1] and lo < hi and label[lo] == word[0]
                out.append(lo + (matched and d + 1 < len(phrase)))
                at = lo
            else:
                out.append(lo)
                at, matched = lo, False
        return out

    def _place(self, word: bytes) -> tuple[int, bool]:
        lo, hi = 0, len(self.words)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.words[mid].as_py() < word:
                lo = mid + 1
            else:
                hi = mid
        return lo, lo < len(self.words) and self.words[lo].as_py() == word

    def part(self, lo: list[int], hi: list[int]) -> Automaton:
        """The states from ``lo`` to ``hi`` of each depth, and those that lead to them with weight 0."""
        start = list(lo)
        for d in range(len(lo) - 1, 0, -1):
            if start[d] < hi[d]:
                start[d - 1] = min(start[d - 1], int(self.parents[d][start[d]]))
        labels = [x[a:b] for x, a, b in zip(self.labels, start, hi)]
        weights = [x[a:b].copy() for x, a, b in zip(self.weights, start, hi)]
        for w, a, b in zip(weights, start, lo):
            w[: b - a] = 0
        parents = [x[a:b] - base for x, a, b, base in zip(self.parents, start, hi, [0, *start])]
        used = np.unique(np.concatenate(labels))
        return Automaton(self.words.take(pa.array(used)), parents, [np.searchsorted(used, x) for x in labels], weights)

    def ranges(self, cuts: list[tuple[bytes, ...]]) -> Iterator[tuple[int, Automaton]]:
        """(range, its part) of every range between the sorted cuts that has states."""
        edges = [[0] * len(self.labels), *map(self.before, cuts), [len(x) for x in self.labels]]
        for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
            if lo != hi:
                yield k, self.part(lo, hi)

    def dumps(self) -> bytes:
        import zstandard

        raw = self.words.to_pylist()
        parts = [_planes(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))), b"".join(raw)]
        before = 1
        for parent, label, weight in zip(self.parents, self.labels, self.weights):
            parts += [_planes(np.bincount(parent, minlength=before)), _planes(label), _planes(weight)]
            before = len(label)
        sizes = np.array([len(parts), *map(len, parts)], dtype="<u8").tobytes()
        return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(parts))

    @classmethod
    def loads(cls, data: bytes) -> Automaton:
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(data)
        n = int(np.frombuffer(raw, dtype="<u8", count=1)[0])
        sizes = np.frombuffer(raw, dtype="<u8", count=n, offset=8).astype(np.int64)
        edges = 8 * (n + 1) + np.concatenate([[0], np.cumsum(sizes)])
        parts = [raw[a:b] for a, b in zip(edges[:-1], edges[1:])]
        lengths = _from_planes(parts[0])
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(parts[1])])
        children, labels, weights = ([_from_planes(x) for x in parts[k::3]] for k in (2, 3, 4))
        return cls(words, [np.repeat(np.arange(len(c)), c) for c in children], labels, weights)

    @classmethod
    def union(cls, parts: list[Automaton]) -> Automaton:
        """All phrases of the parts, their weights summed."""
        if len(parts) == 1:
            return parts[0]
        coded = pa.concat_arrays([p.words for p in parts]).dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        codes = np.split(rank[coded.indices.to_numpy()], np.cumsum([len(p.words) for p in parts])[:-1])
        states = [np.zeros(1, dtype=np.int64) for _ in parts]
        out: tuple[list, list, list] = ([], [], [])
        for d in range(max(len(p.labels) for p in parts)):
            keys = [s[p.parents[d]] * len(order) + c[p.labels[d]] for p, s, c in zip(parts, states, codes)]
            found, at = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.zeros(len(found), dtype=np.int64)
            np.add.at(sums, at, np.concatenate([p.weights[d] for p in parts]))
            states = np.split(at, np.cumsum([len(k) for k in keys])[:-1])
            for kept, made in zip(out, (found // len(order), found % len(order), sums)):
                kept.append(made)
        return cls(coded.dictionary.take(pa.array(order)), *out)

    def phrases(self, least: int) -> Iterator[tuple[int, bytes, int]]:
        """(words, phrase, weight) of the phrases of at least this weight."""
        for d, weight in enumerate(self.weights):
            at = np.flatnonzero(weight >= least)
            state, columns = at, []
            for k in range(d, -1, -1):
                columns.append(self.words.take(pa.array(self.labels[k][state])).to_pylist())
                state = self.parents[k][state]
            for path, w in zip(zip(*reversed(columns)), weight[at].tolist()):
                yield d + 1, b" ".join(path), w

    def compose(self, other: Automaton) -> list[np.ndarray]:
        """For the states of ``other``, depth by depth, the weight of the same phrase here (0: none)."""
        code = pc.index_in(other.words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64) if len(self.words) else \
            np.full(len(other.words), -1, dtype=np.int64)
        mine, out = np.zeros(1, dtype=np.int64), []  # the state here of each state there; -1: none
        for d, (parent, label) in enumerate(zip(other.parents, other.labels)):
            from_, word = mine[parent], code[label]
            ok = (from_ >= 0) & (word >= 0)
            state, weight = np.full(len(label), -1, dtype=np.int64), np.zeros(len(label), dtype=np.int64)
            if d < len(self.labels) and len(self.labels[d]):
                keys = self.parents[d] * len(self.words) + self.labels[d]
                want = from_[ok] * len(self.words) + word[ok]
                at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                state[ok] = np.where(keys[at] == want, at, -1)
                weight[state >= 0] = self.weights[d][state[state >= 0]]
            mine = state
            out.append(weight)
        return out


# --------------------------------------------------------------------------- ranges
def _cuts(slim: DataFrame, p: PhraseParams) -> dict[str, list[tuple[bytes, ...]]]:
    """The sorted cuts between the prefix ranges of each language that has more than one range."""
    sizes = slim.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows")) \
        .where(F.col("bytes") > p.range_bytes).collect()
    wanted = {r.lang: -(-r.bytes // p.range_bytes) for r in sizes}
    if not wanted:
        return {}
    # A phrase starts at every sixth byte or so; each sampled document gives a few of its phrases.
    need = p.samples * max(wanted.values())
    share = {r.lang: min(1.0, p.samples * wanted[r.lang] / 4 / r.rows) for r in sizes}
    spread = max(int(max(r.bytes for r in sizes) / 6 / need), 1)
    spread = max(int(spread * max(share.values())), 1)

    def phrases(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(1)

        def rows() -> Iterator[tuple]:
            for part in parts:
                for lang, text in zip(*(c.to_pylist() for c in part.columns)):
                    numbers = _Numbers({_BREAK: 0})
                    stream = np.concatenate([*cut_words(text, numbers), np.zeros(p.words, dtype=np.int32)])
                    names, at = list(numbers), np.flatnonzero(stream)
                    for k in at[rng.random(len(at)) < 1 / spread].tolist():
                        end = next(j for j in range(k, k + p.words + 1) if j == k + p.words or not stream[j])
                        yield lang, [names[w] for w in stream[k:end]]

        yield from batches(rows(), pa.schema([("lang", pa.string()), ("phrase", pa.list_(pa.binary()))]))

    picked = None
    for lang, part in share.items():
        rule = (F.col("lang") == lang) & (F.rand(seed=1) < part)
        picked = rule if picked is None else picked | rule
    sample: dict[str, list[tuple[bytes, ...]]] = {}
    for row in slim.where(picked).transform(arrow_map, phrases, "lang string, phrase array<binary>").collect():
        sample.setdefault(row.lang, []).append(tuple(bytes(w) for w in row.phrase))
    out = {}
    for lang, found in sample.items():
        found.sort()
        n = wanted[lang]
        out[lang] = sorted(set(found[k * len(found) // n] for k in range(1, n)))
    return out


def _counted(slim: DataFrame, cuts: dict, p: PhraseParams) -> DataFrame:
    """(lang, range, words, phrase, weight): the phrases of ``min_count`` occurrences, and for every
    range a row of no words with the number of word occurrences."""
    shared = slim.sparkSession.sparkContext.broadcast(cuts)

    def shards(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        open_: dict[str, tuple[_Numbers, list[np.ndarray], list[int]]] = {}
        gap = np.zeros(1, dtype=np.int32)

        def close(lang: str) -> Iterator[pa.RecordBatch]:
            numbers, streams, _ = open_.pop(lang)
            whole = Automaton.of_stream(np.concatenate(streams), numbers, p.words)
            for k, part in whole.ranges(cuts.get(lang, [])):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([k], type=pa.int32()), pa.array([part.dumps()], type=pa.binary())],
                    names=["lang", "range", "part"])

        size = 0
        for part in parts:
            for some in blocks_of(part, 1):
                for lang, text in zip(*(c.to_pylist() for c in some.columns)):
                    if lang not in open_:
                        open_[lang] = (_Numbers({_BREAK: 0}), [], [0])
                    numbers, streams, held = open_[lang]
                    streams += [*cut_words(text, numbers), gap]
                    held[0] += len(text)
                    size += len(text)
                    if size >= p.shard_bytes:  # of all languages: the largest makes room
                        largest = max(open_, key=lambda x: open_[x][2][0])
                        size -= open_[largest][2][0]
                        yield from close(largest)
        for lang in list(open_):
            yield from close(lang)

    def merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("words", pa.int32()), ("phrase", pa.string()),
                            ("weight", pa.int64())])

        def closed(key: tuple, held: list[Automaton]) -> Iterator[tuple]:
            whole = Automaton.union(held)
            yield *key, 0, "", int(whole.weights[0].sum())
            for n, phrase, weight in whole.phrases(p.min_count):
                yield *key, n, phrase.decode(), weight

        def rows() -> Iterator[tuple]:
            key, held, states, met = None, [], 0, 0
            for part in parts:
                for lang, k, data in zip(*(c.to_pylist() for c in part.columns)):
                    if (lang, k) != key:
                        if key:
                            yield from closed(key, held)
                        key, held, states, met = (lang, k), [], 0, 0
                    held.append(Automaton.loads(data))
                    states += len(held[-1])
                    if states > 2 * met + 2_000_000:  # what is held at least doubles between unions
                        held = [Automaton.union(held)]
                        states = met = len(held[0])
            if key:
                yield from closed(key, held)

        yield from batches(rows(), schema)

    pieces = slim.transform(arrow_map, shards, "lang string, range int, part binary")
    n_ranges = sum(len(c) + 1 for c in cuts.values())
    n_parts = max(int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_ranges // 4)
    dealt = pieces.repartition(n_parts, "lang", "range").sortWithinPartitions("lang", "range")
    return written(dealt.transform(arrow_map, merged, "lang string, range int, words int, phrase string, weight long"), "phrases")


# --------------------------------------------------------------------------- look-ups
def _looked_up(counts: DataFrame, candidates: DataFrame, cuts: dict, p: PhraseParams) -> DataFrame:
    """(lang, phrase, a, k, l, r): the weights of both parts of every cut of every candidate."""
    shared = candidates.sparkSession.sparkContext.broadcast(cuts)

    def parts_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        schema = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("phrase", pa.string()), ("a", pa.int64()),
                            ("k", pa.int32()), ("side", pa.int32()), ("part", pa.string())])

        def rows() -> Iterator[tuple]:
            for batch in parts:
                for lang, phrase, a in zip(*(c.to_pylist() for c in batch.columns)):
                    words, mine = phrase.split(" "), cuts.get(lang, [])
                    for k in range(1, len(words)):
                        for side, some in enumerate((words[:k], words[k:])):
                            at = bisect_right(mine, tuple(w.encode() for w in some))
                            yield lang, at, phrase, a, k, side, " ".join(some)

        yield from batches(rows(), schema)

    asked = written(candidates.select("lang", "phrase", "a").transform(
        arrow_map, parts_of, "lang string, range int, phrase string, a long, k int, side int, part string"), "phrase-parts")
    loads = asked.groupBy("lang", "range").agg(F.ceil(F.count(F.lit(1)) / p.lookups).cast("int").alias("salts"))
    questions = asked.join(loads, ["lang", "range"]).select(
        "lang", "range", F.pmod(F.xxhash64("phrase", "k"), "salts").cast("int").alias("salt"), F.lit(1).alias("kind"),
        "part", "phrase", "a", "k", "side")
    known = counts.join(loads, ["lang", "range"]).select(
        "lang", "range", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"),
        F.col("phrase").alias("part"), F.lit(None).cast("string").alias("phrase"), F.col("weight").alias("a"),
        F.lit(0).alias("k"), F.lit(0).alias("side"))
    order = ["lang", "range", "salt", "kind"]
    dealt = known.unionByName(questions).repartition("lang", "range", "salt").sortWithinPartitions(*order)

    def answers(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("k", pa.int32()),
                            ("side", pa.int32()), ("weight", pa.int64())])

        def rows() -> Iterator[tuple]:
            key, names, weights, table, open_ = None, [], [], None, []
            for batch in parts:
                for lang, range_, salt, kind, part, phrase, a, k, side in zip(*(c.to_pylist() for c in batch.columns)):
                    if (lang, range_, salt) != key:
                        yield from asked_of(table, names, weights, open_)
                        key, names, weights, table, open_ = (lang, range_, salt), [], [], None, []
                    if kind == 0:
                        names.append(part.encode())
                        weights.append(a)
                    else:
                        open_.append((part.encode(), lang, phrase, a, k, side))
                        if len(open_) >= 50_000:
                            table = table or Automaton.of_phrases(names, weights)[0]
                            yield from asked_of(table, names, weights, open_)
                            open_ = []
            yield from asked_of(table, names, weights, open_)

        def asked_of(table, names, weights, open_) -> Iterator[tuple]:
            if not open_:
                return
            table = table or Automaton.of_phrases(names, weights)[0]
            distinct = list({q[0] for q in open_})
            parts_, depth, state = Automaton.of_phrases(distinct)
            found = table.compose(parts_)
            weight = {q: int(found[d][s]) for q, d, s in zip(distinct, depth.tolist(), state.tolist())}
            for part, lang, phrase, a, k, side in open_:
                yield lang, phrase, a, k, side, weight[part]

        yield from batches(rows(), schema)

    found = dealt.transform(arrow_map, answers, "lang string, phrase string, a long, k int, side int, weight long")
    return found.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("weight"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("weight"))).alias("r"))


def _covered(candidates: DataFrame, p: PhraseParams) -> DataFrame:
    """Candidates that no longer one covers."""
    words = F.split("phrase", " ")
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: F.array_join(F.slice(words, at, n), " ")))))
    longer = candidates.where("words > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("longest"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    hidden = F.coalesce(F.lit(100) * wide("longest") >= F.lit(p.covered) * wide("a"), F.lit(False))
    return candidates.join(longer, ["lang", "phrase"], "left").where(~hidden).drop("longest")


def collocations(docs: DataFrame, p: PhraseParams = PhraseParams(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of every language."""
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    cuts = _cuts(slim, p)
    counted = _counted(slim, cuts, p)
    totals = counted.where("words = 0").groupBy("lang").agg(F.sum("weight").alias("n"))
    counts = counted.where("words > 0").drop("words")
    candidates = counted.where("words > 1").select("lang", "words", "phrase", F.col("weight").alias("a"))
    stay = _covered(candidates, p)
    cut = _looked_up(counts, stay, cuts, p).withColumn("score", F.expr(
        "cast(2000000 * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)"))
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b")).select(
        "lang", "phrase", "a", "b.l", "b.r", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
