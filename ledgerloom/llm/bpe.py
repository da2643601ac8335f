"""Encoding of a corpus with a public byte-level BPE vocabulary, by a pair occurrence index.

Texts are cut into words by the vocabulary's pattern. The distinct new words of a chunk of a partition are laid out as
one array of byte tokens. An index maps every adjacent pair to all its positions; the ranks of the pairs that occur
("active" ranks) are taken in ascending order from a heap, and for each one all its positions are merged, which updates
the lists of the neighbouring pairs. Each word's ids are kept for the partition, so a word is merged once.

Defined results: an empty and a NULL text give an empty list; marks that look like special tokens are ordinary text
(the vocabulary's special tokens are never produced); texts of any length are encoded whole; repeated rows give repeated
results; characters that are no valid UTF-8 (lone surrogates) are encoded as the replacement character.

Scale: a narrow map with no shuffle; the vocabulary is read by each Python worker from ``vocabulary``, a path that must
exist on every executor, and is never shipped with the plan.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabularies lie; a parameter of every function here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which this public vocabulary cuts text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a partition remembers, and characters of text that are encoded at a time.
WORDS_KEPT, CHUNK_CHARS = 400_000, 2_000_000


class PairIndexEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.byte = [ranks[bytes([b])] for b in range(256)]
        self.pair_rank: dict[tuple[int, int], int] = {}
        by_id = {i: t for t, i in ranks.items()}
        self.bytes_of = by_id
        self.ranks = ranks
        self.words: dict[str, tuple[int, ...]] = {}
        self.cut = regex.compile(PATTERN)

    @staticmethod
    def load(path: str) -> PairIndexEncoder:
        with open(path, "rb") as f:
            return PairIndexEncoder({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def rank(self, a: int, b: int) -> int:
        """The rank of merging tokens a and b, which is the id of the merged token; -1 if they do not merge."""
        found = self.pair_rank.get((a, b))
        if found is None:
            found = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1)
            self.pair_rank[(a, b)] = found
        return found

    def learn(self, words: Iterable[str]) -> None:
        """Merge the given new words together and remember their ids."""
        words = list(words)
        tokens: list[int] = []
        starts: list[int] = []
        byte = self.byte
        for w in words:
            starts.append(len(tokens))
            tokens.extend(byte[b] for b in w.encode("utf-8", "replace"))
            tokens.append(-1)  # ends a word; merges with nothing
        n = len(tokens)
        following = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        positions: dict[int, list[int]] = {}  # by rank, which names the pair's merged token
        made_of: dict[int, set[tuple[int, int]]] = {}
        rank = self.rank
        for p in range(n - 1):
            a, b = tokens[p], tokens[p + 1]
            if a >= 0 and b >= 0 and (r := rank(a, b)) >= 0:
                positions.setdefault(r, []).append(p)
                made_of.setdefault(r, set()).add((a, b))
        active = list(positions)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            at, pairs = positions.pop(r), made_of.pop(r)
            at.sort()
            for p in at:
                a = tokens[p]
                if a < 0:
                    continue
                q = following[p]
                if q >= n or (a, tokens[q]) not in pairs:
                    continue
                tokens[p], tokens[q] = r, -2  # -2: swallowed
                after = following[q]
                following[p], before[after] = after, p
                left = before[p]
                for x, y, place in ((left, p, left), (p, after, p)):
                    if x < 0 or y >= n:
                        continue
                    u, v = tokens[x], tokens[y]
                    if u >= 0 and v >= 0 and (s := rank(u, v)) >= 0:
                        if s not in positions:
                            positions[s], made_of[s] = [], set()
                            heapq.heappush(active, s)
                        positions[s].append(place)
                        made_of[s].add((u, v))
        if len(self.words) + len(words) > WORDS_KEPT:
            self.words.clear()
        for w, p in zip(words, starts):
            ids = []
            while tokens[p] != -1:
                ids.append(tokens[p])
                p = following[p]
            self.words[w] = tuple(ids)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        cut = [self.cut.findall(t) if t else [] for t in texts]
        new = {w for words in cut for w in words if w not in self.words}
        if new:
            if len(self.words) + len(new) > WORDS_KEPT:  # forget, and learn this chunk anew
                self.words.clear()
                new = {w for words in cut for w in words}
            self.learn(new)
        known, out = self.words, []
        for words in cut:
            ids: list[int] = []
            for w in words:
                ids += known[w]
            out.append(ids)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PairIndexEncoder:
    return PairIndexEncoder.load(path)


def _chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _encode_batches(path: str, count_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            done = 0
            for chunk in _chunks(batch["text"].to_pylist()):
                ids = bpe.encode(chunk)
                keys = batch["id"].slice(done, len(chunk))
                done += len(chunk)
                out = pa.array([len(x) for x in ids], pa.int64()) if count_only else pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([keys, out], names=["id", "out"])

    return run


def encode(df: DataFrame, row_id: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """row id and ``ids`` (array<int>) of every row."""
    kind = df.schema[row_id].dataType.simpleString()
    rows = df.select(F.col(row_id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_encode_batches(vocabulary, False), f"id {kind}, out array<int>").toDF(row_id, "ids")


def token_counts(df: DataFrame, row_id: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """row id and ``n_tokens`` of every row; the ids stay in the workers."""
    kind = df.schema[row_id].dataType.simpleString()
    rows = df.select(F.col(row_id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_encode_batches(vocabulary, True), f"id {kind}, out bigint").toDF(row_id, "n_tokens")
