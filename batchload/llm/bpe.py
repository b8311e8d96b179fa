"""Byte-level BPE encoding and decoding by replaying the merges over a whole block of words.

Texts are cut into words by the tokenizer's pattern; the distinct words of a block of documents are
laid out as one array of byte symbols. An inverted index from the rank of a pair of neighbours to its
positions drives the merges: the lowest rank present is applied at all its positions at once, and
only the neighbours of these positions are looked up again. Equal words are encoded once per block,
and words that an earlier block of the task has encoded are taken from there.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A block holds whole documents of about so many characters.
BLOCK_CHARS = 2_000_000
#: Words kept from block to block; beyond, the task starts afresh.
KEPT_WORDS = 120_000


class Ranks:
    """A vocabulary of byte strings by rank, with every pair of tokens that joins to a token."""

    def __init__(self, lines: bytes):
        ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in lines.splitlines() if line)
        }
        self.ranks = ranks
        self.width = max(ranks.values()) + 1
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[token[:i]] * self.width + ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        pairs.sort()
        self.pairs = np.array([key for key, _ in pairs] or [-1], np.int64)
        self.pair_ranks = np.array([rank for _, rank in pairs] or [-1], np.int32)
        tokens = [b""] * self.width
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that two neighbours make, -1 where they make none."""
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], -1)

    def encode_word(self, word: bytes) -> list[int]:
        """One word by itself: the lowest rank first, the leftmost of equal ones."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            joined = [
                (rank, i)
                for i, pair in enumerate(zip(parts, parts[1:], strict=False))
                if (rank := self.ranks.get(pair[0] + pair[1])) is not None
            ]
            if not joined:
                return [self.ranks[part] for part in parts]
            _, i = min(joined)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts): the ids of all words one after the other, and where each word starts.

        Words must not be empty.
        """
        if not words:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        symbols = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        lengths = np.array([len(word) for word in words], np.int64)
        ends = np.cumsum(lengths)
        n = len(symbols)
        after = np.arange(1, n + 1, dtype=np.int64)
        after[ends - 1] = n  # place n stands for the end of a word
        before = np.arange(-1, n, dtype=np.int64)
        before[ends[:-1]] = n
        before[0] = n
        # The rank of the pair that starts at a place; -1 where there is none or the place is gone.
        pair = np.full(n + 1, -1, np.int32)
        inner = np.flatnonzero(after < n)
        pair[inner] = self.join(symbols[inner], symbols[inner + 1])
        marked = np.zeros(n + 1, bool)
        gone = np.zeros(n, bool)
        again: list[np.ndarray] = []  # places in words to be encoded by themselves
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(places: np.ndarray) -> None:
            ranks = pair[places]
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            firsts = ranks[np.concatenate([[0], cuts])].tolist()
            bounds = [0, *cuts.tolist(), len(places)]
            for k, rank in enumerate(firsts):
                part = places[bounds[k] : bounds[k + 1]]
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(heap, rank)

        if len(found := np.flatnonzero(pair[:n] >= 0)):
            note(found)
        while heap:
            rank = heapq.heappop(heap)
            parts = index.pop(rank)
            left = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            left = left[pair[left] == rank]
            if not len(left):
                continue
            right = after[left]
            marked[left] = True
            if marked[right].any():
                left = _leftmost(left, right, marked)
                right = after[left]
            marked[parts[0]] = False
            for part in parts[1:]:
                marked[part] = False
            symbols[left] = rank
            gone[right] = True
            pair[right] = -1
            following = after[right]
            after[left] = following
            held = following < n
            before[following[held]] = left[held]
            previous = before[left]
            touched = np.concatenate([left, previous[previous < n]])
            follows = after[touched]
            ok = follows < n
            pair[touched[~ok]] = -1
            touched, follows = touched[ok], follows[ok]
            if not len(touched):
                continue
            fresh = self.join(symbols[touched], symbols[follows])
            pair[touched] = fresh
            some = fresh >= 0
            if some.any():
                places = touched[some]
                if (fresh[some] < rank).any():
                    # A merge of lower rank has come up late: it may have to go before other merges
                    # of this rank in its word.
                    again.append(places[fresh[some] < rank])
                note(places)
        ids = symbols[~gone]
        kept = np.concatenate([[0], np.cumsum(~gone)])
        starts = np.concatenate([[0], kept[ends]])
        if again:
            ids, starts = self._corrected(words, np.concatenate(again), ends, ids, starts)
        return ids, starts

    def _corrected(self, words, places, ends, ids, starts):
        out = [ids[starts[k] : starts[k + 1]] for k in range(len(words))]
        for k in np.unique(np.searchsorted(ends, places, side="right")):
            out[k] = np.array(self.encode_word(words[k]), np.int32)
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        lengths = self.lengths[ids]
        return self.bytes[ranges(self.starts[ids], lengths)]


    def decoded(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes of each of several sequences of ids."""
        values, offsets = ids.flatten().to_numpy(), ids.offsets.to_numpy()
        upto = np.concatenate([[0], np.cumsum(self.lengths[values])])
        cuts = (upto[offsets - offsets[0]]).astype(np.int32)
        data = [pa.py_buffer(part) for part in (cuts.tobytes(), self.decode(values).tobytes())]
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, *data])


def _leftmost(left: np.ndarray, right: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Of pairs that share a symbol, as in runs of one letter, the ones that come first."""
    taken, blocked = [], -1
    overlaps = marked[right]
    for place, follows, more in zip(left.tolist(), right.tolist(), overlaps.tolist(), strict=True):
        if place == blocked:
            blocked = -1
            continue
        taken.append(place)
        blocked = follows if more else -1
    return np.array(taken, np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... lengths[0] numbers, then from starts[1], and so on."""
    shift = starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(starts) else starts
    return np.arange(int(lengths.sum())) + np.repeat(shift, lengths)


@lru_cache(maxsize=2)
def _ranks(lines: bytes) -> Ranks:
    """Made once per Python worker."""
    return Ranks(lines)


def ship(spark, path: str):
    """The rank file, read on the driver and broadcast; it is as large as a vocabulary is."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids) for every row: the ids of the whole text, an empty array for null or empty.

    Special tokens are ordinary text. Repeated rows give repeated rows; other columns play no part.
    A text is never split over blocks, so a block is as large as the longest text at least.
    """
    return _encoded(docs, ranks_path, pattern, id_col, text_col, decoding=False)


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids, decoded): as `encode`, and the bytes that the ids decode to, in one pass."""
    return _encoded(docs, ranks_path, pattern, id_col, text_col, decoding=True)


def _encoded(docs, ranks_path, pattern, id_col, text_col, decoding: bool) -> DataFrame:
    shared = ship(docs.sparkSession, ranks_path)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoding:
        schema = T.StructType([*schema.fields, T.StructField("decoded", T.BinaryType())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, cut = _ranks(shared.value), regex.compile(pattern).findall
        words = _Words(ranks)
        for batch in batches:
            texts, first, size, block = batch.column(1), 0, 0, []
            for row in range(batch.num_rows):
                text = texts[row].as_py() or ""
                block.append(words.numbered(cut(text)))
                size += len(text)
                if size >= BLOCK_CHARS or row == batch.num_rows - 1:
                    columns = [batch.column(0).slice(first, row + 1 - first), words.ids(block)]
                    if decoding:
                        columns.append(ranks.decoded(columns[1]))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                    first, size, block = row + 1, 0, []
                    if len(words) > KEPT_WORDS:
                        words = _Words(ranks)

    return rows.mapInArrow(encoded, schema)


class _Words:
    """Numbers words as they come, and knows the ids of those it has encoded."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.numbers)

    def numbered(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))

    def ids(self, block: list[np.ndarray]) -> pa.ListArray:
        known = len(self.starts) - 1
        new = [word.encode("utf-8", "surrogatepass") for word in list(self.numbers)[known:]]
        flat, starts = self.ranks.encode_words(new)
        self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])
        self.flat = np.concatenate([self.flat, flat])
        offsets, parts = [0], []
        for numbers in block:
            lengths = self.starts[numbers + 1] - self.starts[numbers]
            parts.append(self.flat[ranges(self.starts[numbers], lengths)])
            offsets.append(offsets[-1] + len(parts[-1]))
        values = np.concatenate(parts) if parts else self.flat[:0]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """`encoded` (doc_id, ids) with `decoded`, the bytes that the ids stand for; null ids give null."""
    shared = ship(encoded.sparkSession, ranks_path)
    rows = encoded.select("doc_id", "ids")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(shared.value)
        for batch in batches:
            ids = batch.column(1)
            known = ranks.decoded(ids.fill_null([])).to_pylist()
            out = [x if ok else None for x, ok in zip(known, ids.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids, pa.array(out, pa.binary())],
                names=["doc_id", "ids", "decoded"],
            )

    return rows.mapInArrow(decoded, schema)


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(ids.cast("array<string>"), " ")
