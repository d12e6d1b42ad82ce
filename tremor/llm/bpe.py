"""Byte-level BPE by a two-tier lookup: a minimal perfect hash, then a heap over linked bytes.

A text is cut into pre-tokens by the vocabulary's pattern. The distinct pre-tokens of a slice
of rows are looked up together in a minimal perfect hash of the whole vocabulary; those that
are one token need no merging. Each of the others is merged byte by byte: neighbours stand in
a linked list, and a heap yields the pair of the lowest rank, leftmost first.

The work is row by row, so there is no shuffle, no key and no skew; a task holds one slice of
texts at a time. Null text has no bytes: its ids are empty. Repeated rows are encoded alike.
Ids that the vocabulary lacks decode to null, as does a null list. All other columns pass
through; a column that has the name of a new one is replaced.
"""

import base64
import heapq
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tremor.llm.common import forget, kept_in_worker, list_array, offsets, ragged, release, ship, slices

#: Merged pre-tokens that a Python worker remembers; past it, it starts afresh.
MEMO = 300_000
#: Ids that one step of decoding holds at once.
SLICE_IDS = 1 << 20

_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    x = values ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MinimalPerfectHash:
    """Sends n distinct byte strings to the slots 0 .. n-1, each to its own.

    Keys fall into buckets. Larger buckets are placed first, each by the first displacement
    that sends its keys to free slots; a bucket of one key names its slot outright.
    """

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.longest = max(map(len, keys), default=0)
        self._powers = np.ones(self.longest + 1, np.uint64)
        np.cumprod(np.full(self.longest, 0x100000001B3, np.uint64), out=self._powers[1:])
        hashed = self._hash(keys)
        self._buckets = max(1, self.size)
        bucket = (_mixed(hashed, _MIX[0]) % np.uint64(self._buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self._buckets)
        at = offsets(counts)
        self._moves = np.zeros(self._buckets, np.int64)
        free = np.ones(self.size, bool)
        slot = np.zeros(self.size, np.int64)
        for b in np.argsort(-counts, kind="stable"):
            members = order[at[b] : at[b + 1]]
            if len(members) < 2:
                break
            move = 1
            while True:
                to = self._slots(hashed[members], np.full(len(members), move))
                if free[to].all() and len(set(to.tolist())) == len(to):
                    break
                move += 1
            free[to] = False
            slot[members] = to
            self._moves[b] = move
        left = np.flatnonzero(free)
        alone = np.flatnonzero(counts == 1)
        single = order[at[:-1][alone]]
        slot[single] = left[: len(single)]
        self._moves[alone] = -left[: len(single)] - 1
        self.slot_of_key = slot

    def _hash(self, keys: list[bytes]) -> np.ndarray:
        """A polynomial of each key's bytes, modulo 2 ** 64."""
        if not keys:
            return np.zeros(0, np.uint64)
        lengths = np.fromiter(map(len, keys), np.int64, len(keys))
        data = np.frombuffer(b"".join(keys), np.uint8).astype(np.uint64) + np.uint64(1)
        starts = offsets(lengths)[:-1]
        power = self._powers[ragged(np.zeros(len(keys), np.int64), lengths)]
        out = np.zeros(len(keys), np.uint64)
        full = lengths > 0
        out[full] = np.add.reduceat(data * power, starts[full]) if full.any() else 0
        return out

    def _slots(self, hashed: np.ndarray, move: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            step = move.astype(np.uint64) * np.uint64(_MIX[1])
        return (_mixed(hashed + step, _MIX[1]) % np.uint64(self.size)).astype(np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """The slot that each key has if it is in the set; otherwise any slot, or -1."""
        if not self.size:
            return np.full(len(keys), -1)
        short = np.fromiter(map(len, keys), np.int64, len(keys)) <= self.longest
        out = np.full(len(keys), -1, np.int64)
        hashed = self._hash([k for k, ok in zip(keys, short.tolist(), strict=True) if ok])
        move = self._moves[(_mixed(hashed, _MIX[0]) % np.uint64(self._buckets)).astype(np.int64)]
        out[short] = np.where(move < 0, -move - 1, self._slots(hashed, move))
        return out


def merge_by_heap(symbols: list[int], joined: dict[int, int], base: int) -> list[int]:
    """Merge neighbours, the pair that makes the lowest rank first, of equals the leftmost.

    Symbols are ranks; ``joined[left * base + right]`` is the rank that a pair makes.
    """
    last = len(symbols) - 1
    after = [*range(1, last + 1), -1]
    before = [*range(-1, last)]
    # What the pair that starts here would make now; older heap entries differ from it.
    makes = [joined.get(symbols[i] * base + symbols[i + 1], -1) for i in range(last)] + [-1]
    heap = [made << 32 | i for i, made in enumerate(makes) if made >= 0]
    heapq.heapify(heap)
    while heap:
        made, i = divmod(heapq.heappop(heap), 1 << 32)
        if makes[i] != made:
            continue
        gone = after[i]
        symbols[i], symbols[gone] = made, -1
        makes[gone] = -1
        after[i] = j = after[gone]
        if j >= 0:
            before[j] = i
            makes[i] = found = joined.get(made * base + symbols[j], -1)
            if found >= 0:
                heapq.heappush(heap, found << 32 | i)
        else:
            makes[i] = -1
        h = before[i]
        if h >= 0:
            makes[h] = found = joined.get(symbols[h] * base + made, -1)
            if found >= 0:
                heapq.heappush(heap, found << 32 | h)
    return [s for s in symbols if s >= 0]


def read_ranks(path: str) -> dict[bytes, int]:
    """The byte strings of a rank file, each with its rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class TokenBytes:
    """The bytes that each id of a vocabulary stands for, which is all that decoding needs."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = [None] * (max(ranks.values(), default=-1) + 1)
        for key, rank in ranks.items():
            by_id[rank] = key
        self.known = np.array([k is not None for k in by_id], bool)
        self.lengths = np.array([len(k or b"") for k in by_id], np.int64)
        self.bytes = np.frombuffer(b"".join(k or b"" for k in by_id), np.uint8)
        self.starts = offsets(self.lengths)[:-1]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
        """The bytes of each row of ids, or None where the vocabulary lacks one of them."""
        sound = (ids >= 0) & (ids < len(self.known))
        sound[sound] = self.known[ids[sound]]
        used = np.where(sound, ids, 0)
        sizes = np.where(sound, self.lengths[used], 0) if len(self.lengths) else used * 0
        data = self.bytes[ragged(self.starts[used], sizes)].tobytes() if len(ids) else b""
        at = offsets(counts)
        ends = offsets(sizes)[at]
        bad = offsets(~sound)[at]
        return [
            data[ends[i] : ends[i + 1]] if bad[i] == bad[i + 1] else None
            for i in range(len(counts))
        ]


class ByteBpe(TokenBytes):
    """A vocabulary of byte strings and their ranks, which are also their ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__(ranks)
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        keys = list(ranks)
        self.hash = MinimalPerfectHash(keys)
        self._key_at = [b""] * len(keys)
        self._id_at = [b""] * len(keys)  # as four bytes, like all ids of pre-tokens
        for key, slot in zip(keys, self.hash.slot_of_key.tolist(), strict=True):
            self._key_at[slot], self._id_at[slot] = key, array("i", [ranks[key]]).tobytes()
        self._memo: dict[bytes, bytes] = {}
        self._base = len(self.known)
        self._joined = {
            ranks[left] * self._base + ranks[right]: rank
            for key, rank in ranks.items()
            for i in range(1, len(key))
            if (left := key[:i]) in ranks and (right := key[i:]) in ranks
        }
        self._byte = [ranks.get(bytes([i]), -1) for i in range(256)]

    @classmethod
    def load(cls, path: str, pattern: str) -> "ByteBpe":
        return cls(read_ranks(path), pattern)

    def merged(self, token: bytes) -> bytes:
        """The ids of a pre-token, four bytes each."""
        ids = self._memo.get(token)
        if ids is None:
            merged = merge_by_heap([self._byte[b] for b in token], self._joined, self._base)
            ids = array("i", merged).tobytes()
            if len(self._memo) >= MEMO:
                self._memo.clear()
            if len(token) <= 64:
                self._memo[token] = ids
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each text has."""
        words = [self.pattern.findall(text) for text in texts]
        index = {word: i for i, word in enumerate(dict.fromkeys(chain.from_iterable(words)))}
        distinct = [word.encode() for word in index]
        slots = self.hash.slots(distinct).tolist()
        # A slot's key is compared, because words outside the set also get slots.
        key_at, id_at = self._key_at, self._id_at
        of_word = [
            id_at[slot] if slot >= 0 and key_at[slot] == word else self.merged(word)
            for word, slot in zip(distinct, slots, strict=True)
        ]
        sizes = np.fromiter(map(len, of_word), np.int64, len(of_word)) // 4
        flat = np.frombuffer(b"".join(of_word), np.int32)
        starts = offsets(sizes)[:-1]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        where = np.fromiter(
            map(index.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum())
        )
        each = sizes[where] if len(where) else np.zeros(0, np.int64)
        ids = flat[ragged(starts[where], each)] if len(where) else flat
        ends = offsets(each)[offsets(counts)]
        return ids, np.diff(ends)


@kept_in_worker
def vocabulary(path: str, pattern: str) -> ByteBpe:
    return ByteBpe.load(path, pattern)


@kept_in_worker
def token_bytes(path: str) -> TokenBytes:
    return TokenBytes(read_ranks(path))


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema if f.name != name] + [T.StructField(name, kind)])


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [i for i, field in enumerate(batch.schema.names) if field != name]
    columns = [*(batch.column(i) for i in kept), values]
    return pa.RecordBatch.from_arrays(columns, [*(batch.schema.names[i] for i in kept), name])


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids"
) -> DataFrame:
    """Add the token ids of ``text``. ``path`` names a rank file that every executor can open."""
    ship(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(vocabulary, token_bytes)
        bpe = vocabulary(path, pattern)
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(part.schema.get_field_index(text))
                texts = [value or "" for value in column.to_pylist()]
                yield _replaced(part, ids, list_array(*bpe.encode(texts), pa.int32()))
        release()

    return df.mapInArrow(run, _with(df.schema, ids, T.ArrayType(T.IntegerType())))


def decode(
    df: DataFrame, path: str, pattern: str, ids: str = "token_ids", data: str = "decoded"
) -> DataFrame:
    """Add the bytes that the ids stand for; the rank file says all, whatever the ``pattern``."""
    ship(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(vocabulary, token_bytes)
        table = token_bytes(path)
        for batch in batches:
            # Rows are cut by the number of ids; a slice of them needs a few bytes each.
            for part in slices(batch, ids, SLICE_IDS):
                column = part.column(part.schema.get_field_index(ids))
                counts = pc.list_value_length(column).fill_null(0).to_numpy(False)
                values = column.flatten().fill_null(-1).to_numpy(False)
                found = table.decode(values.astype(np.int64), counts.astype(np.int64))
                none = column.is_null().to_numpy(False)
                found = [None if gone else x for x, gone in zip(found, none, strict=True)]
                yield _replaced(part, data, pa.array(found, pa.binary()))
        release()

    return df.mapInArrow(run, _with(df.schema, data, T.BinaryType()))
