"""Alignment of two tokenizers over the same bytes, and how often their tokens meet.

A is a byte-level BPE tokenizer, B a sentence-piece model that puts a blank in front; A gets that
blank too. Offsets at which a token of A and one of B both end cut a text into groups. They are
found by divide and conquer: of an interval the common end nearest to the middle token of A is
located by bisecting B's ends, outwards in rings that double; both halves go on in the same way,
and an interval without a common end inside is a leaf, which is a group. The intervals of all
documents of a block are open together, as numpy arrays, so that there are some three log n
rounds, whatever the texts.

``align`` gives the groups. ``measure`` counts in addition how often each pair of ids is linked
(their bytes overlap) in all documents, and what that says of each document:

1. One pass over the texts makes one row for each block of about BLOCK bytes: facts of its
   documents, its distinct pairs with their counts, by bucket of the B id, and for each document
   which of them it has, packed. It is stored; the texts are not read again, nor shuffled.
2. Counts are summed by bucket in two steps, over groups of blocks and over the groups, so that no
   task gathers more than SUMMED blocks, and then no more than the pairs that there are. A pair
   that a third of all text has is one entry for each block.
3. The sums go back to the groups of blocks, and from there to each block.

Null and empty texts have no tokens, nor have texts that a tokenizer does not give back byte by
byte: all their numbers are 0. Every row is a document of its own, also where ids repeat; a null
id stays null. A document longer than a block is a block; it is aligned whole, in memory. An
empty table gives no rows. ``align`` keeps all columns but those that have the names of new ones;
``measure`` keeps the id alone.
"""

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm.bpe import merge_by_heap
from tremor.llm.common import byte_signs, list_array, offsets, ragged, release, ship, slices
from tremor.sinks import settled, stored

#: Bytes of text that are aligned together.
BLOCK = 4 << 20
#: B ids fall into so many buckets.
BUCKETS = 64
#: Blocks whose counts one task sums up.
SUMMED = 4096

# Fixed value: how a byte-level tokenizer of this kind splits texts before its merges.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_level(path: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]]]:
    """The bytes of a byte-level tokenizer's tokens, and its merges."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    model, split = made["model"], made["pre_tokenizer"] or {}
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")
    if (
        made["normalizer"]
        or split.get("type") != "ByteLevel"
        or split["add_prefix_space"]
        or any(model.get(name) for name in options)
    ):
        raise ValueError("only byte-level tokenizers without normaliser, prefix or suffix")
    signs = byte_signs()
    special = {token["content"] for token in made["added_tokens"]}

    def data(token: str) -> bytes:
        return bytes(signs[s] for s in token)

    ranks = {data(token): i for token, i in model["vocab"].items() if token not in special}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    return ranks, [(data(left), data(right)) for left, right in pairs]


@lru_cache(maxsize=2)
def check_byte_level(path: str) -> None:
    """Refuse a vocabulary whose ids do not say all about its merges.

    Ids must follow the merges, and each token must come out of its own bytes by the merges alone.
    Then two neighbours that spell a token are always the pair that its merge names, so that
    merging by ids, as rank files are used, gives what the merges give.
    """
    ranks, merges = _byte_level(path)
    order = [ranks[left + right] for left, right in merges]
    base = max(ranks.values()) + 1
    joined = {ranks[left] * base + ranks[right]: i for (left, right), i in zip(merges, order, strict=True)}
    byte = [ranks[bytes([b])] for b in range(256)]
    if order != sorted(set(order)) or len(ranks) != len(merges) + 256:
        raise ValueError("the ids do not follow the merges")
    if any(merge_by_heap([byte[b] for b in token], joined, base) != [i] for token, i in ranks.items()):
        raise ValueError("a token does not come out of its own bytes")


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens by id."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        ranks, _ = _byte_level(path_a)
        self._a = tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        pieces = range(self._b.get_piece_size())
        self.bytes_b = [
            bytes([int(name[3:5], 16)]) if self._b.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in ((i, self._b.id_to_piece(i)) for i in pieces)
        ]
        self.lengths_a, self.lengths_b = (
            np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b)
        )
        #: Every id in decimal figures, with each of the two signs that can follow it.
        self.figures = [
            b"%d%c" % (i, sign)
            for table, signs in ((self.bytes_a, b",|"), (self.bytes_b, b",;"))
            for i in range(len(table))
            for sign in signs
        ]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of both sides; none where either does not give back the bytes of the text."""
        ids_b = self._b.encode(texts, num_threads=1)
        out_a, out_b = [], []
        none = np.zeros(0, np.int64)
        for text, b in zip(texts, ids_b, strict=True):
            # A has a token for each byte, so that it gives back the bytes of any text.
            sound = bool(text) and b"".join(map(self.bytes_b.__getitem__, b)) == b" " + text.encode()
            out_a.append(self._a.encode_to_numpy(" " + text) if sound else none)
            out_b.append(np.array(b, np.int64) if sound else none)
        return out_a, out_b


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _nearest_cut(common, first, last) -> np.ndarray:
    """In each range of A's ends the common one nearest to its middle, the left one of two; or -1."""
    middle = (first + last) // 2
    reach = np.maximum(middle - first, last - middle)
    found = np.full(len(first), -1)
    found[(first <= last) & common[np.minimum(middle, len(common) - 1)]] = 0
    open_ = np.flatnonzero((first < last) & (found < 0))
    found = np.where(found < 0, -1, middle)
    near = 1
    while len(open_):
        far = 2 * near + 1  # this ring has the distances from near to far, without it
        width = np.minimum(far, reach[open_] + 1) - near
        owner = np.repeat(np.arange(len(open_)), 2 * width)
        slot = ragged(np.zeros(len(open_), np.int64), 2 * width)
        distance = near + slot // 2
        place = middle[open_][owner] + np.where(slot % 2, distance, -distance)
        inside = (place >= first[open_][owner]) & (place <= last[open_][owner])
        hit = np.flatnonzero(inside)
        hit = hit[common[place[hit]]]
        nearest = hit[np.flatnonzero(np.diff(owner[hit], prepend=-1))]
        found[open_[owner[nearest]]] = place[nearest]
        near = far
        open_ = open_[(found[open_] < 0) & (reach[open_] >= near)]
    return found


def groups(ends_a, ends_b, a_lo, a_hi, b_lo, b_hi) -> np.ndarray:
    """The groups of some intervals of tokens, in order: rows of a_lo, a_hi, b_lo, b_hi.

    Ends rise over all intervals, and each interval's last ends are equal.
    """
    open_ = np.stack([a_lo, a_hi, b_lo, b_hi], axis=1)
    open_ = open_[open_[:, 0] < open_[:, 1]]
    # Where each end of A stands among B's, by bisecting them, and if it is one of them.
    place = np.searchsorted(ends_b, ends_a)
    common = ends_b[place] == ends_a
    leaves = []
    while len(open_):
        single = (open_[:, 1] - open_[:, 0] == 1) | (open_[:, 3] - open_[:, 2] == 1)
        leaves.append(open_[single])
        open_ = open_[~single]
        at = _nearest_cut(common, open_[:, 0], open_[:, 1] - 2)
        leaves.append(open_[at < 0])
        left, at = open_[at >= 0], at[at >= 0]
        right = left.copy()
        left[:, 1], left[:, 3] = at + 1, place[at] + 1
        right[:, 0], right[:, 2] = at + 1, place[at] + 1
        open_ = np.concatenate([left, right])
    out = np.concatenate(leaves) if leaves else open_
    return out[np.argsort(out[:, 0], kind="stable")]


class Aligned:
    """The documents of a block: their tokens, groups and links."""

    def __init__(self, made: Tokenizers, texts: list[str]):
        self.made = made
        each_a, each_b = made.encode(texts)
        self.n_a = np.fromiter(map(len, each_a), np.int64, len(each_a))
        self.n_b = np.fromiter(map(len, each_b), np.int64, len(each_b))
        self.at_a, self.at_b = offsets(self.n_a), offsets(self.n_b)
        none = [np.zeros(0, np.int64)]
        self.a, self.b = (np.concatenate(each + none).astype(np.int64) for each in (each_a, each_b))
        self.ends_a, self.ends_b = np.cumsum(made.lengths_a[self.a]), np.cumsum(made.lengths_b[self.b])
        self.groups = groups(
            self.ends_a, self.ends_b, self.at_a[:-1], self.at_a[1:], self.at_b[:-1], self.at_b[1:]
        )
        self.sizes_a = self.groups[:, 1] - self.groups[:, 0]
        self.sizes_b = self.groups[:, 3] - self.groups[:, 2]
        #: Groups of each document.
        self.n_groups = np.diff(np.searchsorted(self.groups[:, 0], self.at_a))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens of B each token of A overlaps, and the first of them."""
        first, last = np.repeat(self.groups[:, 2], self.sizes_a), np.repeat(self.groups[:, 3], self.sizes_a) - 1
        # In a group with one token on a side all overlap; in others the offsets decide.
        mixed = np.flatnonzero(np.repeat((self.sizes_a > 1) & (self.sizes_b > 1), self.sizes_a))
        starts = self.ends_a - self.made.lengths_a[self.a]
        first[mixed] = np.searchsorted(self.ends_b, starts[mixed], "right")
        last[mixed] = np.searchsorted(self.ends_b, self.ends_a[mixed])
        return last - first + 1, first

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``, without tokens ''."""
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.groups[:, 1] - 1] = 1
        last_b[self.groups[:, 3] - 1] = 1
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        before_b, before_a = self.groups[:, 2], self.groups[:, 1]
        codes[np.arange(len(self.a)) + np.repeat(before_b, self.sizes_a)] = 2 * self.a + last_a
        shift = 2 * len(self.made.bytes_a)
        codes[np.arange(len(self.b)) + np.repeat(before_a, self.sizes_b)] = shift + 2 * self.b + last_b
        figure, ends = self.made.figures.__getitem__, (self.at_a + self.at_b).tolist()
        return [
            hashlib.sha256(b"".join(map(figure, codes[x:y].tolist()))[:-1]).hexdigest() if x < y else ""
            for x, y in pairwise(ends)
        ]


def _texts(part: pa.RecordBatch, text: str) -> list[str]:
    return [value or "" for value in part.column(part.schema.get_field_index(text)).to_pylist()]


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Add a_ids and b_ids, and the numbers of tokens in each group: a_sizes and b_sizes."""
    ship(df.sparkSession)
    check_byte_level(path_a)
    made = ("a_ids", "b_ids", "a_sizes", "b_sizes")
    kept = [f for f in df.schema if f.name not in made]
    fields = [*kept, *(T.StructField(name, T.ArrayType(T.IntegerType())) for name in made)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        for part in (p for batch in batches for p in slices(batch, text, BLOCK)):
            found = Aligned(both, _texts(part, text))
            lists = (
                (found.a, found.n_a),
                (found.b, found.n_b),
                (found.sizes_a, found.n_groups),
                (found.sizes_b, found.n_groups),
            )
            columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
            columns += [list_array(values.astype(np.int32), n, pa.int32()) for values, n in lists]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return df.mapInArrow(run, T.StructType(fields))


# ---- counts over all documents -------------------------------------------------

_PAIR = np.dtype("<u8")
_TIMES = np.dtype("<u4")


def _packed_counts(values: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, plane by plane of their bytes, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked_counts(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _block_row(block: int, ids: pa.Array, found: Aligned, schema: pa.Schema) -> pa.RecordBatch:
    """What ``measure`` keeps of a block."""
    many, first = found.links()
    a, b = np.repeat(found.a, many), found.b[ragged(first, many)]
    n_links = np.diff(offsets(many)[found.at_a])
    size_a, size_b = len(found.made.bytes_a), len(found.made.bytes_b)
    # Sorted by bucket, B and A.
    key = ((b % BUCKETS) * size_b + b) * size_a + a
    keys, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    document = np.repeat(np.arange(len(found.n_a)), n_links)
    own, often = np.unique(document * max(len(keys), 1) + inverse, return_counts=True)
    owner = own // max(len(keys), 1)
    rank = own - owner * max(len(keys), 1)
    step = np.diff(rank, prepend=0)
    step[np.flatnonzero(np.diff(owner, prepend=-1))] = rank[np.flatnonzero(np.diff(owner, prepend=-1))]
    pair = keys % (size_a * size_b)
    cuts = np.searchsorted(keys // (size_a * size_b), np.arange(BUCKETS + 1))
    used = [(k, slice(x, y)) for k, (x, y) in enumerate(pairwise(cuts.tolist())) if x < y]
    buckets = [
        {"bucket": k, "pairs": pair[s].astype(_PAIR).tobytes(), "times": times[s].astype(_TIMES).tobytes()}
        for k, s in used
    ]
    facts = (found.n_a, found.n_b, found.n_groups, n_links)
    row = [
        pa.array([block]),
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        *(pa.array([x], pa.list_(pa.int64())) for x in facts),
        pa.array([found.digests()], pa.list_(pa.string())),
        pa.array([np.bincount(owner, minlength=len(ids))], pa.list_(pa.int64())),
        pa.array([_packed_counts(step)]),
        pa.array([_packed_counts(often)]),
        pa.array([buckets], schema.field("buckets").type),
    ]
    return pa.RecordBatch.from_arrays(row, schema=schema)


def _summed(pairs: list[bytes], times: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    given = np.frombuffer(b"".join(pairs), _PAIR)
    distinct, which = np.unique(given, return_inverse=True)
    # Exact up to 2 ** 53 links of one pair.
    total = np.bincount(which, np.frombuffer(b"".join(times), kind), len(distinct))
    return distinct, total.astype("<u8")


def _totals(parts: DataFrame, size_a: int) -> DataFrame:
    """For each bucket its pairs, how many links hold each, and whether it is the most of its B id."""

    def partial(table: pa.Table) -> pa.Table:
        pairs, times = _summed(table["pairs"].to_pylist(), table["times"].to_pylist(), _TIMES)
        return pa.table(
            {"bucket": table["bucket"].slice(0, 1), "pairs": [pairs.tobytes()], "times": [times.tobytes()]}
        )

    def whole(table: pa.Table) -> pa.Table:
        pairs, total = _summed(table["pairs"].to_pylist(), table["times"].to_pylist(), np.dtype("<u8"))
        b = pairs // np.uint64(size_a)
        heads = np.flatnonzero(np.diff(b, prepend=b[:1] + np.uint64(1)))
        most = np.repeat(np.maximum.reduceat(total, heads), np.diff(np.r_[heads, len(b)]))
        best = (total == most).astype(np.uint8)
        return pa.table(
            {
                "bucket": table["bucket"].slice(0, 1),
                "pairs": [pairs.tobytes()],
                "total": [total.tobytes()],
                "best": [best.tobytes()],
            }
        )

    summed = parts.groupBy("bucket", "team").applyInArrow(partial, "bucket int, pairs binary, times binary")
    return summed.groupBy("bucket").applyInArrow(whole, "bucket int, pairs binary, total binary, best binary")


def _looked_up(parts: DataFrame, totals: DataFrame) -> DataFrame:
    """For each block and bucket the totals of its pairs, and which of them are the most."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {"block": left["block"], "bucket": left["bucket"]}
        if not left.num_rows:
            return pa.table({**found, "total": pa.array([], pa.binary()), "best": pa.array([], pa.binary())})
        known = np.frombuffer(right["pairs"][0].as_py(), _PAIR)
        total = np.frombuffer(right["total"][0].as_py(), "<u8")
        best = np.frombuffer(right["best"][0].as_py(), np.uint8)
        at = [np.searchsorted(known, np.frombuffer(x, _PAIR)) for x in left["pairs"].to_pylist()]
        return pa.table(
            {**found, "total": [total[x].tobytes() for x in at], "best": [best[x].tobytes() for x in at]}
        )

    return (
        parts.groupBy("bucket", "team")
        .cogroup(totals.groupBy("bucket", "team"))
        .applyInArrow(run, "block bigint, bucket int, total binary, best binary")
    )


def measure(df: DataFrame, path_a: str, path_b: str, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Numbers of each document's alignment, and of how common its links are in all documents.

    Columns: the id, n_a, n_b, n_groups, n_links, n_best (links whose pair of ids is, of all pairs
    with its B id, linked most often; ties count), count_sum (over its links, how often their pair
    is linked) and groups_sha256 (of ``a1,a2|b1;a3|b2,b3``; '' without tokens).
    """
    ship(df.sparkSession)
    check_byte_level(path_a)
    return settled(df.sparkSession, "measured", lambda: _measured(df, path_a, path_b, id_, text))


def _measured(df: DataFrame, path_a: str, path_b: str, id_: str, text: str) -> DataFrame:
    size_a = len(tokenizers(path_a, path_b).bytes_a)
    kind = df.schema[id_].dataType.simpleString()
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    schema = (
        f"block bigint, ids array<{kind}>, {', '.join(f'{n} array<bigint>' for n in numbers)}, "
        "digests array<string>, n_own array<bigint>, own binary, often binary, "
        "buckets array<struct<bucket:int,pairs:binary,times:binary>>"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            fields = [("block", pa.int64()), ("ids", pa.list_(batch.schema.field(0).type))]
            fields += [(n, pa.list_(pa.int64())) for n in numbers]
            bucket = pa.struct([("bucket", pa.int32()), ("pairs", pa.binary()), ("times", pa.binary())])
            fields += [("digests", pa.list_(pa.string())), ("n_own", pa.list_(pa.int64()))]
            fields += [("own", pa.binary()), ("often", pa.binary()), ("buckets", pa.list_(bucket))]
            for part in slices(batch, "text", BLOCK):
                found = Aligned(both, _texts(part, "text"))
                yield _block_row(block, part.column(0), found, pa.schema(fields))
                block += 1
                del found
                release()

    given = df.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    blocks = stored(given.mapInArrow(run, schema), "blocks")
    teams = max(1, -(-blocks.count() // SUMMED))
    parts = blocks.select("block", F.explode("buckets").alias("b")).select(
        "block", "b.*", F.pmod(F.xxhash64("block"), F.lit(teams)).cast("int").alias("team")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(teams - 1))).alias("team")
    totals = stored(_totals(parts, size_a), "totals").select("*", every)
    looked_up = _looked_up(parts, totals)

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("bucket")
        total = np.frombuffer(b"".join(right["total"].to_pylist()), "<u8").astype(np.int64)
        best = np.frombuffer(b"".join(right["best"].to_pylist()), np.uint8)
        out = {id_: left["ids"].combine_chunks().flatten()}
        out |= {n: left[n].combine_chunks().flatten() for n in numbers}
        n_own = left["n_own"].combine_chunks().flatten().to_numpy()
        n = int(n_own.sum())
        step, often = (_unpacked_counts(left[c][0].as_py(), n) for c in ("own", "often"))
        ends = offsets(n_own)
        # Steps are counted from 0 anew in each document.
        run_ = np.cumsum(step)
        rank = run_ - np.repeat(np.r_[0, run_][ends[:-1]], n_own)
        sums = [offsets(often * x)[ends] for x in (best[rank], total[rank])]
        out |= {"n_best": np.diff(sums[0]), "count_sum": np.diff(sums[1])}
        return pa.table(out | {"groups_sha256": left["digests"].combine_chunks().flatten()})

    facts = blocks.drop("buckets").groupBy("block")
    counted = ", ".join(f"{n} bigint" for n in (*numbers, "n_best", "count_sum"))
    return facts.cogroup(looked_up.groupBy("block")).applyInArrow(
        settle, f"`{id_}` {kind}, {counted}, groups_sha256 string"
    )
