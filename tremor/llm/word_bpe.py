"""BPE with word ends: a priority queue of merge ranks over a doubly linked list of symbols.

A text is cut at the tokenizer's special strings, normalised and split into words by its own
rules. The bytes of a word are symbols in a doubly linked list, the last one with the mark of a
word's end. A priority queue holds the rank and place of every pair of neighbours that can
merge; the lowest rank comes first, of equals the leftmost. A merge changes the pairs beside it,
whose entries stay in the queue and are skipped as stale when they come up. Decoding puts the
vocabulary's strings one after the other, with a blank between them, as a tokenizer without a
decoder does.

Nothing reaches across a blank or a line end, so that a worker remembers the ids of pieces
between them, MEMO of them at most, and MEMO words. Pieces of characters below U+0250, which
Unicode will not change any more, are split by a pattern here, all others by the library. The work is row by row: no shuffle, no key,
no skew, and a task holds one slice of texts at a time. Null and empty texts have no ids; null
ids decode to null, ids that the vocabulary lacks to nothing. Very long texts without a blank
are merged like others, in n log n steps. Repeated rows are encoded alike. All other columns
pass through; a column that has the name of a new one is replaced.
"""

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice, pairwise
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tremor.llm.bpe import SLICE_IDS, _replaced, _with
from tremor.llm.common import SLICE_BYTES, byte_signs, list_array, offsets, ragged, release, ship, slices

#: Pieces, and words, that a Python worker remembers; past it, it goes back to the first half.
MEMO = 400_000
#: Longer pieces and words are not remembered.
LONGEST = 64

_LATIN = [chr(c) for c in range(0x250)]


def _class(kind: str) -> str:
    """The Latin characters whose Unicode category begins with ``kind``, for a pattern."""
    return "".join(c for c in _LATIN if category(c).startswith(kind))


# Fixed value: how normalised texts are split into words, and what counts as a blank.
_BLANKS = "\t-\r \x85\xa0"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^{_BLANKS}{_class('L')}{_class('N')}]+")
#: The dotted capital I becomes a letter and a mark, and is left to the library.
_PLAIN = re.compile("[\0-\u012f\u0131-\u024f]*")


class _Numbered(dict):
    """Numbers keys as they come."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class WordBpe:
    """Encoder and decoder of a tokenizer file with merges, word ends and byte-level signs."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model = made["model"]
        added = made["added_tokens"]
        self._suffix = model["end_of_word_suffix"] or ""
        plain = not (model["dropout"] or model["continuing_subword_prefix"] or model["byte_fallback"])
        flags = ("single_word", "lstrip", "rstrip", "normalized")
        if not plain or made["decoder"] or made["post_processor"] or any(t[f] for t in added for f in flags):
            raise ValueError("only tokenizers with plain merges, plain special strings and no decoder")
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in added}
        names = vocab | self.special
        self.strings: list[str | None] = [None] * (max(names.values()) + 1)
        for name, i in names.items():
            self.strings[i] = name
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self._base = len(self.strings)
        #: The rank of each pair, and what the merge of each rank makes.
        self._ranks: dict[int, int] = {}
        self._products: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self._ranks[vocab[left] * self._base + vocab[right]] = rank
            self._products.append(vocab[left + right])
        if len(set(self._products)) != len(model["merges"]):
            raise ValueError("two merges make one token")
        signs = byte_signs()
        if any(s not in vocab or s + self._suffix not in vocab for s in signs):
            raise ValueError("the vocabulary lacks a byte")
        self._sign = {s: (vocab[s], vocab[s + self._suffix]) for s in signs}
        by_byte = {b: self._sign[s] for s, b in signs.items()}
        self._inner = [by_byte[b][0] for b in range(256)]
        self._last = [by_byte[b][1] for b in range(256)]
        self._words: dict[str, bytes] = {}
        self._pieces = _Numbered()
        self._flat = np.zeros(0, np.int32)
        self._starts = np.zeros(0, np.int64)
        self._sizes = np.zeros(0, np.int64)
        # Plain characters, and some others, must be split as the library does.
        pairs = "".join(f"a{chr(x)}{chr(y)}b" for x in range(128) for y in range(128))
        latin = "".join(f" {c}a{c}1{c}'{c}s" for c in _LATIN)
        for probe in (*pairs.split("\n"), latin, " Don't É́x 1½ Σς クク　 क़, <|x"):
            if self.ids(probe) != self._library.encode(probe, add_special_tokens=False).ids:
                raise ValueError("the tokenizer splits texts in another way")

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours by rank, of equal ranks the leftmost pair first."""
        n, base, rank_of, products = len(symbols), self._base, self._ranks.get, self._products
        following, preceding = [*range(1, n), -1], [*range(-1, n - 1)]
        # The rank of the pair that begins at each place now; entries that differ from it are stale.
        now = [rank_of(a * base + b, -1) for a, b in pairwise(symbols)]
        now.append(-1)
        shift = n.bit_length()
        mask = (1 << shift) - 1
        queue = [rank << shift | i for i, rank in enumerate(now) if rank >= 0]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i, rank = entry & mask, entry >> shift
            if now[i] != rank:
                continue
            j = following[i]
            symbols[i] = made = products[rank]
            symbols[j] = now[j] = now[i] = -1
            following[i] = after = following[j]
            if after >= 0:
                preceding[after] = i
                now[i] = rank = rank_of(made * base + symbols[after], -1)
                if rank >= 0:
                    heappush(queue, rank << shift | i)
            before = preceding[i]
            if before >= 0:
                now[before] = rank = rank_of(symbols[before] * base + made, -1)
                if rank >= 0:
                    heappush(queue, rank << shift | before)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str, symbols: list[int] | None = None) -> bytes:
        """The ids of a word, four bytes each; ``symbols`` are those of one spelled in signs."""
        found = self._words.get(word)
        if found is None:
            if symbols is None:
                inner, data = self._inner, word.encode()
                symbols = [inner[b] for b in data]
                symbols[-1] = self._last[data[-1]]
            found = array("i", self.merge(symbols)).tobytes()
            if len(word) <= LONGEST:
                if len(self._words) >= MEMO:
                    self._words = dict(islice(self._words.items(), MEMO // 2))
                self._words[word] = found
        return found

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() or _PLAIN.fullmatch(piece):
            piece = piece.lower()
            if piece.isalpha():
                return self._word(piece)
            return b"".join([self._word(w) for w in _WORDS.findall(piece)])
        # The blank keeps words that are spelled in signs of bytes apart from others.
        split = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(piece))
        sign = self._sign
        return b"".join(
            [self._word(f" {word}", [sign[s][0] for s in word[:-1]] + [sign[word[-1]][1]]) for word, _ in split]
        )

    def _encoded(self, piece: str) -> bytes:
        if "<" not in piece or not self._special.search(piece):
            return self._piece(piece)
        out, at = [], 0
        for hit in self._special.finditer(piece):
            out += [self._piece(piece[at : hit.start()]), array("i", [self.special[hit[0]]]).tobytes()]
            at = hit.end()
        return b"".join([*out, self._piece(piece[at:])])

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self._encoded(text), np.int32).tolist()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each text has."""
        if len(self._pieces) > MEMO:
            keep = MEMO // 2
            self._pieces = _Numbered(islice(self._pieces.items(), keep))
            starts, sizes = self._starts[:keep], self._sizes[:keep]
            self._flat = self._flat[ragged(starts, sizes)]
            self._starts, self._sizes = offsets(sizes)[:-1], sizes
        known = len(self._pieces)
        pieces = [text.replace("\n", " ").split(" ") for text in texts]
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        where = np.fromiter(
            map(self._pieces.__getitem__, chain.from_iterable(pieces)), np.int64, int(counts.sum())
        )
        new = [self._encoded(piece) for piece in islice(self._pieces, known, None)]
        if new:
            sizes = np.fromiter(map(len, new), np.int64, len(new)) // 4
            self._starts = np.r_[self._starts, offsets(sizes)[:-1] + len(self._flat)]
            self._sizes = np.r_[self._sizes, sizes]
            self._flat = np.r_[self._flat, np.frombuffer(b"".join(new), np.int32)]
        each = self._sizes[where]
        ids = self._flat[ragged(self._starts[where], each)]
        return ids, np.diff(offsets(each)[offsets(counts)])

    def decode(self, ids: list[int]) -> str:
        strings, n = self.strings, len(self.strings)
        return " ".join([s for i in ids if 0 <= i < n and (s := strings[i]) is not None])


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Add the token ids of ``text``. ``path`` names a tokenizer file that every executor can open."""
    return _step(df, path, text, {ids: T.ArrayType(T.IntegerType())}, _encoded_column)


def decode(df: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """Add the text that the ids stand for, special strings included."""
    return _step(df, path, ids, {text: T.StringType()}, _decoded_column)


def encode_and_decode(
    df: DataFrame, path: str, text: str = "text", ids: str = "token_ids", again: str = "decoded"
) -> DataFrame:
    """Both in one pass: the ids of ``text``, and the text that those ids stand for."""

    def both(bpe: WordBpe, column: pa.Array) -> tuple[pa.Array, ...]:
        found = _encoded_column(bpe, column)
        return *found, *_decoded_column(bpe, found[0])

    return _step(df, path, text, {ids: T.ArrayType(T.IntegerType()), again: T.StringType()}, both)


def _encoded_column(bpe: WordBpe, column: pa.Array) -> tuple[pa.Array]:
    texts = [value or "" for value in column.to_pylist()]
    return (list_array(*bpe.encode(texts), pa.int32()),)


def _decoded_column(bpe: WordBpe, column: pa.Array) -> tuple[pa.Array]:
    counts = pc.list_value_length(column).fill_null(0).to_numpy(False)
    values, ends = column.flatten().fill_null(-1).to_numpy().tolist(), offsets(counts).tolist()
    found = [
        None if gone else bpe.decode(values[a:b])
        for gone, (a, b) in zip(column.is_null().to_pylist(), pairwise(ends), strict=True)
    ]
    return (pa.array(found, pa.string()),)


def _step(df: DataFrame, path: str, of: str, made: dict[str, T.DataType], run_column) -> DataFrame:
    """Add columns that are made of another one, slice by slice."""
    ship(df.sparkSession)
    schema = df.schema
    for name, kind in made.items():
        schema = _with(schema, name, kind)
    size = SLICE_IDS if isinstance(df.schema[of].dataType, T.ArrayType) else SLICE_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            for part in slices(batch, of, size):
                column = part.column(part.schema.get_field_index(of))
                for name, values in zip(made, run_column(bpe, column), strict=True):
                    part = _replaced(part, name, values)
                yield part
        release()

    return df.mapInArrow(run, schema)
