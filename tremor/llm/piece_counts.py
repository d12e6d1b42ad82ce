"""Token counts of a sentence-piece BPE model by rank-synchronous merging of ragged arrays.

A text is cut before each run of word marks (the model's sign for a blank), which no piece
contains after another character, so that no merge crosses a cut. The distinct pre-tokens of
a slice of rows lie one after the other in numpy arrays. Each round finds the lowest-ranked
pair of every pre-token and merges all its occurrences in all pre-tokens at once; finished
pre-tokens leave the arrays. What survives is counted: a symbol of the vocabulary is a token,
a character outside it one token for each of its UTF-8 bytes.

The work is row by row: no shuffle, no key, no skew. Null and empty texts have no tokens and
no bytes. Repeated rows are counted alike; other columns pass through, and columns that have
the names of new ones are replaced. Texts are never truncated. A round costs as much as the
pre-tokens that are still open, so a single one of LONG characters and more, text without any
blank, is merged by a heap instead.
"""

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tremor.llm.bpe import merge_by_heap
from tremor.llm.common import offsets, ship, slices

MARK = "▁"
LONG = 1 << 14
_NEVER = np.int32(np.iinfo(np.int32).max)
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")


def _extra_bytes(codes: np.ndarray) -> np.ndarray:
    """The UTF-8 bytes of each code point after the first."""
    return (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)


class PieceCounter:
    """The merges of a BPE model, as numbers.

    A pair's rank is the place of the piece that it makes among all scores. Pieces of word
    marks alone are left out of the merges: their score is below all others, so that they come
    last, and how they combine depends on the length of the run only.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = model.normalize(" é Éﬁ  x\n ")
        if probe != f"{MARK}{MARK}é{MARK}Éﬁ{MARK}{MARK}x\n{MARK}":
            raise ValueError("only models that keep texts as they are, with a mark in front")
        size = model.get_piece_size()
        plain = [
            i
            for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        marks = {piece for piece in score if len(piece) > 1 and not piece.strip(MARK)}
        words = [piece for piece in score if len(piece) > 1 and piece not in marks]
        if any(MARK in piece.lstrip(MARK) for piece in words):
            raise ValueError("a piece has a word mark after another character")
        if marks and words and max(score[m] for m in marks) >= min(score[w] for w in words):
            raise ValueError("runs of word marks do not come last")
        self._marks = {len(piece): score[piece] for piece in marks}
        self._run_counts: dict[int, int] = {0: 0, 1: 1}
        # Equal scores share a rank; ids follow ranks, so that a lower id merges first.
        values = sorted({score[w] for w in words}, reverse=True)
        if len(values) != len(words):
            raise ValueError("two pieces have one score")
        order = sorted(words, key=lambda w: -score[w])
        self._id = {w: i for i, w in enumerate(order)}
        for piece in score:
            if len(piece) == 1:
                self._id.setdefault(piece, len(self._id))
        self.base = len(self._id) + 1  # the last id stands for characters outside the model
        self.joined = {
            self._id[left] * self.base + self._id[right]: made
            for w, made in self._id.items()
            for i in range(1, len(w))
            if (left := w[:i]) in self._id and (right := w[i:]) in self._id
        }
        self._keys = np.array(sorted(self.joined), np.int64)
        self._made = np.array([self.joined[k] for k in self._keys.tolist()], np.int32)
        # A merge can be made everywhere at once unless it opens a pair of a lower rank.
        self._alone = np.zeros(self.base, bool)
        for key, made in self.joined.items():
            for side in divmod(key, self.base):
                self._alone[side] |= made <= side < len(order)
        self._of_char = np.full(0x110000, self.base - 1, np.int32)
        for piece, i in self._id.items():
            if len(piece) == 1:
                self._of_char[ord(piece)] = i

    def _makes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self._keys):
            return np.full(len(left), _NEVER)
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._made[at], _NEVER)

    def _run(self, marks: int) -> int:
        """The tokens of a run of word marks, whose pieces merge leftmost first."""
        if marks not in self._run_counts:
            # Taking in one mark at a time is what leftmost-first does while scores are equal.
            done: list[int] = []
            for _ in range(marks):
                done.append(1)
                while len(done) > 1 and done[-2] + done[-1] in self._marks:
                    last = done.pop()
                    done[-1] += last
            self._run_counts[marks] = len(done)
        return self._run_counts[marks]

    def _survivors(self, words: list[str]) -> np.ndarray:
        """How many tokens each pre-token has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
        symbols = self._of_char[codes]
        outside = self.base - 1
        # Bytes of characters outside the model, beyond the one symbol that stands for them.
        more = np.where(symbols == outside, _extra_bytes(codes), 0)
        at = offsets(lengths)
        out = np.diff(offsets(more)[at]).astype(np.int64)
        mark = self._id.get(MARK, -2)
        word = np.repeat(np.arange(len(words)), lengths)
        makes = np.full(len(symbols), _NEVER, np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1]) if len(word) else np.zeros(0, np.int64)
        makes[inside] = self._makes(symbols[inside], symbols[inside + 1])
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(makes, first)
            sizes = np.diff(np.r_[first, len(word)])
            open_ = lowest != _NEVER
            if not open_.all():
                self._close(symbols, word, first, sizes, ~open_, mark, out)
                keep = np.repeat(open_, sizes)
                symbols, word, makes = symbols[keep], word[keep], makes[keep]
                lowest, sizes = lowest[open_], sizes[open_]
                if not len(symbols):
                    break
                first = offsets(sizes)[:-1]
            take = makes == np.repeat(lowest, sizes)
            place = np.arange(len(take))
            # Of neighbours that both match, every second one from the left is merged.
            begins = take & ~np.r_[False, take[:-1]]
            take &= (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0
            single = self._alone[lowest]
            if single.any():
                leftmost = np.minimum.reduceat(np.where(take, place, len(take)), first)
                take &= ~np.repeat(single, sizes) | (place == np.repeat(leftmost, sizes))
            hit = np.flatnonzero(take)
            symbols[hit] = makes[hit]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            now = hit - np.arange(len(hit))
            symbols, word, makes = symbols[keep], word[keep], makes[keep]
            touched = np.zeros(len(symbols), bool)
            touched[now] = touched[np.maximum(now - 1, 0)] = True
            changed = np.flatnonzero(touched)
            last = np.r_[word[1:] != word[:-1], True][changed]
            makes[changed[last]] = _NEVER
            changed = changed[~last]
            makes[changed] = self._makes(symbols[changed], symbols[changed + 1])
        return out

    def _close(self, symbols, word, first, sizes, done, mark, out) -> None:
        """Count the symbols of finished pre-tokens, runs of word marks by their length."""
        out[word[first[done]]] += sizes[done]
        if not self._marks:
            return
        marked = offsets(symbols == mark)
        runs = (marked[first + sizes] - marked[first])[done]
        many = np.flatnonzero(runs > 1)
        for i, n in zip(word[first[done]][many].tolist(), runs[many].tolist(), strict=True):
            out[i] += self._run(n) - n

    def _long(self, word: str) -> int:
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        left = merge_by_heap(self._of_char[codes].tolist(), self.joined, self.base)
        outside = self.base - 1
        more = len(word.encode()) - len(word)
        inside = codes[self._of_char[codes] != outside]
        more -= int(_extra_bytes(inside).sum())
        marks = left.count(self._id.get(MARK, -2))
        return len(left) + more - marks + self._run(marks)

    def count(self, texts: list[str]) -> np.ndarray:
        words = [self._words(text) for text in texts]
        index = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(words)))}
        distinct = list(index)
        counts = np.zeros(len(distinct), np.int64)
        short = [i for i, w in enumerate(distinct) if len(w) < LONG]
        if short:
            counts[short] = self._survivors([distinct[i] for i in short])
        for i in set(range(len(distinct))) - set(short):
            counts[i] = self._long(distinct[i])
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        where = np.fromiter(
            map(index.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum())
        )
        return np.diff(offsets(counts[where])[offsets(sizes)])

    @staticmethod
    def _words(text: str) -> list[str]:
        if not text:
            return []
        marked = (" " + text).replace(" ", MARK)
        return _RUNS.findall(marked)


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(df: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    ship(df.sparkSession)
    made = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())]
    names = [name for name, _ in made]
    kept = [f for f in df.schema if f.name not in names]
    schema = T.StructType(kept + [T.StructField(*x) for x in made])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = counter(path)
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(part.schema.get_field_index(text))
                tokens = counted.count([value or "" for value in column.to_pylist()])
                sizes = pc.cast(pc.binary_length(column).fill_null(0), pa.int64())
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, sizes, pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                    [*(f.name for f in kept), *names],
                )

    return df.mapInArrow(run, schema)
