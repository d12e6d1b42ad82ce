"""Token ids as flat binary files that can be memory-mapped.

Documents are put in ascending order of their id over the partitions of a range shuffle; each
partition writes three flat files of little-endian integers:

* ``.ids``: the token ids, 16 bits each if the vocabulary has at most 65,536, otherwise 32;
* ``.idx``: 64-bit offsets into them, one for each document and one for the end;
* ``.doc``: the documents' 64-bit ids; NO_ID stands for null, which comes first.

A manifest in Parquet has a row for each partition; the bases, the tokens of all partitions
before, are prefix sums over it. Only files that a finished task reports are in the manifest,
so that what a lost executor or a second attempt leaves behind is never read. ``folder`` must
be one that all executors can open by pyarrow: a mounted one, or a store that pyarrow knows.

Null text has no ids but the end id. Repeated document ids are written one after the other, in
the order of their texts. An empty table gives no files and an empty manifest. Other columns
are not written. A task holds one slice of texts; files are appended to slice by slice.
"""

import os
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm.common import offsets, ragged, ship, slices

NO_ID = -(1 << 63)
#: Pieces between blanks whose ids a Python worker remembers; past it, it goes back to the
#: first KEPT of them, among which are the common ones.
MEMO = 800_000
KEPT = 300_000

# Marks that end a word and are a piece of their own there.
_MARKS = (".", ",", ";", ":", "!", "?")


@lru_cache(maxsize=1 << 16)
def _stays_letter(char: str) -> bool:
    """If a letter is one letter still when it is composed and in lower case.

    Otherwise it may end in a mark, which the library takes as one piece with a mark behind it.
    """
    made = normalize("NFC", normalize("NFC", char).lower())
    return len(made) == 1 and made.isalpha()


class _Codes(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        return code


class WordEncoder:
    """Ids by the tokenizers library, each distinct piece between blanks encoded once.

    Right for a tokenizer that drops white space, lets no token reach across a blank or a line
    end, keeps runs of letters apart from other characters, and marks the last token of each
    run by a suffix; ``load`` checks that on a probe. Pieces of letters alone are encoded many
    at a time, and told apart by that mark; where the marks are not as many as the pieces, the
    pieces are encoded one by one, as are all others.
    """

    def __init__(self, tokenizer, suffix: str = "</w>"):
        self._tokenizer = tokenizer
        self.size = tokenizer.get_vocab_size()
        self._last = np.zeros(self.size, bool)
        for token, i in tokenizer.get_vocab().items():
            self._last[i] = token.endswith(suffix)
        self._codes = _Codes()
        self._flat = np.zeros(0, np.uint32)
        self._starts = np.zeros(0, np.int64)
        self._sizes = np.zeros(0, np.int64)
        probe = " a  b\nc\n\n Don't é́ x<|endoftext|> y\t z, A.B .. über, x1. end. a, क़ b "
        whole = tokenizer.encode(probe, add_special_tokens=False).ids
        if whole != self([probe])[0].tolist():
            raise ValueError("the tokenizer does not drop white space")

    @classmethod
    def load(cls, path: str) -> "WordEncoder":
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        return cls(Tokenizer.from_file(path))

    def _forget(self) -> None:
        self._codes = _Codes(islice(self._codes.items(), KEPT))
        starts, sizes = self._starts[:KEPT], self._sizes[:KEPT]
        self._flat = self._flat[ragged(starts, sizes)]
        self._starts, self._sizes = offsets(sizes)[:-1], sizes

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = [" ".join(words[i : i + 256]) for i in range(0, len(words), 256)]
        flat, _ = self._each(texts)
        ends = np.flatnonzero(self._last[flat]) + 1
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(flat)):
            return self._each(words)
        return flat, np.diff(np.r_[0, ends])

    def _learn(self, known: int) -> None:
        """Encode the words from number ``known`` on."""
        codes = self._codes
        new = list(islice(codes, known, None))
        # A word with one mark behind it is that word and that mark, if it ends in a letter still
        # once the library has normalised it.
        marked = [
            w for w in new if w[-1:] in _MARKS and w[:-1].isalpha() and _stays_letter(w[-2])
        ]
        for w in marked:
            codes[w[:-1]], codes[w[-1]]  # noqa: B018  numbers those that are new
        new = list(islice(codes, known, None))
        letters = [w for w in new if w.isalpha()]
        plain = set(letters).union(marked)
        others = [w for w in new if w not in plain]
        total = len(codes)
        self._starts = np.r_[self._starts, np.zeros(total - known, np.int64)]
        self._sizes = np.r_[self._sizes, np.zeros(total - known, np.int64)]
        for words, encode in ((letters, self._letters), (others, self._each)):
            if words:
                self._keep(words, *encode(words))
        if marked:
            stems = np.fromiter((codes[w[:-1]] for w in marked), np.int64, len(marked))
            marks = np.fromiter((codes[w[-1]] for w in marked), np.int64, len(marked))
            parts = np.stack([stems, marks], axis=1).ravel()
            sizes = self._sizes[parts]
            flat = self._flat[ragged(self._starts[parts], sizes)]
            self._keep(marked, flat, sizes.reshape(-1, 2).sum(axis=1))

    def _keep(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        code = np.fromiter(map(self._codes.__getitem__, words), np.int64, len(words))
        self._starts[code] = offsets(sizes)[:-1] + len(self._flat)
        self._sizes[code] = sizes
        self._flat = np.r_[self._flat, flat]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._codes) > MEMO:
            self._forget()
        known = len(self._codes)
        words = [text.replace("\n", " ").split(" ") for text in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        where = np.fromiter(
            map(self._codes.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum())
        )
        if len(self._codes) > known:
            self._learn(known)
        each = self._sizes[where]
        ids = self._flat[ragged(self._starts[where], each)]
        return ids, np.diff(offsets(each)[offsets(counts)])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder.load(path)


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str, end_id: int, id_: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode ``text``, append ``end_id`` to each document, write the files; the manifest.

    Its columns: part, path (without suffix), bytes_per_id, n_docs, n_tokens and base.
    """
    spark = ship(df.sparkSession)
    ordered = (
        df.select(F.col(id_).cast("bigint").alias("id"), F.col(text).alias("text"))
        .repartitionByRange("id")
        .sortWithinPartitions("id", "text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width = 2 if max(encode.size, end_id + 1) <= 1 << 16 else 4
        store, root = _opened(folder)
        store.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"{root.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}"
        n_docs = n_tokens = 0
        files = None
        for piece in (p for batch in batches for p in slices(batch, "text")):
            if files is None:
                files = [store.open_output_stream(f"{name}.{kind}") for kind in ("ids", "idx", "doc")]
                files[1].write(np.zeros(1, "<u8").tobytes())
            ids, counts = encode([value or "" for value in piece.column(1).to_pylist()])
            ends = np.cumsum(counts + 1)
            out = np.full(len(ids) + len(counts), end_id, f"<u{width}")
            body = np.ones(len(out), bool)
            body[ends - 1] = False
            out[body] = ids
            files[0].write(out.tobytes())
            files[1].write((ends + n_tokens).astype("<u8").tobytes())
            files[2].write(piece.column(0).fill_null(NO_ID).to_numpy().astype("<i8").tobytes())
            n_docs, n_tokens = n_docs + len(counts), n_tokens + len(out)
        if files is not None:
            for file in files:
                file.close()
            row = [[part], [name], [width], [n_docs], [n_tokens]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in row], ["part", "path", "bytes_per_id", "n_docs", "n_tokens"]
            )

    schema = "part bigint, path string, bytes_per_id bigint, n_docs bigint, n_tokens bigint"
    # One row for each partition, however many documents there are.
    rows = sorted(ordered.mapInArrow(run, schema).collect())
    bases = accumulate((row.n_tokens for row in rows), initial=0)
    manifest = [(*row, base) for row, base in zip(rows, bases)]  # noqa: B905
    out = f"{folder.rstrip('/')}/manifest.parquet"
    spark.createDataFrame(manifest, f"{schema}, base bigint").write.parquet(out)
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/manifest.parquet")


def _mapped(store: fs.FileSystem, path: str, kind: str):
    """An array over the file: mapped if it lies in a mounted folder."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


def read_token_files(manifest: DataFrame, folder: str, rows: int = 2000) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    ``start`` counts the ids of all documents before it; the checksum is taken of the ids as
    little-endian 32-bit integers. The parts are spread over the cluster; a task reads the
    files of one part after the other.
    """
    ship(manifest.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _opened(folder)
        for part in (row for batch in batches for row in batch.to_pylist()):
            if not part["n_docs"]:
                continue
            ids = _mapped(store, f"{part['path']}.ids", f"<u{part['bytes_per_id']}")
            at = _mapped(store, f"{part['path']}.idx", "<u8")
            docs = _mapped(store, f"{part['path']}.doc", "<i8")
            for i in range(0, part["n_docs"], rows):
                ends = np.array(at[i : i + rows + 1]).astype(np.int64)
                sums = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                name = np.array(docs[i : i + rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(name, mask=name == NO_ID),
                        pa.array(ends[:-1] + part["base"]),
                        pa.array(np.diff(ends)),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
