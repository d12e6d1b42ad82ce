r"""Chat formatting by columnar byte assembly.

Every turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>``. Inside roles and texts each
``<``, backslashes, ``|`` gets one backslash more, so that no control string can occur there;
reading takes it away again. Turns are put in order by a range shuffle on conversation and
turn, so that a conversation with very many turns spreads over tasks; each task then assembles
slices of turns: the lengths of the five segments of each turn, their running offsets and the
indices that the bytes go to are numpy arrays, and all bytes are copied into one Arrow buffer.

A conversation comes out as one row, or as several chunks, ordered by (part, chunk), where it
is long or crosses a task's border. Next to the text stand the byte spans under the loss mask.

Null text or role is empty; an empty turn keeps its marks. Null turns come before others and
turns of one number in the order of role and text, repeated rows included; a null conversation
id is a conversation of its own. An empty table gives no rows; other columns are not read.
"""

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import list_array, offsets, ragged, ship, slices

START, SEP, END = b"<|im_start|>", b"<|im_sep|>", b"<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", re.DOTALL)
_ESCAPED = re.compile(r"<\\(\\*)\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted text, as they were before."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _escaped(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values and the length of each."""
    safe = pc.replace_substring_regex(column, pattern=r"<(\\*)\|", replacement=r"<\\\1|")
    lengths = pc.binary_length(safe).to_numpy().astype(np.int64)
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(safe)], safe), "")[0].as_py()
    return np.frombuffer(joined.encode(), np.uint8), lengths


def _assembled(part: pa.RecordBatch, trained: str, task: int, first_chunk: int) -> pa.RecordBatch:
    ids, roles, texts = part.column(0), part.column(2), part.column(3)
    (role_bytes, role_sizes), (text_bytes, text_sizes) = _escaped(roles), _escaped(texts)
    turns = part.num_rows
    sizes = np.empty((turns, 5), np.int64)
    sizes[:, 0], sizes[:, 2], sizes[:, 4] = len(START), len(SEP), len(END)
    sizes[:, 1], sizes[:, 3] = role_sizes, text_sizes
    at = offsets(sizes.ravel())
    begin = at[:-1].reshape(turns, 5)
    buffer = pa.allocate_buffer(int(at[-1]))
    out = np.frombuffer(buffer, np.uint8)
    for column, mark in ((0, START), (2, SEP), (4, END)):
        out[begin[:, column, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    out[ragged(begin[:, 1], role_sizes)] = role_bytes
    out[ragged(begin[:, 3], text_sizes)] = text_bytes

    ends = pc.run_end_encode(ids).run_ends.to_numpy().astype(np.int64)
    starts = np.r_[0, ends[:-1]]
    bounds = np.r_[begin[starts, 0], at[-1]]
    formatted = pa.StringArray.from_buffers(
        len(ends), pa.py_buffer(bounds.astype(np.int32)), buffer
    )
    loss = pc.equal(roles, trained).to_numpy(zero_copy_only=False)
    chunk = np.repeat(np.arange(len(ends)), ends - starts)
    inside = begin[loss, 3] - bounds[chunk[loss]]
    spans = np.bincount(chunk[loss], minlength=len(ends))
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(starts)),
            pa.array(np.full(len(ends), task)),
            pa.array(np.arange(len(ends)) + first_chunk),
            pa.array(ends - starts),
            formatted,
            list_array(inside, spans, pa.int64()),
            list_array(inside + text_sizes[loss], spans, pa.int64()),
        ],
        ["conv_id", "part", "chunk", "n_turns", "formatted", "loss_starts", "loss_ends"],
    )


def format_conversations(df: DataFrame, trained: str = "assistant") -> DataFrame:
    """Format ``conv_id, turn, role, text``; texts of the role ``trained`` are under the loss."""
    ship(df.sparkSession)
    order = ["conv_id", "turn", "role", "text"]
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    turns = df.select("conv_id", "turn", *empty)
    # Rows of one turn stay together, so that their order is that of the whole table.
    ordered = turns.repartitionByRange("conv_id", "turn").sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, chunks = TaskContext.get().partitionId(), 0
        for part in (p for batch in batches for p in slices(batch, "text")):
            made = _assembled(part, trained, task, chunks)
            chunks += made.num_rows
            yield made

    kind = df.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(
        run,
        f"conv_id {kind}, part bigint, chunk bigint, n_turns bigint, formatted string, "
        "loss_starts array<bigint>, loss_ends array<bigint>",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What each conversation holds, read from its formatted chunks alone.

    ``turns_sha256`` is taken of role, line end, text, line end of each turn, ``loss_sha256``
    of all text under the loss mask. Chunks are hashed one after the other as they come, so
    that a task holds one of them at a time.
    """
    ship(formatted.sparkSession)
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    names = "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars".split()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        done: list[tuple] = []
        now: list | None = None

        def close() -> None:
            conv, turns, turns_hash, chars, loss_hash, length = now
            done.append((conv, turns, turns_hash.hexdigest(), chars, loss_hash.hexdigest(), length))

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * len(names)
            done.clear()
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for part in slices(batch, "formatted"):
                for row in part.to_pylist():
                    if now is None or now[0] != row["conv_id"]:
                        if now is not None:
                            close()
                        now = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    for role, text in parse(row["formatted"]):
                        now[1] += 1
                        now[2].update(f"{role}\n{text}\n".encode())
                    data = row["formatted"].encode()
                    for start, end in zip(row["loss_starts"], row["loss_ends"], strict=True):
                        text = unescape(data[start:end].decode())
                        now[3] += len(text)
                        now[4].update(text.encode())
                    now[5] += len(row["formatted"])
                if len(done) >= 1000:
                    yield flushed()
        if now is not None:
            close()
            yield flushed()

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(
        run,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
