"""Helpers that the operators share: shipping the package, slices of Arrow batches, ragged arrays."""

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.shipping import ship
from tremor.sinks import stored

#: Text that one step of a Python task holds at once.
SLICE_BYTES = 2 << 20

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROW = "__row"
GIVEN = "__given"


#: Bits of a row's number within its file; those above number the file.
_ROW_BITS = 36


def _has_places(df: DataFrame) -> bool:
    """If ``df`` is columns or rows of one Parquet table, which have a place in its files."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.child()
    if plan.nodeName() != "LogicalRelation":
        return False
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return False
    # A file that is named twice has its rows twice, in one place.
    return plan.relation().location().rootPaths().size() == 1


def stable(df: DataFrame) -> DataFrame:
    """``df``, stored unless it reads one Parquet table: its rows have places to be told apart by.

    What is matched by ROW has to come from one such frame.
    """
    return df if _has_places(df) else stored(df, "rows")


#: Files up to which their numbers, 16 bytes each, are sent to every task; others are shuffled.
_MOST_FILES = 1 << 20


def _file(path: Column) -> Column:
    """A file by the hash of its path; an empty host may be spelled or not."""
    return F.xxhash64(F.replace(path, F.lit("///"), F.lit("/"))).alias("__file")


def placed(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Some columns of a ``stable`` frame, and ROW: the number of the row's file, and its own in it.

    Unlike ``monotonically_increasing_id`` it does not depend on how a scan cuts the files, which
    changes between two scans when executors come or go. The files are those that the scan's own
    list has on the driver; nothing is read for it. They are told apart by a hash of 64 bits, which
    is checked to be different for all of them.
    """
    spark, place = df.sparkSession, df.metadataColumn("_metadata")
    paths = sorted(df.inputFiles()) or [""]
    table = pa.table({"path": paths, "number": pa.array(range(len(paths)), pa.int64())})
    numbers = spark.createDataFrame(table).select(_file(F.col("path")), F.col("number").alias("__number"))
    if len(paths) > 1 and numbers.select("__file").distinct().count() < len(paths):
        raise ValueError("two files have one hash")
    if len(paths) <= _MOST_FILES:
        numbers = F.broadcast(numbers)
    found = df.select(*columns, _file(place["file_path"]), place["row_index"].alias("__at"))
    kept = [c for c in found.columns if c not in ("__file", "__at")]
    unknown = F.raise_error("a file that is not in the scan's list").cast("bigint")
    number = F.shiftleft(F.coalesce("__number", unknown), _ROW_BITS).bitwiseOR(F.col("__at"))
    return found.join(numbers, "__file", "left").select(*kept, number.alias(ROW))


def release() -> None:
    """Give freed memory of this Python worker back, which stays for the next task otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


#: What operators keep in this Python worker from one task to the next.
_KEPT: list = []


def kept_in_worker(build: Callable) -> Callable:
    """Make something once in a Python worker, and keep it there until ``forget``."""
    made = lru_cache(maxsize=2)(build)
    _KEPT.append(made)
    return made


def forget(*but: Callable) -> None:
    """Let go of what tasks of other operators have left in this worker, ``but`` the given.

    Spark hands each task the worker that has waited longest, so that tables of one operator would
    stay in all workers through every later stage.
    """
    gone = [made for made in _KEPT if made not in but and made.cache_info().currsize]
    for made in gone:
        made.cache_clear()
    if gone:
        release()


def packed(df: DataFrame) -> DataFrame:
    """All columns in one, so that no name meets an operator's own, and the row's place."""
    return placed(df, F.struct("*").alias(GIVEN))


def given(name: str) -> Column:
    return F.col(GIVEN)[name]


def unpacked(df: DataFrame, columns: list[str], text: Column | None = None) -> DataFrame:
    """The columns as they were given; with a new ``text``, and ``n_chars`` to fit it."""
    made = {}
    if text is not None:
        made = {"text": text, "n_chars": F.char_length(text)}
    return df.select(
        *(
            (made[c].cast(df.schema[GIVEN].dataType[c].dataType) if c in made else given(c)).alias(c)
            for c in columns
        )
    )


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(col: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    plain = F.octet_length(col) == F.char_length(col)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, upper, upper.lower()))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that ``column`` holds about ``limit`` bytes, or list items, in each piece."""
    if not batch.num_rows:
        return
    values = batch.column(batch.schema.get_field_index(column))
    listed = pa.types.is_list(values.type)
    sizes = pc.list_value_length(values) if listed else pc.binary_length(values)
    sizes = sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(sizes) - sizes
    cuts = np.flatnonzero(np.diff(before // limit)) + 1
    for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(start, stop - start)


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Where each of consecutive pieces starts, and where the last one ends."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each piece, one piece after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of consecutive values as an Arrow list column."""
    at = pa.array(offsets(lengths).astype(np.int32))
    return pa.ListArray.from_arrays(at, pa.array(values, kind))


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}
