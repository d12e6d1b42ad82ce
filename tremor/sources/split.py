r"""Feature collections of any size and spelling, read by many tasks.

A file is cut into ranges of bytes. Where a range begins, a task cannot see if it is inside a
string, nor how deep in brackets. So each range is outlined first, for both cases: how many
brackets it closes that were open before, which ones it leaves open, and if its quotes are odd.
Put one after the other, a few numbers for each range, the outlines say how every range begins.
In a second pass each range gives the features that begin in it, as text; the last one may end
beyond. Features are the objects in an array named ``features`` at the top of a document.

A file may hold several documents. One that ends inside a string or a bracket is an error; one
without such an array has no features. Elements that are no objects give no feature. More than LEAD bytes of blanks
between the name and its array are not looked through.
"""

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tremor.shipping import ship

RANGE_BYTES = 32 << 20
LEAD = 4096
#: Features that go to Spark together.
_BATCH = 10_000

# Fixed value: the name of the array, as it stands before its bracket.
_NAME = re.compile(rb'(?<!\\)"features"[ \t\r\n]*:[ \t\r\n]*\Z')
_QUOTE, _BACKSLASH = 0x22, 0x5C
_STEP = np.zeros(256, np.int8)
for _sign, _step in zip(b"[{]}", (1, 1, -1, -1), strict=True):
    _STEP[_sign] = _step


class _Structure:
    """Quotes and brackets of some bytes; what lies before ``lead`` is only looked back at."""

    def __init__(self, data: bytes, lead: int):
        self.data = data
        signs = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(signs[lead:] == _QUOTE) + lead
        behind = quotes[signs[quotes - 1] == _BACKSLASH] if len(quotes) else quotes
        behind = behind[behind > 0]
        escaped = {q for q in behind.tolist() if self._backslashes(q) % 2}
        self.quotes = quotes[~np.isin(quotes, list(escaped))] if escaped else quotes
        self.places = np.flatnonzero(_STEP[signs[lead:]]) + lead
        self.odd = np.searchsorted(self.quotes, self.places) % 2 == 1

    def _backslashes(self, at: int) -> int:
        n = 0
        while at - n > 0 and self.data[at - n - 1] == _BACKSLASH:
            n += 1
        return n

    def brackets(self, in_string: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places of the brackets outside strings, and if each opens (1) or closes (-1)."""
        places = self.places[self.odd if in_string else ~self.odd]
        return places, _STEP[np.frombuffer(self.data, np.uint8)[places]].astype(np.int64)

    def is_features(self, place: int) -> bool:
        opens = self.data[place : place + 1] == b"["
        return opens and _NAME.search(self.data[max(0, place - LEAD) : place]) is not None

    def outline(self, in_string: bool) -> tuple[int, str]:
        """How many earlier brackets are closed, and what is left open: ``f`` for features."""
        places, steps = self.brackets(in_string)
        if not len(places):
            return 0, ""
        depth = np.cumsum(steps)
        later = np.minimum.accumulate(depth[::-1])[::-1]
        left = places[(steps == 1) & (later >= depth)]
        return max(0, -int(depth.min())), "".join("f" if self.is_features(p) else "." for p in left.tolist())

    def features(self, in_string: bool, opened: str, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the features that begin before ``end`` begin, and end; -1 for one that does not."""
        places, steps = self.brackets(in_string)
        depth = len(opened) + np.cumsum(steps)
        arrays = np.flatnonzero((steps == 1) & (depth == 2))
        wanted = np.array([self.is_features(p) for p in places[arrays].tolist()], bool)
        wanted = np.r_[opened[1:2] == "f", wanted]
        braces = np.frombuffer(self.data, np.uint8)[places] == ord("{")
        starts = np.flatnonzero((steps == 1) & (depth == 3) & braces & (places < end))
        starts = starts[wanted[np.searchsorted(arrays, starts)]]
        ends = np.flatnonzero((steps == -1) & (depth == 2))
        last = np.searchsorted(ends, starts)
        none = last == len(ends)
        found = np.full(len(starts), -1)
        found[~none] = places[ends[last[~none]]]
        return places[starts], found


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, size: int, in_string: bool = False, opened: str = ""):
        self.path, self.start, self.end, self.size = path, start, end, size
        self.in_string, self.opened = in_string, opened

    def read(self, beyond: int = 0) -> tuple[bytes, int]:
        """The bytes of the range, with some before it and some beyond, and how many are before."""
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(self.path)
        first = max(0, self.start - LEAD)
        with store.open_input_file(path) as file:
            return file.read_at(min(self.end + beyond, self.size) - first, first), self.start - first


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.ranges = [_Range(*given) for given in json.loads(options["ranges"])]
        self.outlines = options["pass"] == "outlines"

    def partitions(self) -> list[_Range]:
        return self.ranges

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        return self._outline(partition) if self.outlines else self._features(partition)

    def _outline(self, part: _Range) -> Iterator[pa.RecordBatch]:
        found = _Structure(*part.read())
        (closed, left), (closed_in, left_in) = found.outline(False), found.outline(True)
        row = (part.path, part.start, len(found.quotes) % 2 == 1, closed, left, closed_in, left_in)
        names = "path start odd closed left closed_in left_in".split()
        yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], _OUTLINE)

    def _features(self, part: _Range) -> Iterator[pa.RecordBatch]:
        beyond = 0
        while True:
            data, lead = part.read(beyond)
            found = _Structure(data, lead)
            starts, ends = found.features(part.in_string, part.opened, lead + part.end - part.start)
            if not len(starts) or ends[-1] >= 0 or part.end + beyond >= part.size:
                break
            beyond = max(2 * beyond, 1 << 20)
        for i in range(0, len(starts), _BATCH):
            spans = zip(starts[i : i + _BATCH].tolist(), ends[i : i + _BATCH].tolist(), strict=True)
            texts = pa.array([data[a : b + 1] for a, b in spans], pa.binary())
            yield pa.RecordBatch.from_arrays([texts.cast(pa.string())], ["value"])


_OUTLINE = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("odd", pa.bool_()),
        ("closed", pa.int64()),
        ("left", pa.string()),
        ("closed_in", pa.int64()),
        ("left_in", pa.string()),
    ]
)


class FeatureRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tremor_feature_ranges"

    def schema(self) -> str:
        if self.options["pass"] == "outlines":
            return (
                "path string, start bigint, odd boolean, closed bigint, left string, "
                "closed_in bigint, left_in string"
            )
        return "value string"

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options)


class BrokenDocumentError(ValueError):
    """A document is cut off."""


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The data files at a path, or below it, with their sizes."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, listed = [], store.listFiles(where, True)
    while listed.hasNext():
        status = listed.next()
        if not status.getPath().getName().startswith(("_", ".")) and status.getLen():
            found.append((status.getPath().toUri().toString(), status.getLen()))
    # Arrow wants an empty host to be spelled.
    return sorted((re.sub("^file:/(?!/)", "file:///", uri), size) for uri, size in found)


def _placed(ranges: list[tuple], outlines: dict[tuple, tuple]) -> list[tuple]:
    """The ranges with the state that each begins in."""
    out, in_string, opened, path = [], False, "", None

    def ended() -> None:
        if in_string or opened:
            raise BrokenDocumentError(f"{path} ends inside a document")

    for given in ranges:
        if given[0] != path:
            ended()
            in_string, opened, path = False, "", given[0]
        out.append((*given, in_string, opened))
        odd, closed, left, closed_in, left_in = outlines[given[:2]]
        if in_string:
            closed, left = closed_in, left_in
        if closed > len(opened):
            raise BrokenDocumentError(f"{path} closes more brackets than it opens")
        in_string, opened = in_string != odd, opened[: len(opened) - closed] + left
    ended()
    return out


def split_features(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The text of every feature in the documents at ``path``, as ``value``."""
    ship(spark)
    spark.dataSource.register(FeatureRanges)
    ranges = [
        (uri, start, min(start + range_bytes, size), size)
        for uri, size in _files(spark, path)
        for start in range(0, size, range_bytes)
    ]
    if not ranges:
        return spark.createDataFrame([], "value string")

    def scan(which: str, given: list[tuple]) -> DataFrame:
        reader = spark.read.format(FeatureRanges.name()).option("pass", which)
        return reader.option("ranges", json.dumps(given)).load()

    # A few numbers for each range.
    outlines = {(r.path, r.start): tuple(r)[2:] for r in scan("outlines", ranges).collect()}
    return scan("features", _placed(ranges, outlines))
