"""A journal of loads, by which silver, table and aggregates change together.

A load writes what it is about to do (``begun/<load id>.json``), then its files, each layer's in a
folder of its own load id, and then one record (``committed/<version>.json``). That record is put
in its place by a rename that fails if there is one of its number already; before it nothing of
the load counts, after it all of it does. Which loads count in a layer follows from the committed
records in their order. What a load replaced is removed after that, and then its first note.

A load that broke off left its note: if its record is there, the next load finishes the removal,
otherwise it undoes what there is of it. One load at a time may use a journal; a second one that
commits the same version fails. The journal has some 300 bytes for each load.
"""

import json
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.sinks.scratch import _located, exists, remove


class ConcurrentLoadError(RuntimeError):
    """Another load has committed meanwhile."""


@dataclass(frozen=True)
class Record:
    """A load: what it is, where its rows go, the days of its load instants, and what it replaced."""

    load_id: str
    feed: str
    load_date: str
    mode: str
    silver: str
    table: str | None = None
    aggregates: str | None = None
    rejects: str | None = None
    version: int = 0
    first_day: str | None = None
    last_day: str | None = None
    gone_silver: list[str] = field(default_factory=list)
    gone_table: list[str] = field(default_factory=list)


_FIELDS = ", ".join(
    f"{name} {'array<string>' if name.startswith('gone') else 'bigint' if name == 'version' else 'string'}"
    for name in Record.__dataclass_fields__
)


class Journal:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _write(self, record: Record, path: str) -> None:
        where, store = _located(self.spark, path)
        out = store.create(where, True)
        out.write(bytearray(json.dumps(asdict(record)).encode()))
        out.close()

    def _read(self, folder: str) -> list[Record]:
        path = f"{self.path}/{folder}"
        if not exists(self.spark, path):
            return []
        # One short line for each load.
        rows = self.spark.read.schema(_FIELDS).json(path).collect()
        return sorted((Record(**row.asDict()) for row in rows), key=lambda r: (r.version, r.load_id))

    def begin(self, record: Record) -> None:
        self._write(record, f"{self.path}/begun/{record.load_id}.json")

    def begun(self) -> list[Record]:
        """Loads that are open, or whose removals are."""
        return self._read("begun")

    def committed(self) -> list[Record]:
        return self._read("committed")

    def forget(self, load_id: str) -> None:
        remove(self.spark, f"{self.path}/begun/{load_id}.json")

    def commit(self, record: Record) -> Record:
        """Make a load count, with the next version, in all its layers at once."""
        before = self.committed()
        after = [*before, record]
        made = Record(
            **asdict(record)
            | {
                "version": (before[-1].version if before else 0) + 1,
                "gone_silver": sorted(_silver(before).keys() - _silver(after).keys()),
                "gone_table": sorted(_table(before, record.table).keys() - _table(after, record.table).keys()),
            }
        )
        # A name with a dot in front is no file to a scan.
        draft = f"{self.path}/committed/.{record.load_id}.json"
        self._write(made, draft)
        jvm = self.spark.sparkContext._jvm
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never_over = self.spark.sparkContext._gateway.new_array(kinds, 1)
        never_over[0] = kinds.NONE
        (source, _), (target, _) = (
            _located(self.spark, p) for p in (draft, f"{self.path}/committed/{made.version:010d}.json")
        )
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            source.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        try:
            files.rename(source, target, never_over)
        except Py4JJavaError as error:
            raise ConcurrentLoadError(f"version {made.version} of {self.path} is taken") from error
        return made

    def silver_loads(self) -> dict[str, Record]:
        """The loads that count in silver, by id."""
        return _silver(self.committed())

    def table_loads(self, table: str) -> dict[str, Record]:
        """The loads that count in a table, and in its aggregates, by id."""
        return _table(self.committed(), table)


def _of_other_days(loads: dict[str, Record], record: Record) -> dict[str, Record]:
    day = (record.feed, record.load_date)
    return {key: r for key, r in loads.items() if (r.feed, r.load_date) != day}


def _silver(records: list[Record]) -> dict[str, Record]:
    loads: dict[str, Record] = {}
    for record in records:
        if record.mode != "append":
            loads = _of_other_days(loads, record)
        loads[record.load_id] = record
    return loads


def _table(records: list[Record], table: str | None) -> dict[str, Record]:
    loads: dict[str, Record] = {}
    for record in records:
        if record.table == table and table is not None:
            if record.mode == "overwrite":
                loads = {}
            elif record.mode == "replace_partition":
                loads = _of_other_days(loads, record)
            loads[record.load_id] = record
    return loads


def zones(spark: SparkSession, loads: dict[str, Record]) -> DataFrame:
    """The first and last day of the load instants in each load's folder: load_id, first, last."""
    rows = [(r.load_id, r.first_day, r.last_day) for r in loads.values() if r.first_day]
    days = [F.col(c).cast("date").alias(c) for c in ("first", "last")]
    return spark.createDataFrame(rows, "load_id string, first string, last string").select("load_id", *days)
