"""Intermediate results in the shared folder that the cluster names."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; on one machine alone, else the warehouse.

    A cluster must name a folder, and not one that each of its machines has for itself.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if spark.sparkContext.master.startswith("local"):
        return folder or spark.conf.get("spark.sql.warehouse.dir")
    if not folder or folder.startswith("file:"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no one else uses."""
    return f"{shared_folder(spark).rstrip('/')}/tremor/{name}-{uuid4().hex}"


def _located(spark: SparkSession, path: str):
    """A path and its file system, of any kind that Spark knows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _located(spark, path)
    return store.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path with all below it, if it is there."""
    where, store = _located(spark, path)
    store.delete(where, True)


def remove_others(spark: SparkSession, folder: str, name: str) -> None:
    """Delete all in a folder but ``name``."""
    where, store = _located(spark, folder)
    if store.exists(where):
        for status in store.listStatus(where):
            if status.getPath().getName() != name:
                store.delete(status.getPath(), True)


def _folders_at(store, where, depth: int, prefix: str = "") -> list[str]:
    """Names of the partition folders ``depth`` levels below a path."""
    found = []
    for status in store.listStatus(where):
        name = status.getPath().getName()
        if status.isDirectory() and "=" in name:
            below = [] if depth == 1 else _folders_at(store, status.getPath(), depth - 1, f"{prefix}{name}/")
            found += [f"{prefix}{name}"] if depth == 1 else below
    return found


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to where it replaces ``target``; without a source that becomes empty."""
    old, store = _located(spark, source)
    new, _ = _located(spark, target)
    store.delete(new, True)
    if not store.exists(old):
        store.mkdirs(new)
        return
    store.mkdirs(new.getParent())
    if not store.rename(old, new):
        raise OSError(f"{source} cannot be moved to {target}")


def move_folders(spark: SparkSession, source: str, target: str, depth: int) -> list[str]:
    """Move the partition folders ``depth`` levels below ``source`` to the same place below
    ``target``, where each replaces one of its name; returns their names.

    A move that broke off is repeated safely by writing ``source`` again.
    """
    where, store = _located(spark, source)
    folders = sorted(_folders_at(store, where, depth))
    for folder in folders:
        move_folder(spark, f"{source}/{folder}", f"{target.rstrip('/')}/{folder}")
    return folders


_NOTED: ContextVar[list[str] | None] = ContextVar("noted", default=None)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths that ``stored`` uses while the block runs."""
    paths: list[str] = []
    outer = _NOTED.set(paths)
    try:
        yield paths
    finally:
        _NOTED.reset(outer)
        if (around := _NOTED.get()) is not None:
            around.extend(paths)


def stored(df: DataFrame, name: str = "stored", path: str | None = None, **options: str) -> DataFrame:
    """Compute ``df`` once, keep it in the shared folder, and read it from there.

    What is read later depends on the files alone, so the loss of an executor
    costs no recomputation. ``options`` are the Parquet writer's.
    """
    path = path or scratch_path(df.sparkSession, name)
    if (paths := _NOTED.get()) is not None:
        paths.append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Store what ``build`` makes, and remove all that it has stored on the way."""
    with noted() as paths:
        made = build()
    try:
        return stored(made, name)
    finally:
        for path in paths:
            remove(spark, path)


@contextmanager
def scratch(spark: SparkSession, name: str = "scratch") -> Iterator[str]:
    """A path for as long as the block runs; what was written there is then removed."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)
