"""N-gram Jaccard join: documents as rows of a sparse matrix, n-grams as its columns.

Two documents link if their sets of word n-grams have a Jaccard similarity of at least
``percent`` per cent. The product of the matrix with itself counts the n-grams that two
documents share; the sizes of two sets say how many that must be, which bounds the work:

1. Documents with equal sets collapse to one row (a class). Everything below is on classes.
2. A class needs a partner with at least ``percent`` of its n-grams in common, so that any two
   that link share one of the first n - ceil(percent * n / 100) + 1 n-grams of each, in one
   order for all. N-grams that are common in the corpus come last in that order: a table of
   fixed size (SKETCH counters) has an estimate of how common each is. The order only has to
   be the same for all; the estimate decides about speed, not about results.
3. A column of these prefixes with up to SMALL classes gives its pairs that fit in size. The
   columns that a pair shares are counted over all prefixes, and with what may be shared beyond
   them bound the overlap; few pairs pass, and those that hang together make a block. A column
   with more than SMALL classes is a block itself, whose pairs are all found there. Blocks are
   cut into tiles of bounded volume, and each two tiles of a block are multiplied in one task,
   piece by piece; documents whose sizes rule each other out are never multiplied, and of the
   links found only a spanning forest leaves the task. Nothing is capped: tiles cover all pairs.
4. Links are joined to components by alternating stars.

N-grams are compared by 64-bit hashes. Documents without words, or without text, link with
nothing and are components of their own; documents of fewer words than ``size`` have one
n-gram, all of them. Rows that repeat an id are rows of their own, with a component each that
is named by the least id in it; a null id is never the least. An empty table gives no rows.
Extra columns are kept by ``keep_first``; ``link`` has its own columns only. Rows are told
apart by their place in the files of a table; a frame that is not read from one is stored first.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import (
    ROW,
    forget,
    list_array,
    lower_ascii,
    offsets,
    packed,
    placed,
    ragged,
    release,
    ship,
    slices,
    stable,
    unpacked,
)
from tremor.llm.components import components
from tremor.llm.words import PLAIN_WORD, hashes, with_run_hashes, words
from tremor.sinks import remove, scratch_path, settled, stored

#: Counters of the table of common n-grams; one byte each is sent to every task.
SKETCH = 1 << 22
#: Occurrences within a task from which it reports an n-gram.
COMMON = 8
#: Classes up to which a column's pairs are listed.
SMALL = 128
#: Rows of a table of a few numbers up to which it is sent to all tasks: some 30 MB.
MOST_BROADCAST = 500_000
#: Bits of a place within one bitmap of kept rows, and bitmaps (4 KB each, for 32,768 places) up
#: to which they are sent to all tasks: 32 MB, for some 268 million rows.
_BITMAP = 15
MOST_BITMAPS = 8192
#: N-grams in a tile, about; two tiles are in memory at once.
TILE = 1 << 20
_BLOCK = 512
_COLUMNS = 2048


def n_gram_sets(documents: DataFrame, size: int) -> DataFrame:
    """Columns __row, doc_id, n and grams: the sorted distinct hashes."""
    df = documents.select(
        ROW, "doc_id", words(lower_ascii(F.col("text")), PLAIN_WORD).alias("words")
    ).withColumn("hash", hashes(F.col("words")))
    df = with_run_hashes(df, "runs", "hash", size)
    whole = F.when(F.size("words") > 0, F.array(F.xxhash64("words"))).otherwise(F.slice("hash", 1, 0))
    runs = F.when(F.size("words") < size, whole).otherwise(F.col("runs"))
    return df.select(ROW, "doc_id", F.sort_array(F.array_distinct(runs)).alias("grams")).select(
        ROW, "doc_id", F.size("grams").cast("bigint").alias("n"), "grams"
    )


def _common(sets: DataFrame) -> np.ndarray:
    """How common the n-grams of each counter are, as the bits of a count."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts = np.zeros(SKETCH, np.int32)
        for part in (p for batch in batches for p in slices(batch, "grams", 1 << 18)):
            grams = part.column(0).flatten().to_numpy().view(np.uint64)
            at, n = np.unique(grams & np.uint64(SKETCH - 1), return_counts=True)
            counts[at] += n.astype(np.int32)
        at = np.flatnonzero(counts >= COMMON)
        for i in range(0, len(at), 100_000):
            part = at[i : i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array(counts[part], pa.int64())], ["at", "n"]
            )
        del counts, at
        release()

    reported = sets.select("grams").mapInArrow(run, "at bigint, n bigint")
    bits = F.ceil(F.log2(F.sum("n") + 1)).cast("tinyint").alias("bits")
    # At most SKETCH rows of five bytes.
    summed = reported.groupBy("at").agg(bits).select(F.col("at").cast("int"), "bits").toArrow()
    out = np.zeros(SKETCH, np.uint8)
    out[summed["at"].to_numpy()] = summed["bits"].to_numpy()
    return out


def _prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """Columns gram, node, n: the first n-grams of each class in the common order."""
    spark = classes.sparkSession
    common = spark.sparkContext.broadcast(_common(classes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        weight = common.value
        for part in (p for batch in batches for p in slices(batch, "grams", 1 << 18)):
            lists = part.column(2)
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            grams = lists.flatten().to_numpy()
            document = np.repeat(np.arange(len(sizes)), sizes)
            heavy = weight[grams.view(np.uint64) & np.uint64(SKETCH - 1)]
            ordered = grams[np.lexsort((grams, heavy, document))]
            first = sizes + 1 - (sizes * percent + 99) // 100
            kept = ordered[ragged(offsets(sizes)[:-1], first)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), list_array(kept, first, pa.int64())],
                ["node", "n", "first"],
            )

    made = classes.select("node", "n", "grams").mapInArrow(
        run, "node bigint, n bigint, first array<bigint>"
    )
    return made.select(F.explode("first").alias("gram"), "node", "n")


def _may_link(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _beyond(a: Column, b: Column, percent: int) -> Column:
    """What two sets can share, at most, outside their prefixes.

    Up to the end of the prefix that ends first in the common order, all they share is in both
    prefixes; after it, the set whose prefix that is has so many n-grams left.
    """
    return F.ceil(F.greatest(a, b) * percent / 100) - 1


def _least_overlap(percent: int) -> Column:
    return F.ceil((F.col("n") + F.col("m")) * percent / (100 + percent))


def _needed(sizes_a: np.ndarray, sizes_b: np.ndarray, percent: int) -> np.ndarray:
    """The overlap from which two sets link: 100 * o >= percent * (a + b - o)."""
    return -(-(sizes_a + sizes_b) * percent // (100 + percent))


def _tile_links(members: DataFrame, percent: int) -> DataFrame:
    """A spanning forest of the links within each pair of tiles."""

    def run(table: pa.Table) -> pa.Table:
        forget()
        try:
            return _forest(table, percent)
        finally:
            release()

    return members.groupBy("kind", "block", "tile_a", "tile_b").applyInArrow(run, "a bigint, b bigint")


def _forest(table: pa.Table, percent: int) -> pa.Table:
    table = table.select(["node", "n", "grams"]).sort_by("n").combine_chunks()
    nodes, sizes = table["node"].to_numpy(), table["n"].to_numpy()
    lists = table["grams"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    # Columns get small numbers; one of a single document adds to no pair. Entries are put in the
    # order of slices of _COLUMNS columns, and of documents in each slice.
    grams = lists.flatten().to_numpy()
    order = np.argsort(grams, kind="stable").astype(np.int32)
    grams = grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    del grams, lists, table
    many = np.diff(np.r_[np.flatnonzero(new), len(order)]) > 1
    keep = np.repeat(many, np.diff(np.r_[np.flatnonzero(new), len(order)]))
    column = (np.cumsum(new[keep], dtype=np.int32) - 1).astype(np.int32)
    document = np.repeat(np.arange(len(nodes), dtype=np.int32), lengths)[order[keep]]
    del order, new, keep
    width = int(many.sum())
    order = np.lexsort((document, column // _COLUMNS))
    column, document = column[order], document[order]
    del order
    cuts = np.searchsorted(column // _COLUMNS, np.arange(-(-width // _COLUMNS) + 1))
    root = np.arange(len(nodes))
    starts = range(0, len(nodes), _BLOCK)
    for i in starts:
        for j in (j for j in starts if j >= i):
            a, b = slice(i, i + _BLOCK), slice(j, j + _BLOCK)
            if sizes[a][-1] * 100 < sizes[b][0] * percent:
                break  # documents are in order of size: nothing further fits either
            if (root[a] == root[i]).all() and (root[b] == root[i]).all():
                continue  # one tree already: further links say nothing new
            overlap = np.zeros((len(sizes[a]), len(sizes[b])), np.float32)
            for k in range(len(cuts) - 1):
                part = slice(cuts[k], cuts[k + 1])
                halves = []
                for side in (a, b):
                    lo, hi = np.searchsorted(document[part], (side.start, side.stop))
                    if lo == hi:
                        break
                    half = np.zeros((len(sizes[side]), _COLUMNS), np.float32)
                    half[document[part][lo:hi] - side.start, column[part][lo:hi] - k * _COLUMNS] = 1
                    halves.append(half)
                if len(halves) == 2:
                    overlap += halves[0] @ halves[1].T
            links = overlap >= _needed(sizes[a][:, None], sizes[b][None, :], percent)
            if i == j:
                links = np.triu(links, 1)
            x, y = np.nonzero(links)
            root = _joined(root, x + i, y + j)
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.table({"a": nodes[moved], "b": nodes[root[moved]]})


def _joined(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Roots after linking x and y: each tree's root is its least member."""
    while len(x):
        a, b = root[x], root[y]
        differ = a != b
        x, y, a, b = x[differ], y[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _bounded(df: DataFrame, name: str) -> DataFrame:
    """Store a table; where it has few rows, send it whole to every task that joins it."""
    df = stored(df, name)
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def _links(classes: DataFrame, percent: int) -> DataFrame:
    spark = classes.sparkSession
    path = scratch_path(spark, "prefixes")
    entries = stored(_prefixes(classes, percent), path=path)
    columns = entries.groupBy("gram").agg(F.count("*").alias("members")).filter("members > 1")
    # All joins on grams are by a shuffle at every size: both sides grow with the documents.
    shared = stored(entries.join(columns.hint("merge"), "gram"), "shared")
    remove(spark, path)
    small = shared.filter(F.col("members") <= SMALL).select("gram", "node", "n")
    right = small.select("gram", F.col("node").alias("b"), F.col("n").alias("m"))
    pairs = stored(
        small.withColumnRenamed("node", "a")
        .join(right.hint("merge"), "gram")
        .filter((F.col("a") < F.col("b")) & _may_link(F.col("n"), F.col("m"), percent))
        .groupBy("a", "b", "n", "m")
        .agg(F.count("*").alias("shared"))
        .filter(F.col("shared") + _beyond(F.col("n"), F.col("m"), percent) >= _least_overlap(percent))
        .select("a", "b"),
        "pairs",
    )
    blocks = components(pairs, "blocks").select(F.lit(0).alias("kind"), F.col("root").alias("block"), "node")
    large = shared.filter(F.col("members") > SMALL)
    blocks = stored(blocks.union(large.select(F.lit(1), "gram", "node")), "blocks")
    # The sets of classes that are in a block; all others are done.
    wanted = _bounded(blocks.select("node").distinct(), "wanted")
    sets = stored(classes.select("node", "n", "grams").join(wanted, "node", "left_semi"), "sets")
    volumes = (
        blocks.join(sets.select("node", "n"), "node").groupBy("kind", "block").agg(F.sum("n").alias("volume"))
    )
    tiles = F.ceil(F.col("volume") / TILE).cast("int")
    members = (
        blocks.join(volumes, ["kind", "block"])
        .select("kind", "block", "node", tiles.alias("tiles"))
        .withColumn("side", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "kind",
            "block",
            "node",
            F.least("side", "other").alias("tile_a"),
            F.greatest("side", "other").alias("tile_b"),
        )
    )
    # Joined by a shuffle at every size, as these rows grow with the documents.
    return _tile_links(stored(members, "members").hint("merge").join(sets, "node"), percent)


def link(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """A row for each document: __row, doc_id, n_shingles, component_id and component.

    ``component`` is a number of its own for each component, ``component_id`` its least doc_id.
    """
    ship(documents.sparkSession)
    return settled(documents.sparkSession, "linked", lambda: _linked(documents, size, percent))


def _linked(documents: DataFrame, size: int, percent: int) -> DataFrame:
    rowed = placed(stable(documents.select("doc_id", "text")), "doc_id", "text")
    hashed = {"h1": F.xxhash64("grams"), "h2": F.xxhash64(F.lit("again"), "grams")}
    facts = stored(n_gram_sets(rowed, size).withColumns(hashed).drop("grams"), "facts")
    key = ["h1", "h2", "n"]
    classes = stored(
        facts.filter("n > 0").groupBy(*key).agg(F.min(ROW).alias("node"), F.min("doc_id").alias("least")),
        "classes",
    )
    # All rows but the first of each class; their sets are not needed again.
    others = _bounded(
        facts.select(ROW).join(classes.select(F.col("node").alias(ROW)), ROW, "left_anti"), "others"
    )
    first = n_gram_sets(rowed.join(others, ROW, "left_anti"), size)
    path = scratch_path(documents.sparkSession, "n-grams")
    sets = stored(first.select(F.col(ROW).alias("node"), "n", "grams"), path=path)
    links = _links(sets, percent)
    remove(documents.sparkSession, path)  # what is still needed has been stored by itself
    roots = stored(components(links), "roots")
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    final = rooted.join(named, "root").select(*key, F.col("root").alias("component"), "component_id")
    return facts.join(final, key, "left").select(
        ROW,
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("component", ROW).alias("component"),
    )


def _rows_of(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The rows whose ROW is in ``places``, by one bit for each where that is small enough.

    A bitmap for each stretch of a file goes to every task then, and no text is shuffled; the
    number of bitmaps is checked, and beyond the bound rows and places are joined by a shuffle.
    """
    bucket = F.shiftright(ROW, _BITMAP)
    bit = F.col(ROW).bitwiseAND((1 << _BITMAP) - 1)
    bits = F.bitmap_construct_agg(bit).alias("bits")
    bitmaps = stored(places.groupBy(bucket.alias("bucket")).agg(bits), "bitmaps")
    if bitmaps.count() > MOST_BITMAPS:
        return rows.join(places, ROW, "left_semi")
    at = F.substring("bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
    byte = F.conv(F.hex(at), 16, 10).cast("int")
    kept = F.getbit(byte, bit.bitwiseAND(7).cast("int")) == 1
    return rows.join(F.broadcast(bitmaps), (bucket == F.col("bucket")) & kept, "left_semi")


def keep_first(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns: the first by id, then by place."""
    documents = stable(documents)

    def firsts() -> DataFrame:
        kept = link(documents, size, percent).groupBy("component").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first")
        )
        return kept.select(F.col(f"first.{ROW}").alias(ROW))

    first = settled(documents.sparkSession, "firsts", firsts)
    return unpacked(_rows_of(packed(documents), first), documents.columns)
