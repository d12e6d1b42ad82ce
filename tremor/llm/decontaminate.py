"""Benchmark decontamination: windows of benchmark words found in documents.

A benchmark item gives a window for each run of ``length`` words, or one window if it has
fewer words, and none if it has none. The hashes of all windows make a filter of fixed size
(FILTER_WORDS numbers of 64 bits, two bits for each hash), which every task gets as the value of
a scalar subquery. Every document is cut into words and every window of it is hashed and looked
up in the scan, so that only windows that may hit leave it. Each of those is verified: its words,
not its hash, are joined to the benchmark's. The plan is the same for every benchmark; a larger
one fills the filter, which then lets more windows through that the join refuses, and nothing
else changes. Spark sends the benchmark's windows to all tasks while their table is small enough
for its own limit, and shuffles them otherwise; a window of a third of all documents is then
one skewed partition, which adaptive execution splits.

Hits are exploded with the window's words only and aggregated per document. A passage that a
third of all documents share is one entry of the filter, which each task looks up for itself.

Null and empty texts have no words and hit nothing; so does every document if the benchmark is
empty. Every row is a document of its own, also where ids repeat. An item without id makes
hits, but is not counted among the items; repeated items count once. ``remove_documents`` and
``remove_spans`` keep all columns, ``find_hits`` keeps doc_id. Rows are told apart by their
place in the files of a table; a frame that is not read from one is stored first.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import ROW, given, lower_ascii, packed, placed, stable, unpacked
from tremor.llm.words import LETTER_WORD, hashes, with_run_hashes, words
from tremor.sinks import settled, stored

LENGTH = 10
#: Numbers of 64 bits in the filter, a power of two: 4 MB. A million windows let half a per cent through.
FILTER_WORDS = 1 << 19
# A word with the characters before it, and what follows the last word.
_PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TAIL = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z"


def item_words(text: Column) -> Column:
    return words(lower_ascii(text), LETTER_WORD)


def benchmark_windows(benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """The distinct windows: item (its id as text), size (in words) and window (text)."""
    texts = benchmark.select(
        F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("words")
    ).withColumn("size", F.least(F.size("words"), F.lit(length)))
    window = F.array_join(F.slice("words", F.col("at") + 1, F.col("size")), " ")
    return (
        texts.filter("size > 0")
        .withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))))
        .select("item", "size", window.alias("window"))
        .distinct()
    )


def _slot(hash: str) -> str:
    """The number of the filter that has the bits of a hash."""
    return f"CAST({hash} & {FILTER_WORDS - 1}L AS int)"


def _bits(hash: str) -> list[str]:
    """The bits of a hash within its number, taken from the other end of the hash."""
    return [f"CAST(shiftrightunsigned(shiftleft({hash}, {drop}), 58) AS int)" for drop in (0, 6)]


def window_filter(distinct: DataFrame, sizes: list[int]) -> DataFrame:
    """One row, with the filter of all windows as an array of FILTER_WORDS numbers.

    The hashes are taken as those of documents are. One task puts the array together, of a size
    that does not depend on the benchmark.
    """
    spark = distinct.sparkSession
    made = spark.range(FILTER_WORDS).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("bigint").alias("bits"))
    for size in sizes:
        split = distinct.filter(F.col("size") == size).select(hashes(F.split("window", " ")).alias("hash"))
        runs = with_run_hashes(split, "run", "hash", size).select(F.get("run", F.lit(0)).alias("h"))
        first, second = _bits("h")
        made = made.union(
            runs.selectExpr(f"{_slot('h')} AS slot", f"shiftleft(1L, {first}) | shiftleft(1L, {second}) AS bits")
        )
    merged = made.groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("slot", "bits")))
    return merged.agg(ordered.alias("slots")).select(F.col("slots.bits").alias("filter"))


def _candidates(name: str, size: int) -> str:
    """SQL for the windows that may hit: of the places ``at_``, those whose bits are set in ``q``."""
    hash = f"get({name}, i)"
    is_set = " AND ".join(f"getbit(get(q, {_slot(hash)}), {bit}) = 1" for bit in _bits(hash))
    text = ", ".join(f"get(words, i + {k})" for k in range(size))
    return (
        f"transform(filter(at_{name}, i -> {is_set}), "
        f"i -> named_struct('at', i, 'end', i + {size}, 'window', concat_ws(' ', {text})))"
    )


def find_hits(documents: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """A row for each document: __row, doc_id, n_words, hit_words (sorted places), items (sorted)."""
    return settled(documents.sparkSession, "hits", lambda: _hits(documents, benchmark, length))


def _hits(documents: DataFrame, benchmark: DataFrame, length: int) -> DataFrame:
    windows = stored(benchmark_windows(benchmark, length), "windows")
    known = stored(windows.select("size", "window").distinct(), "known")
    # At most ``length`` sizes.
    sizes = sorted(row.size for row in known.select("size").distinct().collect())

    df = placed(
        stable(documents.select("doc_id", "text")), "doc_id", item_words(F.col("text")).alias("words")
    ).withColumn("hash", hashes(F.col("words")))
    found = ["CAST(array() AS array<struct<at:int,end:int,window:string>>)"]
    for size in sizes:
        df = with_run_hashes(df, f"runs{size}", "hash", size)
        found.append(_candidates(f"runs{size}", size))
    filter_of = stored(window_filter(known, sizes), "filter").scalar()
    # A subquery may not stand in a higher-order function. As a column that is named once the
    # optimizer puts it there, so that no row carries the array; the places, which name the runs
    # twice, keep it from being put together with the step before instead.
    places = {
        f"at_runs{size}": F.expr(f"if(size(runs{size}) > 0, sequence(0, size(runs{size}) - 1), array())")
        for size in sizes
    }
    df = df.withColumns({"__filter": filter_of, **places})
    all_found = F.expr(f"get(transform(array(__filter), q -> flatten(array({', '.join(found)}))), 0)")
    rows = df.select(
        ROW, "doc_id", F.size("words").alias("n_words"), all_found.alias("found")
    ).select(ROW, "doc_id", "n_words", F.explode_outer("found").alias("found"))

    # No window holds a NUL: documents without candidates meet nothing, in places of their own.
    alone = F.concat(F.lit("\0"), F.col(ROW).cast("string"))
    key = F.coalesce("found.window", alone)
    known = known.select(F.col("window").alias("known"))
    verified = rows.withColumn("key", key).join(known, F.col("key") == F.col("known"), "left")
    places = F.when(F.col("known").isNotNull(), F.sequence("found.at", F.col("found.end") - 1))
    hits = verified.groupBy(ROW).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").cast("bigint").alias("n_words"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list(places)))).alias("hit_words"),
        F.sort_array(F.collect_set("known")).alias("windows"),
    )
    # The places go with the first window only, not with a copy for each of them.
    opened = hits.select(
        ROW, "doc_id", "n_words", "hit_words", F.posexplode_outer("windows").alias("i", "window")
    ).withColumn("hit_words", F.when(F.coalesce("i", F.lit(0)) == 0, F.col("hit_words")))
    of_item = windows.select("item", F.col("window").alias("of"))
    named = opened.join(of_item, F.coalesce("window", alone) == F.col("of"), "left")
    return named.groupBy(ROW).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.first("hit_words", ignorenulls=True).alias("hit_words"),
        F.sort_array(F.collect_set("item")).alias("items"),
    )


def remove_documents(documents: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents that hold no window, with all their columns."""
    documents = stable(documents)
    hit = find_hits(documents, benchmark, length).filter(F.size("hit_words") > 0).select(ROW)
    # Stored, so that its size decides how it is joined.
    rest = packed(documents).join(stored(hit, "hit"), ROW, "left_anti")
    return unpacked(rest, documents.columns)


def remove_spans(documents: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """All documents, without the words that were hit and the characters before each of those."""
    documents = stable(documents)
    hit = find_hits(documents, benchmark, length).filter(F.size("hit_words") > 0)
    rows = packed(documents).join(stored(hit.select(ROW, "hit_words"), "hit"), ROW, "left")
    pieces = F.regexp_extract_all(given("text"), F.lit(_PIECE), F.lit(0))
    rows = rows.withColumn("__pieces", F.when(F.col("hit_words").isNotNull(), pieces))
    stays = F.array_except(F.sequence(F.lit(0), F.size("__pieces") - 1), F.col("hit_words"))
    rest = F.transform(stays, lambda i: F.get(F.col("__pieces"), i))
    text = F.concat(F.array_join(rest, ""), F.regexp_extract(given("text"), _TAIL, 0))
    cut = F.when(F.col("hit_words").isNotNull(), text).otherwise(given("text"))
    return unpacked(rows, documents.columns, cut)
