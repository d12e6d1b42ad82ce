r"""Quality rules: few words, repetition, and lines that a host repeats over its documents.

A document fails the base rules with fewer than MIN_WORDS words, or if more than half of its
words stand in windows of three words that occur twice or more in it.

Lines are normalised (A-Z in lower case, blanks joined) and hashed to 64 bits; each document
counts a line once for its host (the column ``source``). A line is boilerplate of a host if it
occurs in at least MIN_DOCUMENTS of its documents and in more than MOST_SHARE of them. Such
lines are removed, and a document is depleted, and rejected, if they held more than
MOST_REMOVED of its words.

Counts are partial in each task before they are shuffled, so that a line or a host with a
third of all rows arrives as one row per task. The lines above the limits are stored, and
joined to the lines of all documents: sent to all tasks if they are few (Spark goes by the size
of the stored files), otherwise by a shuffle on host and line, which adaptive execution splits
where one line is hot. Texts stay out of every shuffle of ``judge``.

Null and empty texts have no words and fail the base rules. A null host is a host of its own.
Repeated rows are documents of their own, and so are rows that repeat an id: each has its
verdict. Rows are told apart by their place in the files of a table; a frame that is not read
from one is stored first. An empty table gives no rows. ``clean`` keeps extra columns.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import ROW, given, lower_ascii, packed, placed, stable, text_or_empty, unpacked
from tremor.llm.words import PLAIN_WORD, hashes, with_run_hashes, words
from tremor.sinks import settled, stored

MIN_WORDS = 50
#: Of 100 words, those that may stand in repeated windows.
MOST_REPEATED = 50
#: Documents of a host that a line is in, and their share, from which it is boilerplate. The share
#: decides in hosts of more than 250 documents, and has to be small, as it grows with them.
MIN_DOCUMENTS = 5
MOST_SHARE = 0.02
#: The share of its words that a document may lose.
MOST_REMOVED = 0.2

_BLANKS = r"[\x20\x09-\x0D]+"


def normal_line(line: Column) -> Column:
    return lower_ascii(F.trim(F.regexp_replace(line, _BLANKS, " ")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _has_word(line: Column) -> Column:
    return line.rlike(PLAIN_WORD)


def with_base(documents: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = text_or_empty()
    df = (
        documents.withColumn("__words", words(F.col("text"), PLAIN_WORD))
        .withColumn("__hash", hashes(F.col("__words")))
        .withColumn("__lines", F.filter(_lines(text), _has_word))
    )
    df = with_run_hashes(df, "__runs", "__hash", 3)
    # Equal windows are neighbours once they are sorted.
    ordered = F.sort_array(
        F.transform("__runs", lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    )
    df = df.withColumn("__sorted", ordered)

    def repeated(run: Column, i: Column) -> Column:
        before, after = F.get("__sorted", i - 1), F.get("__sorted", i + 1)
        same = (before["hash"] == run["hash"], after["hash"] == run["hash"])
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    places = F.transform(
        F.filter("__sorted", repeated),
        lambda run: F.array(run["at"], run["at"] + 1, run["at"] + 2),
    )
    df = df.withColumns(
        {
            "n_words": F.size("__words").cast("bigint"),
            "word_chars": F.char_length(F.translate(text, " \t\n\x0b\f\r", "")).cast("bigint"),
            "n_symbols": (
                F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))
            ).cast("bigint"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": F.size(F.array_distinct(F.flatten(places))).cast("bigint"),
        }
    ).drop("__words", "__hash", "__lines", "__runs", "__sorted")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED
    )
    return df.withColumn("base_failed", failed)


def _line_rows(documents: DataFrame) -> DataFrame:
    """A row for each line with a word: its document's row, host, hash, and number of words."""
    lines = F.filter(_lines(text_or_empty()), _has_word)
    made = F.transform(
        F.transform(lines, normal_line),
        lambda line: F.struct(
            F.xxhash64(line).alias("line"),
            # Blanks are joined, so that words are one more than they.
            (F.char_length(line) - F.char_length(F.replace(line, F.lit(" "))) + 1).alias("n"),
        ),
    )
    return documents.select(ROW, "source", F.explode(made).alias("l")).select(ROW, "source", "l.*")


def boilerplate(documents: DataFrame) -> DataFrame:
    """The lines above the limits: source, line (hash), n_documents and n_host."""
    lines = F.transform(F.filter(_lines(text_or_empty()), _has_word), normal_line)
    once = F.array_distinct(F.transform(lines, lambda line: F.xxhash64(line)))
    counted = (
        documents.select("source", F.explode(once).alias("line"))
        .groupBy("source", "line")
        .agg(F.count("*").alias("n_documents"))
        .filter(F.col("n_documents") >= MIN_DOCUMENTS)
    )
    hosts = documents.groupBy("source").agg(F.count("*").alias("n_host"))
    same = counted["source"].eqNullSafe(hosts["source"])
    return (
        counted.join(hosts, same)
        .select(counted["source"], "line", "n_documents", "n_host")
        .filter(F.col("n_documents") > F.col("n_host") * MOST_SHARE)
    )


def _removed(rowed: DataFrame) -> DataFrame:
    """For each document that has boilerplate: the hashes of those lines, and their words."""
    limits = stored(boilerplate(rowed).select(F.col("source").alias("host"), "line"), "lines")
    lines = _line_rows(rowed)
    hit = lines.join(limits, (lines["source"].eqNullSafe(limits["host"])) & (lines["line"] == limits["line"]))
    return hit.groupBy(ROW).agg(
        F.sum("n").alias("n_removed_words"), F.collect_set(lines["line"]).alias("removed_lines")
    )


def _verdict(df: DataFrame) -> DataFrame:
    lost = F.coalesce("n_removed_words", F.lit(0)).cast("bigint")
    depleted = lost > F.col("n_words") * MOST_REMOVED
    return df.withColumn("n_removed_words", lost).withColumn(
        "kept", ~F.col("base_failed") & ~depleted
    )


def judge(documents: DataFrame) -> DataFrame:
    """One row for each document: doc_id, the base counts, n_removed_words, base_failed, kept."""
    return settled(documents.sparkSession, "judged", lambda: _judged(documents))


def _judged(documents: DataFrame) -> DataFrame:
    columns = ["doc_id", "text", "source"]
    rowed = placed(stable(documents.select(*columns)), *columns)
    base = with_base(rowed).drop("text", "source")
    lost = _removed(rowed).select(ROW, "n_removed_words")
    return _verdict(base.join(lost, ROW, "left")).drop(ROW)


def clean(documents: DataFrame) -> DataFrame:
    """The documents that pass, without boilerplate lines; ``n_chars`` follows the text."""
    rows = packed(stable(documents))
    plain = rows.select(ROW, given("text").alias("text"), given("source").alias("source"))
    # Both are stored: their sizes decide how they are joined, and the rules run once, as a
    # filter on them would be moved below and repeat what they are made of.
    lost = stored(_removed(plain), "removed")
    verdicts = _verdict(with_base(plain).join(lost, ROW, "left")).select(ROW, "kept")
    rejected = stored(verdicts, "verdicts").filter(~F.col("kept")).select(ROW)
    kept = rows.join(stored(rejected, "rejected"), ROW, "left_anti").join(lost, ROW, "left")
    stays = F.filter(
        _lines(given("text")),
        lambda line: ~_has_word(line)
        | ~F.array_contains(F.col("removed_lines"), F.xxhash64(normal_line(line))),
    )
    text = F.when(F.col("removed_lines").isNull(), given("text")).otherwise(
        F.array_join(stays, "\n")
    )
    return unpacked(kept, documents.columns, text)
