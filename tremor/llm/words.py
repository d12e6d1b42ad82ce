"""Words, hashes of words, and hashes of runs of words, as array columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs of anything but blanks.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
#: Runs of digits, lower-case ASCII letters and characters beyond ASCII.
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column, pattern: str) -> Column:
    """All words, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def hashes(items: Column) -> Column:
    return F.transform(items, lambda w: F.xxhash64(w))


def with_run_hashes(df: DataFrame, name: str, of: str, length: int) -> DataFrame:
    """Add the hash of every run of ``length`` neighbours in the array of hashes ``of``.

    Runs are doubled: a run of eight is two runs of four. Every step reads its input twice,
    so that the optimizer keeps the steps apart and computes each one once.
    """
    power, made = 1, {1: of}
    temporary = []
    while power * 2 <= length:
        made[power * 2] = f"__{name}{power * 2}"
        df = df.withColumn(made[power * 2], _joined(made[power], made[power], power))
        temporary.append(made[power * 2])
        power *= 2
    run, covered = made[power], power
    while covered < length:
        power = max(p for p in made if p <= length - covered)
        df = df.withColumn(f"__{name}_{covered}", _joined(run, made[power], covered))
        run = f"__{name}_{covered}"
        temporary.append(run)
        covered += power
    count = F.greatest(F.size(of) - (length - 1), F.lit(0))
    return df.withColumn(name, F.slice(F.col(run), F.lit(1), count)).drop(*temporary)


def _joined(left: str, right: str, shift: int) -> Column:
    return F.transform(left, lambda x, i: F.xxhash64(x, F.get(F.col(right), i + shift)))
