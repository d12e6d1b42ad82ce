"""Placement of keys on shards by a lookup table that permutations fill.

Each shard orders the slots of a table of prime size by its own permutation: an offset and a
step taken from a hash of the shard's name. Shards take turns; whoever has the turn claims the
first slot of its order that is still free, until the table is full. Shares then differ by
one slot at most, and when a shard goes, few keys of the others move.

The table depends on the shards alone, never on the data: ``slots`` rows, which are broadcast.
A key is placed by one lookup, in the scan, without a shuffle; that holds for a key with a
third of all rows too. Where such rows are written, ``write_shards`` splits them over files.

A null key has a slot of its own hash, like any other value; equal keys share a shard. Columns
of the input that are named like the new ones are replaced. An empty table gives no rows.
"""

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm.common import GIVEN, given

#: Slots for each shard at least, so that shares are even to within a percent.
SLOTS_PER_SHARD = 100
#: The table is broadcast with every placement; larger ones are refused.
MOST_SLOTS = 1 << 20


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(text: str) -> int:
    """60 bits of a hash, as DataFrame and SQL functions can take them too."""
    return int(md5(text.encode(), usedforsecurity=False).hexdigest()[:15], 16)


def table_size(shards: int) -> int:
    size = max(2, shards * SLOTS_PER_SHARD)
    while not _prime(size):
        size += 1
    return size


def fill_table(shards: list[str], slots: int) -> list[int]:
    """The index of the shard that owns each slot."""
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards need distinct names")
    if not _prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime of {len(shards)} to {MOST_SLOTS}")
    at = [_number(f"{name}/offset") % slots for name in shards]
    step = [_number(f"{name}/step") % (slots - 1) + 1 for name in shards]
    owner = [-1] * slots
    free = slots
    while True:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    owner = fill_table(shards, slots)
    rows = [(slot, shard, shards[shard]) for slot, shard in enumerate(owner)]
    return spark.createDataFrame(rows, "slot bigint, shard int, shard_name string")


def slot_of(key: Column, slots: int) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % F.lit(slots)


def place(df: DataFrame, key: str, shards: list[str], slots: int | None = None) -> DataFrame:
    """Add ``slot``, ``shard`` and ``shard_name`` for each row."""
    slots = slots or table_size(len(shards))
    made = ("slot", "shard", "shard_name")
    # Columns keep apart from the new ones in a struct; a slot needs no place of its row.
    rows = df.select(F.struct("*").alias(GIVEN)).withColumn("slot", slot_of(given(key), slots))
    owned = rows.join(F.broadcast(lookup_table(df.sparkSession, shards, slots)), "slot")
    return owned.select(*(given(c).alias(c) for c in df.columns if c not in made), *made)


def write_shards(placed: DataFrame, path: str) -> None:
    """A folder for each shard; shards with many rows are split over several files."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
