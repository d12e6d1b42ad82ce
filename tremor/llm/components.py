"""Connected components of an edge table, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.sinks import remove, scratch_path, stored


def _stars(edges: DataFrame, downward: bool) -> DataFrame:
    """Hang neighbours on the least node of each neighbourhood.

    Upward, a node's larger neighbours go to the least of its neighbourhood; downward, the node
    itself and its smaller ones do. The least is an aggregate that each task combines, and is
    joined back to the edges; the join may split a node with very many neighbours.
    """
    both = edges if downward else edges.union(edges.select("b", "a"))
    sides = both.toDF("node", "near")
    if downward:
        sides = sides.select(
            F.greatest("node", "near").alias("node"), F.least("node", "near").alias("near")
        )
    least = sides.groupBy("node").agg(F.min("near").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    joined = sides.join(least, "node")
    if downward:
        moved = joined.select(F.col("near").alias("a"), F.col("least").alias("b"))
        moved = moved.union(least.select("node", "least"))
    else:
        moved = joined.filter(F.col("near") > F.col("node")).select(
            F.col("near").alias("a"), F.col("least").alias("b")
        )
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Columns node and root (the least node of its component), for every node of an edge.

    ``edges`` has two columns of one integer type. A round costs two groupings and two joins of
    the edges, whose number does not grow; rounds grow with the logarithm of the longest chain.
    Each round's edges are stored in the shared folder, which cuts the lineage.
    """
    spark = edges.sparkSession
    now_path = scratch_path(spark, name)
    given = edges.toDF("a", "b").filter("a <> b")
    now = stored(given.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), path=now_path)
    before = None
    while True:
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.max("a")
        ).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
        before = state
        path = scratch_path(spark, name)
        now = stored(_stars(_stars(now, False), True), path=path)
        remove(spark, now_path)
        now_path = path
