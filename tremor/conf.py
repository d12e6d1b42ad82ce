"""Session settings that the library is meant to run with."""

SESSION_CONF = {
    # Days and weeks are UTC days and weeks.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution merges small shuffle partitions and splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
