from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c
