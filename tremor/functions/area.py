"""The two rules that turn a place description into an area.

They disagree: ``10 km SSW of Idyllwild, CA`` is ``Idyllwild, CA`` by the tail
rule and ``CA`` by the comma rule. Both are kept exactly.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremor.functions._columns import ColumnOrName, column

# Fixed value: the tail rule's pattern.
TAIL_PATTERN = r"of (.+)$"

# Outer whitespace: Unicode white space and the four ASCII separators.
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def area_tail(place: ColumnOrName) -> Column:
    """Text after the first ``of ``; ``""`` without one; null for a null place."""
    return F.regexp_extract(column(place), TAIL_PATTERN, 1)


def area_comma(place: ColumnOrName) -> Column:
    """Text after the first comma, each later comma followed by one more space,
    stripped; ``""`` without a comma; null for a null or empty place."""
    place = column(place)
    comma = F.instr(place, ",")
    tail = F.replace(F.substr(place, comma + 1), F.lit(","), F.lit(", "))
    return F.when(
        F.length(place) > 0,
        F.when(comma == 0, "").otherwise(F.regexp_replace(tail, _OUTER_SPACE, "")),
    )


AREA_RULES = {"tail": area_tail, "comma": area_comma}
