"""Dense numbering of sale lines in date order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.ranking import with_position


def number_lines(lines: DataFrame, identity: list[str], name: str, after: int = 0) -> DataFrame:
    """Number the lines ``after + 1 ...`` by date and identity, at every size.

    The lines are sorted once, in ranges of date and identity, so a day with very many lines
    is spread over several tasks; what each range holds tells where its numbers start.
    """
    order = [F.asc(c) for c in dict.fromkeys(["date", *identity])]
    placed = with_position(lines, order, name)
    return placed.withColumn(name, F.col(name) + F.lit(after))
