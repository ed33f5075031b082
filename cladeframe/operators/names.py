"""Lists of names whose size is checked before they reach the driver."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 50_000


def names(df: DataFrame, column: str, most: int = MOST) -> list[str]:
    """The distinct values of a column, sorted: marker and target lists, which have some hundred to some ten thousand names."""
    found = [r[0] for r in df.select(column).where(f"{column} is not null").distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} distinct values of {column}")
    return sorted(found)


def listed(values: Sequence[str]) -> Column:
    """A list of names as a constant array: one literal in the plan, however many they are."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")
