"""Picking columns out of tables that may have any others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Columns under new names; each is the first one of exactly that name.

    Columns are found by position, so others that differ in case only, repeat a name or have dots in it do no harm.
    """
    places = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*places)
    return plain.select(*[plain[places[df.columns.index(column)]].alias(name) for name, column in wanted.items()])


def numbered(df: DataFrame) -> tuple[DataFrame, Callable[[str], str]]:
    """The table with its columns named c0, c1, ..., and a function from an old name to the new name of the first column
    of exactly that name. `toDF` with the old names undoes it."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), lambda name: f"c{df.columns.index(name)}"


def without(df: DataFrame, *replaced: str) -> list[int]:
    """Places of the columns whose names, in any case, are none of those that a result adds."""
    taken = {name.lower() for name in replaced}
    return [i for i, name in enumerate(df.columns) if name.lower() not in taken]
