"""User functions per group: the escape hatch for what columns and windows cannot say."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from laurel.session import GROUP_ROWS


def apply_per_group(
    df: DataFrame,
    keys: Sequence[str],
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    max_rows: int = GROUP_ROWS,
) -> DataFrame:
    """`function` on each group as a pandas frame.

    A group goes to one task as a whole, so a table with a larger group is refused before it runs;
    such work needs `scan_groups`, or the window and aggregation operators.
    """
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest > max_rows:
        raise ValueError(f"a group has {largest} rows, more than {max_rows}: use scan_groups, windows or aggregates")
    return df.groupBy(*keys).applyInPandas(function, schema)


def scan_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    start: Callable[[], Any],
    step: Callable[[Any, pd.DataFrame], tuple[Any, pd.DataFrame | None]],
    finish: Callable[[tuple, Any], pd.DataFrame | None],
    schema: str,
) -> DataFrame:
    """A function with state over the ordered rows of each group, whatever the size of the groups.

    `start()` gives the state before a group's first row, `step(state, rows)` takes the next rows of the group in
    `order` as a pandas frame and gives the new state and any output, `finish(key, state)` the output at the
    group's end. Groups are sorted by Spark, which spills, and pass in batches: a task holds one batch and one
    state. A group is one task's work, as its rows depend on each other; null keys are groups like others.
    """
    keys = list(keys)

    def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, begun = None, None, False
        for frame in frames:
            for key, rows in frame.groupby(keys, sort=False, dropna=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                if begun and key != current:
                    out = finish(current, state)
                    if out is not None:
                        yield out
                if not begun or key != current:
                    current, state, begun = key, start(), True
                state, out = step(state, rows)
                if out is not None:
                    yield out
        if begun:
            out = finish(current, state)
            if out is not None:
                yield out

    ordered = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return ordered.mapInPandas(scanned, schema)
