"""Change detection on streams: an extension of :func:`foliant.operators.blocks.header_changes` to rows that keep arriving."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def changes(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, order, value): rows whose value differs from the one before of the same key, the first always.

    ``rows`` is a stream whose rows of a key arrive in order from batch to batch; inside a batch they are sorted. State: a value a key.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def fold(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(parts)).sort_values(order, kind="stable")
        before = state.get[0] if state.exists else None
        shifted = got[value].shift(1)
        shifted.iloc[0] = before
        state.update((got[value].iloc[-1],))
        yield got[(got[value] != shifted)][[key, order, value]]

    out = f"{key} {kinds[key]}, {order} {kinds[order]}, {value} {kinds[value]}"
    return rows.select(key, order, value).groupBy(key).applyInPandasWithState(fold, out, f"last {kinds[value]}", "append", GroupStateTimeout.NoTimeout)


def batch_changes(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The same on a finished table, for comparison."""
    from pyspark.sql import Window

    before = F.lag(value).over(Window.partitionBy(key).orderBy(order))
    return rows.select(key, order, value).withColumn("_b", before).filter(~F.col("_b").eqNullSafe(F.col(value))).drop("_b")
