"""Aggregated tables joined back to their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lotwise.sources.scratch import materialize


def written_lookup(table: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(the table as written once, the same table ready to join).

    The files' size is known when the join is planned, so a table under the broadcast threshold is sent to
    the rows, and of a larger one adaptive execution splits hot keys.
    """
    written = materialize(table, label)
    return written, written
