"""Rule routing per micro-batch: clean rows to one table, bad rows to another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from terrane.operators.rules import Rule, quality_report
from terrane.plans.layers import route
from terrane.streaming.ingest import run_available


def route_stream(
    stream: DataFrame,
    rules: Sequence[Rule],
    clean_table: str,
    quarantine_table: str,
    checkpoint: str,
) -> dict[str, float]:
    """A batch is parsed and judged once; both its writes carry its name, so none repeats."""
    clean = bad = 0

    def each(batch: DataFrame, name: str) -> None:
        nonlocal clean, bad
        counts = route(
            batch, rules, clean_table, quarantine_table, "append", staged=True, segment=name
        )
        clean, bad = clean + counts[0], bad + counts[1]

    run_available(stream, checkpoint, each)
    return quality_report(clean, bad)
