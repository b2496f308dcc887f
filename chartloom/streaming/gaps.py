"""Missing weeks of charts as they arrive: what a chart has shown is kept in state, and a timer says what has not come."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.relational import CHART

EVENTS = "source_name string, territory string, expected date, status string"
STATE = "first int, seen array<int>, told array<int>"
EPOCH = date(1970, 1, 1)


def due(first: int, seen: set[int], weeks: int, slack: int) -> set[int]:
    """Days, counted from 1970, of the weeks back from the last one that have no chart within ``slack`` days."""
    last = max(seen)
    back = [last - 7 * g for g in range(weeks + 1) if last - 7 * g >= first - slack]
    return {d for d in back if not any(d + s in seen for s in range(-slack, slack + 1))}


def watch_gaps(rows: DataFrame, weeks: int = 12, slack: int = 3, grace: int = 21) -> DataFrame:
    """A stream of (source_name, territory, expected, status) from one of chart rows with a ``week_start``.

    A week is ``missing`` when ``grace`` days of all charts' time have gone by since the chart's last week and nothing
    has come for it, and ``filled`` if it comes after that. The last word on a week is that of
    ``operators.calendar.missing_weeks`` over the same rows. A chart's state is the weeks of its last ``weeks``; rows
    older than that change nothing, and rows further back than the watermark of so many weeks are left to a batch.
    """
    days = 7 * weeks + grace

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, seen, told = state.get if state.exists else (None, [], [])
        seen, told = set(seen), set(told)
        if not state.hasTimedOut:
            for p in parts:
                new = {(d - EPOCH).days for d in p["week_start"] if d is not None}
                seen |= new
                first = min([*new, *([] if first is None else [first])], default=first)
        if not seen:
            return
        last = max(seen)
        seen = {d for d in seen if d >= last - 7 * weeks - slack}
        missing = due(first, seen, weeks, slack)
        events = [(d, "filled") for d in sorted(told - missing) if d >= last - 7 * weeks]
        told &= missing
        clock = state.getCurrentWatermarkMs() // 86_400_000
        if clock >= last - days + grace:  # so much time has gone by since the last week
            events += [(d, "missing") for d in sorted(missing - told)]
            told = missing
        else:
            state.setTimeoutTimestamp((last - days + grace) * 86_400_000)
        state.update((first, sorted(seen), sorted(told)))
        if events:
            yield pd.DataFrame({"source_name": key[0], "territory": key[1], "expected": [EPOCH + timedelta(d) for d, _ in events], "status": [s for _, s in events]})

    timed = rows.select(*CHART, "week_start", F.col("week_start").cast("timestamp").alias("at")).withWatermark("at", f"{days} days")
    return timed.groupBy(*CHART).applyInPandasWithState(step, EVENTS, STATE, "append", GroupStateTimeout.EventTimeTimeout)
