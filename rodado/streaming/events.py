"""Streaming extensions over event rows (event_id, ts, user_id, event_type, value); none of them is needed elsewhere."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Counts and sums by tumbling or sliding window and type; rows later than the watermark are dropped."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    g = events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of each user: events apart by less than the gap."""
    g = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def once(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Each event once, repeats within the watermark dropped; state is bounded by it."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def track_lengths(points: DataFrame, idle_ms: int | None = 3_600_000) -> DataFrame:
    """(track, points, length_m) so far, for each track with new points (track, ord, lng, lat); points come in order.

    The state of a track is its last point and sums; it is dropped after ``idle_ms`` without points,
    or kept for good if that is None.
    """
    from ..operators.graph import _metres

    def step(key, batches: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        n, length, x, y = state.get if state.exists else (0, 0.0, None, None)
        for pdf in batches:
            for lng, lat in pdf.sort_values("ord")[["lng", "lat"]].itertuples(index=False):
                length += _metres(x, y, lng, lat) if x is not None else 0.0
                x, y, n = lng, lat, n + 1
        state.update((n, length, x, y))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({"track": [key[0]], "points": [n], "length_m": [length]})

    kind = points.schema["track"].dataType.simpleString()
    return points.groupBy("track").applyInPandasWithState(
        step, f"track {kind}, points bigint, length_m double", "n bigint, length double, x double, y double", "update", GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    )
