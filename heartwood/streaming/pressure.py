"""Failures under pressure, from a stream that runs on: an as-of join in state.

Rows of a session wait until the watermark has passed them; then nothing
older can arrive, and they are taken in the order of their moments, pressure
before failures of the same moment. So the result is that of the batch as-of
join over the rows in time, in whatever order they came.

State of a session: the rows between watermark and the latest moment, and
the last ``pressure_kept`` pressure rows before it. A pressure row without a place is
dropped once no later failure can be near it; one with a place may be near in
passages at any time, and goes ``forget`` seconds after its moment (never, if
that is None).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from heartwood.config import DEFAULT, EngineConfig

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COLUMNS = ["session_id", "record_id", "pressure_source_id", "lag_s", "lag_n"]


def _order(row: tuple) -> tuple:
    return (*row[:-1], str(row[-1]))


def _due(ts: float) -> float:
    """The first whole millisecond at or after a moment; never stays never."""
    return ts if ts == math.inf else math.ceil(ts * 1000)


class _Pressure(StatefulProcessor):
    def __init__(self, kind: str, kept: int, seconds: float, within: int, forget: float | None) -> None:
        self.kind, self.kept, self.seconds, self.within, self.forget = kind, kept, seconds, within, forget

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"ts double, late boolean, passage_idx int, record_id {self.kind}")
        self.held = handle.getListState("held", f"ts double, passage_idx int, record_id {self.kind}")

    def _expiry(self, row: tuple) -> float:
        """When a held row can be of no use any more."""
        return row[0] + (self.seconds if row[1] < 0 else math.inf if self.forget is None else self.forget)

    def _wake(self, moments: list[float], after: float = -math.inf) -> None:
        """A timer at the earliest of these moments, unless one past ``after`` comes sooner."""
        due = min((_due(m) for m in moments if m < math.inf), default=None)
        if due is not None and not any(after < t <= due for t in list(self.handle.listTimers())):
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = []
        for part in rows:
            new = [(float(r.moment), r.kind != "pressure", int(r.passage_idx), r.record_id) for r in part.itertuples(index=False)]
            if new:
                self.waiting.appendList(new)
                first.append(min(r[0] for r in new))
        self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        rows = [tuple(r) for r in self.waiting.get()]
        later = [r for r in rows if _due(r[0]) > now]
        held, out = [tuple(r) for r in self.held.get()], []
        for ts, late, place, record in sorted((r for r in rows if _due(r[0]) <= now), key=_order):
            if not late:
                held = sorted([*held, (ts, place, record)], key=_order)[-self.kept :]
            elif held:
                at, there, source = held[-1]
                if ts - at <= self.seconds or min(place, there) >= 0 and place - there <= self.within:
                    out.append((key[0], record, source, round(ts - at, 1), max(0, place - there)))
        held = [r for r in held if _due(self._expiry(r)) > now]
        for state, content in ((self.waiting, later), (self.held, held)):
            if content:
                state.put(content)
            else:
                state.clear()
        self._wake([*(r[0] for r in later), *(self._expiry(r) for r in held)], now)
        yield pd.DataFrame(out, columns=COLUMNS)

    def close(self) -> None:
        pass


def pressure(rows: DataFrame, at: str = "at", cfg: EngineConfig = DEFAULT, forget: float | None = None) -> DataFrame:
    """(session_id, record_id, pressure_source_id, lag_s, lag_n) of failures with the latest pressure at or before them, if that is near.

    ``rows``: session_id, record_id, passage_idx (-1 or null: none), kind
    ('pressure' or 'failed') and ``at``, a timestamp with a watermark; rows
    without session or moment go. The session's state store must be RocksDB
    (``STATE_STORE``).
    """
    kind = rows.schema["record_id"].dataType.simpleString()
    out = f"session_id string, record_id {kind}, pressure_source_id {kind}, lag_s double, lag_n int"
    need = rows.select("session_id", "record_id", (F.unix_micros(at) / 1e6).alias("moment"), F.coalesce("passage_idx", F.lit(-1)).cast("int").alias("passage_idx"), "kind", F.col(at).alias("marked")).where("session_id is not null and moment is not null")
    return need.groupBy("session_id").transformWithStateInPandas(_Pressure(kind, cfg.pressure_kept, cfg.pressure_seconds, cfg.pressure_passages, forget), out, "append", "eventTime")
