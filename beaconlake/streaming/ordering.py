"""Events of a key in the order of their time, from a stream that delivers them in any order.

Each event waits in state until the watermark has passed its time. Then nothing older can come any more, and the key's
events go out by (``timestamp``, ``event_id``), numbered. What comes of a key in a micro-batch waits as chunks in order of
time, and one timer per key wakes the first of them: the calls to the state store are a few per key and micro-batch and not
per event. Chunks that begin after the watermark are not looked at, so of a busy key only what is due is read.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import StructType

# The processor travels with its tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POSITION = "position"
_ROW = "event_row"


#: Events of a chunk, and rows that are given out at once.
CHUNK_ROWS = 5_000


class InOrder(StatefulProcessor):
    """Holds events (``timestamp``, ``event_id``, the row as JSON) and gives them out when the watermark has passed them."""

    def init(self, handle) -> None:
        self.handle = handle
        # Events [moment, id, row] by time, a chunk each. Of the key: how many have gone out, the next chunk's number, and
        # the waiting chunks as [first moment, last moment, number].
        self.waiting = handle.getMapState("waiting", "chunk bigint", "events string")
        self.state = handle.getValueState("state", "state string")

    def _state(self) -> tuple[int, int, list]:
        found = self.state.get()
        return json.loads(found[0]) if found else (0, 0, [])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given, number, chunks = self._state()
        woken = min((chunk[0] for chunk in chunks), default=None)
        for frame in rows:
            events = sorted(zip(frame["timestamp"].tolist(), frame["event_id"], frame[_ROW]), key=lambda event: event[0])
            for i in range(0, len(events), CHUNK_ROWS):
                part = events[i:i + CHUNK_ROWS]
                self.waiting.updateValue((number,), (json.dumps(part),))
                chunks.append((part[0][0], part[-1][0], number))
                number += 1
        if not chunks:
            return iter([])
        first = min(chunk[0] for chunk in chunks)
        if woken is None or first < woken:
            self.handle.registerTimer(first)
        self.state.update((json.dumps((given, number, chunks)),))
        return iter([])

    def _due(self, chunks: list, limit: int, left: list) -> Iterator[tuple]:
        """The events up to ``limit`` in order; ``left`` gets the chunks that go on waiting."""
        heap: list[tuple] = []
        for first, last, number in sorted(chunks):
            if first > limit:
                left.append((first, last, number))
                continue
            while heap and heap[0][0] < first:
                yield heapq.heappop(heap)
            events = json.loads(self.waiting.getValue((number,))[0])
            for i, (moment, event_id, row) in enumerate(events):
                if moment > limit:
                    self.waiting.updateValue((number,), (json.dumps(events[i:]),))
                    left.append((moment, last, number))
                    break
                heapq.heappush(heap, (moment, event_id.encode(), number, i, row))
            else:
                self.waiting.removeKey((number,))
        while heap:
            yield heapq.heappop(heap)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        given, number, chunks = self._state()
        limit = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        if all(chunk[0] > limit for chunk in chunks):
            return
        left: list = []
        rows: list[str] = []
        for event in self._due(chunks, limit, left):
            rows.append(event[-1])
            if len(rows) == CHUNK_ROWS:
                yield pd.DataFrame({_ROW: rows, POSITION: range(given + 1, given + len(rows) + 1)})
                given, rows = given + len(rows), []
        if rows:
            yield pd.DataFrame({_ROW: rows, POSITION: range(given + 1, given + len(rows) + 1)})
            given += len(rows)
        if left:
            self.handle.registerTimer(min(chunk[0] for chunk in left))
        self.state.update((json.dumps((given, number, left)),))

    def close(self) -> None:
        pass


def ordered_by_key(events: DataFrame, key: str, delay: str, row_type: StructType | None = None) -> DataFrame:
    """A stream's events with their ``position`` among those of their ``key``, by (``timestamp``, ``event_id``).

    An event goes out once the stream's latest ``timestamp`` is more than ``delay`` ahead of it. One that comes later than
    that is late: Spark leaves it out here, and it is still in the table that ingestion fills. Events without a key, id or
    time have no place in an order and are left out too. Needs the RocksDB state store that ``configure`` sets.
    """
    row_type = row_type or events.schema
    placed = events.where(F.col(key).isNotNull() & F.col("event_id").isNotNull() & F.col("timestamp").isNotNull())
    timed = placed.select(
        F.col(key).alias("order_key"), "timestamp", "event_id", F.to_json(F.struct(*[F.col(f"`{c}`") for c in events.columns])).alias(_ROW),
        F.timestamp_millis("timestamp").alias("moment"),
    ).withWatermark("moment", delay)
    ordered = timed.groupBy("order_key").transformWithStateInPandas(
        statefulProcessor=InOrder(), outputStructType=f"{_ROW} string, {POSITION} bigint", outputMode="Append", timeMode="EventTime",
    )
    return ordered.select(F.from_json(_ROW, row_type).alias("row"), POSITION).select("row.*", POSITION)
