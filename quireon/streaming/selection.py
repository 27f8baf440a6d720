"""The selection screen as a stream: keyed state over key presses, applied in order of event time."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import names as N
from ..operators.selection import PRESS, ROW, framed, fresh, pressed, with_entries

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Screen(StatefulProcessor):
    """Per image: its row, and the presses that the watermark hasn't passed yet, by (time, event).

    A press that comes again meets its own place; one that the watermark has passed is never
    applied out of order, as the row remembers the last press applied.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", "json string, at long, event long")
        self.waiting = handle.getMapState("waiting", "at long, event long", "press string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        _, at, event = self.row.get() or (None, -(1 << 62), -1)
        latest = None
        for batch in rows:
            for p in batch.to_dict("records"):
                place = (int(p["at"]), int(p["event_id"]))
                if place > (at, event):
                    self.waiting.updateValue(place, (json.dumps({c: p[c] for c in [*PRESS, "image_name", "image_cote"]}, default=bool),))
                    latest = max(latest or 0, place[0])
        if latest is not None:
            self.handle.registerTimer(latest // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due = sorted((k, v[0]) for k, v in ((tuple(k), v) for k, v in self.waiting.iterator()) if k[0] <= passed)
        if not due:
            return
        held = self.row.get()
        row = json.loads(held[0]) if held else None
        for place, text in due:
            press = json.loads(text)
            row = pressed(row or fresh(press["image_name"], press["image_cote"]), press)
            row["states"] = sorted(row["states"])
            self.waiting.removeKey(place)
        self.row.update((json.dumps(row), *due[-1][0]))
        yield framed([{"image": key[0], **row}], "image")

    def close(self) -> None:
        pass


def replayed_stream(presses: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """(image, ROW) of each image whenever the watermark has passed more of its presses; the last row of an image is its state.

    presses is a stream with the columns of the batch form (operators.selection.replayed), whose
    rules it shares; presses may be late by `delay` and may repeat. Needs the RocksDB state store
    (PROVIDER in spark.sql.streaming.stateStore.providerClass).
    """
    rows = with_entries(presses).withColumns({"image_cote": N.cote(F.col("image_name")), "at": F.unix_micros("ts")})
    timed = rows.withWatermark("ts", delay).select("image", "image_name", "image_cote", *PRESS, "ts", "at", "event_id")
    return timed.groupBy("image").transformWithStateInPandas(statefulProcessor=Screen(), outputStructType=f"image long, {ROW}", outputMode="Update", timeMode="EventTime")
