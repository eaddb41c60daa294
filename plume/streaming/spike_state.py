"""The stacked spike view as keyed state: one value per language, updated in place.

The reference stacks a per-minute count and a trailing-hour self-join, both kept
up on update.  Here one stateful operator per language holds the counts of the
minutes that a row can still depend on, and emits the spike rows that a
micro-batch changes.

* Events are counted per (language, minute) inside each Arrow batch before the
  shuffle, so a language with a third of all posts costs a row per minute and
  batch.
* A minute's count stands in the state until the minute an hour after it is
  closed by the watermark: 61 minutes behind the watermark, plus whatever the
  stream is ahead of it.  Event-time timers clear languages that fall silent.
* Late rows follow the windowed views: a row is dropped once its minute is closed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import columns as C
from ..operators.spikes import LOOKBACK_MIN

MINUTE_MS = 60_000
SPIKES = "lang string, minute long, posts_in_minute long, rolling_hr_avg double, is_spiking boolean"


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, minute) rows -> (lang, minute, n) per batch."""
    for batch in batches:
        out = pa.Table.from_batches([batch]).group_by(["lang", "minute"]).aggregate([([], "count_all")])
        yield from out.rename_columns(["lang", "minute", "n"]).to_batches()


class TrailingHour(StatefulProcessor):
    """Minute counts of a language and the spike rows they give."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.minutes = handle.getMapState("minutes", "minute long", "posts long")

    def _held(self) -> dict[int, int]:
        return {k[0]: v[0] for k, v in self.minutes.iterator()}

    def _clear(self, held: dict[int, int], watermark_ms: int) -> None:
        """Forget minutes that no open minute can look back to."""
        for m in list(held):
            if (m + LOOKBACK_MIN + 1) * MINUTE_MS <= watermark_ms:
                self.minutes.removeKey((m,))
                del held[m]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        new: dict[int, int] = {}
        for frame in rows:
            frame = frame[(frame["minute"] + 1) * MINUTE_MS > watermark]
            for m, n in frame.groupby("minute")["n"].sum().items():
                new[int(m)] = new.get(int(m), 0) + int(n)
        held = self._held()
        for m, n in new.items():
            held[m] = held.get(m, 0) + n
            self.minutes.updateValue((m,), (held[m],))
        if new:  # by then all minutes held have run out
            self.handle.registerTimer((max(new) + LOOKBACK_MIN + 1) * MINUTE_MS)
        yield changed_spikes(key[0], held, sorted(new))
        self._clear(held, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._clear(self._held(), timerValues.getCurrentWatermarkInMs())
        yield changed_spikes(key[0], {}, [])

    def close(self) -> None:
        pass


def changed_spikes(lang: str, held: dict[int, int], changed: list[int]) -> pd.DataFrame:
    """Spike rows of the held minutes whose count or hour before holds a changed minute."""
    minute = np.array(sorted(held), np.int64)
    posts = np.array([held[m] for m in minute.tolist()], np.int64)
    sums = np.append(0, np.cumsum(posts))
    lo, here = np.searchsorted(minute, minute - LOOKBACK_MIN), np.arange(len(minute))
    total, count = sums[here] - sums[lo], here - lo
    moved = np.searchsorted(np.array(changed, np.int64), minute, "right") > \
        np.searchsorted(np.array(changed, np.int64), minute - LOOKBACK_MIN)
    out = (count > 0) & moved
    mean = total[out] / np.maximum(count[out], 1)
    name = pd.Series([lang] * int(out.sum()), dtype=object)
    return pd.DataFrame({"lang": name, "minute": minute[out], "posts_in_minute": posts[out],
                         "rolling_hr_avg": mean, "is_spiking": posts[out] > C.SPIKE_FACTOR * mean})


def spike_stream(events: DataFrame) -> DataFrame:
    """minute_bucket, lang, posts_in_minute, rolling_hr_avg, is_spiking on update, from watermarked events."""
    minutes = (events.filter(C.is_create_post_any_kind() & F.col("event_time").isNotNull())
               .select(C.primary_lang("commit.record.langs").alias("lang"),
                       C.floor_div(F.unix_seconds("event_time"), 60).alias("minute")))
    counts = minutes.mapInArrow(count_batches, "lang string, minute long, n long")
    rows = counts.groupBy("lang").transformWithStateInPandas(TrailingHour(), SPIKES, "Update", "EventTime")
    return rows.select(F.timestamp_seconds(F.col("minute") * 60).alias("minute_bucket"), "lang", "posts_in_minute",
                       "rolling_hr_avg", "is_spiking")
