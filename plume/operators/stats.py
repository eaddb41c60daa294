"""Ingest statistics: events, payload bytes, events per second, MB.

Batch: one aggregate.  Stream: ``observe_ingest`` attaches the same metrics
with ``DataFrame.observe``; they are reported per micro-batch through
``StreamingQuery.lastProgress['observedMetrics']`` or a listener.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MB = 1024 * 1024


def ingest_stats(landed: DataFrame, value_col: str = "value") -> DataFrame:
    """events, bytes (UTF-8 payload size), events/s over the event-time span,
    and MB."""
    n = F.count(F.lit(1))
    b = F.sum(F.octet_length(F.col(value_col))).cast("long")
    span_s = (F.max("time_us") - F.min("time_us")) / F.lit(1_000_000.0)
    return landed.agg(n.alias("events"), b.alias("bytes"),
                      F.when(span_s > 0, n / span_s).alias("events_per_sec"),
                      (b / F.lit(float(MB))).alias("mb"))


def observe_ingest(stream: DataFrame, name: str = "ingest", value_col: str = "value") -> DataFrame:
    return stream.observe(name, F.count(F.lit(1)).alias("events"),
                          F.sum(F.octet_length(F.col(value_col))).alias("bytes"))


class IngestListener:
    """Running ingest totals across micro-batches (the ingestor's periodic
    "events | events/s | MB" line), fed by the metrics that ``observe_ingest``
    attaches to a streaming query.  Register with
    ``spark.streams.addListener(IngestListener().listener)``.
    """

    def __init__(self, name: str = "ingest", log_every: int = 0):
        from pyspark.sql.streaming import StreamingQueryListener

        self.name = name
        self.log_every = log_every
        self.events = 0
        self.bytes = 0
        self.seconds = 0.0
        outer = self

        class _Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                outer._add(event.progress)

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        self.listener = _Listener()

    def _add(self, progress) -> None:
        metrics = progress.observedMetrics.get(self.name) if progress.observedMetrics else None
        if metrics is None:
            return
        before = self.events
        self.events += int(metrics["events"] or 0)
        self.bytes += int(metrics["bytes"] or 0)
        self.seconds += (progress.batchDuration or 0) / 1000.0
        if self.log_every and self.events // self.log_every > before // self.log_every:
            print(self.line())

    def totals(self) -> dict:
        rate = self.events / self.seconds if self.seconds else None
        return {"events": self.events, "bytes": self.bytes, "events_per_sec": rate,
                "mb": self.bytes / MB}

    def line(self) -> str:
        t = self.totals()
        rate = f"{t['events_per_sec']:.1f}" if t["events_per_sec"] else "-"
        return f"Processed {t['events']} events | {rate} events/sec | {t['mb']:.2f} MB total"
