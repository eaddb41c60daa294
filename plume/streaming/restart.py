"""Restart check (the exactly-once harness, re-aimed at Spark).

Markers and posts are streamed into the append-only posts sink; the query is
stopped while it still has input to read, then restarted on the same
checkpoint; finally the landed table is reconciled against the expected ids.
``land_with_kill`` is the hard form: the writing process is killed in mid-batch.
With exactly-once delivery the report says PASS (no duplicate, no missing).
"""

from __future__ import annotations

import json
import os
import signal
import subprocess
import sys
import tempfile
import time
from typing import IO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import readers as RD
from .views import event_stream, start_posts_flat


def _run_until_progress(q: StreamingQuery, batches: int, timeout_s: float,
                        idle_s: float = 5.0) -> None:
    """Wait until ``q`` has run ``batches`` micro-batches with data, or has
    had no new data for ``idle_s`` seconds (input drained), or timed out."""
    start = time.time()
    last_seen, last_change = 0, start
    while time.time() < start + timeout_s and q.isActive:
        done = len([p for p in q.recentProgress if p.get("numInputRows", 0) > 0])
        if done >= batches:
            return
        if done != last_seen:
            last_seen, last_change = done, time.time()
        elif time.time() - last_change > idle_s:
            return
        time.sleep(0.2)


def land_with_restart(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str,
                      files_per_batch: int = 1, stop_after_batches: int = 1,
                      timeout_s: float = 300.0, stops: int = 1,
                      stopped: list[dict] | None = None) -> DataFrame:
    """Land posts_flat from ``source_dir`` with ``stops`` mid-stream stops.

    Each round runs a processing-time trigger reading ``files_per_batch``
    files per batch and is stopped after ``stop_after_batches`` more batches
    with data (the stop interrupts whatever batch is running); the next round
    restarts on the same checkpoint.  A final ``availableNow`` run drains the
    rest.  Returns the landed table read through the sink's commit log.

    ``stopped`` gets one entry per mid-stream stop: the last batch reported,
    the files read so far and the files left.  A stop with no file left does
    not count.
    """
    files = spark.read.text(source_dir).select(F.input_file_name().alias("f")).distinct().count()
    read = 0
    def stream():
        return event_stream(RD.read_raw_stream(spark, fmt="files", path=source_dir,
                                               max_files_per_trigger=files_per_batch))

    for _ in range(stops):
        q = start_posts_flat(stream(), out_path, checkpoint, trigger="0 seconds")
        try:
            _run_until_progress(q, stop_after_batches, timeout_s)
        finally:
            q.stop()
        done = [p for p in q.recentProgress if p.get("numInputRows", 0) > 0]
        read += files_per_batch * len(done)
        stop = {"batch": done[-1]["batchId"] if done else None, "files_read": read, "files_left": files - read}
        if stopped is not None and stop["files_left"] > 0:
            stopped.append(stop)
    q2 = start_posts_flat(stream(), out_path, checkpoint, trigger="availableNow")
    q2.awaitTermination(timeout_s)
    if q2.isActive:
        q2.stop()
        raise TimeoutError("restart run did not drain its input")
    return RD.scan_posts(spark, out_path)


def part_files(spark: SparkSession, folder: str) -> set[str]:
    """Names of the data files in a folder, committed or not, on any file system Spark reads."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return set()
    return {f.getPath().getName() for f in system.listStatus(path) if f.getPath().getName().startswith("part-")}


def committed_files(spark: SparkSession, folder: str) -> set[str]:
    """Names of the data files that the sink's commit log holds."""
    jvm = spark._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{folder}/_spark_metadata")
    if not log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log):
        return set()
    return {f.rsplit("/", 1)[1] for f in RD.scan_posts(spark, folder).inputFiles()}


#: Settings of a session without which another process may not reach the same folders, or this host.
SHARED_CONF = ("spark.hadoop.", "spark.jars", "spark.driver.host", "spark.driver.bindAddress", "spark.local.dir",
               "spark.sql.warehouse.dir")


def _child(source_dir: str, out_path: str, checkpoint: str, files_per_batch: int, conf: dict[str, str]) -> None:
    """The process that gets killed: land posts until then."""
    from ..session import build_session
    spark = build_session("local[2]", app="plume-killed", shuffle_partitions=2, extra=conf)
    events = event_stream(RD.read_raw_stream(spark, fmt="files", path=source_dir, max_files_per_trigger=files_per_batch))
    start_posts_flat(events, out_path, checkpoint, trigger="0 seconds").awaitTermination()


def _start_child(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str, files_per_batch: int,
                 log: IO[bytes]) -> subprocess.Popen:
    """Start the landing process with this one's modules and the session's access to files, in a process group of its own."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")}  # a JVM of its own
    env["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([root, *filter(None, sys.path), *filter(
        None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
    conf = {k: v for k, v in spark.sparkContext.getConf().getAll() if k.startswith(SHARED_CONF)}
    return subprocess.Popen([sys.executable, "-m", "plume.streaming.restart", source_dir, out_path, checkpoint,
                             str(files_per_batch), json.dumps(conf)], env=env, start_new_session=True,
                            stdin=subprocess.DEVNULL, stdout=log, stderr=subprocess.STDOUT)


def _kill(child: subprocess.Popen) -> None:
    """Kill the process group without notice, also if its first process has ended by itself."""
    try:
        os.killpg(child.pid, signal.SIGKILL)
    except ProcessLookupError:
        pass
    child.wait()


def land_with_kill(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str, files_per_batch: int = 8,
                   kills: int = 5, timeout_s: float = 300.0) -> tuple[DataFrame, int]:
    """Land posts_flat with the writing driver killed in mid-batch, then drain the rest on its checkpoint.

    Another process (driver, JVM and tasks) lands the posts; once files of a
    batch stand in the folder that its commit log does not have yet, the whole
    process group is killed without notice.  A kill that came after the commit is
    repeated with a new process, ``kills`` times at most; so is a process that
    ended by itself, and if the last one did, its last words are the error.
    Returns the landed table and the number of files that dead attempts left: the
    commit log passes over them, and the restarted query writes the batch again.
    """
    for attempt in range(1, kills + 1):
        with tempfile.TemporaryFile() as log:
            child = _start_child(spark, source_dir, out_path, checkpoint, files_per_batch, log)
            ended = False
            try:
                deadline = time.time() + timeout_s
                # the file system's names first, the log after: a file that is in neither is not yet written
                while not (part_files(spark, out_path) - committed_files(spark, out_path)):
                    ended = child.poll() is not None
                    if ended or time.time() > deadline:
                        break
                    time.sleep(0.02)
            finally:
                _kill(child)
            left = part_files(spark, out_path) - committed_files(spark, out_path)
            if left:
                break
            if time.time() > deadline or (ended and attempt == kills):
                log.seek(0, os.SEEK_END)
                log.seek(max(0, log.tell() - 2000))
                raise RuntimeError("the landing process ended or wrote nothing before it could be killed: "
                                   + log.read().decode(errors="replace"))
    q = start_posts_flat(event_stream(RD.read_raw_stream(spark, fmt="files", path=source_dir)), out_path, checkpoint,
                         trigger="availableNow")
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("restart run did not drain its input")
    return RD.scan_posts(spark, out_path), len(left)


def exactly_once_run(spark: SparkSession, n: int, files: int = 40, stop_after_batches: int = 2,
                     timeout_s: float = 600.0, stops: int = 3) -> DataFrame:
    """The reference's end-to-end check at its own scale: n marker events are
    delivered to the source folder as ``files`` JSON-lines files, landed with
    ``stops`` mid-stream stops and restarts (three faults by default, as in
    the published run), and reconciled against the delivered ids.  Returns
    the one-row report (PASS iff no duplicate and no missing) with the
    measured number of mid-stream stops.
    """
    from ..operators import reconcile as X
    from ..session import scratch_path

    markers = X.make_markers(spark, n)
    src = scratch_path(spark, "markers-src")
    (markers.select(F.to_json(F.struct(*markers.columns)).alias("value"), "time_us")
            .repartitionByRange(files, "time_us").sortWithinPartitions("time_us")
            .select("value").write.mode("overwrite").text(src))
    delivered = X.expected_from_landed(
        RD.decode_events(spark.read.text(src)).select("did"))
    stopped: list[dict] = []
    landed = land_with_restart(spark, src, scratch_path(spark, "markers-landed"),
                               scratch_path(spark, "markers-ckpt"), files_per_batch=1,
                               stop_after_batches=stop_after_batches, timeout_s=timeout_s,
                               stops=stops, stopped=stopped)
    report = X.reconcile_report(X.reconcile(delivered, X.marker_counts(landed)))
    return report.withColumn("stops", F.lit(len(stopped)))


if __name__ == "__main__":
    _child(*sys.argv[1:4], int(sys.argv[4]), json.loads(sys.argv[5]))
