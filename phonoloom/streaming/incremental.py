"""Structured Streaming counterparts: following a growing input, gap windows with state, and batch assignment."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.joins import first_wins
from ..operators.ordered import ranged_sum


def follow(spark: SparkSession, source: str, schema: str, key: str, sink: str, checkpoint: str, work=lambda df: df):
    """J1, J10. Processes what has come into ``source`` (a folder of Parquet files) and isn't done yet; returns the finished query.

    New files come from the checkpoint's log, repeated keys are met by an anti-join with the sink,
    and a batch that is run again after a failure adds nothing twice.
    """

    def batch(df: DataFrame, number: int) -> None:
        new = first_wins(df, [key], [c for c in df.columns if c != key]) if len(df.columns) > 1 else df.distinct()
        try:
            new = new.join(spark.read.parquet(sink).select(key), key, "left_anti")
        except AnalysisException as e:  # no sink before the first batch
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        work(new).write.mode("append").parquet(sink)

    q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def streamed_gap_windows(stream: DataFrame, max_gap_ms: int = 6000, late: str = "10 seconds") -> DataFrame:
    """F1 over a stream of (sid, at timestamp, s, e): windows are emitted once the watermark passes their end plus the gap.

    The state of a recording is one (start, end, number) per open window: rows are merged into windows as
    they come, in any order, so a window that never closes is one entry however many rows it has.
    """
    out, state = "sid string, win_start long, win_end long, n_seg long", "open array<struct<s:bigint,e:bigint,n:bigint>>"

    def run(key: tuple, batches: Iterator[pd.DataFrame], st: GroupState) -> Iterator[pd.DataFrame]:
        held = [tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in (st.get[0] if st.exists else [])]
        for b in batches:
            held += [(s, e, 1) for s, e in zip(b["s"].tolist(), b["e"].tolist())]
        held.sort()
        mark = st.getCurrentWatermarkMs()
        merged: list[list[int]] = []
        for s, e, n in held:
            if merged and s - merged[-1][1] <= max_gap_ms:
                merged[-1] = [merged[-1][0], max(merged[-1][1], e), merged[-1][2] + n]
            else:
                merged.append([s, e, n])
        due = lambda w: w[1] + max_gap_ms < mark or st.hasTimedOut and w[1] + max_gap_ms <= mark
        closed, keep = [(key[0], *w) for w in merged if due(w)], [w for w in merged if not due(w)]
        if keep:
            st.update(([{"s": s, "e": e, "n": n} for s, e, n in keep],))
            st.setTimeoutTimestamp(max(min(w[1] for w in keep) + max_gap_ms + 1, mark + 1))  # the first window to close
        elif st.exists:
            st.remove()
        yield pd.DataFrame(closed, columns=["sid", "win_start", "win_end", "n_seg"])

    return stream.withWatermark("at", late).groupBy("sid").applyInPandasWithState(run, out, state, "append", GroupStateTimeout.EventTimeTimeout)


def assigned_batches(units: DataFrame, order: str, size: str, limit: int) -> DataFrame:
    """J4. Batch number of each unit (an archive a row): a batch is closed once it holds ``limit``, by the running size before the unit.

    The running size is taken over ranges of ``order``, so the table of units is never one task.
    """
    return ranged_sum(units, order, size, "__before").withColumn("batch", F.floor(F.col("__before") / F.lit(limit)).cast("long")).drop("__before")


def live_keys(beats: DataFrame, now: float, lease: float = 1800.0) -> DataFrame:
    """J5. Keys whose last heartbeat is younger than the lease: key, owner, ts."""
    last = beats.groupBy("key").agg(F.max_by("owner", F.struct("ts", "owner")).alias("owner"), F.max("ts").alias("ts"))
    return last.where(F.lit(now) - F.col("ts") < lease)
