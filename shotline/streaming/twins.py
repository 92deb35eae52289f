"""Streaming forms of the incremental operators."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..errors import InputError
from ..sources.writers import exists


def files(spark: SparkSession, path: str, schema: str, per_batch: int = 10, form: str = "json") -> DataFrame:
    """New files of a folder, some in each micro-batch; the checkpoint remembers which were taken."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).format(form).load(path)


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", form: str = "parquet") -> None:
    """Process what is there and stop; a second call goes on where the first ended."""
    q = stream.writeStream.outputMode(mode).format(form).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def each_batch_once(stream: DataFrame, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Write each micro-batch to a folder of its number; one that is run again replaces its own folder only."""

    def write(df: DataFrame, number: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def sessions(stream: DataFrame, key: str, at: str, gap: str, late: str) -> DataFrame:
    """Runs of events whose gaps are shorter than ``gap``; events later than ``late`` are left out."""
    w = stream.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("n"))
    return w.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def keep_last(stream: DataFrame, key: str, order: str, vector: str, threshold: float = 0.9) -> DataFrame:
    """Rows less like the last kept row of their key than ``threshold``; the state is that row's vector.  Rows of a micro-batch are taken in order."""

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = np.array(state.get[0]) if state.exists else None
        rows = pd.concat(list(frames)).sort_values(order)
        kept = []
        for o, v in zip(rows[order], rows[vector], strict=True):
            v = np.asarray(v, np.float64)
            if last is None or float(np.dot(last, v)) < threshold:
                last = v
                kept.append(o)
        state.update((last.tolist(),))
        yield pd.DataFrame({key: [k[0]] * len(kept), order: kept})

    kind = lambda c: stream.schema[c].dataType.simpleString()
    out = f"{key} {kind(key)}, {order} {kind(order)}"
    return stream.select(key, order, vector).groupBy(key).applyInPandasWithState(run, out, "last array<double>", "append", GroupStateTimeout.NoTimeout)


def finished(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a stream has committed any batch."""
    return exists(spark, f"{checkpoint}/commits/[0-9]*")


def restarted(run: Callable[[], None], tries: int = 15, wait: float = 5.0) -> int:
    """Call ``run`` again after a failure, from where its checkpoint stands, ``tries`` times at most; gives the calls it took."""
    for n in range(1, tries + 1):
        try:
            run()
            return n
        except Exception:
            if n == tries:
                raise
            time.sleep(wait)
    raise InputError("at least one try")
