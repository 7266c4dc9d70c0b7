"""Streams: micro-batch training, a series store, and scoring of arriving rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.analyze import AutoAnalyze
from ..operators.knn import Metric
from ..operators.react import neighbours, predict_continuous, predict_nominal
from ..sources.store import CaseStore


def read_files(spark: SparkSession, path: str, schema, files_per_batch: int = 1, form: str = "parquet") -> DataFrame:
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def train(stream: DataFrame, store: CaseStore, checkpoint: str, *, status: str | None = None, analyze: AutoAnalyze | None = None, most: int | None = None, once: bool = True) -> StreamingQuery:
    """Append every micro-batch to the store, under a session that is named by the batch. A batch that is tried again replaces its own
    session first, so each row is trained once. A status row per batch (batch, n, total, needs_analyze, needs_data_reduction) goes to `status`."""
    state = {"analyze": analyze or AutoAnalyze()}

    def batch(df: DataFrame, number: int) -> None:
        session = f"batch-{number}"
        if store.has_session(session):
            store.delete_session(session)
        n = store.train(df, session)
        total = store.count()
        due = state["analyze"].due(total)
        if due:
            state["analyze"] = state["analyze"].done(total)
        if status:
            row = (number, n, total, due, most is not None and total > most)
            df.sparkSession.createDataFrame([row], "batch bigint, n bigint, total bigint, needs_analyze boolean, needs_data_reduction boolean").write.mode("append").parquet(status)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_series(stream: DataFrame, path: str, key: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Rows appended to the series store, a folder per series: exactly once by the file sink's log."""
    writer = stream.writeStream.format("parquet").partitionBy(key).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


#: Groups of keys whose open series share one state.
STATE_BUCKETS = 256


def follow_series(stream: DataFrame, key: str, time: str, gap: float, late: float, ends: str | None = None, buckets: int = STATE_BUCKETS) -> DataFrame:
    """Rows of `stream` with `started` (microseconds: with the key the identity of a series), `position` in it and `complete`; and a row with `complete`, the
    number of rows in `position` and no values for each series that has come to its end.

    A series of a key ends with `gap` seconds of event time without a row, or with a row for which `ends`, an SQL condition, holds; the next row starts another.
    The gap is seen by the next row of the key, or else by a timer once the watermark, `late` seconds behind the newest row, has passed it. The state of
    an open series is its key and four numbers; rows go through. Rows without a key or time are left out, rows later than the watermark too. Keys are dealt to
    `buckets`, each of which is called once a batch for all its keys; a checkpoint belongs to one number of them.
    """
    names = stream.columns
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    df = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    df = df.withColumn("__t", F.col(time).cast("timestamp")).withColumn("__us", micros).withColumn("__end", F.coalesce(F.expr(ends), F.lit(False)) if ends else F.lit(False))
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(buckets))).withWatermark("__t", f"{int(late * 1000)} milliseconds")
    gap_us = int(gap * 1_000_000)

    def step(own: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_series = {who: tuple(numbers) for who, *numbers in zip(*state.get, strict=True)} if state.exists else {}
        now, done, seen = state.getCurrentWatermarkMs(), [], set()
        if not state.hasTimedOut:
            rows = pd.concat(list(batches), ignore_index=True).sort_values("__us", kind="stable", ignore_index=True)
            begun, places = [], []
            for who, us, end in zip(rows[key].tolist(), rows["__us"].tolist(), rows["__end"].tolist(), strict=True):
                n, started, last, _ = open_series.pop(who, (0, None, None, None))
                if n and us - last > gap_us:
                    done.append((who, started, n))
                    n = 0
                if not n:
                    started, last = us, us
                begun.append(started)
                places.append(n)
                n, last = n + 1, max(last, us)
                if end:
                    done.append((who, started, n))
                else:
                    open_series[who] = n, started, last, max((last + gap_us) // 1000 + 1, now + 1)
                seen.add(who)
            yield rows[names].assign(started=begun, position=places, complete=False)
        for who in [who for who, (*_, due) in open_series.items() if due < now and who not in seen]:
            n, started, *_ = open_series.pop(who)
            done.append((who, started, n))
        if open_series:
            state.update(([*open_series], *map(list, zip(*open_series.values(), strict=True))))
            state.setTimeoutTimestamp(min(due for *_, due in open_series.values()))
        elif state.exists:
            state.remove()
        if done:
            whose, started, position = zip(*done, strict=True)
            yield pd.DataFrame({c: list(whose) if c == key else [None] * len(done) for c in names} | {"started": started, "position": position, "complete": True})

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema]).add("started", "long").add("position", "long").add("complete", "boolean")
    held = T.StructType([T.StructField("key", T.ArrayType(stream.schema[key].dataType)), *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("n", "started", "last", "due"))])
    return df.groupBy("__bucket").applyInPandasWithState(step, schema, held, "append", GroupStateTimeout.EventTimeTimeout)


def train_series(stream: DataFrame, store: CaseStore, key: str, time: str, checkpoint: str, staged: str, *, gap: float, late: float, ends: str | None = None, once: bool = True) -> StreamingQuery:
    """Train every series once, when it is complete (see `follow_series`); its rows carry `series_start` and `series_place`.

    Rows wait in the folder `staged`, a folder per micro-batch, so a series of any length needs no memory. A batch that is tried again overwrites its folder and replaces its
    session, so a restart from the checkpoint neither loses nor repeats a series.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        df.write.mode("overwrite").parquet(f"{staged}/part={number}")
        mine = spark.read.schema(df.schema).parquet(f"{staged}/part={number}")
        done = mine.where("complete").select(F.col(key).alias("__key"), F.col("started").alias("__started"))
        since = done.agg(F.min("__started")).first()[0]
        if since is None:
            return
        rows = spark.read.schema(df.schema).option("basePath", staged).parquet(f"{staged}/part=*").where(~F.col("complete") & (F.col("started") >= F.lit(since)))
        rows = rows.join(done, (F.col(key) == F.col("__key")) & (F.col("started") == F.col("__started"))).drop("__key", "__started", "complete", "part")
        session = f"series-{number}"
        if store.has_session(session):
            store.delete_session(session)
        store.train(rows.withColumnsRenamed({"started": "series_start", "position": "series_place"}), session, order=[key, "series_start", "series_place"])

    got = follow_series(stream, key, time, gap, late, ends)
    writer = got.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def score(stream: DataFrame, cases: DataFrame, metric: Metric, action: str, kind: str, sink: Callable[[DataFrame, int], None], checkpoint: str, *, k: int = 10, id_column: str = "id", once: bool = True) -> StreamingQuery:
    """Predictions of arriving rows from static cases, handed to `sink` per micro-batch."""

    def batch(df: DataFrame, number: int) -> None:
        near = neighbours(df, cases, metric, k, carry=[action], id_column=id_column)
        got = predict_continuous(near, action, name="predicted") if kind == "continuous" else predict_nominal(near, action, name="predicted")
        sink(got.withColumnRenamed("query_id", id_column), number)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def fanout(stream: DataFrame, incremental, checkpoint: str) -> StreamingQuery:
    """Functional dependencies over micro-batches; `incremental` (operators.fanout.Incremental) stops adding once they have converged."""
    done = {"it": False}

    def batch(df: DataFrame, number: int) -> None:
        if not done["it"]:
            done["it"] = incremental.add(df)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(stream: DataFrame, time: str, keys: list[str], value: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts, sums, least and largest values by event-time window; rows later than the watermark are dropped by its rule."""
    df = stream.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    return df.groupBy(F.window("__t", width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"))
