"""An editable store of cases: Parquet tables of cases, sessions, series and parameters under one folder.

A table is a list of layers: rows that were trained, patches (whole rows of edited cases) and keys of cases that were taken out. An edit
writes one layer in proportion to what it changes and then the version that names all layers, so a reader sees one version and a failed edit leaves none behind. Readers
merge the layers; `compact` makes one of them, by itself once there are `most_layers`. Versions have running numbers; `clear` deletes layers of old ones.
Every case has `_session` and `_idx`, its place in the order of training; the pair is its identity.
"""

from __future__ import annotations

import json
import time
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators.condition import compile_condition
from ..operators.knn import Metric, knn, metric_of
from ..operators.react import influence
from ..operators.validate import check
from ..plans.storage import written

KEY = ["_session", "_idx"]
_VERSION = "number bigint, at double, layers array<struct<kind: string, folder: string>>, next bigint"


class Version(NamedTuple):
    number: int
    layers: list[tuple[str, str]]  # (rows, patch or gone; folder)
    next: int | None  # number of the next case, where known


def identified(df: DataFrame) -> DataFrame:
    """`df` with `id`, a string made of both parts of the identity, in the order of training."""
    return df.withColumn("id", F.format_string("%020d %s", "_idx", "_session"))


def running_index(df: DataFrame, start: int, order: list[Column] | None = None) -> DataFrame:
    """`df` with `_idx` from `start` on, in the order of its rows' partitions or in `order`, by prefix sums of partition sizes."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df = df.withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id())
    if order:  # the ranges are drawn once
        df = written(df, "store-order")
    sizes = df.groupBy("__p").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row per partition
    starts = sizes.select("__p", before.alias("__before"))
    inside = F.row_number().over(W.partitionBy("__p").orderBy("__m"))
    return df.withColumn("__i", inside).join(starts, "__p").withColumn("_idx", F.col("__before") + F.col("__i") - 1 + start).drop("__p", "__m", "__i", "__before")


class CaseStore:
    """Cases under `path`, a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str, most_layers: int = 200):
        self.spark, self.path, self.most_layers = spark, path.rstrip("/"), most_layers

    # --- tables: layers of Parquet folders; a version names its layers

    def _current(self, table: str) -> Version | None:
        try:
            rows = self.spark.read.schema(_VERSION).json(f"{self.path}/{table}/versions").orderBy(F.desc("number"), F.desc("at")).limit(1).collect()
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        return Version(rows[0].number, [tuple(x) for x in rows[0].layers], rows[0].next) if rows else None

    def _commit(self, table: str, df: DataFrame, kind: str, replace: bool = False, next: int | None = None) -> str:
        """Write `df` as the next layer and then name the version that has it; returns the layer's folder."""
        old = self._current(table)
        number, folder = (old.number if old else 0) + 1, uuid.uuid4().hex
        df.withColumn("_layer", F.lit(number).cast("bigint")).write.parquet(f"{self.path}/{table}/{folder}")
        layers = [*([] if replace or not old else old.layers), (kind, folder)]
        next = old.next if next is None and old and not replace else next
        self.spark.createDataFrame([(number, time.time(), layers, next)], _VERSION).coalesce(1).write.mode("append").json(f"{self.path}/{table}/versions")
        if len(layers) > self.most_layers:
            self.compact(table)
        return f"{self.path}/{table}/{folder}"

    def _replace(self, table: str, df: DataFrame) -> None:
        self._commit(table, df, "rows", replace=True)

    def _append(self, table: str, df: DataFrame, next: int | None = None) -> str:
        return self._commit(table, df, "rows", next=next)

    def _read(self, table: str) -> DataFrame | None:
        """Rows and patches of all layers, without those that a later patch replaces or a later layer takes out."""
        now = self._current(table)
        if now is None:
            return None
        at = {kind: [f"{self.path}/{table}/{folder}" for k, folder in now.layers if k == kind] for kind in ("rows", "patch", "gone")}
        df = self.spark.read.option("mergeSchema", True).parquet(*at["rows"], *at["patch"])
        if at["patch"] or at["gone"]:
            changed = self.spark.read.parquet(*at["patch"], *at["gone"]).select(*(F.col(c).alias("__" + c) for c in KEY), F.col("_layer").alias("__layer"))
            changed = changed.groupBy(*("__" + c for c in KEY)).agg(F.max("__layer").alias("__layer"))
            same = [F.col(c) == F.col("__" + c) for c in KEY]
            df = df.join(changed, [*same, F.col("__layer") > F.col("_layer")], "left_anti")
        return df.drop("_layer")

    def _patch(self, rows: DataFrame) -> int:
        """New values of some cases, whole rows; returns their number."""
        return self.spark.read.parquet(self._commit("cases", rows, "patch")).count()

    def _take_out(self, keys: DataFrame) -> int:
        return self.spark.read.parquet(self._commit("cases", keys.select(*KEY).distinct(), "gone")).count()

    def compact(self, table: str = "cases") -> None:
        """One layer in place of many, with the same rows."""
        now = self._current(table)
        if now and len(now.layers) > 1:
            self._commit(table, self._read(table), "rows", replace=True, next=now.next)

    def clear(self, table: str = "cases") -> int:
        """Delete the layers that the current version does not name; returns their number. Not while others read or write older versions."""
        now = self._current(table)
        held = {folder for _, folder in now.layers} if now else set()
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        old = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName() not in held | {"versions"}]
        for path in old:
            fs.delete(path, True)
        return len(old)

    def cases(self) -> DataFrame:
        df = self._read("cases")
        if df is None:
            raise ValueError("nothing was trained")
        return df

    # --- sessions

    def begin_session(self, name: str, metadata: dict | None = None) -> str:
        row = (uuid.uuid4().hex, name, json.dumps(metadata or {}), time.time())
        self._append("sessions", self.spark.createDataFrame([row], "session string, name string, metadata string, created double"))
        return row[0]

    def query_sessions(self, text: str = "") -> DataFrame:
        df = self._read("sessions")
        return df.where(F.contains(F.lower("name"), F.lit(text.lower()))).orderBy(F.desc("created"))

    def update_session(self, session: str, metadata: dict) -> None:
        df = self._read("sessions")
        self._replace("sessions", df.withColumn("metadata", F.when(F.col("session") == session, F.lit(json.dumps(metadata))).otherwise(F.col("metadata"))))

    def delete_session(self, session: str) -> None:
        self._take_out(self.cases().where(F.col("_session") == session))

    def has_session(self, session: str) -> bool:
        df = self._read("cases")
        return df is not None and not df.where(F.col("_session") == session).isEmpty()

    def sessions(self) -> DataFrame:
        return self.cases().groupBy("_session").agg(F.count("*").alias("n"), F.min("_idx").alias("first"), F.max("_idx").alias("last"))

    def session_indices(self, session: str) -> DataFrame:
        return self.cases().where(F.col("_session") == session).select("_idx").orderBy("_idx")

    # --- training and reading

    def count(self) -> int:
        df = self._read("cases")
        return 0 if df is None else df.count()

    def train(self, df: DataFrame, session: str = "default", *, profile=None, derived: list[tuple[str, str]] = (), series: str | None = None, order: list[str] = ()) -> int:
        """Append cases, numbered in `order` if given; returns their number. `profile`: they are checked first. `derived`: (name, SQL expression) in order.
        `series`: rows of this staged series get the one case's values."""
        if profile:
            check(df, profile)
        if series:
            staged = self.series(series)
            df = staged.join(df.drop(*(c for c in df.columns if c in staged.columns)), F.lit(True)) if df.limit(2).count() == 1 else running_index(staged, 0).join(running_index(df, 0), "_idx").drop("_idx")
        for name, expression in derived:
            df = df.withColumn(name, F.expr(expression))
        now = self._current("cases")
        if now is None or now.next is None:
            last = None if now is None else self.cases().agg(F.max("_idx")).first()[0]
            start = 0 if last is None else last + 1
        else:
            start = now.next
        new = written(running_index(df, start, [F.col(c) for c in order]).withColumn("_session", F.lit(session)), "store-new")
        n = new.count()
        self._append("cases", new, next=start + n)
        return n

    def train_weights(self, df: DataFrame, features: list[str], k: int = 10, weight: str = "_case_weight") -> None:
        """Absorb new cases: each gives its weight to its neighbours by their influence; no case is added."""
        cases = identified(self.cases())
        asked = df.withColumn("id", F.format_string("new %020d", F.monotonically_increasing_id()))
        self._replace("cases", distribute(cases, asked, metric_of(cases, features), k, weight).drop("id"))

    def get(self, features: list[str] | None = None, *, session: str | None = None, indices: list[tuple[str, int]] | None = None, condition: dict | None = None, sort_by: list[tuple[str, bool]] = (), imputed: bool = False) -> DataFrame:
        """Cases by indices, else by session, else by condition. `sort_by`: (feature, ascending)."""
        df = self.cases()
        if indices is not None:
            df = df.join(F.broadcast(self.spark.createDataFrame(indices, "_session string, _idx bigint")), KEY, "left_semi")
        elif session is not None:
            df = df.where(F.col("_session") == session)
        else:
            df = df.where(compile_condition(condition))
        if sort_by:
            df = df.orderBy(*(F.col(f).asc() if up else F.col(f).desc() for f, up in sort_by))
        marks = [c for c in ("_imputed",) if imputed and c in df.columns]
        return df.select(*(features or [c for c in df.columns if not c.startswith("_")]), *KEY, *marks)

    def similar(self, condition: dict, k: int = 10, features: list[str] | None = None) -> DataFrame:
        """The k cases that come closest to the values of the condition (middles of ranges)."""
        cases = identified(self.cases())
        point = {f: (sum(v) / 2 if isinstance(v, (list, tuple)) else v) for f, v in condition.items()}
        q = self.spark.createDataFrame([("asked", *point.values())], ["id", *point]).select("id", *(F.col(f).cast(dict(cases.dtypes)[f]).alias(f) for f in point))
        near = knn(q, cases, metric_of(cases, list(point)), k)
        return cases.join(near.select(F.col("case_id").alias("id"), "distance", "rank"), "id").drop("id").select(*(features or [c for c in cases.columns if not c.startswith("_") and c != "id"]), *KEY, "distance", "rank")

    def extreme(self, feature: str, n: int) -> DataFrame:
        """The n cases with the highest values, or with the lowest for a negative n."""
        order = F.col(feature).desc() if n > 0 else F.col(feature).asc()
        return self.cases().where(F.col(feature).isNotNull()).orderBy(order, *KEY).limit(abs(n))

    # --- edits

    def _chosen(self, condition: dict | None, indices: list[tuple[str, int]] | None, session: str | None, limit: int | None, precision: str = "exact", k: int = 10) -> DataFrame:
        """Keys of the cases that an edit means: indices go before session, session before condition."""
        df = self.cases()
        if limit is not None and limit < 1:
            raise ValueError("at least one case")
        if indices is not None:
            return self.spark.createDataFrame(indices, "_session string, _idx bigint")
        if session is not None:
            df = df.where(F.col("_session") == session)
        elif precision == "similar":
            return self.similar(condition, limit or k).select(*KEY)
        else:
            df = df.where(compile_condition(condition))
        df = df.select(*KEY)
        return df if limit is None else df.orderBy(*KEY).limit(limit)

    def remove(self, condition: dict | None = None, *, indices=None, session=None, limit=None, precision="exact", distribute_features: list[str] | None = None, k: int = 10) -> int:
        """Remove cases and return their number; with `distribute_features` their weight goes to their neighbours that stay."""
        cases = self.cases()
        gone = written(cases.join(self._chosen(condition, indices, session, limit, precision), KEY, "left_semi"), "store-gone")
        if not distribute_features:
            return self._take_out(gone)
        rest = distribute(identified(cases.join(gone.select(*KEY), KEY, "left_anti")), identified(gone), metric_of(cases, distribute_features), k, "_case_weight")
        self._replace("cases", rest.drop("id"))
        return gone.count()

    def move(self, target: CaseStore, condition: dict | None = None, **which) -> int:
        gone = self._chosen(condition, which.get("indices"), which.get("session"), which.get("limit"), which.get("precision", "exact"))
        moved = written(self.cases().join(gone, KEY, "left_semi"), "store-moved")
        target._take_in(moved)
        return self._take_out(moved)

    def edit(self, values: dict, condition: dict | None = None, **which) -> int:
        """Set features where the condition holds; returns the number of cases."""
        cases = self.cases()
        chosen = self._chosen(condition, which.get("indices"), which.get("session"), which.get("limit"), which.get("precision", "exact"))
        kinds = dict(cases.dtypes)
        hit = cases.join(chosen, KEY, "left_semi")
        return self._patch(hit.select(*(F.lit(values[c]).cast(kinds[c]).alias(c) if c in values else F.col(c) for c in cases.columns)))

    def add_feature(self, name: str, value=None, *, values: DataFrame | None = None, condition: dict | None = None, overwrite: bool = False) -> None:
        """A feature with one value, or with `values` (_session, _idx, value), where the condition holds; null elsewhere."""
        cases = self.cases()
        if name in cases.columns and not overwrite and condition is None:
            raise ValueError(f"{name} exists")
        if values is not None:
            df = cases.drop(name).join(values.select(*KEY, F.col("value").alias(name)), KEY, "left")
        elif condition is None:
            df = cases.withColumn(name, F.lit(value))
        else:  # the others read it as null, or keep what they have
            hit = cases.where(compile_condition(condition))
            self._patch(hit.withColumn(name, F.lit(value).cast(dict(cases.dtypes)[name]) if name in cases.columns else F.lit(value)))
            return
        self._replace("cases", df)

    def remove_feature(self, name: str, condition: dict | None = None) -> None:
        cases = self.cases()
        if condition is None:
            self._replace("cases", cases.drop(name))
        else:
            self._patch(cases.where(compile_condition(condition)).withColumn(name, F.lit(None).cast(dict(cases.dtypes)[name])))

    def evaluate(self, expressions: dict[str, str], aggregate: dict[str, str] | None = None) -> DataFrame:
        """SQL expressions per case, and SQL aggregates over their results."""
        df = self.cases().select(*(F.expr(e).alias(n) for n, e in expressions.items()))
        return df.agg(*(F.expr(e).alias(n) for n, e in aggregate.items())) if aggregate else df

    # --- series, copies, profiles and parameters

    def append_series(self, series: str, df: DataFrame) -> None:
        df.withColumn("series", F.lit(series)).write.mode("append").partitionBy("series").parquet(f"{self.path}/series")

    def series(self, series: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/series").where(F.col("series") == series).drop("series")

    def remove_series(self, series: str) -> None:
        df = self.spark.read.parquet(f"{self.path}/series").where(F.col("series") == series)
        df.limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/series/series={series}")

    def copy(self, path: str) -> CaseStore:
        other = CaseStore(self.spark, path)
        for table in ("cases", "sessions", "params", "profile"):
            df = self._read(table)
            if df is not None:
                other._replace(table, df)
        return other

    def combine(self, *others: CaseStore) -> None:
        """Take in the cases of other stores; they keep their sessions, columns that one lacks are null. In a session that is here already they are numbered on."""
        for other in others:
            self._take_in(other.cases())

    def _take_in(self, df: DataFrame) -> None:
        """Append cases of another store."""
        new = written(self._fitted(df), "store-taken")
        now, most = self._current("cases"), new.agg(F.max("_idx")).first()[0]
        if most is not None:
            self._append("cases", new, next=max(most + 1, now.next) if now and now.next is not None else None if now else most + 1)

    def _fitted(self, df: DataFrame) -> DataFrame:
        """Cases of another store with numbers that go on after those of the same session here, so that session and number stay an identity."""
        here = self._read("cases")
        if here is None:
            return df
        after = here.groupBy("_session").agg((F.max("_idx") + 1).alias("__after"))  # a row per session
        return df.join(after, "_session", "left").withColumn("_idx", F.col("_idx") + F.coalesce("__after", F.lit(0))).drop("__after").select(*df.columns)

    def set_profile(self, profile: dict) -> None:
        rows = [(n, json.dumps(a.as_dict(), default=str)) for n, a in profile.items()]
        self._replace("profile", self.spark.createDataFrame(rows, "feature string, attributes string"))

    def profile(self) -> dict[str, dict]:
        df = self._read("profile")
        return {} if df is None else {r.feature: json.loads(r.attributes) for r in df.collect()}

    def set_params(self, target: str, contexts: list[str], params: dict, weight: str | None = None) -> None:
        row = (target, sorted(contexts), weight, json.dumps(params), time.time())
        self._append("params", self.spark.createDataFrame([row], "target string, contexts array<string>, weight string, params string, at double"))

    def params(self, target: str, contexts: list[str], weight: str | None = None, exactly: bool = False) -> dict | None:
        """The latest parameters that match best: target first, then contexts, then weight. `exactly`: of this target only."""
        df = self._read("params")
        if df is None:
            return None
        if exactly:
            df = df.where(F.col("target") == target)
        same = F.array_sort(F.col("contexts")) == F.array(*map(F.lit, sorted(contexts)))
        order = [F.desc(F.col("target") == target), F.desc(same), F.desc(F.col("weight").eqNullSafe(F.lit(weight))), F.desc("at")]
        row = df.orderBy(*order).limit(1).first()
        return json.loads(row.params) if row else None


def distribute(stay: DataFrame, go: DataFrame, metric: Metric, k: int, weight: str, id_column: str = "id") -> DataFrame:
    """`stay` with the weights of `go` added to their neighbours by influence: the total mass is kept."""
    mass = lambda df: df if weight in df.columns else df.withColumn(weight, F.lit(1.0))
    stay, go = mass(stay), mass(go)
    near = influence(knn(go, stay, metric, k, id_column=id_column))
    given = near.join(go.select(F.col(id_column).alias("query_id"), F.col(weight).alias("__w")), "query_id").groupBy("case_id").agg(F.sum(F.col("weight") * F.col("__w")).alias("__more"))
    out = stay.join(given.withColumnRenamed("case_id", id_column), id_column, "left")
    return out.withColumn(weight, F.col(weight) + F.coalesce("__more", F.lit(0.0))).drop("__more").select(*stay.columns)
