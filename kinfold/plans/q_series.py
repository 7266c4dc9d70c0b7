"""Queries of time series, the case store, streams, synthesis, reduction and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reduce as fewer
from ..operators import series, synth
from ..operators.influence import residuals
from ..operators.knn import metric_of
from ..operators.ml import CaseClassifier, CaseRegressor
from ..sources.store import CaseStore
from ..streaming import ingest
from .q_react import ALL, CONTEXTS, ID, PROBS, near, part, rounded, split, sql_near
from .storage import folder, written

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _events(spark, d):
    return spark.read.parquet(f"{d}/events.parquet")


def _place(spark, label: str) -> str:
    import uuid

    return f"{folder(spark)}/{label}-{uuid.uuid4().hex}"


STEP = "WITH e AS (SELECT *, epoch_us(ts) / 1e6 AS t FROM events), s AS (SELECT *, t - lag(t) OVER w AS dt, value - lag(value) OVER w AS d1 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), r AS (SELECT *, d1 / CASE WHEN dt <> 0 THEN dt WHEN dt IS NOT NULL THEN 0.001 END AS r1 FROM s), q AS (SELECT *, d1 - lag(d1) OVER w AS d2, (r1 - lag(r1) OVER w) / CASE WHEN dt <> 0 THEN dt WHEN dt IS NOT NULL THEN 0.001 END AS r2 FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) "


@query(STEP + "SELECT event_id, round(d1, 6) + 0.0 AS value_delta_1, round(r1, 6) + 0.0 AS value_rate_1, round(d2, 6) + 0.0 AS value_delta_2 FROM q")
def series_derivatives(spark, d):
    got = series.derive(_events(spark, d), ["user_id"], "ts", ["value"], 2, ["event_id"])
    return rounded(got.select("event_id", "value_delta_1", "value_rate_1", "value_delta_2"))


@query(STEP + ", b AS (SELECT 'value_delta_1' AS feature, min(d1) AS a, max(d1) AS b FROM q UNION ALL SELECT 'value_delta_2', min(d2), max(d2) FROM q) SELECT feature, round(CASE WHEN a >= 0 THEN greatest(0, b - w) ELSE b - w END, 4) AS low, round(CASE WHEN b <= 0 THEN least(0, a + w) ELSE a + w END, 4) AS high FROM (SELECT *, exp(ln(b - a) + 0.5) AS w FROM b)")
def series_bounds(spark, d):
    got = series.derived_bounds(_events(spark, d), ["user_id"], "ts", ["value"], 2)
    return spark.createDataFrame([(k, round(v[0], 4), round(v[1], 4)) for k, v in got.items() if k.startswith("value_delta")], "feature string, low double, high double")


@query("SELECT event_id, round(lag(value) OVER w, 6) AS value_lag_1, round(lag(value, 3) OVER w, 6) AS value_lag_3, lag(event_type) OVER w AS event_type_lag_1 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def series_lags(spark, d):
    got = series.lag_features(_events(spark, d), ["user_id"], "ts", {"value": [1, 3], "event_type": 1}, ["event_id"])
    return rounded(got.select("event_id", "value_lag_1", "value_lag_3", "event_type_lag_1"))


@query("SELECT 'user_id' AS feature UNION ALL SELECT 'parity' UNION ALL SELECT 'nothing'")
def series_invariants(spark, d):
    df = _events(spark, d).withColumn("parity", F.col("user_id") % 2).withColumn("nothing", F.lit(None).cast("string"))
    got = series.time_invariant(df, ["user_id"], ["user_id", "event_type", "value", "parity", "nothing"], "ts")
    return spark.createDataFrame([(x,) for x in got], "feature string")


@query("WITH e AS (SELECT *, epoch_us(ts) / 1e6 AS t FROM events), s AS (SELECT event_id, t, min(t) OVER (PARTITION BY user_id) AS a, max(t) OVER (PARTITION BY user_id) AS b FROM e) SELECT event_id, round(CASE WHEN a = b THEN 1.0 ELSE (t - a) / (b - a) END, 6) AS progress, t = b AS series_end FROM s")
def series_progress(spark, d):
    return rounded(series.progress(_events(spark, d), ["user_id"], "ts").select("event_id", "progress", "series_end"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) SELECT event_id, 4 - k AS step FROM r WHERE k <= 3")
def series_holdout(spark, d):
    return rounded(series.holdout(_events(spark, d), ["user_id"], "ts", 3, "event_id")[1].select("event_id", "step"))


@query()
def series_forecast(spark, d):
    df = _events(spark, d)
    history, _ = series.holdout(df, ["user_id"], "ts", 2, "event_id")
    learned = series.training_rows(history, ["user_id"], "ts", {"value": "continuous"}, 2, "event_id")
    m = metric_of(learned, ["value_lag_1", "value_lag_2"])
    got = series.forecast(history, ["user_id"], "ts", {"value": "continuous", "event_type": "nominal"}, m, 2, key="event_id", lags=2, k=10)
    return got.select("user_id", "step", F.round("value", 6).alias("value"), "event_type", "series_end")


FORECAST = """WITH h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k > 2),
l AS (SELECT event_id, user_id, value, lag(value) OVER w AS v1, lag(value, 2) OVER w AS v2 FROM h WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
c AS (SELECT * FROM l WHERE v2 IS NOT NULL),
s AS (SELECT user_id, max(value) FILTER (r = 1) AS v1, max(value) FILTER (r = 2) AS v2 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM h) WHERE r <= 2 GROUP BY 1),
d AS (SELECT s.user_id, c.event_id, abs(s.v1 - c.v1) + abs(s.v2 - c.v2) AS distance, c.value FROM s, c WHERE s.v2 IS NOT NULL),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY distance, event_id) AS rank FROM d) WHERE rank <= 10),
w AS (SELECT *, CASE WHEN min(distance) OVER (PARTITION BY user_id) = 0 THEN CASE WHEN distance = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / distance END AS raw FROM n)
SELECT user_id, round(sum(raw * value) / sum(raw), 6) AS value FROM w GROUP BY user_id"""


def _steps(behind: int, steps: int, on: str = "true", ends: str = "false") -> str:
    """SQL of forecasts by two lags from all rows but the last `behind` of each user; `on`: which rows (c) a series (s) may follow, `ends`: after which row it ends."""
    sql = f"""WITH h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k > {behind}),
l AS (SELECT event_id, user_id, value, lag(value) OVER w AS v1, lag(value, 2) OVER w AS v2 FROM h WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
c AS (SELECT * FROM l WHERE v1 IS NOT NULL AND v2 IS NOT NULL), r AS (SELECT max(v2) - min(v2) AS spread FROM c),
s1 AS (SELECT user_id, max(value) FILTER (r = 1) AS v1, max(value) FILTER (r = 2) AS v2 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM h) WHERE r <= 2 GROUP BY 1)"""
    for i in range(1, steps + 1):
        sql += f""",
d{i} AS (SELECT s.user_id, c.event_id, abs(s.v1 - c.v1) + coalesce(abs(s.v2 - c.v2), r.spread) AS distance, c.value FROM s{i} AS s JOIN c ON {on} CROSS JOIN r),
n{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY distance, event_id) AS rank FROM d{i}) WHERE rank <= 10),
w{i} AS (SELECT *, CASE WHEN min(distance) OVER (PARTITION BY user_id) = 0 THEN CASE WHEN distance = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / distance END AS raw FROM n{i}),
p{i} AS (SELECT s.user_id, s.v1, sum(raw * value) / sum(raw) AS value FROM s{i} AS s LEFT JOIN w{i} AS w ON w.user_id = s.user_id GROUP BY s.user_id, s.v1),
o{i} AS (SELECT user_id, {i} AS step, value, {i} = {steps} OR value IS NULL OR coalesce({ends}, false) AS series_end, v1 FROM p{i}),
s{i + 1} AS (SELECT user_id, value AS v1, v1 AS v2 FROM o{i} WHERE NOT series_end)"""
    return sql + " " + " UNION ALL ".join(f"SELECT user_id, step, round(value, 6) AS value, series_end FROM o{i}" for i in range(1, steps + 1))


def _continued(spark, d, behind: int, steps: int, **options):
    history, _ = series.holdout(_events(spark, d), ["user_id"], "ts", behind, "event_id")
    learned = series.training_rows(history, ["user_id"], "ts", {"value": "continuous"}, 2, "event_id")
    got = series.forecast(history, ["user_id"], "ts", {"value": "continuous"}, metric_of(learned, ["value_lag_1", "value_lag_2"]), steps, key="event_id", lags=2, k=10, **options)
    return rounded(got.select("user_id", "step", "value", "series_end"))


@query(_steps(60, 1, "c.user_id = s.user_id"))
def series_tracking_fixed(spark, d):
    """Each user followed by rows of its own, from histories without their last 60 rows: users with one or two rows left end without a value."""
    return _continued(spark, d, 60, 1, tracking="fixed")


@query(_steps(2, 2, ends="value >= 60 OR value <= 30"))
def series_stop_maps(spark, d):
    return _continued(spark, d, 2, 2, stop_maps={"value": {"min": 30.0, "max": 60.0}})


@query(FORECAST)
def series_forecast_step(spark, d):
    history, _ = series.holdout(_events(spark, d), ["user_id"], "ts", 2, "event_id")
    learned = series.training_rows(history, ["user_id"], "ts", {"value": "continuous"}, 2, "event_id")
    got = series.forecast(history, ["user_id"], "ts", {"value": "continuous"}, metric_of(learned, ["value_lag_1", "value_lag_2"]), 1, key="event_id", lags=2, k=10)
    return rounded(got.select("user_id", "value"))


@query()
def series_stationary(spark, d):
    df = _events(spark, d).withColumn("kind", F.when(F.col("user_id") % 3 == 0, "a").otherwise("b"))
    return rounded(series.stationary(df, ["user_id"], ["value"], "kind", df, 5))


# --- the store

EDITED = "(SELECT p_partkey, p_brand, p_size, CASE WHEN p_size BETWEEN 40 AND 45 THEN 0.0 ELSE p_retailprice END AS p_retailprice, CASE WHEN p_brand = 'Brand#11' THEN 'first' END AS mark FROM part WHERE NOT (p_size >= 48))"


@query(f"SELECT p_partkey, p_brand, CAST(p_size AS BIGINT) AS p_size, round(p_retailprice, 6) AS p_retailprice, mark FROM {EDITED}")
def store_edits(spark, d):
    store = CaseStore(spark, _place(spark, "store"))
    store.train(part(spark, d).select(ID, "p_brand", "p_size", "p_retailprice"), "first")
    store.remove({"p_size": [48, None]})
    store.edit({"p_retailprice": 0.0}, {"p_size": [40, 45]})
    store.add_feature("mark", "first", condition={"p_brand": ["Brand#11"]})
    return rounded(store.get([ID, "p_brand", "p_size", "p_retailprice", "mark"]).drop("_session", "_idx"))


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 20 AND 30 THEN CAST(7 AS BIGINT) WHEN p_size > 45 THEN CAST(9 AS BIGINT) ELSE CAST(p_size AS BIGINT) END AS p_size, CASE WHEN p_size BETWEEN 20 AND 30 THEN NULL ELSE round(p_retailprice, 6) END AS p_retailprice, CASE WHEN p_size < 5 THEN CAST(1.5 AS DOUBLE) END AS mark, CASE WHEN p_partkey % 2 = 1 AND p_size NOT IN (33, 34) THEN 'again' ELSE 'first' END AS session FROM part WHERE p_size NOT IN (33, 34) OR p_partkey % 2 = 1 AND p_size = 34")
def store_layers(spark, d):
    """Rows, patches and keys taken out in turn: edits of edited cases, cases taken out and moved back, a session trained anew after it was deleted."""
    store, other = (CaseStore(spark, _place(spark, "store")) for _ in range(2))
    df = part(spark, d).select(ID, "p_size", "p_retailprice")
    store.train(df.where(f"{ID} % 2 = 0"), "first")
    store.train(df.where(f"{ID} % 2 = 1"), "again")
    store.delete_session("again")
    store.train(df.where(f"{ID} % 2 = 1 AND p_size <> 34"), "again")
    store.remove({"p_size": [33, 34]})
    store.train(df.where(f"{ID} % 2 = 1 AND p_size = 34"), "first")
    store.edit({"p_size": 48}, {"p_size": [46, None]})
    store.move(other, {"p_size": [20, 30]})
    store.edit({"p_size": 9}, {"p_size": [48, 48]})
    store.add_feature("mark", 1.5, condition={"p_size": [None, 4]})
    other.edit({"p_size": 7, "p_retailprice": None}, {"p_size": [20, 30]})
    store.combine(other)
    return rounded(store.cases().select(ID, "p_size", "p_retailprice", "mark", F.col("_session").alias("session")))


@query("SELECT 'even' AS _session, count(*) FILTER (p_partkey % 2 = 0) AS n, CAST(0 AS BIGINT) AS first, count(*) FILTER (p_partkey % 2 = 0) - 1 AS last FROM part UNION ALL SELECT 'odd', count(*) FILTER (p_partkey % 2 = 1), count(*) FILTER (p_partkey % 2 = 0), count(*) - 1 FROM part")
def store_sessions(spark, d):
    store = CaseStore(spark, _place(spark, "store"))
    df = part(spark, d)
    store.train(df.where(f"{ID} % 2 = 0"), "even")
    store.train(df.where(f"{ID} % 2 = 1"), "odd")
    return store.sessions()


@query("SELECT p_partkey, round(p_retailprice, 6) AS p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")
def store_extremes(spark, d):
    store = CaseStore(spark, _place(spark, "store"))
    store.train(part(spark, d), "all", order=[ID])
    return rounded(store.extreme("p_retailprice", 10).select(ID, "p_retailprice"))


@query("SELECT CAST(sum(p_size) AS BIGINT) AS total, count(*) AS n FROM part WHERE p_type IN (SELECT min(p_type) FROM part)")
def store_evaluate(spark, d):
    store = CaseStore(spark, _place(spark, "store"))
    df = part(spark, d)
    first = df.agg(F.min("p_type")).first()[0]
    store.train(df, "all")
    kind = "'" + str(first).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return store.evaluate({"x": "p_size + 0", "kind": "p_type"}, {"total": f"sum(x) FILTER (WHERE kind = {kind})", "n": f"count(*) FILTER (WHERE kind = {kind})"})


# --- streams


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total, round(min(value), 6) AS low, round(max(value), 6) AS high FROM events GROUP BY 1, 2")
def stream_windows(spark, d):
    schema = _events(spark, d).schema
    out = _place(spark, "stream")
    stream = ingest.read_files(spark, f"{d}/events*.parquet", schema)
    got = ingest.windowed(stream, "ts", ["event_type"], "value", late="60 days")
    ingest_query = got.writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("append").parquet(out)).option("checkpointLocation", _place(spark, "stream-log")).trigger(availableNow=True).start()
    ingest_query.awaitTermination()
    return spark.read.parquet(out).select(F.date_format("window.start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"), F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS k FROM events")
def stream_training(spark, d):
    store = CaseStore(spark, _place(spark, "store"))
    stream = ingest.read_files(spark, f"{d}/events*.parquet", _events(spark, d).schema)
    ingest.train(stream, store, _place(spark, "stream-log")).awaitTermination()
    return store.cases().agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("k"))


_GAP, _LATE = 12 * 3600, 3600


@query(f"""WITH o AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS behind FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(CASE WHEN behind <= {_GAP * 1_000_000} THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM o),
x AS (SELECT user_id, s, epoch_us(min(ts)) AS series_start, count(*) AS n, round(sum(value), 6) AS total, epoch_us(max(ts)) AS last FROM g GROUP BY 1, 2)
SELECT user_id, series_start, n, total, n - 1 AS last_place FROM (SELECT *, max(s) OVER (PARTITION BY user_id) AS newest FROM x)
WHERE s < newest OR last + {_GAP * 1_000_000} < (SELECT epoch_us(max(ts)) - {_LATE * 1_000_000} FROM events)""")
def stream_series_training(spark, d):
    """Events arrive in six files of some days each; after the third the stream is stopped and goes on from its checkpoint. A user's series ends with half a day of silence."""
    df, path, log, staged = _events(spark, d), _place(spark, "stream-files"), _place(spark, "stream-log"), _place(spark, "stream-staged")
    store = CaseStore(spark, _place(spark, "store"))
    lo, hi = df.agg(F.min("ts"), F.max("ts")).first()
    part = F.least(F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(lo).cast("timestamp"))) * 6 / F.lit((hi - lo).total_seconds() * 1e6)), F.lit(5))
    for half in (range(3), range(3, 6)):
        for i in half:
            df.where(part == i).repartition(1).write.mode("append").parquet(path)
        stream = ingest.read_files(spark, path, df.schema)
        ingest.train_series(stream, store, "user_id", "ts", log, staged, gap=_GAP, late=_LATE).awaitTermination()
    got = store.cases().groupBy("user_id", "series_start").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"), F.max("series_place").alias("last_place"))
    return got.select("user_id", "series_start", "n", "total", "last_place")


@query(sql_near() + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS v FROM i GROUP BY 1) SELECT query_id AS p_partkey, round(v, 6) AS predicted FROM y")
def stream_scoring(spark, d):
    q, c = split(spark, d)
    out = _place(spark, "stream")
    stream = ingest.read_files(spark, f"{d}/part*.parquet", q.schema).where(f"{ID} % 50 = 0")
    ingest.score(stream, c, metric_of(c, CONTEXTS), "p_retailprice", "continuous", lambda df, n: df.write.mode("append").parquet(out), _place(spark, "stream-log"), id_column=ID).awaitTermination()
    return rounded(spark.read.parquet(out))


# --- reduction, imputation, synthesis


@query(ALL + ", e AS (SELECT query_id, round(-sum(CASE WHEN weight > 0 THEN weight * ln(weight) ELSE 0.0 END), 9) AS h FROM i GROUP BY 1) SELECT query_id AS p_partkey FROM e ORDER BY h, query_id LIMIT 500")
def reduced_cases(spark, d):
    df = part(spark, d)
    return fewer.reduce_cases(df, metric_of(df, CONTEXTS), 500, 10, id_column=ID).select(ID)


@query("SELECT count(*) AS n, least(count(*), 500) AS kept, CAST(count(*) AS DOUBLE) AS mass FROM part")
def reduced_mass(spark, d):
    df = part(spark, d)
    got = fewer.reduce_cases(df, metric_of(df, CONTEXTS), 500, 10, id_column=ID)
    total = df.agg(F.count("*").alias("n"))
    return total.crossJoin(got.agg(F.count("*").alias("kept"), F.sum("_case_weight").alias("m"))).select("n", "kept", F.round("m", 6).alias("mass"))


HOLES = "(SELECT p_partkey, p_size, p_type, p_brand, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS p_retailprice FROM part)"


@query(sql_near(queries="p_retailprice IS NULL", cases="p_retailprice IS NOT NULL", part=HOLES) + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS v FROM i GROUP BY 1) SELECT query_id AS p_partkey, round(v, 6) AS p_retailprice FROM y")
def imputed_values(spark, d):
    df = part(spark, d).withColumn("p_retailprice", F.when(F.col(ID) % 7 != 0, F.col("p_retailprice")))
    got = fewer.impute(df, {"p_retailprice": "continuous"}, CONTEXTS, 10, id_column=ID)
    return rounded(got.where(F.size("_imputed") > 0).select(ID, "p_retailprice"))


@query()
def generated_cases(spark, d):
    df = part(spark, d)
    m = metric_of(df, [*CONTEXTS, "p_retailprice"])
    kinds = {"p_size": "continuous", "p_retailprice": "continuous", "p_type": "nominal"}
    res = {r.feature: r.residual for r in residuals(df, m, {"p_size": "continuous", "p_retailprice": "continuous"}, id_column=ID).collect()}
    got = written(synth.generate(df, m, kinds, df.count(), residuals=res, id_column=ID, bounds={"p_size": (1, 50)}, decimals={"p_size": 0, "p_retailprice": 2}), "generated")
    return got.join(synth.privacy(got, df, m, 0.5, id_column=ID).select("id", "private"), "id")


@query("SELECT count(*) AS n, count(*) AS inside FROM part")
def generated_bounds(spark, d):
    df = part(spark, d)
    m = metric_of(df, ["p_size", "p_type"])
    got = synth.generate(df, m, {"p_size": "continuous", "p_type": "nominal"}, df.count(), residuals={"p_size": 5.0}, id_column=ID, bounds={"p_size": (1, 50)}, decimals={"p_size": 0})
    return got.agg(F.count("*").alias("n"), F.count_if((F.col("p_size") >= 1) & (F.col("p_size") <= 50) & F.col("p_type").isNotNull()).alias("inside"))


@query(sql_near(on="true") + PROBS + "SELECT query_id AS p_partkey, class AS prediction FROM best")
def classifier(spark, d):
    q, c = split(spark, d)
    model = CaseClassifier(CONTEXTS, "p_brand", id_column=ID).fit(c)
    return model.transform(q).select(ID, "prediction")


@query(sql_near(on="true") + ", o AS (SELECT query_id, q.p_retailprice AS a, sum(weight * i.p_retailprice) AS p FROM i JOIN q ON q.p_partkey = query_id GROUP BY 1, 2) SELECT round(1 - sum((a - p) * (a - p)) / sum((a - (SELECT avg(a) FROM o)) * (a - (SELECT avg(a) FROM o))), 6) AS score FROM o")
def regressor_score(spark, d):
    q, c = split(spark, d)
    return rounded(CaseRegressor(CONTEXTS, "p_retailprice", id_column=ID).fit(c).score(q))


@query()
def drawn_neighbours(spark, d):
    return series.drawn(near(spark, d), 7).select("query_id", "case_id")
