"""Further queries: local details, matrices, reduction, and profiles of series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import conviction, fanout, influence, profile, react, series, stats, validate
from ..operators import reduce as fewer
from ..operators.knn import knn, metric_of
from ..operators.profile import Attributes
from ..sources.store import CaseStore
from .q_react import ALL, CONTEXTS, ID, NEAR, NULLS, PROBS, part, rounded, split, sql_near
from .q_stats import CONTRIBUTION, FULL, LOO
from .storage import folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _both(spark, d, contexts=CONTEXTS):
    df = part(spark, d)
    m = metric_of(df, contexts)
    return df, m, react.neighbours(df, df, m, 10, carry=["p_retailprice"], id_column=ID)


E = LOO + ", er AS (SELECT query_id, abs(a - p) AS e, a, p FROM o)"


@query(E + "SELECT i.query_id, round(sum(i.weight * er.e), 9) AS local_residual FROM i JOIN er ON er.query_id = i.case_id GROUP BY 1")
def local_residuals(spark, d):
    df, _, near = _both(spark, d)
    actual = df.select(F.col(ID).alias("query_id"), F.col("p_retailprice").alias("actual"))
    loo = influence.errors(actual.join(react.predict_continuous(near, "p_retailprice", name="predicted"), "query_id"), "continuous").withColumnRenamed("query_id", "case_id")
    return rounded(react.local_residual(near, loo), 9)


@query(E + ", l AS (SELECT i.query_id, sum(i.weight * er.e) AS r FROM i JOIN er ON er.query_id = i.case_id GROUP BY 1) SELECT query_id, CASE WHEN round(e, 9) = 0 THEN 'Infinity'::DOUBLE ELSE round(round(r / round(e, 9), 9), 4) END AS residual_conviction FROM l JOIN er USING (query_id)")
def residual_convictions(spark, d):
    df, _, near = _both(spark, d)
    actual = df.select(F.col(ID).alias("query_id"), F.col("p_retailprice").alias("actual"))
    own = influence.errors(actual.join(react.predict_continuous(near, "p_retailprice", name="predicted"), "query_id"), "continuous")
    got = react.residual_conviction(react.local_residual(near, own.withColumnRenamed("query_id", "case_id")), own)
    return rounded(rounded(got, 9), 4)  # a value halfway at the fourth decimal falls to one side only


@query(E + "SELECT n.query_id, round(avg(er.e), 6) AS mae, round(sqrt(avg(er.e * er.e)), 6) AS rmse, round(avg(er.a - er.p), 6) AS bias FROM n JOIN er ON er.query_id = n.case_id GROUP BY 1")
def local_prediction_stats(spark, d):
    df, _, near = _both(spark, d)
    loo = df.select(F.col(ID).alias("query_id"), F.col("p_retailprice").alias("actual")).join(react.predict_continuous(near, "p_retailprice", name="predicted"), "query_id").withColumnRenamed("query_id", "case_id")
    return rounded(react.local_stats(near, loo))


_RANK = "rank() OVER (PARTITION BY query_id ORDER BY {0}) + (count(*) OVER (PARTITION BY query_id, {0}) - 1) / 2.0"


@query(E + f""", j AS (SELECT n.query_id, er.a, er.p, round(er.p, 9) AS r FROM n JOIN er ON er.query_id = n.case_id),
gap AS (SELECT query_id, min(g) AS g FROM (SELECT query_id, a - lag(a) OVER (PARTITION BY query_id ORDER BY a) AS g FROM (SELECT DISTINCT query_id, a FROM j)) GROUP BY 1),
m AS (SELECT j.*, coalesce(gap.g, 0) AS g, avg(a) OVER (PARTITION BY query_id) AS mean, {_RANK.format("a")} AS ra, {_RANK.format("r")} AS rp FROM j JOIN gap USING (query_id))
SELECT query_id, CAST(1 AS DOUBLE) AS missing_value_accuracy, round(avg(abs(a - p)), 6) AS mae, round(sqrt(avg((a - p) * (a - p))), 6) AS rmse,
CASE WHEN sum((a - mean) * (a - mean)) > 0 THEN round(1 - sum((a - p) * (a - p)) / sum((a - mean) * (a - mean)), 5) END AS r2, round(avg(abs(a - p) / (abs(a) + abs(p))), 7) AS smape,
round(avg(abs(a - p) / (abs(a) + abs(p) + g / 2)), 7) AS adjusted_smape, CASE WHEN min(a) < max(a) AND min(r) < max(r) THEN round(corr(ra, rp), 6) END AS spearman_coeff FROM m GROUP BY 1""")
def local_regression_stats(spark, d):
    df, _, near = _both(spark, d)
    loo = df.select(F.col(ID).alias("case_id"), F.col("p_retailprice").alias("actual")).join(react.predict_continuous(near, "p_retailprice", name="predicted").withColumnRenamed("query_id", "case_id"), "case_id")
    got = react.local_prediction_stats(near, loo, "continuous")
    return got.select("query_id", "missing_value_accuracy", *(F.round(c, n).alias(c) for c, n in (("mae", 6), ("rmse", 6), ("r2", 5), ("smape", 7), ("adjusted_smape", 7), ("spearman_coeff", 6))))


@query(ALL + PROBS + """, j AS (SELECT n.query_id, part.p_brand AS a, best.class AS p FROM n JOIN best ON best.query_id = n.case_id JOIN part ON p_partkey = n.case_id),
t AS (SELECT query_id, a AS class, CAST(count(*) AS DOUBLE) AS t, CAST(count(*) FILTER (a = p) AS DOUBLE) AS hit FROM j GROUP BY 1, 2), u AS (SELECT query_id, p AS class, CAST(count(*) AS DOUBLE) AS p FROM j GROUP BY 1, 2),
v AS (SELECT query_id, class, coalesce(t, 0) AS t, coalesce(p, 0) AS p, coalesce(hit, 0) AS hit FROM t FULL JOIN u USING (query_id, class)),
w2 AS (SELECT query_id, sum(t) AS s, sum(hit) AS c, sum(t * p) AS tp, sum(t * t) AS tt, sum(p * p) AS pp, avg(CASE WHEN p > 0 THEN hit / p END) AS pr, avg(CASE WHEN t > 0 THEN hit / t END) AS re FROM v GROUP BY 1)
SELECT query_id, round(c / s, 6) AS accuracy, round(pr, 6) AS precision, round(re, 6) AS recall, CASE WHEN (s * s - pp) * (s * s - tt) = 0 THEN 0.0::DOUBLE ELSE round((c * s - tp) / sqrt((s * s - pp) * (s * s - tt)), 6) + 0.0 END AS mcc FROM w2""")
def local_class_stats(spark, d):
    df, m, _ = _both(spark, d)
    near = react.neighbours(df, df, m, 10, carry=["p_brand"], id_column=ID)
    loo = df.select(F.col(ID).alias("case_id"), F.col("p_brand").alias("actual")).join(react.predict_nominal(near, "p_brand", name="predicted").select(F.col("query_id").alias("case_id"), "predicted"), "case_id")
    return rounded(react.local_prediction_stats(near, loo, "nominal", ["accuracy", "precision", "recall", "mcc"]))


_ONE_LESS = {f: sql_near("CAST(abs(q.p_size - c.p_size) AS DOUBLE)" if f == "p_type" else "CASE WHEN q.p_type = c.p_type THEN 0.0 ELSE 1.0 END", queries="true", cases="true") for f in CONTEXTS}
_PRED = "SELECT query_id, sum(weight * p_retailprice) AS p FROM i GROUP BY 1"


@query(f"WITH f AS ({ALL + _PRED}), " + ", ".join(f"{f} AS ({_ONE_LESS[f] + _PRED})" for f in CONTEXTS) + ", pc AS (" + " UNION ALL ".join(f"SELECT f.query_id, '{c}' AS feature, abs(p_retailprice - {c}.p) - abs(p_retailprice - f.p) AS gain FROM f JOIN {c} USING (query_id) JOIN part ON p_partkey = f.query_id" for c in CONTEXTS) + f"), nn AS ({FULL.replace('q AS (SELECT * FROM part WHERE true)', 'q AS (SELECT * FROM part WHERE p_partkey % 50 = 0)')} SELECT query_id, case_id FROM n) SELECT nn.query_id, feature, round(avg(gain), 6) + 0.0 AS accuracy_contribution FROM nn JOIN pc ON pc.query_id = nn.case_id GROUP BY 1, 2")
def contributions_ex_post(spark, d):
    """Accuracy contributions around a row whose action is given: neighbours by contexts and action, means over their own contributions."""
    q, df = split(spark, d)
    near = knn(q, df, metric_of(df, [*CONTEXTS, "p_retailprice"]), 10, id_column=ID)
    per_case = influence.contributions(df, df, metric_of(df, CONTEXTS), "p_retailprice", 10, id_column=ID)
    return rounded(react.local_means(near, per_case, ["accuracy_contribution"]))


DC = FULL + ", dc AS (SELECT query_id, CASE WHEN min(distance) = 0 THEN 0.0 ELSE count(*) / sum(1.0 / greatest(distance, 1e-300)) END AS d FROM n GROUP BY 1)"


@query(DC + ", l AS (SELECT n.query_id, avg(dc.d) AS local FROM n JOIN dc ON dc.query_id = n.case_id GROUP BY 1) SELECT query_id, CASE WHEN d = 0 THEN CASE WHEN local = 0 THEN 1.0 END ELSE round(local / d, 6) END AS similarity_conviction FROM l JOIN dc USING (query_id)")
def similarity_convictions(spark, d):
    _, _, near = _both(spark, d, [*CONTEXTS, "p_retailprice"])
    own = react.distance_contribution(near)
    got = react.similarity_conviction(near, own, own.select(F.col("query_id").alias("case_id"), F.col("distance_contribution").alias("case_contribution")))
    return rounded(got)


@query(FULL + ", f AS (SELECT query_id, distance FROM n WHERE rank = 1), r AS (SELECT n.query_id, min(n.distance) AS nearest, min(f.distance) AS local FROM n JOIN f ON f.query_id = n.case_id GROUP BY 1) SELECT query_id, CASE WHEN local > 0 THEN round(nearest / local, 6) END AS distance_ratio FROM r")
def distance_ratios(spark, d):
    _, _, near = _both(spark, d, [*CONTEXTS, "p_retailprice"])
    return rounded(react.distance_ratio(near, near))


@query(NEAR + ", t AS (SELECT *, sum(weight * p_retailprice) OVER (PARTITION BY query_id) AS s FROM i), u AS (SELECT query_id, case_id, weight, s, CASE WHEN 1 - weight > 1e-12 THEN (s - weight * p_retailprice) / (1 - weight) END AS rest FROM t) SELECT query_id, case_id, round(abs(q.p_retailprice - rest) - abs(q.p_retailprice - s), 4) AS accuracy_contribution FROM u JOIN q ON q.p_partkey = query_id")
def case_accuracy(spark, d):
    q, c = split(spark, d)
    near = react.neighbours(q, c, metric_of(c, CONTEXTS), 10, carry=["p_retailprice"], id_column=ID)
    got = react.case_accuracy_contributions(near, "p_retailprice", q.select(F.col(ID).alias("query_id"), F.col("p_retailprice").alias("actual")))
    return rounded(got, 4)


@query(NEAR + "SELECT query_id, round(min(p_retailprice), 6) AS low, round(quantile_cont(p_retailprice, 0.5), 6) AS middle, round(max(p_retailprice), 6) AS high FROM i WHERE weight > 0 GROUP BY query_id")
def relevant_quantiles(spark, d):
    q, c = split(spark, d)
    near = react.neighbours(q, c, metric_of(c, CONTEXTS), 10, carry=["p_retailprice"], id_column=ID)
    got = react.relevant_values(near, "p_retailprice", "continuous", (0.0, 0.5, 1.0))
    return rounded(got.select("query_id", F.col("values")[0].alias("low"), F.col("values")[1].alias("middle"), F.col("values")[2].alias("high")))


@query(CONTRIBUTION + ", v AS (SELECT p_brand AS value, abs(x - z) AS pc, x - z AS di, abs(p_retailprice - z) - abs(p_retailprice - x) AS ac FROM u JOIN part ON p_partkey = query_id WHERE feature = 'p_type') SELECT value, count(*) AS n, round(avg(pc), 7) AS prediction_contribution, round(avg(di), 7) + 0.0 AS directional, round(avg(ac), 7) + 0.0 AS accuracy_contribution FROM v GROUP BY 1 HAVING count(*) >= 5")
def contributions_by_value(spark, d):
    q = part(spark, d)
    per = influence.contributions(q, q, metric_of(q, CONTEXTS), "p_retailprice", 10, id_column=ID)
    by_type = influence.value_contributions(per.where("feature = 'p_type'").withColumn("feature", F.lit("p_brand")), q, "p_brand", "nominal", least=5, id_column=ID)
    return rounded(by_type, 7)


@query(sql_near("abs(q.p_retailprice - c.p_retailprice)", queries="true", cases="true", part=NULLS) + ", p AS (SELECT query_id, coalesce(sum(weight) FILTER (p_size IS NULL), 0.0) > 0.5 AS gone FROM i GROUP BY 1) SELECT count(*) AS n, round(avg(CASE WHEN (p_size IS NULL) = gone THEN 1.0 ELSE 0.0 END), 6) AS missing_value_accuracy FROM p JOIN q ON p_partkey = query_id")
def missing_values(spark, d):
    df = part(spark, d).withColumn("p_size", F.when(F.col(ID) % 7 != 0, F.col("p_size")))
    near = react.neighbours(df, df, metric_of(df, ["p_retailprice"]), 10, carry=["p_size"], id_column=ID)
    got = df.select(F.col(ID).alias("query_id"), F.col("p_size").alias("actual")).join(react.predict_continuous(near, "p_size", allow_nulls=True, name="predicted"), "query_id")
    return rounded(got.agg(F.count("*").alias("n")).crossJoin(stats.missing_value_accuracy(got)))


@query(sql_near(k=5) + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS v FROM i GROUP BY 1) SELECT p_partkey FROM q JOIN y ON query_id = p_partkey WHERE abs(p_retailprice - v) <= greatest(20.0, 0.02 * abs(p_retailprice))")
def ablation_by_prediction(spark, d):
    q, c = split(spark, d)
    return fewer.predicted_well(c, q, metric_of(c, [*CONTEXTS, "p_retailprice"]), "p_retailprice", "continuous", tolerance=20.0, relative=0.02, k=5, id_column=ID).select(ID)


@query("SELECT count(*) AS n, CAST(count(*) AS DOUBLE) AS mass FROM part")
def ablation_keeps_mass(spark, d):
    df = part(spark, d)
    first, batch = df.where(f"{ID} % 2 = 0"), df.where(f"{ID} % 2 = 1")
    got = fewer.ablate(first, batch, metric_of(df, CONTEXTS), 5, least_cases=100, id_column=ID)
    total = got.agg(F.sum("_case_weight").alias("m"))
    return df.agg(F.count("*").alias("n")).crossJoin(total).select("n", F.round("m", 6).alias("mass"))


@query("SELECT 'ts' AS feature, 'delta' AS kind, false AS invariant UNION ALL SELECT 'value', 'rate', false UNION ALL SELECT 'event_type', 'covariate', false UNION ALL SELECT 'user_id', 'covariate', true")
def series_profile(spark, d):
    df = spark.read.parquet(f"{d}/events.parquet").select("user_id", "ts", "value", "event_type")
    got = series.infer(df, ["user_id"], "ts")
    return spark.createDataFrame([(n, a.extra["series_type"], a.extra["invariant"]) for n, a in got.items()], "feature string, kind string, invariant boolean")


@query("SELECT count(DISTINCT user_id) AS n_values, count(DISTINCT user_id) AS pairs, CAST(0 AS BIGINT) AS outside FROM events")
def value_groups(spark, d):
    """Every user falls into one group, and into one of those asked for."""
    got = profile.group_numbers(spark.read.parquet(f"{d}/events.parquet"), "user_id", 3)
    return got.agg(F.countDistinct("value").alias("n_values"), F.count("*").alias("pairs"), F.count_if(~F.col("group").between(0, 2)).alias("outside"))


@query(sql_near(k=3) + "SELECT query_id, case_id, rank, c.p_brand AS brand FROM n JOIN c ON c.p_partkey = case_id")
def neighbours_with_cases(spark, d):
    q, c = split(spark, d)
    near = knn(q, c, metric_of(c, CONTEXTS), 3, id_column=ID)
    got = near.join(c.select(F.col(ID).alias("case_id"), F.col("p_brand").alias("brand")), "case_id")
    return rounded(got.select("query_id", "case_id", "rank", "brand"))


@query()
def contribution_matrix(spark, d):
    df = part(spark, d)
    cells = influence.contribution_matrix(df, metric_of(df, ["p_size", "p_retailprice", "p_type"]), 10, id_column=ID)
    return rounded(stats.normalize_matrix(cells, "fractional_absolute"), 4)


@query()
def predicted_clusters(spark, d):
    """Cluster of every query row, voted by its neighbours."""
    q, c = split(spark, d)
    m = metric_of(c, ["p_size", "p_retailprice"])
    named = conviction.clusters(c, m, 5, id_column=ID)
    near = react.neighbours(q, named, m, 5, carry=["_cluster_id"], id_column=ID)
    return react.predict_nominal(near, "_cluster_id").select("query_id", "_cluster_id")


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS o_custkey FROM orders")
def coerced_types(spark, d):
    df = _t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit("unknown")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"))
    return validate.coerce(df, {"o_custkey": Attributes("o_custkey", original="bigint")})


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def substituted_values(spark, d):
    return validate.substitute(_t(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "final", "O": "open"})


@query("SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_partkey % 400 = 0)")
def unexpected_values(spark, d):
    df = part(spark, d)
    return validate.unexpected_values(df, "p_brand", df.where(f"{ID} % 400 = 0").select("p_brand").distinct())


@query("SELECT 'text' AS feature, round(avg(strlen(text)), 6) AS avg_bytes FROM documents")
def heavy_features(spark, d):
    stats_ = profile.basics(_t(spark, d, "documents"), ["text", "lang", "source"])
    return rounded(profile.heavy(stats_, 100.0))


@query("SELECT arg_min(v, k) AS value FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey > 100 THEN o_orderpriority END AS v FROM orders) WHERE v IS NOT NULL")
def first_known_value(spark, d):
    df = _t(spark, d, "orders").withColumn("v", F.when(F.col("o_orderkey") > 100, F.col("o_orderpriority")))
    return profile.first_non_null(df, "v", ["o_orderkey"])


@query(NEAR + ", r AS (SELECT *, row_number() OVER (PARTITION BY query_id, p_brand ORDER BY rank) AS k FROM n) SELECT query_id, case_id FROM r WHERE k = 1")
def neighbours_once_per_key(spark, d):
    q, c = split(spark, d)
    near = knn(q, c, metric_of(c, CONTEXTS), 10, id_column=ID, carry=["p_brand"])
    return fanout.once_per_key(near, "p_brand").select("query_id", "case_id")


@query("SELECT p_partkey, rank FROM (SELECT p_partkey, row_number() OVER (ORDER BY abs(p_size - 25), p_partkey) AS rank FROM part) WHERE rank <= 15")
def store_similar(spark, d):
    import uuid

    store = CaseStore(spark, f"{folder(spark)}/store-{uuid.uuid4().hex}")
    store.train(part(spark, d), "all", order=[ID])
    return rounded(store.similar({"p_size": 25}, 15, [ID]).select(ID, "rank"))


@query("WITH e AS (SELECT *, epoch_us(ts) / 1e6 AS t FROM events), f AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM e) SELECT user_id, round(avg(value), 6) AS mean FROM f WHERE k <= 5 GROUP BY 1")
def latest_means(spark, d):
    _, tail = series.holdout(_t(spark, d, "events"), ["user_id"], "ts", 5, "event_id")
    return rounded(tail.groupBy("user_id").agg(F.avg("value").alias("mean")))
