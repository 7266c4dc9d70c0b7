"""Queries of prediction statistics, feature influence, convictions and groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import conviction, influence, stats
from ..operators.analyze import grid
from ..operators.knn import metric_of
from ..operators.react import neighbours, predict_continuous
from .q_react import ALL, CONTEXTS, ID, PROBS, part, rounded, sql_near

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _loo(spark, d):
    df = part(spark, d)
    return stats.leave_one_out(df, metric_of(df, CONTEXTS), "p_retailprice", "continuous", 10, id_column=ID)


LOO = ALL + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS p FROM i GROUP BY 1), o AS (SELECT query_id, p_retailprice AS a, p FROM y JOIN part ON p_partkey = query_id)"
RANKS = ", ra AS (SELECT a, p, (rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0) AS x, (rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0) AS z FROM (SELECT a, round(p, 6) AS p FROM o)), gap AS (SELECT min(g) AS g FROM (SELECT a - lag(a) OVER (ORDER BY a) AS g FROM (SELECT DISTINCT a FROM o)))"


@query(LOO + RANKS + "SELECT round(avg(abs(a - p)), 6) AS mae, round(sqrt(avg((a - p) * (a - p))), 6) AS rmse, round(1 - sum((a - p) * (a - p)) / sum((a - (SELECT avg(a) FROM o)) * (a - (SELECT avg(a) FROM o))), 6) AS r2, round(avg(abs(a - p) / (abs(a) + abs(p))), 6) AS smape, round(avg(abs(a - p) / (abs(a) + abs(p) + (SELECT g FROM gap) / 2)), 6) AS adjusted_smape, (SELECT round(corr(x, z), 6) FROM ra) AS spearman_coeff FROM o")
def regression_stats(spark, d):
    df = _loo(spark, d)
    return rounded(stats.continuous_stats(df.withColumn("predicted", F.round("predicted", 6))))


CELLS = ALL + PROBS + ", o AS (SELECT query_id, p_brand AS a, best.class AS p, coalesce((SELECT p FROM pr WHERE pr.query_id = best.query_id AND pr.class = part.p_brand), 0.0) AS t FROM best JOIN part ON p_partkey = query_id)"


@query(CELLS + ", k AS (SELECT DISTINCT a AS c FROM o UNION SELECT DISTINCT p FROM o), v AS (SELECT c, (SELECT count(*) FROM o WHERE a = c) AS t, (SELECT count(*) FROM o WHERE p = c) AS p, (SELECT count(*) FROM o WHERE p = c AND a = c) AS h FROM k), s AS (SELECT count(*) AS s, count(*) FILTER (a = p) AS c, 1 - avg(t) AS mae FROM o) SELECT round(any_value(s.c) / any_value(s.s), 6) AS accuracy, round(avg(CASE WHEN p > 0 THEN h / p END), 6) AS precision, round(avg(CASE WHEN v.t > 0 THEN h / v.t END), 6) AS recall, round((any_value(s.c) * any_value(s.s) - sum(v.t * p)) / sqrt((any_value(s.s) * any_value(s.s) - sum(p * p)) * (any_value(s.s) * any_value(s.s) - sum(v.t * v.t))), 6) AS mcc, round(any_value(s.mae), 6) AS mae FROM v, s".replace("any_value(s.c) / any_value(s.s)", "CAST(any_value(s.c) AS DOUBLE) / any_value(s.s)").replace("h / p", "CAST(h AS DOUBLE) / p").replace("h / v.t", "CAST(h AS DOUBLE) / v.t").replace("sqrt((", "sqrt(CAST((").replace("sum(v.t * v.t)))", "sum(v.t * v.t)) AS DOUBLE))"))
def classification_stats(spark, d):
    df = part(spark, d)
    return rounded(stats.nominal_stats(stats.leave_one_out(df, metric_of(df, CONTEXTS), "p_brand", "nominal", 10, id_column=ID)))


@query(CELLS + ", c2 AS (SELECT a AS actual, p AS predicted, count(*) AS n FROM o GROUP BY 1, 2) SELECT actual, CASE WHEN n < 5 AND actual <> predicted THEN NULL ELSE predicted END AS predicted, n < 5 AND actual <> predicted AS other, CAST(sum(n) AS BIGINT) AS n FROM c2 GROUP BY 1, 2, 3")
def confusion_matrix(spark, d):
    df = part(spark, d)
    return stats.confusion_folded(stats.leave_one_out(df, metric_of(df, CONTEXTS), "p_brand", "nominal", 10, id_column=ID), 5)


@query(CELLS + ", c2 AS (SELECT a AS row, p AS col, CAST(count(*) AS DOUBLE) AS value FROM o GROUP BY 1, 2), s AS (SELECT *, sum(CASE WHEN row <> col THEN value END) OVER (PARTITION BY row) AS t FROM c2) SELECT row, col, round(CASE WHEN row = col THEN value WHEN t = 0 THEN value ELSE value / t END, 6) AS value FROM s")
def matrix_normalized(spark, d):
    df = part(spark, d)
    cells = stats.confusion(stats.leave_one_out(df, metric_of(df, CONTEXTS), "p_brand", "nominal", 10, id_column=ID))
    cells = cells.select(F.col("actual").alias("row"), F.col("predicted").alias("col"), F.col("n").cast("double").alias("value"))
    return rounded(stats.normalize_matrix(cells, "fractional"))


ONE = {f: sql_near(x, queries="true", cases="true") for f, x in (("p_size", "CAST(abs(q.p_size - c.p_size) AS DOUBLE)"), ("p_type", "CASE WHEN q.p_type = c.p_type THEN 0.0 ELSE 1.0 END"))}
MAE = ", y AS (SELECT query_id, sum(weight * {f}) AS p FROM i GROUP BY 1) SELECT avg(abs({f} - p)) AS e FROM y JOIN part ON p_partkey = query_id"
SIZE_FROM_TYPE = sql_near("CASE WHEN q.p_type = c.p_type THEN 0.0 ELSE 1.0 END + abs(q.p_retailprice - c.p_retailprice)", queries="true", cases="true")
PRICE_FROM_REST = ALL


@query(f"SELECT 'p_retailprice' AS feature, round((SELECT e FROM ({PRICE_FROM_REST + MAE.format(f='p_retailprice')})), 6) AS residual, 0.0 AS null_residual UNION ALL SELECT 'p_size', round((SELECT e FROM ({SIZE_FROM_TYPE + MAE.format(f='p_size')})), 6), 0.0".replace("0.0 AS null_residual", "CAST(0 AS DOUBLE) AS null_residual").replace(", 6), 0.0", ", 6), CAST(0 AS DOUBLE)"))
def feature_residuals(spark, d):
    df = part(spark, d)
    m = metric_of(df, [*CONTEXTS, "p_retailprice"])
    return rounded(influence.residuals(df, m, {"p_retailprice": "continuous", "p_size": "continuous"}, 10, id_column=ID))


FULL = sql_near("CAST(abs(q.p_size - c.p_size) AS DOUBLE) + CASE WHEN q.p_type = c.p_type THEN 0.0 ELSE 1.0 END + abs(q.p_retailprice - c.p_retailprice)", queries="true", cases="true")


@query(f"SELECT 'p_retailprice' AS feature, round((SELECT e FROM ({FULL + MAE.format(f='p_retailprice')})), 6) AS deviation UNION ALL SELECT 'p_size', round((SELECT e FROM ({FULL + MAE.format(f='p_size')})), 6)")
def feature_deviations(spark, d):
    df = part(spark, d)
    m = metric_of(df, [*CONTEXTS, "p_retailprice"])
    return rounded(influence.deviations(df, m, {"p_retailprice": "continuous", "p_size": "continuous"}, 10, id_column=ID))


PRED = ", y AS (SELECT query_id, sum(weight * p_retailprice) AS p FROM i GROUP BY 1) SELECT query_id, p FROM y"
CONTRIBUTION = f"""WITH a AS ({ALL + PRED}), s AS ({ONE["p_type"] + PRED}), t AS ({ONE["p_size"] + PRED}),
u AS (SELECT query_id, 'p_size' AS feature, a.p AS x, s.p AS z FROM a JOIN s USING (query_id) UNION ALL SELECT query_id, 'p_type', a.p, t.p FROM a JOIN t USING (query_id))
"""


@query(CONTRIBUTION + "SELECT query_id, feature, round(abs(x - z), 7) AS prediction_contribution, round(x - z, 7) + 0.0 AS directional, round(abs(p_retailprice - z) - abs(p_retailprice - x), 7) + 0.0 AS accuracy_contribution FROM u JOIN part ON p_partkey = query_id")
def contributions_full(spark, d):
    df = part(spark, d)
    return rounded(influence.contributions(df, df, metric_of(df, CONTEXTS), "p_retailprice", 10, id_column=ID), 7)


@query(CONTRIBUTION + "SELECT feature, round(avg(abs(x - z)), 7) AS prediction_contribution, round(avg(x - z), 7) + 0.0 AS directional, round(avg(abs(p_retailprice - z) - abs(p_retailprice - x)), 7) + 0.0 AS accuracy_contribution FROM u JOIN part ON p_partkey = query_id GROUP BY feature")
def contributions_mean(spark, d):
    df = part(spark, d)
    return rounded(influence.mean_contributions(influence.contributions(df, df, metric_of(df, CONTEXTS), "p_retailprice", 10, id_column=ID)), 7)


@query()
def permutation_accuracy(spark, d):
    df = part(spark, d)
    return rounded(influence.permutation_accuracy(df, metric_of(df, CONTEXTS), "p_retailprice", 10, id_column=ID), 4)


@query(ALL + "SELECT round(avg(abs(part.p_retailprice - n.p_retailprice)), 6) AS residual_lower_bound FROM n JOIN part ON p_partkey = query_id WHERE rank = 1")
def residual_lower_bound(spark, d):
    df = part(spark, d)
    near = neighbours(df, df, metric_of(df, CONTEXTS), 1, carry=["p_retailprice"], id_column=ID)
    return rounded(stats.residual_lower_bound(near, df.select(F.col(ID).alias("query_id"), F.col("p_retailprice").alias("actual")), "p_retailprice"))


def _grid_sql(p: int, k: int) -> str:
    x = "CAST(abs(q.p_size - c.p_size) AS DOUBLE) + CASE WHEN q.p_type = c.p_type THEN 0.0 ELSE 1.0 END"
    if p == 2:
        x = "sqrt(pow(q.p_size - c.p_size, 2) + CASE WHEN q.p_type = c.p_type THEN 0.0 ELSE 1.0 END)"
    return f"SELECT CAST({p} AS DOUBLE) AS p, CAST({k} AS BIGINT) AS k, CAST(-1 AS DOUBLE) AS dt, (SELECT count(*) FROM part) AS n, round((SELECT e FROM ({sql_near(x, k, 'true', 'true') + MAE.format(f='p_retailprice')})), 6) AS error"


@query(" UNION ALL ".join(_grid_sql(p, k) for p in (1, 2) for k in (3, 10)))
def parameter_grid(spark, d):
    df = part(spark, d)
    return rounded(grid(df, metric_of(df, CONTEXTS), "p_retailprice", "continuous", k_values=[3, 10], p_values=[1.0, 2.0], folds=1, id_column=ID))


_CELLS = sql_near(k=10, queries="true", cases="true", on="q.p_partkey % 6 <> c.p_partkey % 6") + """, z AS (SELECT *, min(distance) OVER (PARTITION BY query_id) = 0 AS zero FROM n),
g AS (SELECT z.*, g.k, CAST(g.dt AS DOUBLE) AS dt, CASE WHEN zero THEN CASE WHEN distance = 0 THEN 1.0 ELSE 0.0 END ELSE pow(distance, CAST(g.dt AS DOUBLE)) END AS raw FROM z JOIN (VALUES (3, -1), (3, 0), (10, -1), (10, 0)) AS g(k, dt) ON z.rank <= g.k),
v AS (SELECT query_id, k, dt, sum(raw * p_retailprice) / sum(raw) AS v FROM g GROUP BY 1, 2, 3)
SELECT CAST(1 AS DOUBLE) AS p, CAST(k AS BIGINT) AS k, dt, count(*) AS n, round(avg(abs(p_retailprice - v)), 6) AS error FROM v JOIN part ON p_partkey = query_id GROUP BY k, dt"""


@query(_CELLS)
def parameter_grid_folds(spark, d):
    df = part(spark, d)
    return rounded(grid(df, metric_of(df, CONTEXTS), "p_retailprice", "continuous", k_values=[3, 10], dt_values=[-1.0, 0.0], folds=6, fold_by="p_partkey % 6", id_column=ID))


# --- convictions

CONTRIB = ALL + ", dc AS (SELECT query_id, CASE WHEN min(distance) = 0 THEN 0.0 ELSE count(*) / sum(1.0 / greatest(distance, 1e-300)) END AS d FROM n GROUP BY 1)"
KL = """, p AS (SELECT query_id, d, d / (SELECT sum(d) FROM dc) AS p, 1.0 / (SELECT count(*) FROM dc) AS q FROM dc),
kl AS (SELECT query_id, d, CASE WHEN p <= 0 THEN 0.0 ELSE p * ln(p / q) END + CASE WHEN p >= 1 THEN 0.0 ELSE (1 - p) * ln((1 - p) / (1 - q)) END AS kl FROM p)
"""
CONV = "round(least(CASE WHEN round(kl, 12) <= 0 THEN 1e4 ELSE (SELECT avg(kl) FROM kl) / round(kl, 12) END, 1e4), 3)"


def _dc(spark, d):
    df = part(spark, d)
    return conviction.contributions(df, df, metric_of(df, CONTEXTS), 10, id_column=ID)


@query(CONTRIB + KL + f"SELECT query_id, {CONV} AS familiarity_conviction FROM kl")
def familiarity_conviction(spark, d):
    return rounded(conviction.familiarity(_dc(spark, d)), 3)


@query(CONTRIB + KL + "SELECT query_id, round(1 - (rank() OVER (ORDER BY round(kl, 15)) - 1) / CAST((SELECT count(*) FROM kl) AS DOUBLE), 9) AS p_value FROM kl".replace("1 - (rank() OVER (ORDER BY round(kl, 15)) - 1) / CAST((SELECT count(*) FROM kl) AS DOUBLE)", "cume_dist() OVER (ORDER BY round(kl, 15) DESC)"))
def p_value_of_removal(spark, d):
    got = conviction.p_values(conviction.familiarity(_dc(spark, d), keep=True))
    return rounded(got.select("query_id", "p_value"), 9)


@query(CONTRIB + ", l AS (SELECT n.query_id, avg(dc.d) AS local FROM n JOIN dc ON dc.query_id = n.case_id GROUP BY 1), e AS (SELECT query_id, -sum(CASE WHEN weight > 0 THEN weight * ln(weight) ELSE 0.0 END) AS h FROM i GROUP BY 1) SELECT dc.query_id AS p_partkey, round(dc.d, 6) AS distance_contribution, round(CASE WHEN dc.d = 0 THEN NULL ELSE local / dc.d END, 6) AS similarity_conviction, round(h, 6) + 0.0 AS influence_weight_entropy FROM dc JOIN l USING (query_id) JOIN e USING (query_id)")
def conviction_features(spark, d):
    df = part(spark, d)
    got = conviction.into_features(df, metric_of(df, CONTEXTS), 10, id_column=ID)
    return rounded(got.select(ID, "distance_contribution", "similarity_conviction", "influence_weight_entropy"))


OUT = sql_near(queries="true", cases="true", on="q.p_brand <> c.p_brand")


@query(OUT + ", dc AS (SELECT query_id, CASE WHEN min(distance) = 0 THEN 0.0 ELSE count(*) / sum(1.0 / greatest(distance, 1e-300)) END AS d FROM n GROUP BY 1) SELECT p_brand AS group_id, count(*) AS n, round(avg(d), 6) AS distance_contribution FROM dc JOIN part ON p_partkey = query_id GROUP BY 1")
def group_contributions(spark, d):
    df = part(spark, d)
    return rounded(conviction.groups(df, df, metric_of(df, CONTEXTS), "p_brand", 10, id_column=ID).select("group_id", "n", "distance_contribution"))


@query(OUT + ", g AS (SELECT m.p_brand AS group_id, i.p_brand AS class, sum(weight) AS w FROM i JOIN part AS m ON m.p_partkey = query_id GROUP BY 1, 2) SELECT group_id, class, round(w / sum(w) OVER (PARTITION BY group_id), 6) AS probability FROM g")
def group_predictions(spark, d):
    df = part(spark, d)
    return rounded(conviction.group_predictions(df, df, metric_of(df, CONTEXTS), "p_brand", "p_brand", 10, id_column=ID))


@query()
def feature_convictions(spark, d):
    df = part(spark, d)
    return rounded(conviction.feature_conviction(df, metric_of(df, [*CONTEXTS, "p_retailprice"]), 10, ID), 4)


@query()
def case_clusters(spark, d):
    df = part(spark, d)
    return conviction.clusters(df, metric_of(df, ["p_size", "p_retailprice"]), 5, id_column=ID).groupBy("_cluster_id").agg(F.count("*").alias("n"))


@query()
def predictions_for_sample(spark, d):
    """A fixed sample of cases, as large tables are measured."""
    df = part(spark, d)
    some = stats.sample(df, 1000, 0, ID)
    near = neighbours(some, df, metric_of(df, CONTEXTS), 10, carry=["p_retailprice"], id_column=ID)
    return rounded(predict_continuous(near, "p_retailprice"))
