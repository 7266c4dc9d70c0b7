"""Queries of neighbours, predictions and their details, over `part`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import react as r
from ..operators.condition import compile_condition
from ..operators.knn import FOLDED_PAIRS, Feature, Metric, dynamic_k, knn, knn_dependent, metric_of, pairwise
from ..operators.pruned import search, work_of_distinct
from ..operators.stats import leave_one_out

ID = "p_partkey"
CONTEXTS = ["p_size", "p_type"]
ACTIONS = ["p_retailprice", "p_brand"]
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def part(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/part.parquet")


def split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The queries of a search, every id divisible by 50, and the cases, which are all rows (a row is never its own neighbour)."""
    df = part(spark, d)
    return df.where(f"{ID} % 50 = 0"), df


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded (0.0 for -0.0) and integers as longs, as the SQL side has them."""
    kinds = dict(df.dtypes)
    return df.select(*((F.round(c, digits) + 0.0).alias(c) if kinds[c] == "double" else F.col(c).cast("long").alias(c) if kinds[c] in ("int", "smallint", "tinyint") else F.col(c) for c in df.columns))


def near(spark: SparkSession, d: str, k: int = 10, **options) -> DataFrame:
    q, c = split(spark, d)
    return r.neighbours(q, c, metric_of(c, CONTEXTS), k, carry=[*ACTIONS, *CONTEXTS], id_column=ID, **options)


# --- the SQL side of the neighbour table
DISTANCE = "CAST(abs(q.p_size - c.p_size) AS DOUBLE) + CASE WHEN q.p_type = c.p_type THEN 0.0 ELSE 1.0 END"


def sql_near(distance: str = DISTANCE, k: int = 10, queries: str = "p_partkey % 50 = 0", cases: str = "true", on: str = "q.p_partkey <> c.p_partkey", part: str = "part") -> str:
    return f"""
WITH q AS (SELECT * FROM {part} WHERE {queries}), c AS (SELECT * FROM {part} WHERE {cases}),
d AS (SELECT q.p_partkey AS query_id, c.p_partkey AS case_id, {distance} AS distance, c.p_retailprice, c.p_brand, c.p_size, c.p_type FROM q JOIN c ON {on}),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, case_id) AS rank FROM d) WHERE rank <= {k}),
w AS (SELECT *, CASE WHEN min(distance) OVER (PARTITION BY query_id) = 0 THEN CASE WHEN distance = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / distance END AS raw FROM n),
i AS (SELECT *, raw / sum(raw) OVER (PARTITION BY query_id) AS weight FROM w)
"""


NEAR = sql_near()
ALL = sql_near(queries="true", cases="true")
PROBS = """, pr AS (SELECT query_id, p_brand AS class, sum(weight) AS p FROM i GROUP BY 1, 2),
best AS (SELECT query_id, class, p FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(p, 9) DESC, class) AS k FROM pr) WHERE k = 1)
"""
LIST = "SELECT query_id, case_id, round(distance, 6) AS distance, rank FROM n"


def listed(df: DataFrame) -> DataFrame:
    return rounded(df.select("query_id", "case_id", "distance", "rank"))


@query(NEAR + PROBS + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS v FROM i GROUP BY 1) SELECT query_id, round(v, 6) AS p_retailprice, class AS p_brand, round(p, 6) AS probability FROM y JOIN best USING (query_id)")
def knn_predict(spark, d):
    n = near(spark, d)
    return rounded(r.predict_continuous(n, "p_retailprice").join(r.predict_nominal(n, "p_brand"), "query_id"))


@query(NEAR + LIST)
def knn_join(spark, d):
    return listed(near(spark, d))


@query(ALL + LIST)
def knn_self_join(spark, d):
    df = part(spark, d)
    return listed(knn(df, df, metric_of(df, CONTEXTS), 10, id_column=ID))


@query(sql_near(queries="true", cases="true", k=3) + LIST)
def knn_self_join_blocked(spark, d):
    df = part(spark, d)
    return listed(knn(df, df, metric_of(df, CONTEXTS), 3, id_column=ID, broadcast_queries=500, pruned=False))


@query(ALL + LIST)
def knn_pruned(spark, d):
    df = part(spark, d)
    return listed(knn(df, df, metric_of(df, CONTEXTS), 10, id_column=ID, pruned=True))


@query(sql_near(DISTANCE + " + abs(q.p_retailprice - c.p_retailprice)", k=5, queries="true", cases="p_size > 10", on="q.p_partkey <> c.p_partkey AND q.p_brand <> c.p_brand") + LIST)
def knn_pruned_other_brands(spark, d):
    df = part(spark, d)
    return listed(knn(df, df.where("p_size > 10"), metric_of(df, [*CONTEXTS, "p_retailprice"]), 5, id_column=ID, differ=["p_brand"], pruned=True))


@query()
def knn_pruned_work(spark, d):
    """Pairs of rows that the pruned search compares, in cells and with pivots, beside all pairs."""
    df = part(spark, d)
    m = metric_of(df, [*CONTEXTS, "p_retailprice"])
    large = df.count() ** 2 > FOLDED_PAIRS
    work = work_of_distinct(df, df, m, 10, id_column=ID) if large else search(df, df, m, 10, id_column=ID).work
    return work.withColumn("share", F.round(F.col("compared") / F.col("all_pairs"), 6))


@query(sql_near(cases="p_retailprice BETWEEN 950 AND 1100 AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#1', 'Brand#2')") + LIST)
def knn_constrained(spark, d):
    q, c = split(spark, d)
    held = compile_condition({"p_retailprice": [950, 1100], "p_brand": ["Brand#11", "Brand#12", "Brand#13", "Brand#1", "Brand#2"]})
    return listed(knn(q, c.where(held), metric_of(c, CONTEXTS), 10, id_column=ID))


@query(sql_near(on="q.p_brand <> c.p_brand") + LIST)
def knn_leave_series_out(spark, d):
    q, c = split(spark, d)
    return listed(knn(q, c, metric_of(c, CONTEXTS), 10, id_column=ID, differ=["p_brand"]))


@query(sql_near(on="q.p_brand = c.p_brand AND q.p_partkey <> c.p_partkey", k=5) + LIST)
def knn_dependent_feature(spark, d):
    q, c = split(spark, d)
    return listed(knn_dependent(q, c, metric_of(c, CONTEXTS), 5, ["p_brand"], id_column=ID))


@query(sql_near("sqrt(0.5 * pow(least(abs(q.p_size - c.p_size) % 50, 50 - abs(q.p_size - c.p_size) % 50) / 2.0, 2) + 3.0 * pow(abs(q.p_retailprice - c.p_retailprice) / 100.0, 2))", k=5) + LIST)
def knn_weighted_cyclic(spark, d):
    q, c = split(spark, d)
    m = Metric((Feature("p_size", "cyclic", weight=0.5, deviation=2.0, cycle=50.0), Feature("p_retailprice", weight=3.0, deviation=100.0)), p=2.0)
    return listed(knn(q, c, m, 5, id_column=ID))


NULLS = "(SELECT p_partkey, p_brand, p_type, p_retailprice, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS p_size FROM part)"
NULL_DISTANCE = "CASE WHEN q.p_size IS NULL AND c.p_size IS NULL THEN 0.0 WHEN q.p_size IS NULL OR c.p_size IS NULL THEN 49.0 ELSE CAST(abs(q.p_size - c.p_size) AS DOUBLE) END + CASE WHEN q.p_type = c.p_type THEN 0.0 ELSE 1.0 END"


@query(sql_near(NULL_DISTANCE, part=NULLS) + LIST)
def knn_with_nulls(spark, d):
    df = part(spark, d).withColumn("p_size", F.when(F.col(ID) % 7 != 0, F.col("p_size")))
    q, c = df.where(f"{ID} % 50 = 0"), df
    m = Metric((Feature("p_size", spread=49.0), Feature("p_type", "nominal")))
    return listed(knn(q, c, m, 10, id_column=ID))


@query(NEAR + ", s AS (SELECT *, weight / sum(weight) OVER (PARTITION BY query_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS share FROM i), t AS (SELECT *, least(greatest(coalesce(min(CASE WHEN share < 0.12 THEN rank - 1 END) OVER (PARTITION BY query_id), max(rank) OVER (PARTITION BY query_id)), 3), 8) + 1 AS k FROM s) SELECT query_id, case_id, rank FROM t WHERE rank <= k")
def knn_dynamic_k(spark, d):
    return rounded(dynamic_k(near(spark, d), 0.12, 3, 8, 1).select("query_id", "case_id", "rank"))


@query(NEAR + PROBS + "SELECT query_id, class, round(p, 6) AS probability FROM pr")
def class_probabilities(spark, d):
    return rounded(r.class_probabilities(near(spark, d), "p_brand"))


@query(NEAR + "SELECT query_id, case_id, round(raw, 6) AS raw_weight, round(weight, 6) AS weight, row_number() OVER (PARTITION BY query_id ORDER BY round(weight, 9) DESC, rank) AS place FROM i WHERE weight > 0")
def influential_cases(spark, d):
    return rounded(r.influential_cases(near(spark, d)).select("query_id", "case_id", "raw_weight", "weight", "place"))


@query(NEAR + "SELECT query_id, round(CASE WHEN min(distance) = 0 THEN 0.0 ELSE count(*) / sum(1.0 / distance) END, 6) AS distance_contribution FROM n WHERE true GROUP BY query_id".replace("1.0 / distance", "1.0 / greatest(distance, 1e-300)"))
def distance_contributions(spark, d):
    return rounded(r.distance_contribution(near(spark, d)))


@query(NEAR + "SELECT query_id, list_sort(list_distinct(list(p_brand))) AS \"values\" FROM i WHERE weight > 0 GROUP BY query_id".replace("list_sort(list_distinct(list(p_brand)))", "array_to_string(list_sort(list_distinct(list(p_brand))), ',')"))
def relevant_values(spark, d):
    return r.relevant_values(near(spark, d), "p_brand", "nominal").select("query_id", F.array_join("values", ",").alias("values"))


@query(NEAR + ", s AS (SELECT query_id, min(p_retailprice) AS local_min, max(p_retailprice) AS local_max FROM n GROUP BY 1) SELECT query_id, round(p_retailprice, 6) AS value, round(local_min, 6) AS local_min, round(local_max, 6) AS local_max FROM s JOIN q ON q.p_partkey = query_id WHERE p_retailprice < local_min OR p_retailprice > local_max")
def outlying_values(spark, d):
    q, _ = split(spark, d)
    return rounded(r.outlying_values(q, near(spark, d), "p_retailprice", ID))


MEAN = ", m AS (SELECT query_id, sum(weight * p_retailprice) AS mean FROM i GROUP BY 1)"


@query(NEAR + MEAN + ", v AS (SELECT query_id, sum(weight * abs(p_retailprice - mean)) AS local_mad, any_value(mean) AS mean FROM i JOIN m USING (query_id) GROUP BY 1) SELECT query_id, CASE WHEN round(abs(q.p_retailprice - mean), 9) = 0 THEN 'Infinity'::DOUBLE ELSE round(local_mad / round(abs(q.p_retailprice - mean), 9), 6) END AS density_conviction, round(local_mad, 6) AS local_mad FROM v JOIN q ON q.p_partkey = query_id")
def density_convictions(spark, d):
    q, _ = split(spark, d)
    return rounded(r.density_conviction(q, near(spark, d), "p_retailprice", ID))


@query(NEAR + ", t AS (SELECT *, sum(weight * p_retailprice) OVER (PARTITION BY query_id) AS s FROM i), u AS (SELECT query_id, case_id, CASE WHEN 1 - weight > 1e-9 THEN s - (s - weight * p_retailprice) / (1 - weight) END AS x FROM t) SELECT query_id, case_id, round(x, 4) AS directional, round(abs(x), 4) AS contribution FROM u")
def case_contributions(spark, d):
    return rounded(r.case_contributions(near(spark, d), "p_retailprice"), 4)


@query(NEAR + ", g AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY p_retailprice DESC, rank) AS k FROM n), h AS (SELECT *, CASE WHEN min(distance) OVER (PARTITION BY query_id) = 0 THEN CASE WHEN distance = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / distance END AS r2 FROM g WHERE k <= 3) SELECT query_id, round(sum(r2 * p_retailprice) / sum(r2), 6) AS p_retailprice FROM h GROUP BY query_id")
def goal_seeking(spark, d):
    return rounded(r.goal_seek(near(spark, d), "p_retailprice", "max", 3, "p_retailprice"))


@query(NEAR + PROBS + ", b AS (SELECT q.*, best.class FROM q JOIN best ON q.p_partkey = best.query_id), bd AS (SELECT q.p_partkey AS query_id, c.p_partkey AS case_id, " + DISTANCE + " AS distance, c.p_brand FROM b AS q JOIN c ON q.class <> c.p_brand AND q.p_partkey <> c.p_partkey), bn AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, case_id) AS rank FROM bd) SELECT query_id, case_id, round(distance, 6) AS distance, rank, p_brand FROM bn WHERE rank <= 3")
def boundary_cases(spark, d):
    q, c = split(spark, d)
    got = r.predict_nominal(near(spark, d), "p_brand")
    return rounded(r.boundary_cases(q, c, metric_of(c, CONTEXTS), got, "p_brand", 3, id_column=ID))


@query(sql_near(DISTANCE.replace("q.p_size", "25")) .replace("WITH q AS", "WITH q AS") + ", s AS (SELECT query_id, sum(weight * p_retailprice) AS if_changed FROM i GROUP BY 1) SELECT query_id, round(if_changed, 6) AS if_changed FROM s")
def hypothetical_values(spark, d):
    q, c = split(spark, d)
    return rounded(r.hypothetical(q, c, metric_of(c, CONTEXTS), "p_retailprice", {"p_size": 25}, 10, ID).select("query_id", "if_changed"))


@query(NEAR + "SELECT q.p_partkey AS query_id, CAST(any_value(q.p_size) AS BIGINT) AS p_size, round(2 * sum(i.weight * i.p_retailprice), 6) AS p_retailprice, round(2 * sum(i.weight * i.p_retailprice) - any_value(q.p_size), 6) AS margin FROM i JOIN q ON q.p_partkey = i.query_id GROUP BY 1")
def react_with_expressions(spark, d):
    q, c = split(spark, d)
    got = r.react(q, c, metric_of(c, CONTEXTS), {"p_retailprice": "continuous"}, 10, id_column=ID, return_contexts=["p_size"], post_process={"p_retailprice": "2 * p_retailprice"})
    return rounded(got.withColumn("margin", F.expr("p_retailprice - p_size")))


@query(sql_near(k=1) + ", cc AS (SELECT * FROM c), own AS (SELECT case_id FROM n), e AS (SELECT a.p_partkey AS case_id, min(CAST(abs(a.p_size - b.p_size) AS DOUBLE) + CASE WHEN a.p_type = b.p_type THEN 0.0 ELSE 1.0 END + abs(a.p_retailprice - b.p_retailprice)) AS d FROM cc AS a JOIN cc AS b ON a.p_partkey <> b.p_partkey WHERE a.p_partkey IN (SELECT case_id FROM own) GROUP BY 1) SELECT case_id, round(d, 6) AS nearest FROM e")
def nearest_of_neighbours(spark, d):
    q, c = split(spark, d)
    first = knn(q, c, metric_of(c, CONTEXTS), 1, id_column=ID).select(F.col("case_id").alias(ID)).distinct()
    some = c.join(first, ID, "left_semi")
    m = metric_of(c, [*CONTEXTS, "p_retailprice"])
    return rounded(knn(some, c, m, 1, id_column=ID).select(F.col("query_id").alias("case_id"), F.col("distance").alias("nearest")))


@query("SELECT a.p_partkey AS p_partkey, round(CAST(abs(a.p_size - b.p_size) AS DOUBLE) + CASE WHEN a.p_type = b.p_type THEN 0.0 ELSE 1.0 END, 6) AS distance FROM part AS a, (SELECT * FROM part WHERE p_partkey = (SELECT min(p_partkey) FROM part)) AS b")
def pairwise_distances(spark, d):
    df = part(spark, d)
    first = df.join(F.broadcast(df.agg(F.min(ID).alias(ID))), ID, "left_semi")
    return rounded(pairwise(df, first, metric_of(df, CONTEXTS), [ID]))


@query(ALL + PROBS + "SELECT query_id, p_brand AS actual, best.class AS predicted, round(coalesce((SELECT p FROM pr WHERE pr.query_id = best.query_id AND pr.class = part.p_brand), 0.0), 6) AS p_true FROM best JOIN part ON p_partkey = query_id")
def leave_one_out_classes(spark, d):
    df = part(spark, d)
    return rounded(leave_one_out(df, metric_of(df, CONTEXTS), "p_brand", "nominal", 10, id_column=ID))
