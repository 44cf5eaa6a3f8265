"""Registered checks of what the library does beyond the driver's memory and one pass per model:
labels as a table, sparse features, components by distributed products, shared-pass searches,
weighted replicates, salted joins, swapped tables and resumed runs."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from rarebird.operators.features import FEATURES, SCALE_CENTRED, inference_features, prepare
from rarebird.operators.clustering import KMEANS, MIXTURE, cluster
from rarebird.operators.enrich import enrich
from rarebird.operators.shared_search import silhouettes
from rarebird.operators.wide import BlockPCA, category_table
from rarebird.plans import jobs
from rarebird.session import shared_path
from rarebird.plans.registry import (
    CHECK_MOMENT,
    ORACLES,
    SEPARATED_SQL,
    _job_table,
    _share_sql,
    check_table,
    lineitem,
    monitoring_check,
    register,
    rounded,
    segment_keys,
    separated,
    table,
)

# --------------------------------------------------------------------------- F1 / F8

_LABELLED = ["l_partkey", "l_suppkey", "l_returnflag"]


@register("category_index_table", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS label, count(*) AS row_count,
       CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS BIGINT) AS category_index
FROM lineitem GROUP BY {c}""" for c in _LABELLED))
def q_category_index_table(spark, sf_dir):
    """Every label of three columns ranked by a range-partitioned sort, none of them on the driver."""
    return category_table(table(spark, sf_dir, "lineitem").select(*_LABELLED), _LABELLED)


@register("wide_features", """
WITH c AS (SELECT o_custkey AS v, row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS i FROM orders GROUP BY o_custkey),
p AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, 1 + (SELECT count(*) FROM c) + (SELECT count(*) FROM p) AS width, o_totalprice AS price,
       CAST(1 + c.i AS BIGINT) AS customer_slot, CAST(1 + (SELECT count(*) FROM c) + p.i AS BIGINT) AS priority_slot
FROM orders JOIN c ON c.v = o_custkey JOIN p ON p.v = o_orderpriority
""")
def q_wide_features(spark, sf_dir):
    """A slot per customer: sparse vectors encoded by joins with the label table."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderpriority")
    feats = inference_features(o, ["o_custkey", "o_orderpriority"], "o_orderkey", wide=True)
    v = F.unwrap_udt(FEATURES)
    return feats.select(
        "o_orderkey", v["size"].cast("bigint").alias("width"), v["values"][0].alias("price"),
        v["indices"][1].cast("bigint").alias("customer_slot"), v["indices"][2].cast("bigint").alias("priority_slot"))


# --------------------------------------------------------------------------- F7


@register("pca_wide_two_columns", ORACLES["pca_two_columns"])
def q_pca_wide_two_columns(spark, sf_dir):
    """The components of ``pca_two_columns`` by distributed products, centred after the projection."""
    li = lineitem(spark, sf_dir).select("line_id", "l_quantity", "l_extendedprice")
    arr = vector_to_array(F.col(FEATURES))
    frame = prepare(li, None, "line_id", scale=SCALE_CENTRED, pca_k=2, wide=True).frame
    return frame.select("line_id", rounded(F.abs(arr[0]), 4).alias("pc_abs_0"), rounded(F.abs(arr[1]), 4).alias("pc_abs_1"))


_SLOTS = 2000


@register("pca_wide_rank_one", f"""
SELECT s_suppkey, round(abs(s_acctbal) * sqrt((SELECT sum(1.0::DOUBLE / (j * j)) FROM range(1, {_SLOTS + 1}) t(j))), 4) AS pc_abs,
       1.0::DOUBLE AS explained FROM supplier
""")
def q_pca_wide_rank_one(spark, sf_dir):
    """2,000 columns that are multiples of one: the first component has a closed form and explains all."""
    slots = F.transform(F.sequence(F.lit(1), F.lit(_SLOTS)), lambda j: F.col("s_acctbal") / j)
    df = table(spark, sf_dir, "supplier").select("s_suppkey", array_to_vector(slots).alias("v"))
    model = BlockPCA(1, "v", FEATURES).fit(df)
    return model.transform(df).select(
        "s_suppkey", F.round(F.abs(vector_to_array(F.col(FEATURES))[0]), 4).alias("pc_abs"),
        F.round(F.lit(float(model.explainedVariance[0])), 8).alias("explained"))


# --------------------------------------------------------------------------- M5 / M7 / M8

_LABELINGS = {"nation": "c_nationkey", "fifth": "c_nationkey % 5", "pair": "c_custkey % 2"}


@register("silhouettes_shared_passes", " UNION ALL ".join(f"""
SELECT '{name}' AS labeling, round(avg(CASE WHEN own_n = 1 THEN 0.0 WHEN a_dis < b_dis THEN 1 - a_dis / b_dis
                  WHEN a_dis > b_dis THEN b_dis / a_dis - 1 ELSE 0.0 END), 8) AS silhouette FROM (
  SELECT rid, max(CASE WHEN other = own THEN n END) AS own_n,
         max(CASE WHEN other = own AND n > 1 THEN dis * n / (n - 1) END) AS a_dis, min(CASE WHEN other <> own THEN dis END) AS b_dis
  FROM (SELECT p.rid, p.c AS own, cs.c AS other, cs.n, p.x * p.x + cs.sq / cs.n - 2 * (p.x * cs.sx) / cs.n AS dis
        FROM (SELECT c_custkey AS rid, {label} AS c, c_acctbal AS x FROM customer) p
        CROSS JOIN (SELECT {label} AS c, count(*) AS n, sum(c_acctbal) AS sx, sum(c_acctbal * c_acctbal) AS sq FROM customer GROUP BY 1) cs)
  GROUP BY rid)""" for name, label in _LABELINGS.items()))
def q_silhouettes_shared_passes(spark, sf_dir):
    """Silhouettes of three labelings of the customers' balances from the same two passes."""
    c = table(spark, sf_dir, "customer").select(
        array_to_vector(F.array("c_acctbal")).alias(FEATURES), *[F.expr(label).alias(name) for name, label in _LABELINGS.items()])
    return spark.createDataFrame(list(zip(_LABELINGS, silhouettes(c, list(_LABELINGS)))), "labeling string, silhouette double").select(
        "labeling", F.round("silhouette", 8).alias("silhouette"))


@register("kmeans_shared_search", ORACLES["kmeans_separated"])
def q_kmeans_shared_search(spark, sf_dir):
    """The search of ``kmeans_separated`` over 2..6, all candidates scored in shared passes."""
    feats = prepare(separated(spark, sf_dir).select("line_id", "x1", "x2"), None, "line_id", scale=SCALE_CENTRED).frame
    fit = cluster(feats, KMEANS, k=0, ks=range(2, 7), shared=True)
    return segment_keys(fit.scored).withColumn("n_segments", F.lit(fit.k).cast("bigint"))


@register("mixture_shared_search", "SELECT CAST(k AS BIGINT) AS k, true AS same_score, true AS same_rows FROM range(2, 5) t(k)")
def q_mixture_shared_search(spark, sf_dir):
    """Every candidate of a shared search scores as a search of its own does, over all lineitems (a few
    rounds: later on, rounding alone may part the ways of two runs)."""
    li = lineitem(spark, sf_dir).select("line_id", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    feats = prepare(li, None, "line_id", scale=SCALE_CENTRED).frame.persist()
    together = cluster(feats, MIXTURE, ks=[2, 3, 4], max_iter=5, shared=True).search
    rows, n = [], feats.count()
    for k in (2, 3, 4):
        alone = cluster(feats, MIXTURE, ks=[k], max_iter=5, shared=False)
        a, b = together.scores[k], alone.silhouette  # None: a single cluster is in use
        rows.append((k, a is b is None or (None not in (a, b) and abs(a - b) < 1e-4), alone.scored.count() == n))
    feats.unpersist()
    return spark.createDataFrame(rows, "k long, same_score boolean, same_rows boolean")


# --------------------------------------------------------------------------- A1 / E3 / E6


def _poisson_steps(fraction: float) -> list[float]:
    import math

    out, term, total = [], math.exp(-fraction), 0.0
    while total < 1 - 1e-6:
        total += term
        out.append(round(total, 8))
        term *= fraction / len(out)
    return out


_DRAWS_SQL = f"""
WITH u AS (SELECT l_returnflag AS f, r, ('0x' || substr(md5('17:' || r || ':' || CAST(line_id AS VARCHAR)), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS u
  FROM ({SEPARATED_SQL}) sep, range(0, 3) t(r)),
w AS (SELECT f, r, list_sum(list_transform({_poisson_steps(1.0)}, lambda c: CASE WHEN u >= c THEN 1 ELSE 0 END)) AS w FROM u)"""


@register("bootstrap_segment_replicates", f"""{_DRAWS_SQL},
s AS (SELECT f, r, sum(w) AS n, sum(w) / sum(sum(w)) OVER (PARTITION BY r) * 100 AS share FROM w GROUP BY f, r)
SELECT CAST(r AS BIGINT) AS replicate, {_share_sql("share")} AS valor_indicador, '{CHECK_MOMENT}' AS id_momento, 'FRICCIONES' AS proyecto,
       'segmentacion_anomalias_fricciones_ent' AS modelo, 1 AS ejecucion, 2 AS id_indicador,
       'anomalias_gf_' || CAST(row_number() OVER (PARTITION BY r ORDER BY share) - 1 AS VARCHAR) AS nombre_indicador,
       CAST((SELECT sum(w) FROM w x WHERE x.r = s.r) AS BIGINT) AS drawn
FROM s
""")
def q_bootstrap_segment_replicates(spark, sf_dir):
    """Three replicates of the separated rows from one feature frame. Segments are the return flags, so
    the shares are the draws of each flag, row for row what the keyed weights say."""
    base = jobs.replicate_frame(spark, separated(spark, sf_dir).select("line_id", "x1", "x2"), None, "line_id")
    out = None
    reports = jobs.bootstrap_segment_replicates(spark, base, None, "line_id", range(3), k=3, seed=17, key="line_id", moment=CHECK_MOMENT)
    for number, report in enumerate(reports):
        rows = monitoring_check(report.metrics).select(
            F.lit(number).cast("long").alias("replicate"), "*", F.lit(report.result.count()).cast("long").alias("drawn"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("bootstrap_anomaly_replicates", f"""{_DRAWS_SQL.replace("17:", "23:").replace(str(_poisson_steps(1.0)), str(_poisson_steps(0.5)))}
SELECT CAST(r AS BIGINT) AS replicate, CAST(sum(w) AS BIGINT) AS drawn, 100.0::DOUBLE AS share_sum, CAST(3 AS BIGINT) AS k FROM w GROUP BY r
""")
def q_bootstrap_anomaly_replicates(spark, sf_dir):
    """Replicates of a mixture; the rows reported are the draws of each row, no more and no fewer."""
    base = jobs.replicate_frame(spark, separated(spark, sf_dir).select("line_id", "x1", "x2"), None, "line_id")
    rows = []
    for number, report in enumerate(jobs.bootstrap_anomaly_replicates(
            spark, base, None, "line_id", range(3), k=3, pca_k=2, seed=23, key="line_id", moment=CHECK_MOMENT, max_iter=5)):
        shares = report.metrics.where("id_indicador = 2").agg(F.round(F.sum(F.col("valor_indicador").cast("double")), 3)).first()[0]
        rows.append((number, report.result.count(), shares, report.k))
    return spark.createDataFrame(rows, "replicate long, drawn long, share_sum double, k long")


# --------------------------------------------------------------------------- S4 / S5 / E7 / E8


@register("composed_jobs_closed_form", f"""
WITH sep AS ({SEPARATED_SQL}),
e AS (SELECT line_id, floor(min(x1) / 10) AS f FROM sep GROUP BY line_id),
c AS (SELECT f, count(*) AS n, sum(line_id) AS s, min(line_id) AS k FROM e GROUP BY f),
r AS (SELECT *, n / (SELECT sum(n) FROM c) * 100 AS share, row_number() OVER (ORDER BY n) - 1 AS i FROM c)
SELECT t AS what, 'rows' AS label, count(*) AS n, CAST(sum(line_id) AS DOUBLE) AS value FROM sep, (VALUES ('flags train'), ('flags predict')) v(t) GROUP BY t
UNION ALL SELECT t, 'rows', count(*), CAST(sum(line_id) AS DOUBLE) FROM e, (VALUES ('enriched train'), ('enriched predict')) v(t) GROUP BY t
UNION ALL SELECT 'segments', CAST(k AS VARCHAR), n, CAST(s AS DOUBLE) FROM c
UNION ALL SELECT 'monitoring ' || m, 'anomalias_gf_1', 1, 100.0::DOUBLE FROM (VALUES ('anomalias_fricciones_ent'), ('anomalias_fricciones_pre')) v(m)
UNION ALL SELECT 'monitoring segmentacion_' || m, 'anomalias_gf_' || i, 1, {_share_sql("share", 3)} FROM r, (VALUES ('anomalias_fricciones_ent'), ('anomalias_fricciones_pre')) v(m)
""")
def q_composed_jobs_closed_form(spark, sf_dir):
    """E7 and E8 on separated rows, each called twice under one run id, everything read back from the tables.

    With a threshold above 1 every row is flagged, whatever the mixture is like, and the segments of
    separated rows are the return flags; so all that the two jobs store has a closed form.
    """
    separated(spark, sf_dir).createOrReplaceTempView("rarebird_closed_form")
    name = {n: check_table(spark, f"closed_{n}")[0] for n in ("anom", "anom_p", "enr", "enr_p", "seg", "mon_a", "mon_s", "runs")}
    root = shared_path(spark, "tables", "closed", unique=True)
    cross = "SELECT l.line_id, l.x1, l.x2 FROM {t} a JOIN rarebird_closed_form l ON a.line_id = CAST(l.line_id AS STRING)"
    models = [shared_path(spark, "models", f"closed_{m}", unique=True) for m in ("a", "s")]

    def config(flags: str, enriched: str) -> jobs.JobConfig:
        return jobs.JobConfig(
            anomaly_query="SELECT line_id, x1, x2 FROM rarebird_closed_form", anomaly_id="line_id", anomaly_categorical=[],
            segment_query=f"SELECT * FROM {name[enriched]}", segment_id="line_id", segment_categorical=[],
            enrich_query=cross.format(t=name[flags]), anomaly_pipeline=models[0], segment_pipeline=models[1],
            anomaly_exit_table=name[flags], enriched_table=name[enriched], segment_exit_table=name["seg"],
            anomaly_metric_table=name["mon_a"], segment_metric_table=name["mon_s"], threshold=1.5, dedupe_order=["x1", "x2"],
            table_root=root, ledger_table=name["runs"])

    for _ in range(2):
        jobs.training_job(spark, config("anom", "enr"), CHECK_MOMENT, on_error="raise", run_id="train-1",
                          anomaly_params={"pca_k": 2, "ks": [3], "max_iter": 5}, segment_params={"max_k": 4})
        jobs.prediction_job(spark, config("anom_p", "enr_p"), CHECK_MOMENT, on_error="raise", run_id="predict-1")
    out = None
    for what, t in (("flags train", "anom"), ("flags predict", "anom_p"), ("enriched train", "enr"), ("enriched predict", "enr_p")):
        rows = spark.table(name[t])
        rows = rows.where("anomalies = 1") if t.startswith("anom") else rows
        part = rows.agg(F.lit(what).alias("what"), F.lit("rows").alias("label"), F.count(F.lit(1)).alias("n"),
                        F.sum(F.col("line_id").cast("long")).cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    key = F.col("line_id").cast("long")
    segments = spark.table(name["seg"]).groupBy("prediction").agg(
        F.min(key).cast("string").alias("label"), F.count(F.lit(1)).alias("n"), F.sum(key).cast("double").alias("value"))
    out = out.unionByName(segments.select(F.lit("segments").alias("what"), "label", "n", "value"))
    for t in ("mon_a", "mon_s"):
        rows = spark.table(name[t]).where("id_indicador = 2").groupBy("modelo", "nombre_indicador").agg(
            F.count(F.lit(1)).alias("n"), rounded(F.max("valor_indicador").cast("double"), 3).alias("value"))
        out = out.unionByName(rows.select(F.concat(F.lit("monitoring "), "modelo").alias("what"), F.col("nombre_indicador").alias("label"), "n", "value"))
    return out
