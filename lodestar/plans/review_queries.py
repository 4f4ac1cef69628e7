"""Queries over contained names, scored candidates and the review queue, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import review
from lodestar.plans import adapters as A
from lodestar.plans.entity_queries import GRAMS

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


NAMES = "SELECT DISTINCT p_name AS company_id, p_name AS name FROM part"
CALLED = "SELECT DISTINCT p_name AS company_id, substr(p_name, 3) || ' of ' || p_name AS alias FROM part UNION SELECT DISTINCT p_name, p_type FROM part WHERE p_size > 25"
SOUGHT = "SELECT DISTINCT substr(p_name, 3, 4) AS sponsor FROM part UNION SELECT DISTINCT p_name FROM part UNION SELECT DISTINCT substr(p_name, 1, 2) FROM part UNION SELECT DISTINCT lower(p_type) FROM part"
SIM = "coalesce(len(list_intersect({0}, {1})) / nullif(CAST(len({0}) + len({1}) - len(list_intersect({0}, {1})) AS DOUBLE), 0), 0)"


@query(
    f"""WITH c AS (SELECT *, {GRAMS.format('name')} AS gn FROM ({NAMES})), a AS (SELECT *, {GRAMS.format('lower(alias)')} AS ga FROM ({CALLED})), q AS (SELECT *, {GRAMS.format('sponsor')} AS gq FROM ({SOUGHT})),
  r AS (SELECT sponsor, c.company_id, c.name, alias, {SIM.format('gn', 'gq')} AS sn, {SIM.format('ga', 'gq')} AS sa FROM q CROSS JOIN c LEFT JOIN a ON a.company_id = c.company_id),
  k AS (SELECT sponsor, company_id, name, max(greatest(sn, sa)) AS sim_name, max(CASE WHEN starts_with(lower(alias), sponsor) THEN 1 ELSE 0 END) AS alias_prefix_hit FROM r
    WHERE sn >= 3e-1 OR sa >= 3e-1 OR contains(name, sponsor) OR contains(lower(alias), sponsor) GROUP BY ALL)
  SELECT sponsor, company_id, round(sim_name, 6) AS sim_name, CAST(alias_prefix_hit AS INT) AS alias_prefix_hit, CAST(row_number() OVER (PARTITION BY sponsor ORDER BY alias_prefix_hit DESC, sim_name DESC, company_id) AS INT) AS rank FROM k QUALIFY rank <= 10"""
)
def er3b_containment(spark, sf_dir):
    found = review.containment_candidates(A.select(spark, sf_dir, SOUGHT, "part"), A.select(spark, sf_dir, NAMES, "part"), A.select(spark, sf_dir, CALLED, "part"), k=10)
    return found.select("sponsor", "company_id", F.round("sim_name", 6).alias("sim_name"), "alias_prefix_hit", "rank")


QUEUE = "SELECT o_orderkey AS rq_id, 'run' AS run_id, 'NCT' || CAST(o_custkey AS VARCHAR(20)) AS nct_id, 'Acme ' || CAST(o_custkey % 50 AS VARCHAR(20)) || CASE o_orderkey % 2 WHEN 0 THEN ', Inc.' ELSE '' END AS sponsor, o_custkey AS first_id, o_orderkey % 4 AS n, o_orderdate AS created_at FROM orders"


def queue(spark, sf_dir):
    q = A.select(spark, sf_dir, QUEUE, "orders")
    made = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct((F.col("first_id") + i).alias("company_id"), F.when(i == F.col("n"), 0.9).alias("p")))
    return q.withColumn("candidates", F.slice(made, F.lit(1), F.col("n").cast("int"))).drop("first_id", "n")


NORM = "'acme ' || (o_custkey % 50) || CASE o_orderkey % 2 WHEN 0 THEN ' inc' ELSE '' END"


@query("SELECT 'review' AS run_id, 'NCT' || o_custkey AS nct_id, o_custkey AS company_id, 'p1' AS decided_by, 1.0::DOUBLE AS p, '{\"source\":\"review\",\"rq_id\":' || o_orderkey || '}' AS leader_meta FROM orders WHERE o_orderkey % 3 = 0")
def er12_review_accept(spark, sf_dir):
    q = queue(spark, sf_dir)
    picked = A.tables(spark, sf_dir, "orders")["orders"].where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("rq_id"), F.explode(F.array(F.col("o_custkey"), F.col("o_custkey") + 7)).alias("company_id"), F.lit("p1").alias("decided_by"))
    aliases = spark.createDataFrame([], "company_id long, alias string")
    return review.accept(q, picked, aliases, F.lit("review"))[0].select("run_id", "nct_id", "company_id", "decided_by", "p", "leader_meta")


@query(f"SELECT 'label' AS what, 'NCT' || o_custkey AS nct_id, {NORM} AS sponsor_text_norm, o_custkey + o_orderkey % 4 AS company_id FROM orders WHERE o_orderkey % 3 = 1 AND o_orderkey % 4 > 0 UNION ALL SELECT 'left', 'NCT' || o_custkey, NULL, NULL FROM orders WHERE o_orderkey % 3 <> 1")
def er12_review_reject(spark, sf_dir):
    q = queue(spark, sf_dir)
    labels, left = review.reject(q, q.where("rq_id % 3 = 1").select("rq_id"), label=True)
    none = left.select(F.lit("left").alias("what"), "nct_id", F.lit(None).cast("string").alias("sponsor_text_norm"), F.lit(None).cast("long").alias("company_id"))
    return labels.select(F.lit("label").alias("what"), "nct_id", "sponsor_text_norm", "company_id").unionAll(none)


@query("SELECT 'NCT' || o_custkey AS nct_id, CAST(o_orderkey % 4 AS INT) AS n_cands, o_orderkey AS rq_id FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20")
def er12_review_list(spark, sf_dir):
    return review.pending(queue(spark, sf_dir)).select("nct_id", "n_cands", "rq_id")


@query(f"SELECT 'r1' AS run_id, 'NCT' || o_custkey AS nct_id, {NORM} AS sponsor_text_norm, o_custkey AS company_id, '{{\"jw\":0.5,\"same\":' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END || '}}' AS features_jsonb, CAST(NULL AS DOUBLE) AS score_precal, 0.25::DOUBLE AS p_calibrated FROM orders")
def snk4_candidate_rows(spark, sf_dir):
    scored = A.select(spark, sf_dir, QUEUE, "orders").select("nct_id", "sponsor", F.col("first_id").alias("company_id"), F.lit(0.25).alias("p"), F.lit(0.5).alias("jw"), (F.col("rq_id") % 2 == 0).alias("same"))
    return review.candidate_rows(scored, F.lit("r1"), ["jw", "same"])
