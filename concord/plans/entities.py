"""Queries of entity mapping: identity, clusters, resolution, deltas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mapping, transform
from .registry import query, table

# Records of two systems: customers and suppliers. They share an identity where nation and rounded balance agree.
RECORDS = """WITH RECURSIVE rec AS (
  SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, floor(c_acctbal / 50)::BIGINT AS bucket, 'crm' AS source, 1 AS priority FROM customer
  UNION ALL
  SELECT 1000000 + s_suppkey, s_name, s_nationkey, floor(s_acctbal / 50)::BIGINT, 'erp', 2 FROM supplier
), ident AS (SELECT id, nation || ':' || bucket AS v FROM rec WHERE id % 7 <> 0),
star AS (SELECT m.a, i.id AS b FROM ident i JOIN (SELECT v, min(id) AS a FROM ident GROUP BY v) m USING (v) WHERE m.a <> i.id),
chain AS (SELECT r.id - 500 AS a, r.id AS b FROM rec r WHERE r.id % 11 = 0 AND r.id - 500 IN (SELECT id FROM rec)),
edges AS (SELECT a, b FROM star UNION SELECT a, b FROM chain)
"""
CLUSTERS = RECORDS + """, twoway AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
walk(n, r) AS (SELECT id, id FROM rec UNION SELECT b.b, w.r FROM walk w JOIN twoway b ON b.a = w.n WHERE b.b > w.r),
cluster AS (SELECT n AS id, min(r) AS cluster_id FROM walk GROUP BY n)
"""


def records(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 50).alias("bucket"), F.lit("crm").alias("source"), F.lit(1).alias("priority"))
    s = table(spark, d, "supplier").select((F.col("s_suppkey") + 1_000_000).alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 50).alias("bucket"), F.lit("erp").alias("source"), F.lit(2).alias("priority"))
    return c.unionByName(s)


def edges(spark, d):
    rec = records(spark, d)
    shared = F.when(F.col("id") % 7 != 0, F.concat_ws(":", "nation", "bucket"))
    star = mapping.identity_edges(rec, "id", {"place": shared})
    later = rec.where("id % 11 = 0").select((F.col("id") - 500).alias("a"), F.col("id").alias("b"))
    return star.union(later.join(rec.select(F.col("id").alias("a")), "a", "left_semi").select("a", "b")).distinct()


def clustered(spark, d):
    rec = records(spark, d)
    return rec.join(mapping.clusters(edges(spark, d), rec, "id"), "id")


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_name AS _base_name FROM customer")
def forward_view(spark, d):
    made = transform.rename_fields(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"})
    return made.withColumn("_base_name", F.col("name"))


@query("SELECT c_custkey, 'R:' || c_name AS c_name, c_mktsegment FROM customer")
def reverse_view(spark, d):
    resolved = forward_view(spark, d).withColumn("name", F.concat(F.lit("R:"), "name")).drop("_base_name")
    return transform.rename_fields(resolved, {"id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"})


@query(RECORDS + "SELECT a, b FROM edges")
def identity_edges(spark, d):
    return edges(spark, d)


@query(CLUSTERS + "SELECT id, cluster_id FROM cluster")
def clusters(spark, d):
    return mapping.clusters(edges(spark, d), records(spark, d), "id")


@query(CLUSTERS + "SELECT cluster_id, min(priority) AS best, arg_min(name, priority * 10000000 + id) AS name FROM cluster JOIN rec USING (id) GROUP BY 1")
def resolve_coalesce(spark, d):
    rank = F.col("priority") * 10_000_000 + F.col("id")
    return clustered(spark, d).groupBy("cluster_id").agg(F.min("priority").alias("best"), mapping.coalesce_by(F.col("name"), rank).alias("name"))


@query(CLUSTERS + "SELECT cluster_id, arg_max(name, id) AS name FROM cluster JOIN rec USING (id) GROUP BY 1")
def resolve_last_modified(spark, d):
    return clustered(spark, d).groupBy("cluster_id").agg(mapping.last_modified(F.col("name"), F.col("id")).alias("name"))


@query(CLUSTERS + "SELECT cluster_id, upper(min(name)) || '/' || count(*) AS label FROM cluster JOIN rec USING (id) GROUP BY 1")
def resolve_expression(spark, d):
    return clustered(spark, d).groupBy("cluster_id").agg(F.concat_ws("/", F.upper(F.min("name")), F.count("*")).alias("label"))


@query(CLUSTERS + "SELECT cluster_id, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM cluster JOIN rec USING (id) GROUP BY 1")
def resolve_collect(spark, d):
    return clustered(spark, d).groupBy("cluster_id").agg(F.array_join(mapping.collected(F.col("source")), ",").alias("sources"))


@query(CLUSTERS + "SELECT cluster_id, bool_or(bucket > 150) AS rich FROM cluster JOIN rec USING (id) GROUP BY 1")
def resolve_bool_or(spark, d):
    return clustered(spark, d).groupBy("cluster_id").agg(F.bool_or(F.col("bucket") > 150).alias("rich"))


@query(CLUSTERS + "SELECT cluster_id, arg_max(name, id) AS name, arg_max(nation, id) AS nation FROM cluster JOIN rec USING (id) GROUP BY 1")
def resolve_group(spark, d):
    """Name and nation from one and the same record."""
    group = mapping.last_modified(F.struct("name", "nation"), F.col("id"))
    return clustered(spark, d).groupBy("cluster_id").agg(group.alias("g")).select("cluster_id", "g.name", "g.nation")


@query("""WITH new AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal >= 1000),
old AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'old' ELSE c_name END AS name FROM customer WHERE c_acctbal < 8000)
SELECT id, CASE WHEN o.name IS NULL THEN 'insert' WHEN n.name IS NULL THEN 'delete' WHEN o.name = n.name THEN 'noop' ELSE 'update' END AS _action, n.name FROM new n FULL OUTER JOIN old o USING (id)""")
def delta_classify(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_acctbal")
    base = c.where("c_acctbal < 8000").withColumn("name", F.when(F.col("id") % 4 == 0, "old").otherwise(F.col("name")))
    return mapping.delta(c.where("c_acctbal >= 1000"), base, "id", ["name"])


@query(CLUSTERS + "SELECT o_orderkey, cluster_id FROM orders JOIN cluster ON o_custkey = id")
def fk_resolve(spark, d):
    found = mapping.clusters(edges(spark, d), records(spark, d), "id")
    return table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("id")).join(found, "id").select("o_orderkey", "cluster_id")


@query("SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part, count(*) OVER (PARTITION BY l_orderkey) AS lines FROM lineitem")
def nested_explode(spark, d):
    """Lines nested into their orders, and taken out again."""
    nested = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part")))).alias("items"))
    each = nested.select("order_id", F.size("items").cast("long").alias("lines"), F.explode("items").alias("i"))
    return each.select("order_id", "i.line", "i.part", "lines")


@query(RECORDS + """, forced AS (SELECT id AS a, id + 1 AS b FROM rec WHERE id % 50 = 0 AND id < 1000000)
SELECT a, b FROM (SELECT a, b FROM edges UNION SELECT a, b FROM forced) WHERE NOT (a % 4 = 0 AND b % 3 = 0)""")
def edge_overrides(spark, d):
    forced = records(spark, d).where("id % 50 = 0 and id < 1000000").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    wanted = edges(spark, d).union(forced).distinct()
    blocked = wanted.where("a % 4 = 0 and b % 3 = 0")
    return wanted.join(blocked, ["a", "b"], "left_anti")


@query(CLUSTERS + """, sized AS (SELECT source, count(*) OVER (PARTITION BY cluster_id) AS n FROM cluster JOIN rec USING (id))
SELECT source, count(*) AS records, count(*) FILTER (WHERE n = 1) AS singletons, round(count(*) FILTER (WHERE n = 1) / count(*), 4) AS ratio FROM sized GROUP BY 1""")
def singleton_ratio(spark, d):
    rows = clustered(spark, d)
    sizes = rows.groupBy("cluster_id").agg(F.count("*").alias("n"))
    alone = F.count_if(F.col("n") == 1)
    return rows.join(sizes, "cluster_id").groupBy("source").agg(F.count("*").alias("records"), alone.alias("singletons"), F.round(alone / F.count("*"), 4).alias("ratio"))
