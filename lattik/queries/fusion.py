"""Fusion, entity resolution, crosswalks, minting and observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.functions import text as t
from lattik.operators import fuse
from lattik.queries import query, table

#: Three views of suppliers that disagree by rule.
VIEWS = """(SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 <> 0 THEN 1900 + s_suppkey % 90 END AS a, CASE WHEN s_suppkey % 4 <> 0 THEN 1900 + s_suppkey % 90 + (s_suppkey % 7 = 0)::INTEGER * 2 END AS b,
CASE WHEN s_suppkey % 5 = 0 THEN 1950 END AS c FROM supplier)"""


def views(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    year = (1900 + k % 90).cast("int")
    return table(spark, sf, "supplier").select(
        k.alias("k"), F.when(k % 3 != 0, year).alias("a"), F.when(k % 4 != 0, year + F.when(k % 7 == 0, 2).otherwise(0)).alias("b"), F.when(k % 5 == 0, 1950).alias("c")
    )


@query(f"""SELECT k, least(a, b, c)::INTEGER AS founded, coalesce(a, b, c)::INTEGER AS preferred, CASE WHEN a IS NOT NULL THEN 'a' WHEN b IS NOT NULL THEN 'b' WHEN c IS NOT NULL THEN 'c' END AS source,
CASE WHEN len(list_distinct(list_filter([a, b, c], lambda x: x IS NOT NULL))) = 1 THEN coalesce(a, b, c)::INTEGER END AS agreed FROM {VIEWS}""")
def fus03_precedence(spark: SparkSession, sf: str) -> DataFrame:
    """Earliest of the sources, first of the sources, and the value only where they agree (FUS03, FUS04, AGG16, AGG17, WIN02)."""
    v = views(spark, sf).withColumn("p", fuse.first_of(("a", F.col("a")), ("b", F.col("b")), ("c", F.col("c"))))
    return v.select("k", F.least("a", "b", "c").alias("founded"), F.col("p.value").alias("preferred"), F.col("p.source").alias("source"), fuse.unique_or_null(F.array("a", "b", "c")).alias("agreed"))


@query(f"""SELECT k AS entity, 'founded' AS field, least(a, b, c)::VARCHAR AS chosen, concat_ws('; ', 'a=' || a, 'b=' || b, 'c=' || c) AS candidates FROM {VIEWS}
WHERE len(list_distinct(list_filter([a, b, c], lambda x: x IS NOT NULL))) > 1""")
def fus03_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return fuse.conflicts(views(spark, sf), "k", "founded", F.least("a", "b", "c"), [(n, F.col(n)) for n in "abc"])


@query(f"SELECT k AS entity, 'founded' AS field, c::VARCHAR AS value, 'c' AS source FROM {VIEWS} WHERE a IS NULL AND b IS NULL AND c IS NOT NULL")
def fus03_filled(spark: SparkSession, sf: str) -> DataFrame:
    return fuse.filled(views(spark, sf), "k", "founded", F.coalesce("a", "b"), ("c", F.col("c")))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def win01_latest(spark: SparkSession, sf: str) -> DataFrame:
    return fuse.latest(table(spark, sf, "events"), "user_id", F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type")


@query("""SELECT p_type AS name, max_by(p_partkey, struct_pack(r := p_size, k := p_partkey)) AS key, array_to_string(list_sort(list_distinct(list(p_brand))), ',') AS brands, count(*) AS n,
max_by(CASE WHEN p_partkey % 2 = 0 THEN p_name END, CASE WHEN p_partkey % 2 = 0 THEN struct_pack(r := p_size, k := p_partkey) END) AS label FROM part GROUP BY 1""")
def fus17_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Merging records of one name: keeper, filled blanks, united sets (FUS17, AGG20, WIN04, GRF21)."""
    rows = table(spark, sf, "part").select(F.col("p_type").alias("name"), F.col("p_partkey").alias("key"), "p_size", F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("label"), F.array("p_brand").alias("brands"))
    out = fuse.merge_duplicates(rows, "name", "key", [F.col("p_size")], ["label"], ["brands"])
    return out.select("name", "key", F.array_join("brands", ",").alias("brands"), F.size("merged").cast("bigint").alias("n"), "label")


@query("""WITH b AS (SELECT p_partkey AS key, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') AS base FROM part),
r AS (SELECT key, base, row_number() OVER (PARTITION BY base ORDER BY key) AS k FROM b) SELECT key, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS uri FROM r""")
def win07_mint(spark: SparkSession, sf: str) -> DataFrame:
    return fuse.mint(table(spark, sf, "part"), t.slug(F.col("p_type")), "p_partkey")


@query("""SELECT c_custkey, CASE WHEN c_nationkey >= 20 AND c_nationkey % 2 = 1 THEN c_nationkey - 20 ELSE c_nationkey END AS nation FROM customer""")
def jon19_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    merged = table(spark, sf, "nation").where("n_nationkey >= 20 AND n_nationkey % 2 = 1").select(F.col("n_nationkey").alias("old"), (F.col("n_nationkey") - 20).alias("new"))
    return fuse.crosswalk(table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation")), "nation", merged, "old", "new")


@query("""SELECT k AS key, x, y FROM (SELECT s_suppkey AS k, s_name AS x FROM supplier WHERE s_suppkey % 2 = 0) FULL JOIN (SELECT c_custkey AS k, c_name AS y FROM customer WHERE c_custkey % 3 = 0) USING (k)""")
def jon11_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("x"))
    return a.join(table(spark, sf, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("y")), "key", "full")


@query("""SELECT c_custkey, coalesce(n1, n2) AS place FROM customer LEFT JOIN (SELECT n_nationkey AS k, n_name AS n1 FROM nation WHERE n_nationkey % 2 = 0) a ON a.k = c_nationkey
LEFT JOIN (SELECT r_regionkey AS k, r_name AS n2 FROM region) b ON b.k = c_nationkey % 5""")
def jon13_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Exact key first, then a weaker one (JON13, JON15)."""
    exact = table(spark, sf, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("n1"))
    weak = table(spark, sf, "region").select(F.col("r_regionkey").alias("w"), F.col("r_name").alias("n2"))
    rows = table(spark, sf, "customer").withColumn("w", F.col("c_nationkey") % 5)
    return rows.join(F.broadcast(exact), "c_nationkey", "left").join(F.broadcast(weak), "w", "left").select("c_custkey", F.coalesce("n1", "n2").alias("place"))


@query("""SELECT page_id, max_by(lang, struct_pack(n := length(lang), l := lang)) AS lang FROM pages JOIN (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL) ON contains(url, '/' || lang || '/') GROUP BY 1""")
def jon14_longest_contained(spark: SparkSession, sf: str) -> DataFrame:
    """The longest key that a text contains; the keys are a small dimension, its size is checked by the planner."""
    keys = table(spark, sf, "documents").where("lang IS NOT NULL").select("lang").distinct()
    hits = table(spark, sf, "pages").select("page_id", "url").join(keys, F.expr("contains(url, concat('/', lang, '/'))"))
    return hits.groupBy("page_id").agg(F.max_by("lang", F.struct(F.length("lang").alias("n"), F.col("lang").alias("l"))).alias("lang"))


@query("""SELECT sha256(concat_ws('|', 'urn:kg:order/' || o_orderkey, 'status', o_orderstatus, strftime(o_orderdate, '%Y-%m-%d'), '', 'orders')) AS id, o_orderkey AS k, 'qualified' AS status FROM orders""")
def fus25_observations(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders")
    seen = fuse.observation(rows, F.concat(F.lit("urn:kg:order/"), F.col("o_orderkey").cast("string")), "status", F.col("o_orderstatus"), F.col("o_orderdate").cast("date"), F.lit(None).cast("date"), "orders")
    return seen.select("id", F.substring_index("subject", "/", -1).cast("bigint").alias("k"), "status")
