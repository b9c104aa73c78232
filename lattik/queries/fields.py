"""Rules for single fields, list expansion, reports and comparisons, on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lattik.functions import text as t
from lattik.operators import fuse
from lattik.operators.closure import cut, list_members
from lattik.queries import query, table
from lattik.sources import sinks


@query("""SELECT p_partkey, array_to_string(CASE WHEN p_size = 1 THEN [] WHEN p_partkey % 3 = 0 THEN ['OFF'] ELSE
list_sort(list_distinct(list_filter([upper(p_type[1:3]), upper(p_name[1:3])], lambda x: regexp_matches(x, '^[A-Z]{3}$') AND x <> 'ECO'))) END, ',') AS codes FROM part""")
def fus08_codes(spark: SparkSession, sf: str) -> DataFrame:
    """An official code replaces those found in text; a defunct entity has none (FUS08)."""
    found = t.codes(F.concat_ws(" ", F.upper(F.substring("p_type", 1, 3)), F.upper(F.substring("p_name", 1, 3))), ("ECO",))
    none = F.array().cast("array<string>")
    codes = F.when(F.col("p_size") == 1, none).when(F.col("p_partkey") % 3 == 0, F.array(F.lit("OFF"))).otherwise(found)
    return table(spark, sf, "part").select("p_partkey", F.array_join(codes, ",").alias("codes"))


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([p_brand, p_type, p_name, upper(p_name[1:1])],
lambda x: length(x) BETWEEN 2 AND 15 AND NOT (x = lower(x) AND x <> upper(x))))), ',') AS short_names FROM part""")
def fus09_short_names(spark: SparkSession, sf: str) -> DataFrame:
    """Short names of all sources: 2 to 15 characters, not all in lower case (FUS09)."""
    names = fuse.short_names(F.array("p_brand", "p_type", "p_name", F.upper(F.substring("p_name", 1, 1))))
    return table(spark, sf, "part").select("p_partkey", F.array_join(names, ",").alias("short_names"))


SITES = """(SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 'http://a' || s_suppkey || '.example.org' END AS a,
CASE WHEN s_suppkey % 2 = 0 THEN 'http://b' || s_suppkey || '.example.org' END AS b FROM supplier)"""


def _sites(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    site = lambda name: t.norm_url(F.concat(F.lit(f"[{name}"), k.cast("string"), F.lit(".example.org] home")))
    return table(spark, sf, "supplier").select(k.alias("k"), F.when(k % 3 == 0, site("a")).alias("a"), F.when(k % 2 == 0, site("b")).alias("b"))


@query(f"SELECT k, coalesce(a, b) AS website, CASE WHEN a IS NOT NULL THEN 'a' WHEN b IS NOT NULL THEN 'b' END AS source FROM {SITES}")
def fus10_website(spark: SparkSession, sf: str) -> DataFrame:
    """The first source's address, normalised (FUS10)."""
    rows = _sites(spark, sf).withColumn("p", fuse.first_of(("a", F.col("a")), ("b", F.col("b"))))
    return rows.select("k", F.col("p.value").alias("website"), F.col("p.source").alias("source"))


@query(f"SELECT k AS entity, 'website' AS field, a AS chosen, 'a=' || a || '; b=' || b AS candidates FROM {SITES} WHERE a IS NOT NULL AND b IS NOT NULL")
def fus10_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return fuse.conflicts(_sites(spark, sf), "k", "website", F.coalesce("a", "b"), [(n, F.col(n)) for n in "ab"])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 90 BETWEEN 8 AND 24 THEN c_custkey % 90 WHEN c_custkey % 4 = 0 AND c_nationkey = s_nationkey THEN 16 END::DOUBLE AS lat,
CASE WHEN c_custkey % 90 BETWEEN 8 AND 24 THEN 'page' WHEN c_custkey % 4 = 0 AND c_nationkey = s_nationkey THEN 'address' END AS source
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def fus11_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    """The first point inside the box; else a geocoded address that is confirmed by its place (FUS11)."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "supplier"), F.col("s_suppkey") == F.col("c_custkey"), "left")
    at = t.point(F.concat(F.lit("Point(105 "), (F.col("c_custkey") % 90).cast("string"), F.lit(")")))
    page = F.when(t.in_box(at["lat"], at["lon"], (8, 24, 102, 110)), at["lat"])
    address = F.when((F.col("c_custkey") % 4 == 0) & (F.col("c_nationkey") == F.col("s_nationkey")), F.lit(16.0))
    return rows.select("c_custkey", fuse.first_of(("page", page), ("address", address)).alias("p")).select("c_custkey", F.col("p.value").alias("lat"), F.col("p.source").alias("source"))


@query("""WITH o AS (SELECT o_custkey AS k, count(DISTINCT o_orderkey % 5) AS n, min(o_orderkey % 5) AS v FROM orders GROUP BY 1)
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'box' WHEN n = 1 THEN 'unique' ELSE 'fallback' END AS source, CASE WHEN c_acctbal < 0 THEN c_nationkey WHEN n = 1 THEN v ELSE -1 END::BIGINT AS place
FROM customer LEFT JOIN o ON k = c_custkey""")
def fus12_place(spark: SparkSession, sf: str) -> DataFrame:
    """A stated place, else the only one among the linked records, else the fallback (FUS12)."""
    part = F.col("o_orderkey") % 5
    only = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(part).alias("v"), F.max(part).alias("hi"))
    rows = table(spark, sf, "customer").join(only, "c_custkey", "left")
    stated, unique = F.when(F.col("c_acctbal") < 0, F.col("c_nationkey").cast("bigint")), F.when(F.col("v") == F.col("hi"), F.col("v"))
    best = fuse.first_of(("box", stated), ("unique", unique), ("fallback", F.lit(-1).cast("bigint")))
    return rows.select("c_custkey", best.alias("p")).select("c_custkey", F.col("p.value").alias("place"), F.col("p.source").alias("source"))


@query("""SELECT DISTINCT l_partkey AS child, l_suppkey AS parent, 'reported' AS basis FROM lineitem WHERE l_partkey % 7 <> 0
UNION ALL SELECT l_partkey, max(l_suppkey), 'curated' FROM lineitem WHERE l_partkey % 7 = 0 GROUP BY 1""")
def fus14_curated_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Curated edges replace reported ones of the same child (FUS14)."""
    edges = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("child"), F.col("l_suppkey").alias("parent"))
    return fuse.curated_over(edges.distinct(), edges.where("child % 7 = 0").groupBy("child").agg(F.max("parent").alias("parent")), "child")


@query("SELECT p_partkey, CASE WHEN p_type LIKE '%ECO%' THEN 'urn:body/economy' WHEN p_type LIKE '%STAND%' THEN 'urn:body/standard' END AS parent FROM part")
def fus18_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """The parent body by the first name rule that fits (FUS18)."""
    return table(spark, sf, "part").select("p_partkey", t.first_rule(F.col("p_type"), [("ECO", "urn:body/economy"), ("STAND", "urn:body/standard")]).alias("parent"))


@query("""WITH h AS (SELECT n_nationkey, min(s_suppkey) AS hit FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal >= 0 GROUP BY 1 HAVING count(*) = 1)
SELECT n_nationkey AS concept, CASE WHEN n_nationkey = 3 THEN 0 ELSE hit END::BIGINT AS target FROM nation LEFT JOIN h USING (n_nationkey) WHERE n_nationkey = 3 OR hit IS NOT NULL""")
def fus20_concepts(spark: SparkSession, sf: str) -> DataFrame:
    """An override, else the only hit that isn't filtered out (FUS20)."""
    hits = table(spark, sf, "supplier").where("s_acctbal >= 0").groupBy(F.col("s_nationkey").alias("concept")).agg(F.min("s_suppkey").alias("hit"), F.count("*").alias("n")).where("n = 1")
    rows = table(spark, sf, "nation").select(F.col("n_nationkey").alias("concept")).join(hits, "concept", "left")
    return rows.select("concept", F.when(F.col("concept") == 3, F.lit(0).cast("bigint")).otherwise(F.col("hit")).alias("target")).where("target IS NOT NULL")


@query("SELECT c_mktsegment AS segment, count(*) AS n, (SELECT count(*) FROM customer) AS total FROM customer GROUP BY 1")
def jon06_total(spark: SparkSession, sf: str) -> DataFrame:
    """Groups beside a scalar total: the other side is one row (JON06)."""
    rows = table(spark, sf, "customer")
    groups = rows.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))
    return groups.crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"))))


@query("SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 80")
def ord08_caps(spark: SparkSession, sf: str) -> DataFrame:
    """A list view shows 80 rows a group (ORD08)."""
    by = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    return table(spark, sf, "customer").select("c_nationkey", "c_custkey", F.row_number().over(by).alias("r")).where("r <= 80").drop("r")


@query("SELECT n_regionkey AS list, n_nationkey AS member FROM nation")
def grf15_list_members(spark: SparkSession, sf: str) -> DataFrame:
    """Members of lists given as first and rest triples (GRF15)."""
    nation = table(spark, sf, "nation")
    after = F.lead("n_nationkey").over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    cell = lambda c: F.concat(F.lit("_:c"), c.cast("string"))
    rows = nation.select(cell(F.col("n_nationkey")).alias("s"), "n_nationkey", "n_regionkey", cell(after).alias("rest"))
    first = rows.select("s", F.lit("rdf:first").alias("p"), F.col("n_nationkey").cast("string").alias("o"))
    rest = rows.select("s", F.lit("rdf:rest").alias("p"), F.coalesce("rest", F.lit("rdf:nil")).alias("o"))
    heads = nation.groupBy("n_regionkey").agg(cell(F.min("n_nationkey")).alias("list"))
    members = list_members(first.unionByName(rest)).join(heads, "list")
    return members.select(F.col("n_regionkey").alias("list"), F.col("member").cast("int").alias("member"))


@query("SELECT 'supplier' AS name, count(*) AS saved, count(*) AS restored, TRUE AS same FROM supplier UNION ALL SELECT 'nation', count(*), count(*), TRUE FROM nation")
def chk26_restore(spark: SparkSession, sf: str) -> DataFrame:
    """A table that was written and read back, by count and an order-free checksum (CHK26)."""
    out = None
    for name in ("supplier", "nation"):
        rows = table(spark, sf, name)
        part = sinks.fixity(rows).crossJoin(F.broadcast(sinks.fixity(cut(rows)).select(F.col("n").alias("restored"), F.col("sum").alias("again"))))
        part = part.select(F.lit(name).alias("name"), F.col("n").alias("saved"), "restored", ((F.col("n") == F.col("restored")) & F.col("sum").eqNullSafe(F.col("again"))).alias("same"))
        out = part if out is None else out.unionByName(part)
    return out


@query("""SELECT '| ' || c_mktsegment || ' | ' || count(*) || ' | ' || floor(100.0 * count(*) FILTER (c_acctbal >= 0) / count(*) + 0.5)::INTEGER || ' % |' AS line FROM customer GROUP BY c_mktsegment""")
def snk14_report(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a Markdown table: group, entities, completeness (SNK14)."""
    rows = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") >= 0).alias("full"))
    return rows.select(sinks.markdown_row("c_mktsegment", F.col("n"), F.concat(F.floor(F.col("full") * 100.0 / F.col("n") + 0.5).cast("int").cast("string"), F.lit(" %"))).alias("line"))


@query("""SELECT CASE WHEN s_suppkey IS NULL THEN 'added' WHEN c_custkey IS NULL THEN 'removed' WHEN c_nationkey = s_nationkey THEN 'same' ELSE 'changed' END AS verdict, count(*) AS n
FROM customer FULL JOIN supplier ON c_custkey = s_suppkey GROUP BY 1""")
def evl08_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers of two releases: added, removed, same or changed (EVL08)."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "supplier"), F.col("c_custkey") == F.col("s_suppkey"), "full")
    verdict = F.when(F.col("s_suppkey").isNull(), "added").when(F.col("c_custkey").isNull(), "removed").when(F.col("c_nationkey") == F.col("s_nationkey"), "same").otherwise("changed")
    return rows.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))
