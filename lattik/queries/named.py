"""The shapes of the nineteen sample queries, over the star schema as a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.plans import graph as g
from lattik.queries import query, table

#: The crosswalk of nations in SQL: where a nation was merged into.
INTO = "CASE WHEN n_nationkey >= 20 AND n_nationkey % 2 = 1 THEN n_nationkey - 20 END"
CUR = f"WITH cur AS (SELECT n_nationkey AS k, coalesce({INTO}, n_nationkey) AS t FROM nation)"


def current_of(graph: DataFrame) -> DataFrame:
    """``place``, ``now``: where a place is merged into, else itself."""
    places = g.match(graph, "?place", g.TYPE, "Nation")
    return g.optional(places, g.match(graph, "?place", "mergedInto", "?into")).select("place", F.coalesce("into", "place").alias("now"))


@query(f"""{CUR} SELECT n.n_name AS place, count(DISTINCT c_custkey) AS n, count(DISTINCT CASE WHEN c_nationkey <> t THEN c_nationkey END) AS former
FROM customer JOIN cur ON c_nationkey = k JOIN nation n ON n.n_nationkey = t GROUP BY 1 ORDER BY n DESC, place LIMIT 15""")
def q01_by_current_place(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation"))
    rows = g.join(g.match(graph, "?u", g.TYPE, "Customer"), g.match(graph, "?u", "locatedIn", "?place"), current_of(graph))
    rows = rows.join(g.match(graph, "?now", g.LABEL, "?name", lang="en"), "now")
    former = F.when(F.col("place") != F.col("now"), F.col("place"))
    return rows.groupBy(F.col("name").alias("place")).agg(F.countDistinct("u").alias("n"), F.countDistinct(former).alias("former")).orderBy(F.desc("n"), "place").limit(15)


@query("""SELECT r_name AS region, count(DISTINCT c_custkey) AS n, count(DISTINCT CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey END) AS building,
count(DISTINCT CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey END) AS machinery FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def q02_region_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation", "region"))
    rows = g.bgp(graph, ("?u", "locatedIn", "?n"), ("?n", "partOf", "?r"), ("?r", g.LABEL, "?region", "en"), ("?u", g.TYPE, "Customer"))
    for name in ("BUILDING", "MACHINERY"):
        rows = g.optional(rows, g.match(graph, "?u", "inSegment", f"{g.NS}segment/{name}").withColumn(name, F.lit(True)))
    flags = [F.countDistinct(F.when(F.col(name), F.col("u"))).alias(name.lower()) for name in ("BUILDING", "MACHINERY")]
    return rows.groupBy("region").agg(F.countDistinct("u").alias("n"), *flags).orderBy("region")


@query("""SELECT v.kind, n_name AS place, count(DISTINCT c_custkey) AS n, string_agg(DISTINCT c_name, '; ' ORDER BY c_name) AS names FROM customer
JOIN (VALUES ('AUTOMOBILE', 'cars'), ('FURNITURE', 'home')) v(seg, kind) ON c_mktsegment = v.seg
LEFT JOIN (SELECT * FROM nation WHERE n_name NOT IN ('FRANCE', 'NATION_3')) ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def q03_inline_kinds(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation"))
    kinds = g.values(spark, ("seg", "kind"), [(f"{g.NS}segment/AUTOMOBILE", "cars"), (f"{g.NS}segment/FURNITURE", "home")])
    rows = g.join(g.match(graph, "?u", "inSegment", "?seg"), F.broadcast(kinds), g.match(graph, "?u", g.LABEL, "?name", "en"))
    named = g.match(graph, "?t", g.LABEL, "?place", "en").where(~F.col("place").isin("FRANCE", "NATION_3"))
    rows = g.optional(rows, g.match(graph, "?u", "locatedIn", "?t").join(named, "t"))
    return rows.groupBy("kind", "place").agg(F.countDistinct("u").alias("n"), g.group_concat("name", "; ").alias("names"))


@query("""SELECT 'urn:kg:customer/' || c_custkey AS u, c_name AS name, n_name AS place, r_name AS region, c_acctbal::VARCHAR AS balance
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE c_custkey IN (1, 2, 3, 5, 8)""")
def q04_lookup_values(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation", "region"))
    rows = F.broadcast(g.values(spark, ("u",), [(f"{g.NS}customer/{k}",) for k in (1, 2, 3, 5, 8)]))
    rows = g.join(rows, g.match(graph, "?u", g.LABEL, "?name", "en"))
    label = g.edges(graph, "locatedIn").join(g.match(graph, "?o", g.LABEL, "?place", "en"), "o").select(F.col("s").alias("u"), "place")
    region = g.sequence(g.edges(graph, "locatedIn"), g.edges(graph, "partOf")).join(g.match(graph, "?o", g.LABEL, "?region", "en"), "o").select(F.col("s").alias("u"), "region")
    return g.optional(g.optional(g.optional(rows, label), region), g.match(graph, "?u", "balance", "?balance"))


@query("""SELECT r_name AS region, count(DISTINCT n_nationkey) AS members, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS names
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def q05_members(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("nation", "region"))
    has = g.match(graph, "?m", "partOf", "?r")
    rows = has.join(g.match(graph, "?m", g.LABEL, "?name", "en"), "m").join(g.match(graph, "?r", g.TYPE, "Region"), "r").join(g.match(graph, "?r", g.LABEL, "?region", "en"), "r")
    return rows.groupBy("region").agg(F.countDistinct("m").alias("members"), g.group_concat("name", ", ").alias("names"))


@query(f"""SELECT a.n_name AS former, b.n_name AS now, count(DISTINCT c_custkey) AS n FROM (SELECT *, {INTO} AS into_key FROM nation) a
JOIN nation b ON a.into_key = b.n_nationkey LEFT JOIN customer ON c_nationkey = a.n_nationkey GROUP BY 1, 2""")
def q06_former_and_current(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation"))
    rows = g.bgp(graph, ("?f", "mergedInto", "?t"), ("?f", g.LABEL, "?former", "en"), ("?t", g.LABEL, "?now", "en"))
    inside = g.bgp(graph, ("?u", g.TYPE, "Customer"), ("?u", "locatedIn", "?f"))
    return g.optional(rows, inside).groupBy("former", "now").agg(F.countDistinct("u").alias("n"))


@query("""SELECT * FROM (VALUES ('balance'), ('inSegment'), ('locatedIn'), ('rdfs:label')) p(property), LATERAL (SELECT CASE property
WHEN 'balance' THEN c_acctbal::VARCHAR WHEN 'inSegment' THEN c_mktsegment WHEN 'locatedIn' THEN n_name ELSE c_name END AS "values"
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey = 7)""")
def q07_profile(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation"))
    rows = g.match(graph, f"{g.NS}customer/7", "?p", "?o").where(~F.col("p").isin(g.TYPE))
    rows = g.optional(rows, g.match(graph, "?o", g.LABEL, "?name", "en"))
    value = F.coalesce("name", F.when(F.col("o").startswith(g.NS), F.regexp_replace("o", r"^.*[#/]", "")).otherwise(F.col("o")))
    return rows.withColumn("value", value).groupBy(F.col("p").alias("property")).agg(g.group_concat("value", "; ").alias("values"))


@query("""SELECT DISTINCT c_name AS customer, p_type AS kind, n_name AS place FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE p_type = (SELECT min(p_type) FROM part)""")
def q08_chain_to_kind(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation", "orders", "part", "lineitem"))
    first = table(spark, sf, "part").agg(F.min("p_type").alias("kind"))
    wanted = g.match(graph, "?part", "ofType", "?t").withColumn("kind", F.translate(F.regexp_replace("t", "^.*/", ""), "_", " ")).join(F.broadcast(first), "kind")
    rows = g.join(g.match(graph, "?order", "offers", "?part"), wanted.select("part", "kind"), g.match(graph, "?order", "placedBy", "?u"))
    rows = g.join(rows.select("u", "kind").distinct(), g.match(graph, "?u", g.LABEL, "?customer", "en"), g.match(graph, "?u", "locatedIn", "?n"), g.match(graph, "?n", g.LABEL, "?place", "en"))
    return rows.select("customer", "kind", "place").distinct().orderBy("customer", "kind")


@query("""SELECT c_name AS name, count(DISTINCT o_orderkey) AS n, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS done
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name ORDER BY n DESC, name LIMIT 12""")
def q09_ranking(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "orders"))
    rows = g.optional(g.match(graph, "?o", "placedBy", "?u"), g.match(graph, "?o", "status", "F").withColumn("done", F.lit(True)))
    top = rows.groupBy("u").agg(F.countDistinct("o").alias("n"), F.countDistinct(F.when(F.col("done"), F.col("o"))).alias("done"))
    return top.join(g.match(graph, "?u", g.LABEL, "?name", "en"), "u").select("name", "n", "done").orderBy(F.desc("n"), "name").limit(12)


@query("""SELECT c_name AS name, role, CASE role WHEN 'place' THEN n_name ELSE c_mktsegment END AS value FROM customer JOIN nation ON c_nationkey = n_nationkey,
(VALUES ('place'), ('segment')) r(role)""")
def q10_roles(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation"))
    roles = g.values(spark, ("p", "role"), [("locatedIn", "place"), ("inSegment", "segment")])
    rows = g.match(graph, "?u", "?p", "?o").join(F.broadcast(roles), "p").join(g.match(graph, "?u", g.LABEL, "?name", "en"), "u")
    rows = g.optional(rows, g.match(graph, "?o", g.LABEL, "?label", "en"))
    return rows.select("name", "role", F.coalesce("label", F.substring_index("o", "/", -1)).alias("value"))


@query("""SELECT CASE WHEN url LIKE 'https://%.com/%' THEN 'com, secure' WHEN url LIKE '%.com/%' THEN 'com' WHEN url LIKE '%.org/%' THEN 'org' ELSE 'other' END AS dataset,
count(*) AS n FROM pages GROUP BY 1""")
def q11_links_by_dataset(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    bucket = F.when(url.startswith("https://") & url.contains(".com/"), "com, secure").when(url.contains(".com/"), "com").when(url.contains(".org/"), "org").otherwise("other")
    return table(spark, sf, "pages").groupBy(bucket.alias("dataset")).agg(F.count("*").alias("n"))


TOP6 = "SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, k LIMIT 6"


@query(f"""WITH top AS ({TOP6}), ext AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_nationkey % 3 <> 0 GROUP BY 1)
SELECT n_name AS place, n, suppliers, floor(100000 * n / suppliers + 0.5)::BIGINT / 100.0::DOUBLE AS ratio FROM top JOIN nation ON n_nationkey = k LEFT JOIN ext USING (k)""")
def q12_federated_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """A sub-select of six keys bound to an external table; a key that it lacks leaves its variables unbound."""
    top = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "k").limit(6)
    remote = table(spark, sf, "supplier").where("s_nationkey % 3 <> 0").withColumnRenamed("s_nationkey", "k")
    found = remote.join(F.broadcast(top.select("k")), "k", "left_semi").groupBy("k").agg(F.count("*").alias("suppliers"))
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("place"))
    ratio = F.floor(F.try_divide(F.col("n") * 100000, F.col("suppliers")) + 0.5).cast("bigint") / F.lit(100.0)
    return top.join(F.broadcast(names), "k").join(found, "k", "left").select("place", "n", "suppliers", ratio.alias("ratio"))


@query(f"""WITH top AS ({TOP6}) SELECT n_name AS place, s_name AS label, CASE WHEN s_acctbal > 0 THEN s_suppkey END AS positive FROM top JOIN nation ON n_nationkey = k
LEFT JOIN (SELECT s_nationkey AS k, s_name, s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 5 = 0) USING (k)""")
def q13_federated_nested(spark: SparkSession, sf: str) -> DataFrame:
    top = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "k").limit(6)
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("place"))
    remote = table(spark, sf, "supplier").where("s_suppkey % 5 = 0").select(F.col("s_nationkey").alias("k"), F.col("s_name").alias("label"), "s_suppkey", "s_acctbal")
    inner = remote.where("s_acctbal > 0").select(F.col("s_suppkey"), F.col("s_suppkey").alias("positive"))
    nested = remote.join(inner, "s_suppkey", "left").select("k", "label", "positive")
    return top.join(F.broadcast(names), "k").join(nested, "k", "left").select("place", "label", "positive")


@query("""SELECT p_type AS kind, p_name AS name, CASE WHEN p_brand <> 'Brand#1' THEN p_brand END AS brand FROM part""")
def q14_star_by_kind(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("part",))
    rows = g.join(g.match(graph, "?n", "ofType", "?t"), g.match(graph, "?n", g.LABEL, "?name", "en"))
    rows = g.optional(rows, g.match(graph, "?n", "brand", "?brand").where("brand <> 'Brand#1'"))
    return rows.select(F.translate(F.regexp_replace("t", "^.*/", ""), "_", " ").alias("kind"), "name", "brand")


@query("""SELECT field, n, total, floor(1000 * n / total + 0.5)::BIGINT / 10.0::DOUBLE AS percent FROM (SELECT count(*) AS total FROM documents),
LATERAL (VALUES ('text', (SELECT count(nullif(text, '')) FROM documents)), ('lang', (SELECT count(nullif(lang, '')) FROM documents)),
('quality', (SELECT count(DISTINCT doc_id) FROM labels JOIN documents USING (doc_id))), ('toxic', (SELECT count(DISTINCT doc_id) FROM labels JOIN documents USING (doc_id) WHERE toxic = 1))) f(field, n)""")
def q15_completeness(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", (F.length("text") > 0).alias("text"), (F.length("lang") > 0).alias("lang"))
    labels = table(spark, sf, "labels").groupBy("doc_id").agg(F.lit(True).alias("quality"), (F.max("toxic") == 1).alias("toxic"))
    counts = docs.join(labels, "doc_id", "left").agg(F.count("*").alias("total"), *(F.count_if(c).alias(c) for c in ("text", "lang", "quality", "toxic")))
    rows = counts.select("total", F.explode(F.create_map(*(x for c in ("text", "lang", "quality", "toxic") for x in (F.lit(c), F.col(c))))).alias("field", "n"))
    return rows.select("field", "n", "total", (F.floor(F.try_divide(F.col("n") * 1000, F.col("total")) + 0.5).cast("bigint") / F.lit(10.0)).alias("percent"))


@query("""SELECT c_name AS name, n_name AS place FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'BUILDING'
AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def q16_without(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation", "orders"))
    rows = g.exists(g.match(graph, "?u", g.TYPE, "Customer"), g.match(graph, "?u", "inSegment", f"{g.NS}segment/BUILDING"), negated=True)
    rows = g.exists(rows, g.bgp(graph, ("?o", "placedBy", "?u"), ("?o", "status", "F")).select("u"), negated=True)
    rows = g.join(rows, g.match(graph, "?u", g.LABEL, "?name", "en"))
    rows = g.optional(rows, g.match(graph, "?u", "locatedIn", "?t").join(g.match(graph, "?t", g.LABEL, "?place", "en"), "t").select("u", "place"))
    return rows.select("name", "place").orderBy(F.col("place").isNull(), "place", "name")


@query("SELECT count(*) > 0 AS answer FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3")
def q17_ask(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer",))
    return g.ask(g.bgp(graph, ("?u", "inSegment", f"{g.NS}segment/BUILDING"), ("?u", "locatedIn", f"{g.NS}nation/3")))


@query("""SELECT s, p, o FROM (SELECT 'urn:kg:customer/' || c_custkey AS s, c_name, n_regionkey AS r FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'),
LATERAL (VALUES ('rdf:type', 'Builder'), ('name', c_name), ('inRegion', 'urn:kg:region/' || r)) v(p, o)""")
def q18_construct(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_schema(spark, sf, ("customer", "nation"))
    rows = g.bgp(graph, ("?u", "inSegment", f"{g.NS}segment/BUILDING"), ("?u", g.LABEL, "?name"), ("?u", "locatedIn", "?n"), ("?n", "partOf", "?r"))
    made = g.construct(rows, g.fact(F.col("u"), g.TYPE, F.lit("Builder")), g.fact(F.col("u"), "name", F.col("name"), lang="en"), g.fact(F.col("u"), "inRegion", F.col("r")))
    return made.select("s", "p", "o")


@query("""SELECT s, p, o FROM (SELECT 'urn:kg:nation/2' AS s, unnest(['rdf:type', 'rdfs:label', 'partOf']) AS p, unnest(['Nation', n_name, 'urn:kg:region/' || n_regionkey]) AS o FROM nation WHERE n_nationkey = 2)
UNION ALL (SELECT 'urn:kg:customer/' || c_custkey, 'locatedIn', 'urn:kg:nation/2' FROM customer WHERE c_nationkey = 2 ORDER BY 1 LIMIT 1000)""")
def q19_describe(spark: SparkSession, sf: str) -> DataFrame:
    return g.describe(g.star_schema(spark, sf, ("customer", "nation", "region")), f"{g.NS}nation/2").select("s", "p", "o")
