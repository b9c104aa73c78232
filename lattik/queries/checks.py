"""Constraint, contract and integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.operators import shapes as sh
from lattik.plans import graph as g
from lattik.queries import query, table

C = "'urn:kg:customer/' || c_custkey"


@query(f"""SELECT 'Violation' AS severity, 'urn:kg:nation/' || n_nationkey AS focus, 'mergedInto' AS path, 'count not in 1..*' AS message, '0' AS value FROM nation WHERE NOT (n_nationkey >= 20 AND n_nationkey % 2 = 1)
UNION ALL SELECT 'Warning', {C}, 'balance', 'balance not positive', printf('%.2f', c_acctbal) FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'Violation', {C}, 'inSegment', 'segment not allowed', 'urn:kg:segment/' || c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE')
UNION ALL SELECT 'Info', {C}, 'locatedIn', 'value is not of class Region', 'urn:kg:nation/' || c_nationkey FROM customer""")
def chk09_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Targets, counts, value conditions and classes with severities (CHK09, 10, 12, 13, 14, 17)."""
    graph = g.star_frame(spark, sf, ("customer", "nation"))
    nations, customers = sh.targets(graph, "Nation"), sh.targets(graph, "Customer")
    segments = [f"{g.NS}segment/{x}" for x in ("BUILDING", "MACHINERY", "FURNITURE")]
    money = sh.each_value(graph, customers, "balance", F.col("value").try_cast("double") >= 0, "balance not positive", sh.WARNING)
    money = money.withColumn("value", F.col("value").cast("decimal(18,2)").cast("string"))
    return (
        sh.cardinality(graph, nations, "mergedInto", least=1).unionByName(money)
        .unionByName(sh.each_value(graph, customers, "inSegment", F.col("value").isin(*segments) & (F.col("o_kind") == "iri"), "segment not allowed"))
        .unionByName(sh.value_class(graph, customers, "locatedIn", "Region", sh.INFO))
    )


@query("""SELECT 'Violation' AS severity, doc_id::VARCHAR AS focus, 'label' AS path, 'more than one value in a language' AS message, lang AS value FROM documents WHERE doc_id % 10 = 0 AND lang IS NOT NULL
UNION ALL SELECT 'Violation', doc_id::VARCHAR, 'label', 'count not in 1..*', '0' FROM documents WHERE lang IS DISTINCT FROM 'en'""")
def chk11_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Qualified counts and uniqueness by language (CHK11, CHK12)."""
    docs = table(spark, sf, "documents")
    first = docs.select(g.fact(F.col("doc_id").cast("string"), "label", F.lit("a"), lang=F.col("lang")).alias("t"))
    second = docs.where("doc_id % 10 = 0").select(g.fact(F.col("doc_id").cast("string"), "label", F.lit("b"), lang=F.col("lang")).alias("t"))
    graph = first.union(second).select("t.*")
    nodes = sh.targets(graph, subjects_of="label")
    return sh.unique_lang(graph, nodes, "label").unionByName(sh.cardinality(graph, nodes, "label", least=1, lang="en"))


@query("""SELECT 'Violation' AS severity, focus, 'from' AS path, 'greater than to' AS message, x::VARCHAR AS value FROM (SELECT DISTINCT l_orderkey || '/' || l_linenumber AS focus,
epoch(o_orderdate)::BIGINT AS x, epoch(l_shipdate)::BIGINT AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE x > y""")
def chk15_interval(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    key = F.concat_ws("/", "l_orderkey", "l_linenumber")
    second = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    graph = g.dedup(g.facts(rows, g.fact(key, "from", second("o_orderdate"), dt="integer"), g.fact(key, "to", second("l_shipdate"), dt="integer")))
    return sh.less_or_equal(graph, sh.targets(graph, subjects_of="from"), "from", "to", "bigint")


@query("""SELECT 'customer' AS entity_type, c_custkey::VARCHAR AS key, path, message FROM customer, LATERAL (SELECT 'c_mktsegment' AS path, 'not in enum' AS message WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'c_acctbal', 'below minimum' WHERE c_acctbal < -500 UNION ALL SELECT 'c_name', 'pattern' WHERE NOT regexp_matches(c_name, '[02468]$'))""")
def chk18_contract(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        ("c_mktsegment", F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "not in enum"), ("c_acctbal", F.col("c_acctbal") >= -500, "below minimum"),
        ("c_name", F.col("c_name").rlike("[02468]$"), "pattern"),
    ]
    return sh.contract(table(spark, sf, "customer"), "customer", "c_custkey", rules)


@query("SELECT o_orderkey AS key, o_custkey AS ref FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')")
def chk20_references(spark: SparkSession, sf: str) -> DataFrame:
    return sh.references(table(spark, sf, "orders"), "o_orderkey", "o_custkey", table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'"), "c_custkey")


@query("""SELECT 'urn:kg:event/' || event_id AS s, 'value' AS p, event_type AS o, 'integer' AS o_dt FROM events WHERE try_cast(event_type AS BIGINT) IS NULL""")
def chk06_ill_typed(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.facts(table(spark, sf, "events"), g.fact(g.iri("event", "event_id"), "value", F.col("event_type"), dt="integer"), g.fact(g.iri("event", "event_id"), "at", F.col("event_id"), dt="integer"))
    return sh.ill_typed(graph)


@query("""SELECT 'Violation' AS severity, 'urn:kg:order/' || o_orderkey AS focus, 'year' AS path, 'datatype' AS message, year(o_orderdate)::VARCHAR AS value FROM orders
UNION ALL SELECT 'Violation', 'urn:kg:customer/' || o_custkey, 'hasOrder', 'functional', count(*)::VARCHAR FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def chk07_asserted(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_frame(spark, sf, ("orders",))
    back = g.facts(table(spark, sf, "orders"), g.fact(g.iri("customer", "o_custkey"), "hasOrder", g.iri("order", "o_orderkey")))
    return sh.asserted_ranges(graph.where("p = 'year'").unionByName(back), [("year", "gYear")], ["hasOrder"])


@query("""SELECT c_name AS code, count(*) AS n FROM (SELECT substr(c_name, 10, 7) AS c_name FROM customer) GROUP BY 1 HAVING count(*) > 1""")
def agg21_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Keys with more than one member (AGG21, CHK22)."""
    return table(spark, sf, "customer").groupBy(F.substring("c_name", 10, 7).alias("code")).agg(F.count("*").alias("n")).where("n > 1")
