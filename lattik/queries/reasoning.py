"""Closures and entailments over the star schema's graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.operators import reason
from lattik.operators.closure import reach
from lattik.plans import graph as g
from lattik.queries import query, table

N = g.NS
#: The ontology of the demonstration graph.
ONTO = reason.Ontology(
    subclass=[("Customer", "Party"), ("Supplier", "Party"), ("Party", "Agent"), ("Builder", "Customer"), ("Nation", "Place"), ("Region", "Place")],
    subproperty=[("locatedIn", "relatedTo"), ("partOf", "relatedTo")],
    domain=[("inSegment", "Customer")], range=[("locatedIn", "Place")], inverse=[("partOf", "hasPart"), ("mergedInto", "mergedFrom")],
    transitive=["partOf"], chain=[("locatedIn", "partOf", "locatedIn"), ("locatedIn", "mergedInto", "locatedIn")],
    has_value=[("inSegment", f"{N}segment/BUILDING", "Builder")], some_values=[("mergedInto", None, "Former"), ("locatedIn", "Former", "Moved")],
    implied_value=[("locatedIn", "Former", "inSegment", f"{N}segment/MOVED")], functional=["mergedInto", "balance"],
    disjoint=[("Builder", "Moved"), ("Customer", "Place")],
)
KINDS = ("customer", "nation", "region")
INTO = "CASE WHEN n_nationkey >= 20 AND n_nationkey % 2 = 1 THEN n_nationkey - 20 END"
#: Edges and the located-in closure in SQL.
EDGES = f"""WITH RECURSIVE part AS (SELECT 'urn:kg:nation/' || n_nationkey AS s, 'urn:kg:region/' || n_regionkey AS o FROM nation
UNION SELECT 'urn:kg:region/' || r_regionkey, 'urn:kg:world' FROM region),
merged AS (SELECT 'urn:kg:nation/' || n_nationkey AS s, 'urn:kg:nation/' || ({INTO}) AS o FROM nation WHERE ({INTO}) IS NOT NULL),
step AS (SELECT s, o FROM part UNION SELECT s, o FROM merged),
loc AS (SELECT 'urn:kg:customer/' || c_custkey AS s, 'urn:kg:nation/' || c_nationkey AS o FROM customer
UNION SELECT loc.s, step.o FROM loc JOIN step ON loc.o = step.s)
"""


@query("""WITH RECURSIVE e AS (SELECT 'urn:kg:nation/' || n_nationkey AS s, 'urn:kg:region/' || n_regionkey AS o FROM nation UNION SELECT 'urn:kg:region/' || r_regionkey, 'urn:kg:world' FROM region),
c AS (SELECT s, o FROM e UNION SELECT c.s, e.o FROM c JOIN e ON c.o = e.s) SELECT s, o FROM c""")
def grf05_transitive(spark: SparkSession, sf: str) -> DataFrame:
    return reach(g.edges(g.star_frame(spark, sf, ("nation", "region")), "partOf"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS s, o_custkey % 97 AS o FROM orders), c AS (SELECT s, o FROM e UNION SELECT c.s, e.o FROM c JOIN e ON c.o = e.s)
SELECT s, o FROM c UNION SELECT s, s FROM e UNION SELECT o, o FROM e""")
def grf16_star_path_with_cycles(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "orders").select(F.col("o_custkey").alias("s"), (F.col("o_custkey") % 97).alias("o")).distinct()
    return g.star(e)


@query(EDGES + "SELECT s, o FROM loc")
def grf06_chain_closure(spark: SparkSession, sf: str) -> DataFrame:
    onto = reason.Ontology(transitive=["partOf"], chain=ONTO.chain)
    return g.match(reason.materialize(g.star_frame(spark, sf, KINDS), onto), "?s", "locatedIn", "?o")


@query(EDGES + """, former AS (SELECT s FROM merged), moved AS (SELECT DISTINCT loc.s FROM loc JOIN former ON loc.o = former.s),
cust AS (SELECT 'urn:kg:customer/' || c_custkey AS s, c_mktsegment AS seg FROM customer)
SELECT DISTINCT s, o FROM (SELECT s, unnest(['Customer', 'Party', 'Agent']) AS o FROM cust UNION ALL SELECT s, 'Builder' FROM cust WHERE seg = 'BUILDING'
UNION ALL SELECT s, 'Moved' FROM moved UNION ALL SELECT s, 'Former' FROM former UNION ALL SELECT o, 'Place' FROM loc
UNION ALL SELECT 'urn:kg:nation/' || n_nationkey, unnest(['Nation', 'Place']) FROM nation UNION ALL SELECT 'urn:kg:region/' || r_regionkey, unnest(['Region', 'Place']) FROM region)""")
def grf01_types(spark: SparkSession, sf: str) -> DataFrame:
    """All types after materialization: hierarchy, domain, range, defined classes (GRF01, 03, 07, 08, 13)."""
    return g.match(reason.materialize(g.star_frame(spark, sf, KINDS), ONTO), "?s", g.TYPE, "?o")


@query(EDGES + """, former AS (SELECT s FROM merged), moved AS (SELECT DISTINCT loc.s FROM loc JOIN former ON loc.o = former.s)
SELECT s, 'inSegment' AS p, 'urn:kg:segment/MOVED' AS o FROM moved UNION SELECT o, 'hasPart', s FROM (WITH RECURSIVE c AS (SELECT s, o FROM part UNION SELECT c.s, part.o FROM c JOIN part ON c.o = part.s) SELECT s, o FROM c)
UNION SELECT o, 'mergedFrom', s FROM merged""")
def grf04_derived_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Inverses of derived edges and implied values that the base doesn't have (GRF04, GRF09, GRF14)."""
    base = g.star_frame(spark, sf, KINDS)
    new = reason.inferred(reason.materialize(base, ONTO), base, N)
    return new.where(F.col("p").isin("hasPart", "mergedFrom") | ((F.col("p") == "inSegment") & F.col("o").endswith("MOVED"))).select("s", "p", "o")


@query("""SELECT p, count(*) AS n FROM (SELECT 'relatedTo' AS p, 'c' || c_custkey || '/' || c_nationkey AS k FROM customer UNION ALL SELECT 'relatedTo', 'n' || n_nationkey FROM nation
UNION ALL SELECT 'relatedTo', 'r' || r_regionkey FROM region UNION ALL SELECT 'locatedIn', 'c' || c_custkey FROM customer UNION ALL SELECT 'partOf', 'n' || n_nationkey FROM nation UNION ALL SELECT 'partOf', 'r' || r_regionkey FROM region) GROUP BY 1""")
def grf02_subproperties(spark: SparkSession, sf: str) -> DataFrame:
    onto = reason.Ontology(subproperty=ONTO.subproperty)
    return reason.materialize(g.star_frame(spark, sf, KINDS), onto).where(F.col("p").isin("relatedTo", "locatedIn", "partOf")).groupBy("p").agg(F.count("*").alias("n"))


@query("""SELECT 'disjoint' AS kind, 'urn:kg:customer/' || c_custkey AS s, 'Builder' AS a, 'Moved' AS b FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey >= 20 AND c_nationkey % 2 = 1""")
def chk01_inconsistencies(spark: SparkSession, sf: str) -> DataFrame:
    """Disjoint classes, functional literals, differing values (CHK01-05, GRF12)."""
    return reason.inconsistencies(reason.materialize(g.star_frame(spark, sf, KINDS), ONTO), ONTO)


@query("SELECT min(o_orderkey) AS a, max(o_orderkey) AS b, o_custkey AS s FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderkey) > 1")
def grf10_functional(spark: SparkSession, sf: str) -> DataFrame:
    """The ends of the equality classes of a functional property with several values."""
    rows = table(spark, sf, "orders").select(g.fact(g.iri("c", "o_custkey"), "holds", F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("t")).select("t.*")
    equal = reason.same_as(rows, reason.Ontology(functional=["holds"]))
    low = rows.select("s", F.col("o").alias("node")).join(equal, "node").groupBy("s").agg(F.min("label").alias("a"), F.max("node").alias("b"))
    return low.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"), F.substring_index("s", "/", -1).cast("bigint").alias("s"))


@query("""WITH t AS (SELECT 'urn:kg:customer/' || c_custkey AS s, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Builder' ELSE 'Customer' END AS o FROM customer) SELECT * FROM t""")
def win09_most_specific_type(spark: SparkSession, sf: str) -> DataFrame:
    graph = g.star_frame(spark, sf, ("customer",))
    onto = reason.Ontology(subclass=ONTO.subclass, has_value=ONTO.has_value)
    types = g.match(reason.materialize(graph, onto), "?s", g.TYPE, "?o").where(F.col("s").startswith(f"{N}customer/"))
    above = reason.axioms(spark, reason.closed(ONTO.subclass), "sub o")
    general = types.withColumnRenamed("o", "sub").join(above, "sub").select("s", "o").distinct()
    return types.join(general, ["s", "o"], "left_anti")
