"""Further single operators: scans, predicates, joins, aggregates and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lattik.functions import text as t
from lattik.functions import wiki
from lattik.plans import graph as g
from lattik.queries import query, table
from lattik.sources import records, sinks


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS a, l_partkey % (SELECT count(*) FROM supplier) AS b FROM lineitem), c AS (SELECT 1::BIGINT AS node, 0 AS depth UNION SELECT e.b, depth + 1 FROM c JOIN e ON e.a = c.node WHERE depth < 3)
SELECT node, min(depth)::INTEGER AS depth FROM c GROUP BY 1""")
def src08_bounded_crawl(spark: SparkSession, sf: str) -> DataFrame:
    """Breadth-first walk with a visited set and a greatest depth."""
    n = table(spark, sf, "supplier").count()
    e = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("node"), (F.col("l_partkey") % n).alias("b")).distinct()
    seen = spark.range(1, 2).select(F.col("id").alias("node"), F.lit(0).alias("depth"))
    front = seen
    for depth in range(1, 4):
        front = front.join(e, "node").select(F.col("b").alias("node"), F.lit(depth).alias("depth")).distinct().join(seen, "node", "left_anti")
        seen = seen.union(front)
    return seen


@query("""SELECT event_id, event_type AS kind, CASE WHEN value > 50 THEN value::VARCHAR END AS value FROM events""")
def src19_result_bindings(spark: SparkSession, sf: str) -> DataFrame:
    """Query results written as JSON and read back; an unbound variable is an absent key."""
    e = table(spark, sf, "events")
    term = lambda c: F.struct(F.lit("literal").alias("type"), c.cast("string").alias("value"))
    row = F.struct(term(F.col("event_id")).alias("id"), term(F.col("event_type")).alias("kind"), F.when(F.col("value") > 50, term(F.col("value"))).alias("value"))
    made = e.select(F.to_json(F.struct(F.struct(F.array(row).alias("bindings")).alias("results"))).alias("value"))
    back = records.bindings(made, ["id", "kind", "value"])
    return back.select(F.col("id").cast("bigint").alias("event_id"), "kind", "value")


@query(r"""SELECT page_id, trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)) AS title, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages""")
def src14_page_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of pages by pattern."""
    html = F.col("html")
    return table(spark, sf, "pages").select("page_id", F.trim(F.regexp_extract(html, "(?is)<title>(.*?)</title>", 1)).alias("title"), F.regexp_extract(html, '<html lang="([a-z]+)"', 1).alias("lang"))


@query("SELECT s_suppkey, s_name AS name, s_nationkey::VARCHAR AS nation, 'nation ' || s_nationkey AS link FROM supplier")
def src26_infobox(spark: SparkSession, sf: str) -> DataFrame:
    """Parameters and links of generated wikitext."""
    made = F.concat(F.lit("{{Infobox company\n| name = '''"), "s_name", F.lit("'''<ref>x</ref>\n| Nation = [[nation|"), F.col("s_nationkey").cast("string"), F.lit("]] {{flag|x}}\n| name = other\n}}\nIt is in [[nation "), F.col("s_nationkey").cast("string"), F.lit("|here]]. [[File:a.png|thumb]]"))
    rows = table(spark, sf, "supplier").select("s_suppkey", made.alias("w")).withColumn("box", wiki.infobox(F.col("w")))
    return rows.select("s_suppkey", F.col("box")["name"].alias("name"), F.col("box")["nation"].alias("nation"), F.element_at(wiki.links(F.regexp_replace("w", r"(?s)^.*\}\}", "")), 1).alias("link"))


@query("SELECT doc_id, text LIKE 'The%' AS starts, contains(text, ' the ') AS inside, lang IS NOT NULL AS bound FROM documents WHERE lang NOT IN ('fr', 'de')")
def flt06_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Prefix, substring, bound and negated membership (FLT03, 04, 06, 07)."""
    rows = table(spark, sf, "documents").where(~F.col("lang").isin("fr", "de"))
    return rows.select("doc_id", F.col("text").startswith("The").alias("starts"), F.col("text").contains(" the ").alias("inside"), F.col("lang").isNotNull().alias("bound"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE (year(o_orderdate) < 1994 OR o_totalprice > 300000) AND NOT o_orderstatus = 'P'")
def flt08_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where(((F.year("o_orderdate") < 1994) | (F.col("o_totalprice") > 300000)) & (F.col("o_orderstatus") != "P")).select("o_orderkey", "o_orderstatus")


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def flt09_canonical_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier")
    a, b = (rows.select("s_nationkey", F.col("s_suppkey").alias(k)) for k in "ab")
    return a.join(b, "s_nationkey").where("a < b").select("a", "b")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND contains(lower(c_name), '1') AND c_acctbal > 0")
def flt16_facets(spark: SparkSession, sf: str) -> DataFrame:
    """All facets and a search that ignores case and marks."""
    return table(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & t.plain(F.col("c_name")).contains("1") & (F.col("c_acctbal") > 0)).select("c_custkey")


@query("SELECT c_custkey AS k, count(o_orderkey) AS n FROM customer SEMI JOIN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') x ON o_custkey = c_custkey LEFT JOIN orders ON orders.o_custkey = c_custkey GROUP BY 1")
def jon08_semi(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    kept = table(spark, sf, "customer").select("c_custkey").join(o.where("o_orderstatus = 'O'"), "c_custkey", "left_semi")
    return kept.join(o, "c_custkey", "left").groupBy(F.col("c_custkey").alias("k")).agg(F.count("o_orderkey").alias("n"))


@query("SELECT p_partkey, max(len(list_intersect(string_split(lower(p_name), ' '), string_split(lower(s_name), ' '))))::INTEGER AS best FROM part, supplier GROUP BY 1")
def jon18_best_score(spark: SparkSession, sf: str) -> DataFrame:
    """Greatest score of labels against labels, over the words that they share."""
    a = table(spark, sf, "part").select("p_partkey", F.split(F.lower("p_name"), " ").alias("x"))
    b = table(spark, sf, "supplier").select(F.explode(F.array_distinct(F.split(F.lower("s_name"), " "))).alias("w"), "s_suppkey")
    hits = a.select("p_partkey", F.explode(F.array_distinct("x")).alias("w")).join(b, "w").groupBy("p_partkey", "s_suppkey").agg(F.count("*").alias("n"))
    best = hits.groupBy("p_partkey").agg(F.max("n").cast("int").alias("best"))
    return a.select("p_partkey").join(best, "p_partkey", "left").fillna(0, ["best"])


@query("SELECT o_custkey, sum(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END)::BIGINT AS total, count(CASE WHEN o_orderkey % 3 <> 0 THEN 1 END) AS n FROM orders GROUP BY 1")
def agg18_optional_sum(spark: SparkSession, sf: str) -> DataFrame:
    """A sum over values that may be absent, null if all are."""
    given = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey"))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(given).alias("total"), F.count(given).alias("n"))


@query("SELECT p_partkey FROM part JOIN (SELECT p_type AS k, avg(p_size) AS m FROM part GROUP BY 1) ON p_type = k WHERE abs(p_size - m) > greatest(p_size, m) * 0.2")
def agg19_far_apart(spark: SparkSession, sf: str) -> DataFrame:
    means = table(spark, sf, "part").groupBy("p_type").agg(F.avg("p_size").alias("m"))
    return table(spark, sf, "part").join(means, "p_type").where("abs(p_size - m) > greatest(p_size, m) * 0.2").select("p_partkey")


@query("""SELECT count(*) AS triples, count(*) FILTER (WHERE o_kind = 'iri') AS links, count(*) FILTER (WHERE lang = 'en') AS english, count(*) FILTER (WHERE bad) AS spaces FROM (
SELECT 'iri' AS o_kind, NULL AS lang, false AS bad FROM customer UNION ALL SELECT 'literal', 'en', c_name LIKE '% %' FROM customer UNION ALL SELECT 'iri', NULL, false FROM customer UNION ALL SELECT 'iri', NULL, c_mktsegment LIKE '% %' FROM customer UNION ALL SELECT 'literal', NULL, false FROM customer)""")
def agg25_hygiene(spark: SparkSession, sf: str) -> DataFrame:
    """Conditional counts over a graph in one pass (AGG25, EVL05)."""
    graph = g.star_frame(spark, sf, ("customer",))
    return graph.agg(F.count("*").alias("triples"), F.count_if(F.col("o_kind") == "iri").alias("links"), F.count_if(F.col("o_lang") == "en").alias("english"), F.count_if(F.col("o").contains(" ")).alias("spaces"))


@query("SELECT c_mktsegment AS value, c_nationkey AS grp, count(*) AS n, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment)::INTEGER AS place FROM customer GROUP BY 1, 2")
def agg26_grouped_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("value"), F.col("c_nationkey").alias("grp")).agg(F.count("*").alias("n"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("n"), "value")))


@query("SELECT conv_id, max_by(text, turn) AS last, min_by(text, turn) AS first FROM conversations GROUP BY 1 HAVING count(DISTINCT turn) = count(*)")
def win03_first_and_last(spark: SparkSession, sf: str) -> DataFrame:
    """First-wins and last-wins by an explicit order (WIN03, JON12)."""
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.max_by("text", "turn").alias("last"), F.min_by("text", "turn").alias("first"), F.count("*").alias("n"), F.countDistinct("turn").alias("d"))
    return rows.where("n = d").select("conv_id", "last", "first")


@query("SELECT doc_id, min_by(x, r) AS label FROM (SELECT doc_id, lang || ':' || source AS x, CASE lang WHEN 'fr' THEN 0 WHEN 'en' THEN 1 ELSE 2 END AS r FROM documents) GROUP BY 1")
def scl28_best_label(spark: SparkSession, sf: str) -> DataFrame:
    rank = F.when(F.col("lang") == "fr", 0).when(F.col("lang") == "en", 1).otherwise(2)
    return table(spark, sf, "documents").groupBy("doc_id").agg(F.min_by(F.concat_ws(":", "lang", "source"), rank).alias("label"))


@query("""SELECT 'triples' AS measure, '' AS item, (SELECT 4 * count(*) FROM supplier) AS n UNION ALL SELECT 'entities', '', (SELECT count(*) FROM supplier)
UNION ALL SELECT 'class', 'Supplier', (SELECT count(*) FROM supplier) UNION ALL SELECT 'property', p, (SELECT count(*) FROM supplier) FROM (VALUES ('rdf:type'), ('rdfs:label'), ('locatedIn'), ('balance')) v(p)""")
def snk09_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.statistics(g.star_frame(spark, sf, ("supplier",)))


@query("""SELECT '<urn:kg:nation/' || n_nationkey || '> <rdfs:label> "' || n_name || '"@en .' AS value FROM nation""")
def snk05_ntriples(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.ntriples_lines(g.star_frame(spark, sf, ("nation",)).where(F.col("p") == g.LABEL))
