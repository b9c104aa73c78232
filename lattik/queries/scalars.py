"""Scalar functions on the tables' texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.functions import text as t
from lattik.queries import query, table


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'),
'[^\x00-\x7F]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents""")
def scl01_slug(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", t.slug(F.col("text")).alias("slug"))


@query("SELECT c_custkey, regexp_replace(url, '^.*[#/]', '') AS tail, CASE WHEN contains(url, '.') THEN url END AS url FROM customer JOIN pages ON page_id = c_custkey")
def scl06_url_and_tail(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("c_custkey"), t.local_name(F.col("url")).alias("tail"), t.norm_url(F.col("url")).alias("url"))
    return table(spark, sf, "customer").select("c_custkey").join(pages, "c_custkey")


YEARS = "list_filter(list_transform(regexp_split_to_array(coalesce(props, '') || ' ' || strftime(ts, '%Y-%m-%d %H:%M:%S'), '[^0-9]+'), lambda x: CASE WHEN length(x) = 4 THEN x::INTEGER END), lambda y: y BETWEEN 1800 AND 2026)"


@query(f"SELECT event_id, list_min({YEARS}) AS first_year, len({YEARS})::INTEGER AS n_years FROM events")
def scl07_years(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.coalesce("props", F.lit("")), F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf, "events").select("event_id", t.earliest_year(text, 2026).alias("first_year"), F.size(t.years_in(text, 2026)).alias("n_years"))


@query(r"""SELECT doc_id, nullif(lower(regexp_extract(text, '([A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)', 1)), '') AS email,
nullif(regexp_replace(regexp_extract(text, '(\+?\d[\d ()-]{7,}\d)', 1), '\s+', ' ', 'g'), '') AS phone FROM documents""")
def scl16_contacts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", t.email(F.col("text")).alias("email"), t.phone(F.col("text")).alias("phone"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN try_strptime(strftime(o_orderdate, '%Y-%m-') || lpad((o_orderkey % 33)::VARCHAR, 2, '0'), '%Y-%m-%d') IS NOT NULL
THEN strftime(o_orderdate, '%Y-%m-') || lpad((o_orderkey % 33)::VARCHAR, 2, '0') END AS valid FROM orders""")
def scl17_iso_date(spark: SparkSession, sf: str) -> DataFrame:
    made = F.concat(F.date_format("o_orderdate", "yyyy-MM-"), F.lpad((F.col("o_orderkey") % 33).cast("string"), 2, "0"))
    return table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.date_format(t.iso_date(made), "yyyy-MM-dd").alias("valid"))


@query(r"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(text, '\b([A-Z]{3})\b', 1), lambda x: x <> 'THE'))), ',') AS codes FROM documents""")
def scl18_codes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.array_join(t.codes(F.col("text"), ("THE",)), ",").alias("codes"))


@query("SELECT vec_id, round(embedding[1]::DOUBLE, 3) + 0.0 AS lat, round(embedding[2]::DOUBLE, 3) + 0.0 AS lon FROM embeddings")
def scl19_point(spark: SparkSession, sf: str) -> DataFrame:
    rounded = [F.round(F.col("embedding")[k].cast("double"), 3).cast("decimal(12,3)").cast("string") for k in (1, 0)]
    found = t.point(F.concat(F.lit("Point("), rounded[0], F.lit(" "), rounded[1], F.lit(")")))
    return table(spark, sf, "embeddings").withColumn("p", found).select("vec_id", "p.lat", "p.lon")


@query("""SELECT s_suppkey, (floor(s_acctbal + 0.5))::BIGINT AS half_up, (floor(-s_acctbal + 0.5))::BIGINT AS negative, CASE WHEN s_acctbal < 0 THEN 'debt' WHEN s_acctbal < 5000 THEN 'small' ELSE 'large' END AS bucket,
coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, 'odd') AS label FROM supplier""")
def scl22_if_coalesce_round(spark: SparkSession, sf: str) -> DataFrame:
    b = F.col("s_acctbal")
    bucket = F.when(b < 0, "debt").when(b < 5000, "small").otherwise("large")
    return table(spark, sf, "supplier").select(
        "s_suppkey", t.round_half_up(b).cast("bigint").alias("half_up"), t.round_half_up(-b).cast("bigint").alias("negative"), bucket.alias("bucket"),
        F.coalesce(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")), F.lit("odd")).alias("label"),
    )


@query("""SELECT 'https://en.wikipedia.org/wiki/' || replace(replace(url_encode(replace(p_name, ' ', '_')), '+', '%20'), '%2F', '/') AS page, 'kg:part/' || p_partkey AS short, p_partkey FROM part""")
def scl25_wiki_and_prefix(spark: SparkSession, sf: str) -> DataFrame:
    iri = F.concat(F.lit("urn:kg:part/"), F.col("p_partkey").cast("string"))
    return table(spark, sf, "part").select("p_partkey", t.wiki_url("en", F.col("p_name")).alias("page"), t.compact(iri, [("x", "http://x/"), ("kg", "urn:kg:")]).alias("short"))


TOK = "list_distinct(list_filter(regexp_split_to_array(trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-'), '-'), lambda x: x <> ''))"


@query(f"""SELECT a.p_partkey AS a, b.p_partkey AS b, len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y)))::DOUBLE AS jaccard,
len(list_intersect(x, y)) / greatest(1, least(len(x), len(y)))::DOUBLE AS overlap FROM (SELECT p_partkey, {TOK.format("p_name || ' ' || p_type")} AS x FROM part) a JOIN
(SELECT p_partkey, {TOK.format("p_name || ' ' || p_type")} AS y FROM part) b ON b.p_partkey = a.p_partkey + 1""")
def scl29_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of neighbours in the order of keys."""
    rows = table(spark, sf, "part").select("p_partkey", t.tokens(F.concat_ws(" ", "p_name", "p_type")).alias("x"))
    a, b = (rows.select(F.col("p_partkey").alias(k), F.col("x").alias(f"x{k}")) for k in "ab")
    pairs = a.join(b, F.col("a") + 1 == F.col("b"))
    return pairs.select("a", "b", t.jaccard(F.col("xa"), F.col("xb")).alias("jaccard"), t.overlap(F.col("xa"), F.col("xb")).alias("overlap"))


@query("""SELECT a.s_suppkey AS a, b.s_suppkey AS b, levenshtein(lower(a.s_name), lower(b.s_name))::INTEGER AS distance FROM supplier a, supplier b
WHERE a.s_suppkey < b.s_suppkey AND a.s_nationkey = b.s_nationkey AND levenshtein(lower(a.s_name), lower(b.s_name)) <= 3""")
def scl30_levenshtein(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier")
    a, b = (rows.select("s_nationkey", F.col("s_suppkey").alias(k), F.lower("s_name").alias(f"n{k}")) for k in "ab")
    pairs = a.join(b, "s_nationkey").where("a < b").withColumn("distance", F.levenshtein("na", "nb", 3))
    return pairs.where("distance >= 0").select("a", "b", "distance")


@query("SELECT c_custkey, sha256(c_name || chr(31) || c_nationkey::VARCHAR || chr(31) || c_mktsegment) AS digest FROM customer")
def scl33_digest(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", t.canonical_sha(F.col("c_name"), F.col("c_nationkey"), F.col("c_mktsegment")).alias("digest"))


@query("""SELECT c_nationkey AS nation, array_to_string(list_sort(list_distinct(list(c_mktsegment))), ',') AS segments, list_contains(list(c_mktsegment), 'BUILDING') AS building,
list_sort(list_distinct(list(c_mktsegment)))[1] AS first FROM customer GROUP BY 1""")
def scl34_arrays(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.array_sort(F.collect_set("c_mktsegment")).alias("s"))
    return rows.select("nation", F.array_join("s", ",").alias("segments"), F.array_contains("s", "BUILDING").alias("building"), F.element_at("s", 1).alias("first"))


@query("SELECT event_id, json_valid(props) AS valid, json_extract_string(props, '$.page') AS page FROM events")
def scl36_json(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$").isNotNull().alias("valid"), F.get_json_object("props", "$.page").alias("page"))


@query("""SELECT source, n, repeat('█', floor(n / total * 20 + 0.5)::INTEGER) || repeat('░', 20 - floor(n / total * 20 + 0.5)::INTEGER) AS bar
FROM (SELECT source, count(*) AS n, (SELECT count(*) FROM documents) AS total FROM documents GROUP BY 1)""")
def scl37_bars(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    total = docs.agg(F.count("*").alias("total"))
    return docs.groupBy("source").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select("source", "n", t.bar(F.col("n") / F.col("total")).alias("bar"))


@query("""SELECT p_partkey, CASE WHEN p_type LIKE '%STEEL' THEN 'steel' WHEN p_type LIKE '%BRASS' THEN 'brass' WHEN p_type LIKE 'PROMO%' THEN 'promo' ELSE 'other' END AS kind,
CASE WHEN p_size NOT BETWEEN 1 AND 45 THEN 'size' WHEN p_retailprice < 0 THEN 'price' END AS excluded FROM part""")
def flt12_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered name rules (FLT12, FLT15), exclusion with a logged reason (FLT13) and range guards (FLT14)."""
    kind = t.first_rule(F.col("p_type"), [("STEEL$", "steel"), ("BRASS$", "brass"), ("^PROMO", "promo")], "other")
    reason = F.when(~F.col("p_size").between(1, 45), "size").when(F.col("p_retailprice") < 0, "price")
    return table(spark, sf, "part").select("p_partkey", kind.alias("kind"), reason.alias("excluded"))
