"""Writers: N-Triples, reports, resource documents, statistics and manifests; a swap that keeps the old data until the new is verified."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattik.operators.shapes import require


def _escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, mark in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ('"', '\\"')):
        out = F.replace(out, F.lit(char), F.lit(mark))
    return out


def ntriples_lines(graph: DataFrame) -> DataFrame:
    subject = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(F.concat(F.lit("<"), F.col("s"), F.lit(">")))
    tag = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang"))).when(F.col("o_dt").isNotNull(), F.concat(F.lit("^^<"), F.col("o_dt"), F.lit(">"))).otherwise("")
    o = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), F.col("o"), F.lit(">"))).when(F.col("o_kind") == "blank", F.col("o")).otherwise(F.concat(F.lit('"'), _escape(F.col("o")), F.lit('"'), tag))
    return graph.select(F.concat(subject, F.lit(" <"), F.col("p"), F.lit("> "), o, F.lit(" .")).alias("value"))


def write_ntriples(graph: DataFrame, path: str, compressed: bool = False) -> None:
    ntriples_lines(graph).write.option("compression", "gzip" if compressed else "none").text(path)


def write_report(rows: DataFrame, path: str, kept: DataFrame | None = None, key: str = "entity") -> None:
    """A CSV report, only about entities that were kept."""
    if kept is not None:
        rows = rows.join(kept.select(key), key, "left_semi")
    rows.write.option("header", True).csv(path)


def write_gated(records: DataFrame, checks: DataFrame, path: str) -> None:
    """Write only after the contract is met."""
    require(checks)
    records.write.mode("overwrite").parquet(path)


def documents(graph: DataFrame) -> DataFrame:
    """One JSON document for each subject: its properties, and who points to it."""
    prop = F.struct("p", "o", "o_kind", "o_dt", "o_lang")
    out = graph.groupBy("s").agg(F.array_sort(F.collect_list(prop)).alias("properties"))
    into = graph.where("o_kind = 'iri'").groupBy(F.col("o").alias("s")).agg(F.array_sort(F.collect_list(F.struct("s", "p"))).alias("incoming"))
    return out.join(into, "s", "left").select("s", F.to_json(F.struct("s", "properties", "incoming")).alias("document"))


def statistics(graph: DataFrame) -> DataFrame:
    """``measure, item, n``: triples, entities, and how many each class and property has."""
    one = graph.agg(F.count("*").alias("triples"), F.countDistinct("s").alias("entities"))
    totals = one.selectExpr("stack(2, 'triples', '', triples, 'entities', '', entities) AS (measure, item, n)")
    kinds = graph.where("p = 'rdf:type'").groupBy(F.col("o").alias("item")).agg(F.countDistinct("s").alias("n")).select(F.lit("class").alias("measure"), "item", "n")
    props = graph.groupBy(F.col("p").alias("item")).agg(F.count("*").alias("n")).select(F.lit("property").alias("measure"), "item", "n")
    return totals.unionByName(kinds).unionByName(props)


def manifest(files: DataFrame) -> DataFrame:
    """``path``, ``sha256`` of text files (``path``, ``content``), line ends normalised."""
    return files.select("path", F.sha2(F.regexp_replace(F.decode("content", "UTF-8"), "\r\n", "\n"), 256).alias("sha256"))


def same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two graphs without blank nodes are the same set."""
    a, b = a.distinct(), b.distinct()
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def replace_graph(graph: DataFrame, path: str) -> None:
    """Write next to ``path``, read back and compare, then swap; the old data stays as ``path.old`` until the next swap."""
    spark = graph.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    staged, old, now = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new", f"{path}.old", path))
    graph.write.mode("overwrite").parquet(f"{path}.new")
    if not same(spark.read.parquet(f"{path}.new"), graph):
        raise ValueError("what was written differs from the graph")
    fs = now.getFileSystem(conf)
    if fs.exists(now):
        fs.delete(old, True)
        fs.rename(now, old)
    fs.rename(staged, now)


def fixity(df: DataFrame) -> DataFrame:
    """``n``, ``sum``: count and order-free checksum of a table (64-bit hashes of whole rows, added up)."""
    return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("sum"))


def markdown_row(*cells: Column | str) -> Column:
    """A line of a Markdown table; bars inside cells are escaped."""
    text = [F.replace(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *text), F.lit(" |"))
