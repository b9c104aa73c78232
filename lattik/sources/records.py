"""Readers: N-Triples, JSON snapshots, curated CSV, query results; each with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One line of N-Triples: subject, predicate, then an IRI, a blank node, or a literal with datatype or language. Loops are
#: possessive: Java's matcher would recurse on long literals otherwise.
LINE = r'^\s*(?:<([^>]*+)>|(_:\S++))\s+<([^>]*+)>\s+(?:<([^>]*+)>|(_:\S++)|"((?:[^"\\]++|\\.)*+)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?)\s*\.\s*(?:#.*)?$'


def _unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\\\"), F.lit("\x00"))
    for mark, char in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"')):
        out = F.replace(out, F.lit(mark), F.lit(char))
    parts = F.transform(F.split(out, r"(?=\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})"), _code_point)
    return F.replace(F.array_join(parts, ""), F.lit("\x00"), F.lit("\\"))


def _code_point(part: Column) -> Column:
    """A part whose leading numeric escape, if any, is its character."""

    def char(digits: int) -> Column:
        hexed = F.lpad(F.substring(part, 3, digits), 8, "0")
        return F.concat(F.decode(F.unhex(hexed), "UTF-32"), F.substring(part, 3 + digits, 1 << 30))

    return F.when(part.rlike(r"^\\u[0-9A-Fa-f]{4}"), char(4)).when(part.rlike(r"^\\U[0-9A-Fa-f]{8}"), char(8)).otherwise(part)


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """The graph in N-Triples files, read line by line by any number of tasks; lines that are none are in ``ntriples_rejects``."""
    rows = spark.read.text(path).where(F.col("value").rlike(LINE))
    part = lambda k: F.nullif(F.regexp_extract("value", LINE, k), F.lit(""))
    literal = F.regexp_extract("value", LINE, 6)
    kind = F.when(part(4).isNotNull(), "iri").when(part(5).isNotNull(), "blank").otherwise("literal")
    return rows.select(
        F.coalesce(part(1), part(2)).alias("s"), part(3).alias("p"), F.coalesce(part(4), part(5), _unescape(literal)).alias("o"), kind.alias("o_kind"),
        part(7).alias("o_dt"), part(8).alias("o_lang"),
    ).dropDuplicates()


def ntriples_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither triples nor blank nor comments, for a gate to refuse."""
    return spark.read.text(path).where(~F.col("value").rlike(LINE) & ~F.col("value").rlike(r"^\s*(#|$)"))


def curated_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV of strings: trimmed, null as empty."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.select(*(F.coalesce(F.trim(F.regexp_replace(F.col(f"`{c}`"), "^﻿", "")), F.lit("")).alias(c.lstrip("﻿")) for c in rows.columns))


def snapshot(spark: SparkSession, path: str, schema: str, default_empty: bool = False) -> DataFrame:
    """A JSON snapshot; an empty table if it is missing and may be."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if default_empty and not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def keyed_snapshot(spark: SparkSession, path: str, value_schema: str, key: str = "key") -> DataFrame:
    """A JSON object of records by key, as rows."""
    text = spark.read.option("wholetext", True).text(path)
    rows = text.select(F.explode(F.from_json("value", f"map<string, struct<{value_schema}>>")).alias(key, "r"))
    return rows.select(key, "r.*")


def bindings(results: DataFrame, names: list[str], column: str = "value") -> DataFrame:
    """Rows from query results in JSON; an absent binding is null."""
    inner = ", ".join(f"`{n}`: struct<type: string, value: string>" for n in names)
    parsed = F.from_json(column, f"struct<results: struct<bindings: array<struct<{inner}>>>>")
    return results.select(F.explode(parsed["results"]["bindings"]).alias("b")).select(*(F.col(f"b.`{n}`.value").alias(n) for n in names))


def cache_key(method: Column, url: Column, params: Column) -> Column:
    """SHA-1 over method, url and sorted parameters (a map)."""
    ordered = F.array_sort(F.map_entries(params))
    flat = F.array_join(F.transform(ordered, lambda e: F.concat_ws("=", e["key"], e["value"])), "&")
    return F.sha1(F.concat_ws(" ", method, url, flat))


def through_cache(requests: DataFrame, cache: DataFrame, offline: bool = True) -> DataFrame:
    """Requests (``key``) with their cached ``body``; offline, a miss is an error."""
    found = requests.join(cache.select("key", "body"), "key", "left")
    if offline:
        found = found.withColumn("body", F.coalesce("body", F.raise_error(F.concat(F.lit("not cached: "), F.col("key")))))
    return found
