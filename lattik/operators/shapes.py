"""Shape constraints and record contracts, compiled to DataFrame expressions.

Every check gives rows ``severity, focus, path, message, value``; a gate is passed if no row is a violation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATION, WARNING, INFO = "Violation", "Warning", "Info"
Check = Callable[[DataFrame], DataFrame]


def _result(rows: DataFrame, severity: str, focus: Column | str, path: str, message: str, value: Column | str | None = None) -> DataFrame:
    col = lambda x: F.col(x) if isinstance(x, str) else x
    return rows.select(
        F.lit(severity).alias("severity"), col(focus).cast("string").alias("focus"), F.lit(path).alias("path"), F.lit(message).alias("message"),
        (F.lit(None) if value is None else col(value)).cast("string").alias("value"),
    )


def targets(graph: DataFrame, of_class: str | None = None, subjects_of: str | None = None) -> DataFrame:
    """Focus nodes: members of a class, or subjects of a property."""
    rows = graph.where((F.col("p") == "rdf:type") & (F.col("o") == of_class)) if of_class else graph.where(F.col("p") == subjects_of)
    return rows.select(F.col("s").alias("focus")).distinct()


def values_of(graph: DataFrame, path: str) -> DataFrame:
    return graph.where(F.col("p") == path).select(F.col("s").alias("focus"), F.col("o").alias("value"), "o_kind", "o_dt", "o_lang")


def cardinality(graph: DataFrame, nodes: DataFrame, path: str, least: int = 0, most: int | None = None, lang: str | None = None, of_class: str | None = None, severity: str = VIOLATION) -> DataFrame:
    """minCount and maxCount; with ``lang`` or ``of_class`` only qualified values count."""
    vals = values_of(graph, path)
    if lang is not None:
        vals = vals.where(F.col("o_lang") == lang)
    if of_class is not None:
        vals = vals.join(targets(graph, of_class).withColumnRenamed("focus", "value"), "value", "left_semi")
    counted = nodes.join(vals.select("focus", "value").distinct(), "focus", "left").groupBy("focus").agg(F.count("value").alias("n"))
    wrong = F.col("n") < least
    if most is not None:
        wrong = wrong | (F.col("n") > most)
    return _result(counted.where(wrong), severity, "focus", path, f"count not in {least}..{'*' if most is None else most}", "n")


def each_value(graph: DataFrame, nodes: DataFrame, path: str, ok: Column, message: str, severity: str = VIOLATION) -> DataFrame:
    """datatype, nodeKind, in, pattern, languageIn, ranges: a condition on ``value, o_kind, o_dt, o_lang``; unknown counts as wrong."""
    vals = values_of(graph, path).join(nodes, "focus", "left_semi")
    return _result(vals.where(~F.coalesce(ok, F.lit(False))), severity, "focus", path, message, "value")


def unique_lang(graph: DataFrame, nodes: DataFrame, path: str, severity: str = VIOLATION) -> DataFrame:
    vals = values_of(graph, path).where("o_lang IS NOT NULL").join(nodes, "focus", "left_semi").distinct()
    return _result(vals.groupBy("focus", "o_lang").agg(F.count("*").alias("n")).where("n > 1"), severity, "focus", path, "more than one value in a language", "o_lang")


def value_class(graph: DataFrame, nodes: DataFrame, path: str, of_class: str, severity: str = VIOLATION) -> DataFrame:
    vals = values_of(graph, path).join(nodes, "focus", "left_semi")
    wrong = vals.join(targets(graph, of_class).withColumnRenamed("focus", "value"), "value", "left_anti")
    return _result(wrong, severity, "focus", path, f"value is not of class {of_class}", "value")


def less_or_equal(graph: DataFrame, nodes: DataFrame, low: str, high: str, cast: str = "double", severity: str = VIOLATION) -> DataFrame:
    a = values_of(graph, low).select("focus", F.col("value").try_cast(cast).alias("x"))
    b = values_of(graph, high).select("focus", F.col("value").try_cast(cast).alias("y"))
    return _result(a.join(b, "focus").join(nodes, "focus", "left_semi").where("x > y"), severity, "focus", low, f"greater than {high}", "x")


def asserted_ranges(graph: DataFrame, ranges: Sequence[tuple[str, str]], functional: Sequence[str]) -> DataFrame:
    """Declared datatypes of properties, and properties with at most one value."""
    table = F.broadcast(graph.sparkSession.createDataFrame(list(ranges), "p string, dt string"))
    wrong = graph.join(table, "p").where(~F.col("o_dt").eqNullSafe(F.col("dt")))
    first = wrong.select(F.lit(VIOLATION).alias("severity"), F.col("s").alias("focus"), F.col("p").alias("path"), F.lit("datatype").alias("message"), F.col("o").alias("value"))
    many = graph.where(F.col("p").isin(*functional)).groupBy("s", "p").agg(F.countDistinct("o", F.coalesce("o_dt", F.lit("")), F.coalesce("o_lang", F.lit(""))).alias("n")).where("n > 1")
    return first.unionByName(many.select(F.lit(VIOLATION).alias("severity"), F.col("s").alias("focus"), F.col("p").alias("path"), F.lit("functional").alias("message"), F.col("n").cast("string").alias("value")))


def ill_typed(graph: DataFrame) -> DataFrame:
    """Literals whose lexical form their datatype doesn't have."""
    kinds = {"integer": "decimal(38,0)", "decimal": "decimal(38,10)", "boolean": "boolean", "date": "date", "dateTime": "timestamp_ntz"}
    wrong = reduce(lambda a, k: a | ((F.col("o_dt") == k) & F.col("o").try_cast(kinds[k]).isNull()), kinds, F.lit(False))
    return graph.where((F.col("o_kind") == "literal") & wrong).select("s", "p", "o", "o_dt")


def contract(records: DataFrame, entity: str, key: str, rules: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """``entity_type, key, path, message`` of each rule (path, condition, message) that a record fails; null conditions fail."""
    failed = F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(path).alias("path"), F.lit(message).alias("message"))) for path, ok, message in rules))
    rows = records.select(F.col(key).cast("string").alias("key"), F.explode(F.filter(failed, lambda x: x.isNotNull())).alias("f"))
    return rows.select(F.lit(entity).alias("entity_type"), "key", "f.path", "f.message")


def references(records: DataFrame, key: str, fk: str, target: DataFrame, target_key: str) -> DataFrame:
    """Values of ``fk`` (a column or an array) that ``target`` lacks."""
    ref = F.explode(fk) if dict(records.dtypes)[fk].startswith("array") else F.col(fk)
    rows = records.select(F.col(key).alias("key"), ref.alias("ref")).where("ref IS NOT NULL")
    return rows.join(target.select(F.col(target_key).alias("ref")), "ref", "left_anti")


def passed(results: DataFrame, allow_warnings: bool = True) -> bool:
    wrong = results.where(F.col("severity") == VIOLATION) if allow_warnings else results.where(F.col("severity") != INFO)
    return wrong.isEmpty()


def require(results: DataFrame, allow_warnings: bool = True) -> None:
    """Stop before anything is overwritten."""
    if not passed(results, allow_warnings):
        raise ValueError(f"quality gate: {results.limit(5).collect()}")
