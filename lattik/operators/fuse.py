"""Fusion of records from several sources, with logs of what was decided; duplicates, crosswalks and minted identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of(*sources: tuple[str, Column]) -> Column:
    """Value and source of the first source that has one."""
    return F.coalesce(*(F.when(c.isNotNull(), F.struct(c.alias("value"), F.lit(name).alias("source"))) for name, c in sources))


def unique_or_null(values: Column) -> Column:
    """The only distinct value of an array."""
    kept = F.array_distinct(F.filter(values, lambda x: x.isNotNull()))
    return F.when(F.size(kept) == 1, F.element_at(kept, 1))


def conflicts(rows: DataFrame, key: str, field: str, chosen: Column, sources: Sequence[tuple[str, Column]]) -> DataFrame:
    """``entity, field, chosen, candidates`` where sources differ."""
    each = F.array(*(F.struct(F.lit(n).alias("source"), c.cast("string").alias("value")) for n, c in sources))
    given = F.filter(each, lambda x: x["value"].isNotNull())
    log = rows.select(F.col(key).alias("entity"), F.lit(field).alias("field"), chosen.cast("string").alias("chosen"), given.alias("c"))
    text = F.array_join(F.transform("c", lambda x: F.concat_ws("=", x["source"], x["value"])), "; ")
    return log.where(F.size(F.array_distinct(F.transform("c", lambda x: x["value"]))) > 1).select("entity", "field", "chosen", text.alias("candidates"))


def filled(rows: DataFrame, key: str, field: str, primary: Column, fallback: tuple[str, Column]) -> DataFrame:
    """``entity, field, value, source`` where only the fallback has a value."""
    name, value = fallback
    return rows.where(primary.isNull() & value.isNotNull()).select(F.col(key).alias("entity"), F.lit(field).alias("field"), value.cast("string").alias("value"), F.lit(name).alias("source"))


def far_apart(a: Column, b: Column, share: float = 0.2) -> Column:
    return F.abs(a - b) > F.greatest(a, b) * share


def latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The last row of each key in the given descending order."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def merge_duplicates(rows: DataFrame, name: str, key: str, rank: Sequence[Column], fill: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """One record for each name: the keeper is the largest by ``rank`` and key; blanks are filled from the others, best first; sets united."""
    order = F.struct(*(c.alias(f"r{i}") for i, c in enumerate(rank)), F.col(key).alias("rk"))
    aggs = [F.max_by(key, order).alias(key)]
    aggs += [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in fill]
    aggs += [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in sets]
    return rows.groupBy(name).agg(*aggs, F.array_sort(F.collect_set(key)).alias("merged"))


def mint(rows: DataFrame, base: Column, key: str, registry: DataFrame | None = None, longest: int = 80) -> DataFrame:
    """``key, uri``: slugs with ``-2``, ``-3`` for collisions, in order of the key; keys in ``registry`` (key, uri) keep theirs.

    New suffixes go on behind the registry's largest of the same base, so no uri is given twice.
    """
    slugged = rows.select(F.col(key).alias("key"), F.substring(base, 1, longest).alias("base"))
    if registry is None:
        taken = None
    else:
        slugged = slugged.join(registry.select("key"), "key", "left_anti")
        number = F.coalesce(F.nullif(F.regexp_extract("uri", r"-(\d+)$", 1), F.lit("")).try_cast("int"), F.lit(1))
        both = registry.select(F.col("uri").alias("base"), F.lit(1).alias("n")).union(registry.select(F.regexp_replace("uri", r"-\d+$", "").alias("base"), number))
        taken = both.groupBy("base").agg(F.max("n").alias("last"))
        slugged = slugged.join(taken, "base", "left")
    last = F.lit(0) if taken is None else F.coalesce("last", F.lit(0))
    place = F.row_number().over(Window.partitionBy("base").orderBy("key")) + last
    minted = slugged.withColumn("k", place).select("key", F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.col("k").cast("string"))).alias("uri"))
    return minted if registry is None else registry.select("key", "uri").unionByName(minted)


def crosswalk(rows: DataFrame, column: str, table: DataFrame, old: str, new: str) -> DataFrame:
    """Replace retired values of a column by what they were merged into (one hop)."""
    return rows.join(F.broadcast(table.select(F.col(old).alias(column), F.col(new).alias("_into"))), column, "left").withColumn(column, F.coalesce("_into", column)).drop("_into")


def observation(rows: DataFrame, subject: Column, prop: str, value: Column, since: Column, through: Column, source: str) -> DataFrame:
    """Reified statements with an identifier from their content; bounds in the wrong order are an error."""
    whole = F.concat_ws("|", subject, F.lit(prop), value.cast("string"), F.coalesce(since.cast("string"), F.lit("")), F.coalesce(through.cast("string"), F.lit("")), F.lit(source))
    status = F.when(since.isNotNull() | through.isNotNull(), "qualified").otherwise("unqualified")
    ok = since.isNull() | through.isNull() | (since <= through)
    return rows.select(
        F.when(ok, F.sha2(whole, 256)).otherwise(F.raise_error(F.lit("bounds in the wrong order"))).alias("id"), subject.alias("subject"), F.lit(prop).alias("property"),
        value.alias("value"), since.alias("valid_from"), through.alias("valid_through"), status.alias("status"), F.lit(source).alias("source"),
    )


def short_names(names: Column) -> Column:
    """Distinct and sorted: 2 to 15 characters, not all in lower case."""
    fits = F.filter(names, lambda x: F.length(x).between(2, 15) & ~((F.lower(x) == x) & (F.upper(x) != x)))
    return F.array_sort(F.array_distinct(fits))


def curated_over(reported: DataFrame, curated: DataFrame, key: str) -> DataFrame:
    """Curated rows, and those reported rows whose key has no curated one; ``basis`` tells which. Both are joined on ``key`` only."""
    kept = reported.join(curated.select(key).distinct(), key, "left_anti").withColumn("basis", F.lit("reported"))
    return kept.unionByName(curated.withColumn("basis", F.lit("curated")))
