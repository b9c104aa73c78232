"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; all rows are sorted by fractional rank and cut into shards of
equal counts, so that every shard has the corpus's mixture. Ranks are counted in hash buckets of bounded size (a bucket's
offset plus the rank within it), so neither a hot source nor the whole table is sorted in one task. Rows that agree in all that
is read are counted, and each copy gets a place of its own in the shuffle: repeated rows and null ids don't share a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattik.llm.common import materialize

#: Rows that one bucket holds on average, and the greatest number of buckets (their counts are summed in one task).
BUCKET_ROWS, MOST_BUCKETS = 2_000, 100_000
#: Copies of equal rows that one task writes out.
COPIES = 100_000


def shuffle_key(seed: int, *parts: str) -> Column:
    """60 bits of md5 over seed and columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _ranked(df: DataFrame, group: list[str], bucket: Column, order: list[Column | str], name: str, total: str) -> DataFrame:
    """Add ``name`` (rank from 0 within ``group``) and ``total`` (the group's rows); ``bucket`` follows the order."""
    placed = df.withColumn("_b", bucket)
    counts = placed.groupBy(*group, "_b").agg(F.count("*").alias("_n"))
    by = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    upto = by.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*(F.col(g).alias(f"_{g}") for g in group), F.col("_b").alias("_ob"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"), F.sum("_n").over(by).alias(total))
    on = F.col("_b") == F.col("_ob")
    for g in group:
        on = on & (F.col(g) == F.col(f"_{g}"))
    within = F.row_number().over(Window.partitionBy(*group, "_b").orderBy(*order)) - 1
    joined = placed.withColumn("_r", within).join(offsets, on)
    return joined.withColumn(name, F.col("_before") + F.col("_r")).drop("_b", "_ob", "_before", "_r", *(f"_{g}" for g in group))


def assign(docs: DataFrame, shards: int, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``id_col``, ``size``, ``text_crc32``, ``shard`` (0 to ``shards`` - 1), ``slot`` (gapless from 0 in each shard).

    Size: UTF-8 bytes of the text plus 8; a null text counts as empty. Shards' row counts are at most one apart. Null
    sources are one source of their own. Rows equal in id, source, size and checksum are interchangeable. Ties of the shuffle
    key go by id, then size and checksum. An empty table gives no rows; other columns, whatever their names, are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = materialize(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")))
    most = rows.agg(F.max("copies")).first()[0] or 0
    rows = rows.withColumn("block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
    if most > COPIES:
        rows = rows.repartition("id", "text_crc32", "block")
    within = F.expr(f"sequence(block * {COPIES}, least(copies, (block + 1) * {COPIES}) - 1)")
    rows = materialize(rows.select("id", "stratum", "size", "text_crc32", F.explode(within).alias("copy")).withColumn("key", shuffle_key(seed, "id", "size", "text_crc32", "copy")).drop("copy"))
    total = rows.count()
    if not total:
        return rows.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    buckets = min(MOST_BUCKETS, -(-total // BUCKET_ROWS))
    ties = ["key", F.col("id").asc_nulls_first(), "size", "text_crc32"]
    ranked = _ranked(rows, ["stratum"], F.floor(F.col("key") / F.lit(float(1 << 60)) * buckets).cast("int"), ties, "rank", "of")
    placed = ranked.withColumn("part", (F.col("rank") * 2 + 1) / (F.col("of") * 2).cast("double"))
    ordered = _ranked(placed, [], F.floor(F.col("part") * buckets).cast("int"), ["part", "stratum", *ties], "place", "all")
    shard = F.expr(f"place * {shards} div `all`")
    first = F.expr(f"(shard * `all` + {shards} - 1) div {shards}")
    return ordered.withColumn("shard", shard).select(F.col("id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = 17, id_col: str = "doc_id") -> None:
    """Write ``docs`` (ids must be unique) as one folder of Parquet files for each shard, rows in slot order."""
    placed = docs.join(assign(docs, shards, seed, id_col).select(id_col, "shard", "slot"), id_col)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
