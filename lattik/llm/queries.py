"""The queries of this subpackage, for ``__spark_entry__``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.llm import bpe, decontam, html_text, langid, minhash, quality, sharding, toxicity, urlfilter, warc
from lattik.llm.common import materialize, shared_dir

#: The vocabulary file; its path is a parameter of the operators.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def fold(key: str, parts: int, held: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``held``; false for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == held, F.lit(False))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~fold("doc_id", 3, 1)))
    return toxicity.score(docs, model).select("doc_id", fold("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~fold("doc_id", 4, 2)))
    return langid.identify(docs, model).select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY, keep_ids=False)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


SHARDS = 24


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: In the replica, pages whose key has this remainder have their first character overwritten, or are lost.
ROT = (97, 5, 6)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica is written as WARC files and read back, with records overwritten and lost, and is audited against the pages."""
    pages = table(spark, sf_dir, "pages")
    files, rest = warc.files_for(pages), warc.key_of(warc.name_of("page_id", "url")) % ROT[0]
    rotten = F.when(rest == ROT[1], F.concat(F.lit("?"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(pages.where(rest != ROT[2]).withColumn("html", rotten), path, files, gzip=True)
    replica = materialize(warc.read(spark, path, payload=False))
    first = materialize(warc.layout(pages, files))
    return warc.audit(first, replica).select(F.col("id").alias("page_id"), "file", "seq", "offset", "length", "sha256", "status")


OP9_SQL = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, regexp_replace(coalesce(url, ''), '[\\r\\n]', '', 'g') AS u,
           md5(coalesce(page_id::VARCHAR, '') || chr(10) || regexp_replace(coalesce(url, ''), '[\\r\\n]', '', 'g')) AS n FROM pages),
q AS (SELECT *, ('0x' || substr(n, 1, 15))::BIGINT AS k FROM p),
r AS (
    SELECT page_id, k, n, u, body, chr(13) || chr(10) AS e,
           floor(k::DOUBLE / {float(1 << 60)!r}::DOUBLE * (SELECT greatest(1, (count(*) + {warc.FILE_RECORDS} - 1) // {warc.FILE_RECORDS}) FROM pages))::INTEGER AS file FROM q),
w AS (
    SELECT page_id, k, file, 'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:uuid:' || substr(n, 1, 8) || '-' || substr(n, 9, 4)
           || '-' || substr(n, 13, 4) || '-' || substr(n, 17, 4) || '-' || substr(n, 21, 12) || '>' || e || 'WARC-Date: {warc.DATE}' || e
           || 'WARC-Target-URI: ' || u || e || 'Content-Type: text/html' || e || 'WARC-Payload-Digest: sha256:' || sha256(body) || e
           || 'Content-Length: ' || strlen(body)::VARCHAR || e || e || body || e || e AS rec FROM r),
s AS (SELECT page_id, k, file, strlen(rec)::BIGINT AS length, sha256(rec) AS sha256 FROM w)
SELECT page_id, file, (row_number() OVER o - 1)::BIGINT AS seq, (sum(length) OVER o - length)::BIGINT AS "offset", length, sha256,
       CASE k % {ROT[0]} WHEN {ROT[1]} THEN 'corrupt' WHEN {ROT[2]} THEN 'missing' ELSE 'ok' END AS status
FROM s WINDOW o AS (PARTITION BY file ORDER BY k, sha256 ROWS UNBOUNDED PRECEDING)
"""


#: Verdict and rule (host/path), as the contract of op10 fixes them.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Words of host names that mark a labelled URL as one to block; URLs of other hosts are labelled as allowed.
URL_SEEDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "track", "viagra", "warez")


def op10_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    seeded = pages.select("url", urlfilter.host(F.col("url")).rlike(r"(^|[.-])(" + "|".join(URL_SEEDS) + r")([.-]|$)").cast("int").alias("blocked"))
    return urlfilter.judge(pages, urlfilter.train(seeded.where("url IS NOT NULL")), URL_RULES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_minhash, op2_html, op3_toxicity, op4_langid, op5_bpe, op6_quality, op7_sharding, op8_decontam, op9_warc, op10_urlfilter)}


def oracle_sql() -> dict[str, str]:
    return {"op9_warc": OP9_SQL}
