"""WARC archives and their Merkle fixity audit.

Pages become WARC records in files of about ``FILE_RECORDS`` records, ordered by a key that is taken from the record id, over all
files. So a range of keys is an ordered range of offsets, whatever was lost or added elsewhere. The leaves of the tree are the
ranges of the last level: a hash over their records (as a sum of the records' hashes), their number and bytes. An inner node
hashes its ``FANOUT`` children and their ranges. Two replicas are compared from the root down, and only children of nodes that
differ are looked at; under the last ones, records are compared by their ids, so a lost or added record is told from a corrupt
one and no other record is reported.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattik.llm.common import materialize

FILE_RECORDS, FANOUT = 500, 16
#: Bits of a key that choose a child.
BITS = 4
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def name_of(id_col: str, url_col: str) -> Column:
    """The record id's 32 digits: md5 over id and url."""
    return F.md5(F.concat_ws("\n", F.coalesce(F.col(id_col).cast("string"), F.lit("")), _target(url_col)))


def _target(url_col: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\r\n]", "")


def key_of(name: Column) -> Column:
    """The first 60 bits of a record id."""
    return F.conv(F.substring(name, 1, 15), 16, 10).cast("bigint")


def file_of(key: Column, files: int) -> Column:
    return F.floor(key / F.lit(float(1 << 60)) * files).cast("int")


def record(id_col: str, url_col: str, html_col: str) -> Column:
    """The whole record: header block, payload and the closing line ends. Null url and page count as empty."""
    body = F.coalesce(F.col(html_col), F.lit(""))
    url, name = _target(url_col), name_of(id_col, url_col)
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"),
        F.concat_ws("-", *(F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nWARC-Payload-Digest: sha256:"), F.sha2(body, 256),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(END), body, F.lit(END),
    )


def files_for(pages: DataFrame) -> int:
    return max(1, -(-pages.count() // FILE_RECORDS))


def layout(pages: DataFrame, files: int, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id``, ``name``, ``key``, ``file``, ``seq`` (from 0 in the file), ``offset``, ``length``, ``sha256`` of each record; payloads are not shuffled.

    Null ids and urls count as empty; rows of equal id and url have one record id and lie side by side in one file.
    """
    rows = pages.select(F.col(id_col).alias("id"), name_of(id_col, url_col).alias("name"), record(id_col, url_col, html_col).alias("rec"))
    rows = rows.select("id", "name", key_of(F.col("name")).alias("key"), F.octet_length("rec").cast("bigint").alias("length"), F.sha2("rec", 256).alias("sha256"))
    rows = rows.withColumn("file", file_of(F.col("key"), files))
    by = Window.partitionBy("file").orderBy("key", "sha256")
    before = F.coalesce(F.sum("length").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("seq", (F.row_number().over(by) - 1).cast("bigint")).withColumn("offset", before)


def write(pages: DataFrame, path: str, files: int | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", gzip: bool = False) -> DataFrame:
    """Write ``path/file=N/`` WARC files natively (a record's closing line ends are the writer's separator); returns the layout.

    With ``gzip`` each file is one gzip stream; offsets and lengths are those of the unpacked file.
    """
    files = files or files_for(pages)
    rec = record(id_col, url_col, html_col)
    rows = pages.select(key_of(name_of(id_col, url_col)).alias("key"), F.sha2(rec, 256).alias("sha"), rec.alias("rec")).withColumn("file", file_of(F.col("key"), files))
    rows = rows.repartition("file").sortWithinPartitions("file", "key", "sha")
    rows.select("file", F.expr(f"left(rec, char_length(rec) - {len(END)})").alias("value")).write.partitionBy("file").option("lineSep", END).option("compression", "gzip" if gzip else "none").text(path)
    return layout(pages, files, id_col, url_col, html_col)


def read(spark, path: str, payload: bool = True) -> DataFrame:
    """Records of WARC files: ``name``, ``key``, ``file``, ``seq``, ``offset``, ``length``, ``sha256``, ``uri`` and, if asked for, ``payload``.

    A file, plain or of gzip streams, is read by one task. Bytes that don't parse as a record are one last record of the file, with an empty name and null
    ``uri`` and ``payload``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = [(name, int(name[:15] or "0", 16), file, n, at, len(raw), hashlib.sha256(raw).hexdigest(), uri, *[body] * payload) for n, (at, raw, name, uri, body) in enumerate(split(unpacked(data)))]
                for i in range(0, len(out), 256):
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out[i : i + 256]], schema)

    fields = [("name", pa.string()), ("key", pa.int64()), ("file", pa.int32()), ("seq", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("sha256", pa.string()), ("uri", pa.string())]
    schema = pa.schema(fields + [("payload", pa.binary())] * payload)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    named = files.select(F.regexp_extract("path", r"/file=(\d+)/", 1).cast("int").alias("file"), "content")
    return named.mapInArrow(run, "name string, key bigint, file int, seq bigint, offset bigint, length bigint, sha256 string, uri string" + ", payload binary" * payload)


def unpacked(data: bytes, step: int = 1 << 16) -> bytes:
    """The bytes of gzip streams, as far as they can be unpacked; what can't be follows as it is, as do bytes without gzip's mark."""
    out = []
    while data.startswith(b"\x1f\x8b"):
        stream, at = zlib.decompressobj(31), 0
        try:
            while at < len(data) and not stream.eof:
                out.append(stream.decompress(data[at : at + step]))
                at += step
        except zlib.error:
            return b"".join([*out, data[at:]])
        data = stream.unused_data + data[at:]
    return b"".join([*out, data])


def split(data: bytes) -> Iterator[tuple[int, bytes, str, str | None, bytes | None]]:
    """Offset, bytes, record id's digits, target and payload of each record."""
    at, end = 0, END.encode()
    while at < len(data):
        head = data.find(end, at)
        fields = dict(x.split(b": ", 1) for x in data[at:head].split(b"\r\n")[1:] if b": " in x) if head >= 0 and data.startswith(b"WARC/", at) else {}
        size, name = fields.get(b"Content-Length", b""), fields.get(b"WARC-Record-ID", b"").removeprefix(b"<urn:uuid:").removesuffix(b">").replace(b"-", b"")
        stop = head + len(end) + int(size) + len(end) if size.isdigit() else -1
        if stop < 0 or stop > len(data) or data[stop - len(end) : stop] != end or len(name) != 32 or name.strip(b"0123456789abcdef"):
            yield at, data[at:], "", None, None
            return
        yield at, data[at:stop], name.decode(), fields.get(b"WARC-Target-URI", b"").decode("utf-8", "replace"), data[head + len(end) : stop - len(end)]
        at = stop


def height_for(records: int) -> int:
    """Levels of the tree below the root, so that a leaf's range holds about ``FANOUT`` records; replicas are compared at one height."""
    height = 1
    while FANOUT ** (height + 1) < records and height < 14:
        height += 1
    return height


def tree(records: DataFrame, height: int) -> list[DataFrame]:
    """Levels from the leaves to the root (one row; none for an empty archive): ``idx``, ``hash``, ``n``, ``lo``, ``hi``.

    ``idx`` is the range's number on its level; ``lo`` and ``hi`` are the file and offset that it begins and ends at. Leaves are
    sums that are aggregated before the shuffle, so a record id that very many rows share is no hot spot.
    """
    mark = F.sha2(F.concat_ws("|", "name", "length", "sha256"), 256)
    part = lambda k: F.sum(F.conv(F.substring("mark", k, 15), 16, 10).cast("decimal(38,0)"))
    rows = records.select((F.shiftright("key", 60 - BITS * height)).alias("idx"), mark.alias("mark"), "length", F.struct("file", "offset").alias("lo"), F.struct("file", (F.col("offset") + F.col("length")).alias("offset")).alias("hi"))
    sums = rows.groupBy("idx").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), part(1).alias("x"), part(16).alias("y"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    level = materialize(sums.select("idx", F.sha2(F.concat_ws("|", F.lit("leaf"), "n", "bytes", "x", "y"), 256).alias("hash"), "n", "lo", "hi"))
    levels = [level]
    for _ in range(height):
        kids = F.array_sort(F.collect_list(F.struct("idx", "hash")))  # FANOUT at most
        above = level.groupBy(F.shiftright("idx", BITS).alias("idx")).agg(kids.alias("kids"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        joined = F.array_join(F.transform("kids", lambda k: F.concat_ws(":", k["idx"].cast("string"), k["hash"])), ",")
        level = materialize(above.select("idx", F.sha2(F.concat_ws("|", F.lit("node"), "n", joined), 256).alias("hash"), "n", "lo", "hi"))
        levels.append(level)
    return levels


def root(levels: list[DataFrame]) -> str | None:
    row = levels[-1].select("hash").first()
    return row and row["hash"]


def compare(records: DataFrame, replica: DataFrame) -> DataFrame:
    """Records in which the replica differs: ``name``, ``sha256`` (null for extra ones), ``status`` (corrupt, missing or extra).

    Trees of one height are descended together; only children of differing nodes are read. Of rows that share a record id, those
    with a content that the replica has fewer of are reported.
    """
    height = height_for(records.count())
    a, b = tree(records, height), tree(replica, height)
    wrong = None
    for x, y in zip(a[::-1], b[::-1]):
        left, right = x.select("idx", F.col("hash").alias("hx")), y.select("idx", F.col("hash").alias("hy"))
        if wrong is not None:
            up = wrong.withColumnRenamed("idx", "up")
            left, right = (z.join(up, F.shiftright("idx", BITS) == F.col("up"), "left_semi") for z in (left, right))
        wrong = materialize(left.join(right, "idx", "full").where(~F.col("hx").eqNullSafe(F.col("hy"))).select("idx"))
        if wrong.isEmpty():
            break
    under = lambda z, n: z.select("name", "sha256", F.shiftright("key", 60 - BITS * height).alias("idx")).join(wrong, "idx", "left_semi").groupBy("name", "sha256").agg(F.count("*").alias(n))
    counts = under(records, "x").join(under(replica, "y"), ["name", "sha256"], "full").fillna(0, ["x", "y"]).where("x <> y")
    by_name = counts.groupBy("name").agg(F.max(F.col("x") > F.col("y")).alias("less"), F.max(F.col("y") > F.col("x")).alias("more"))
    lost = counts.where("x > y").join(by_name, "name").select("name", "sha256", F.when(F.col("more"), "corrupt").otherwise("missing").alias("status"))
    extra = by_name.where("NOT less").select("name", F.lit(None).cast("string").alias("sha256"), F.lit("extra").alias("status"))
    return lost.unionByName(extra)


def audit(records: DataFrame, replica: DataFrame) -> DataFrame:
    """``records`` (a layout, or records that were read) and their ``status`` in the replica: ok, corrupt or missing.

    Records that only the replica has are not rows here; ``compare`` gives them. Empty archives give no rows; an empty replica
    misses all.
    """
    wrong = compare(records, replica).where("status <> 'extra'")
    return records.join(wrong, ["name", "sha256"], "left").withColumn("status", F.coalesce("status", F.lit("ok")))
