"""What operators leave on disk and in the driver's memory."""

import gzip
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame

from lattik.llm import warc

ROWS = [(k, f"http://a.org/{k}", "<p>" + "many words " * 400 + str(k) + "</p>\r\n\r\n") for k in range(60)] + [(90, None, None), (91, "u", "")]


def test_gzip_archive_is_smaller_and_reads_the_same(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)
    laid = warc.write(pages, f"file://{tmp_path}/plain", 4).orderBy("file", "seq").collect()
    assert warc.write(pages, f"file://{tmp_path}/gz", 4, gzip=True).orderBy("file", "seq").collect() == laid
    size = lambda top: sum(f.stat().st_size for f in Path(tmp_path, top).rglob("part-*"))
    assert size("gz") * 5 < size("plain")
    read = [sorted(map(tuple, warc.read(spark, f"file://{tmp_path}/{top}").collect())) for top in ("plain", "gz")]
    assert read[0] == read[1] and len(read[1]) == len(ROWS)
    assert [(r["file"], r["seq"], r["offset"], r["length"], r["sha256"]) for r in laid] == sorted(r[2:7] for r in read[1])


def test_damaged_gzip_gives_what_can_be_unpacked():
    text = np.random.default_rng(3).bytes(300_000)
    packed = gzip.compress(text)
    assert warc.unpacked(packed) == text == warc.unpacked(text)
    assert warc.unpacked(packed + gzip.compress(b"next") + b"tail") == text + b"next" + b"tail"
    assert text.startswith(warc.unpacked(packed[:150_000])) and len(warc.unpacked(packed[:150_000])) > 140_000
    broken = warc.unpacked(packed[:-8] + b"\0" * 8)  # a wrong checksum
    assert broken[:200_000] == text[:200_000]
    assert warc.unpacked(b"\x1f\x8bno gzip") == b"\x1f\x8bno gzip"


def test_language_model_comes_without_rows_of_objects(spark, monkeypatch):
    from lattik.llm import langid

    monkeypatch.setattr(DataFrame, "toPandas", lambda self: 1 / 0)
    monkeypatch.setattr(type(spark.range(1)), "toPandas", lambda self: 1 / 0)
    docs = spark.createDataFrame([(1, "the ring", "en"), (2, "der ring", "de"), (3, "the", "en")], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.languages == ["de", "en"] and model.keys.dtype == np.uint64 and (np.diff(model.keys.astype(object)) > 0).all()
    at = {w: model.table[np.searchsorted(model.keys, np.uint64(langid.key_of(0, w)))] for w in ("the", "der", "ring")}
    size, s = np.array([2, 3]), langid.SMOOTH
    for w, k in (("the", (0, 2)), ("der", (1, 0)), ("ring", (1, 1))):
        assert np.allclose(at[w], np.log((np.array(k) + s) / (size + s * 3)), atol=1e-5)
