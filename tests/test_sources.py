"""Readers, writers, gates and streams."""

import pytest
from pyspark.sql import functions as F

from lattik.functions import text as t
from lattik.operators import fuse, reason, shapes
from lattik.operators.closure import reach
from lattik.plans import graph as g
from lattik.sources import records, sinks
from lattik.streaming import windows

SF = "/root/testdata/sf0.001"


def test_ntriples_round_trip(spark, tmp_path):
    graph = spark.createDataFrame(
        [("urn:a", "urn:p", 'say "x"\n\\t', "literal", None, "en"), ("urn:a", "urn:p", "5", "literal", "urn:int", None), ("_:b", "urn:q", "urn:c", "iri", None, None), ("urn:a", "urn:p", "", "literal", None, None)], g.SCHEMA
    )
    sinks.write_ntriples(graph, f"file://{tmp_path}/nt")
    back = records.ntriples(spark, f"file://{tmp_path}/nt")
    assert sinks.same(back, graph)
    sinks.replace_graph(graph, f"file://{tmp_path}/kept")
    sinks.replace_graph(graph.limit(1), f"file://{tmp_path}/kept")
    assert spark.read.parquet(f"file://{tmp_path}/kept").count() == 1 and spark.read.parquet(f"file://{tmp_path}/kept.old").count() == 4


def test_readers(spark, tmp_path):
    (tmp_path / "c.csv").write_text('﻿name,place\n x ,\n"a, b"," c"\n', encoding="utf-8")
    assert [tuple(r) for r in records.curated_csv(spark, f"file://{tmp_path}/c.csv").collect()] == [("x", ""), ("a, b", "c")]
    (tmp_path / "k.json").write_text('{"q1": {"n": 1}, "q2": {"n": 2}}')
    assert sorted(map(tuple, records.keyed_snapshot(spark, f"file://{tmp_path}/k.json", "n: int").collect())) == [("q1", 1), ("q2", 2)]
    assert records.snapshot(spark, f"file://{tmp_path}/none.json", "a int", default_empty=True).count() == 0
    answer = spark.createDataFrame([('{"results": {"bindings": [{"x": {"type": "uri", "value": "u"}}, {"y": {"type": "literal", "value": "v"}}]}}',)], "value string")
    assert [tuple(r) for r in records.bindings(answer, ["x", "y"]).collect()] == [("u", None), (None, "v")]
    cache = spark.createDataFrame([("k", "body")], "key string, body string")
    assert records.through_cache(spark.createDataFrame([("k",)], "key string"), cache).first()["body"] == "body"
    with pytest.raises(Exception, match="not cached"):
        records.through_cache(spark.createDataFrame([("z",)], "key string"), cache).collect()


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (t.slug, "Crème brûlée  Đặc sản!", "creme-brulee-dac-san"), (t.official_name, "Name (old) (1990)", "Name (old)"), (t.norm_url, "[example.org] x", "http://example.org"),
        (t.norm_url, "nothing", None), (t.earliest_year, "from 1998 to 12019, 1875", 1875), (t.parse_count, "about 12.500 students", 12500), (t.parse_count, "12 ha", None),
        (t.email, "write to A.B@x.example.org now", "a.b@x.example.org"), (t.iso_date, "2023-02-30", None), (t.tidy_parentheses, "a ( , ) b (; c ,)", "a b (c)"),
    ],
)
def test_scalars(spark, f, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(f(F.col("x"))).first()[0] == want


def test_scalar_structs(spark):
    row = spark.range(1).select(
        t.point(F.lit("Point(105.8 21.0)")).alias("p"), t.dms(F.array(*map(F.lit, ("21", "30", "S")))).alias("d"), t.person(F.lit("Prof. Dr. Anna Maria Lee, PhD")).alias("n"),
        t.year_after(F.lit("Built 1900. It was founded in 1956 by two."), "founded").alias("y"),
    ).first()
    assert (row["p"]["lat"], row["p"]["lon"], row["d"], row["y"]) == (21.0, 105.8, -21.5, 1956)
    assert (row["n"]["name"], row["n"]["honorific"]) == ("Anna Maria Lee", "Prof. Dr.")


def facts_of(spark, *rows):
    return spark.createDataFrame([(s, p, o, "iri", None, None) for s, p, o in rows], g.SCHEMA)


def test_closure_laws(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (None, 1)], "s int, o int")
    once = reach(edges)
    assert {tuple(r) for r in once.collect()} == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4)}
    assert sinks.same(reach(once), once)


def test_entailments_positive_and_negative(spark):
    onto = reason.Ontology(
        transitive=["partOf", "under"], chain=[("locatedIn", "partOf", "locatedIn"), ("governedBy", "under", "governedBy")], inverse=[("governedBy", "governs")],
        has_value=[("governedBy", "defence", "Military")], some_values=[("ownedBy", "Company", "Owned")], implied_value=[("ownedBy", "Company", "ownership", "private")],
    )
    base = facts_of(spark, ("u", "governedBy", "navy"), ("navy", "under", "defence"), ("u", "locatedIn", "city"), ("city", "partOf", "land"), ("land", "partOf", "world"), ("v", "ownedBy", "c"), ("c", g.TYPE, "Company"), ("w", "stateManagedBy", "defence"))
    got = {(r["s"], r["p"], r["o"]) for r in reason.materialize(base, onto).collect()}
    assert {("u", "governedBy", "defence"), ("u", g.TYPE, "Military"), ("defence", "governs", "u"), ("u", "locatedIn", "world"), ("v", "ownership", "private"), ("v", g.TYPE, "Owned")} <= got
    assert not {("w", g.TYPE, "Military"), ("u", "partOf", "world"), ("w", "governedBy", "defence")} & got


def test_gate_stops_before_writing(spark, tmp_path):
    bad = shapes.contract(spark.createDataFrame([(1, None)], "k int, name string"), "x", "k", [("name", F.col("name").isNotNull(), "required")])
    results = bad.select(F.lit(shapes.VIOLATION).alias("severity"), "key", "path", "message")
    with pytest.raises(ValueError, match="quality gate"):
        sinks.write_gated(spark.range(1), results, f"file://{tmp_path}/out")
    assert not (tmp_path / "out").exists()


def test_mint_keeps_registered_uris(spark):
    rows = spark.createDataFrame([(k, "same") for k in "abc"], "key string, base string")
    first = fuse.mint(rows, F.col("base"), "key")
    assert {r["key"]: r["uri"] for r in first.collect()} == {"a": "same", "b": "same-2", "c": "same-3"}
    more = fuse.mint(spark.createDataFrame([("0", "same"), ("b", "same")], "key string, base string"), F.col("base"), "key", first)
    assert {r["key"]: r["uri"] for r in more.collect()} == {"a": "same", "b": "same-2", "c": "same-3", "0": "same-4"}


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    kind = events.schema
    path = f"file://{tmp_path}/in"
    events.write.parquet(path)
    windows.replay(spark, path, kind, f"file://{tmp_path}/out", f"file://{tmp_path}/cp", "1 hour", "0 seconds", 0)
    streamed = {tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    batch = {tuple(r) for r in windows.over_limit(windows.tumbling(events, "1 hour", "0 seconds"), 0).collect()}
    assert streamed <= batch and len(streamed) >= len(batch) - 30  # windows after the last watermark stay open


def test_field_rules(spark):
    row = spark.range(1).select(
        t.english_name(F.lit("Univ. of | Technology and | Education (UTE)")).alias("a"), t.english_name(F.lit("One | Two")).alias("b"),
        t.english_name(F.lit("School of | arts")).alias("c"), t.english_name(F.lit(None).cast("string")).alias("d"),
        t.keyword_class(F.lit("It lies here. It is private. Public money."), [("private", "p"), ("Public", "q")]).alias("e"),
        t.keyword_class(F.lit("One. Two. private"), [("private", "p")]).alias("f"),
        t.aliased(F.create_map(*map(F.lit, ("founded", "1990", "established", "1980", "type", "x", "sort", "own"))), {"founded": "since", "established": "since", "type": "sort"}).alias("g"),
        t.first_known(F.array(*map(F.lit, "abc")), F.array(*map(F.lit, "bc")), F.lit("b")).alias("h"),
    ).first()
    assert (row["a"], row["b"], row["c"], row["d"]) == ("Univ. of Technology and Education", "One", "School of", "")
    assert (row["e"], row["f"], row["h"]) == ("p", None, "c")
    assert row["g"] == {"founded": "1990", "established": "1980", "type": "x", "sort": "own", "since": "1980"}
