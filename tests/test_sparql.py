"""Query text: the policy, parsing errors, and single constructs against hand-made rows."""

import pytest

from lattik.plans import sparql

GRAPH = [
    ("u1", "rdf:type", "Uni", "iri", None, None), ("u2", "rdf:type", "Uni", "iri", None, None), ("u1", "name", "Uni Eins", "literal", None, "de"),
    ("u1", "name", "Uni One", "literal", None, "en"), ("u2", "name", "Uni Two", "literal", None, "en"), ("u1", "in", "c1", "iri", None, None),
    ("c1", "partOf", "n1", "iri", None, None), ("n1", "partOf", "w", "iri", None, None), ("u1", "year", "1990", "literal", "integer", None), ("u2", "year", "2005", "literal", "integer", None),
]
P = "PREFIX : <> "


@pytest.fixture(scope="module")
def graph(spark):
    return spark.createDataFrame(GRAPH, "s string, p string, o string, o_kind string, o_dt string, o_lang string")


@pytest.mark.parametrize(
    "text, want",
    [
        ('SELECT ?u ?n { ?u :name ?n FILTER(LANG(?n) = "en") }', {("u1", "Uni One"), ("u2", "Uni Two")}),
        ("SELECT ?u { ?u :year ?y FILTER(?y > 1995 && ?y < 2010 || ?y = 3) }", {("u2",)}),
        ("SELECT ?u ?c { ?u a :Uni OPTIONAL { ?u :in ?c } }", {("u1", "c1"), ("u2", None)}),
        ("SELECT ?x { :u1 :in/:partOf* ?x }", {("c1",), ("n1",), ("w",)}),
        ("SELECT ?x { :u1 :in/:partOf+ ?x }", {("n1",), ("w",)}),
        ("SELECT ?x { :c1 ^:in ?x }", {("u1",)}),
        ("SELECT ?u { ?u a :Uni MINUS { ?u :in ?c } }", {("u2",)}),
        ("SELECT ?u { ?u a :Uni FILTER EXISTS { ?u :in ?c } }", {("u1",)}),
        ("SELECT ?u { { ?u :in :c1 } UNION { ?u :partOf :w } }", {("u1",), ("n1",)}),
        ("SELECT ?u ?k { VALUES (?u ?k) { (:u1 1) (:u9 2) } ?u a :Uni }", {("u1", "1")}),
        ('SELECT ?u (IF(STRSTARTS(?n, "Uni E"), "x", "y") AS ?t) { ?u :name ?n FILTER(?n NOT IN ("Uni Two")) }', {("u1", "x"), ("u1", "y")}),
        ("SELECT ?u (COUNT(?n) AS ?k) { ?u :name ?n } GROUP BY ?u HAVING (COUNT(?n) > 1)", {("u1", 2)}),
        ("SELECT ?n { { SELECT (MAX(?y) AS ?top) { ?u :year ?y } } ?u :year ?top ; :name ?n }", {("Uni Two",)}),
        ("SELECT ?u { ?u :year ?y } ORDER BY DESC(?y) LIMIT 1 OFFSET 1", {("u1",)}),
        ("SELECT ?p { :c1 ?p ?o }", {("partOf",)}),
    ],
)
def test_constructs(spark, graph, text, want):
    assert {tuple(r) for r in sparql.run(spark, graph, P + text).collect()} == want


@pytest.mark.parametrize("text", ["DELETE WHERE { ?s ?p ?o }", "SELECT * { SERVICE <http://x/> { ?s ?p ?o } }", "SELECT * FROM <http://x/> { ?s ?p ?o }", "SELECT ?x {", "", "SELECT ?x { ?x x:y ?z }", "SELECT ?x { ?x ?p ?z } extra", "SELECT ?x { ?x ?p ?z } # " + "x" * 30_000])
def test_refused(spark, graph, text):
    with pytest.raises(sparql.QueryError):
        sparql.run(spark, graph, text)


def test_words_in_strings_and_comments_are_allowed(spark, graph):
    text = P + 'SELECT ?u { ?u :name ?n FILTER(?n != "INSERT SERVICE") } # DELETE'
    assert sparql.run(spark, graph, text).count() == 3


def test_results(spark, graph):
    rows = sparql.run(spark, graph, P + "SELECT ?u ?c { ?u a :Uni OPTIONAL { ?u :in ?c } } ORDER BY ?u")
    assert [r["value"] for r in sparql.results_csv(rows).collect()] == ["u1,c1", "u2,"]
    assert [r["value"] for r in sparql.results_json(rows).collect()] == ['{"u":{"type":"literal","value":"u1"},"c":{"type":"literal","value":"c1"}}', '{"u":{"type":"literal","value":"u2"}}']
