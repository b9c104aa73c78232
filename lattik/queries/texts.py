"""Sample queries given as text, over the star schema as a graph; each must give the rows of its hand-written twin's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lattik.plans import graph as g
from lattik.plans import sparql
from lattik.queries import SQL, named, query  # noqa: F401  (named registers the SQL that is reused)

PREFIXES = "PREFIX : <> PREFIX kg: <urn:kg:>\n"
TEXTS = {
    "q02_region_by_segment": (("customer", "nation", "region"), """SELECT ?region (COUNT(DISTINCT ?u) AS ?n) (COUNT(DISTINCT ?b) AS ?building) (COUNT(DISTINCT ?m) AS ?machinery) WHERE {
        ?u a :Customer ; :locatedIn ?nation . ?nation :partOf ?r . ?r rdfs:label ?region FILTER(LANG(?region) = "en")
        OPTIONAL { ?u :inSegment kg:segment/BUILDING BIND(?u AS ?b) } OPTIONAL { ?u :inSegment kg:segment/MACHINERY BIND(?u AS ?m) } } GROUP BY ?region ORDER BY ?region"""),
    "q05_members": (("nation", "region"), """SELECT ?region (COUNT(DISTINCT ?m) AS ?members) (GROUP_CONCAT(DISTINCT ?name; SEPARATOR=", ") AS ?names) WHERE {
        ?m :partOf ?r ; rdfs:label ?name . ?r a :Region ; rdfs:label ?region } GROUP BY ?region"""),
    "q06_former_and_current": (("customer", "nation"), """SELECT ?former ?now (COUNT(DISTINCT ?u) AS ?n) WHERE { ?f :mergedInto ?t ; rdfs:label ?former . ?t rdfs:label ?now
        OPTIONAL { ?u a :Customer ; :locatedIn ?f } } GROUP BY ?former ?now"""),
    "q09_ranking": (("customer", "orders"), """SELECT ?name (COUNT(DISTINCT ?o) AS ?n) (COUNT(DISTINCT ?f) AS ?done) WHERE { ?o :placedBy ?u . ?u rdfs:label ?name
        OPTIONAL { ?o :status "F" BIND(?o AS ?f) } } GROUP BY ?u ?name ORDER BY DESC(?n) ?name LIMIT 12"""),
    "q16_without": (("customer", "nation", "orders"), """SELECT ?name ?place WHERE { ?u a :Customer ; rdfs:label ?name OPTIONAL { ?u :locatedIn ?t . ?t rdfs:label ?place }
        FILTER NOT EXISTS { ?u :inSegment kg:segment/BUILDING } FILTER NOT EXISTS { ?o :placedBy ?u ; :status "F" } } ORDER BY (!BOUND(?place)) ?place ?name"""),
    "q17_ask": (("customer",), "ASK { ?u :inSegment kg:segment/BUILDING ; :locatedIn kg:nation/3 }"),
    "q18_construct": (("customer", "nation"), """CONSTRUCT { ?u a :Builder ; :name ?name ; :inRegion ?r } WHERE { ?u :inSegment kg:segment/BUILDING ; rdfs:label ?name ; :locatedIn/:partOf ?r }"""),
    "q19_describe": (("customer", "nation", "region"), "DESCRIBE kg:nation/2"),
}


def _register(name: str, kinds: tuple[str, ...], text: str) -> None:
    def of(spark: SparkSession, sf: str) -> DataFrame:
        return sparql.run(spark, g.star_schema(spark, sf, kinds), PREFIXES + text)

    of.__name__, of.__doc__ = f"text_{name}", f"``{name}`` from query text."
    query(SQL[name])(of)


for _name, (_kinds, _text) in TEXTS.items():
    _register(_name, _kinds, _text)
