"""Rule-based materialization of a small ontology over a large graph.

The ontology (class and property axioms) is closed on the driver: it is a parameter of the job, not data. Each rule is then a
join of the graph with a small table of closed axioms; only transitive properties and chains need rounds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.operators.closure import cut, fixpoint
from lattik.operators.components import components
from lattik.plans.graph import SCHEMA, TERM, TYPE, dedup

KEY = ["s", "p", *TERM]


@dataclass
class Ontology:
    subclass: list[tuple[str, str]] = field(default_factory=list)
    subproperty: list[tuple[str, str]] = field(default_factory=list)
    domain: list[tuple[str, str]] = field(default_factory=list)
    range: list[tuple[str, str]] = field(default_factory=list)
    inverse: list[tuple[str, str]] = field(default_factory=list)
    transitive: list[str] = field(default_factory=list)
    #: (first property, second property, implied property)
    chain: list[tuple[str, str, str]] = field(default_factory=list)
    #: (property, value, class): subjects with the value are in the class, and the other way round
    has_value: list[tuple[str, str, str]] = field(default_factory=list)
    #: (property, class of the object or None for any, class)
    some_values: list[tuple[str, str | None, str]] = field(default_factory=list)
    #: (property, class of the object, property, value): subjects get the value
    implied_value: list[tuple[str, str, str, str]] = field(default_factory=list)
    functional: list[str] = field(default_factory=list)
    disjoint: list[tuple[str, str]] = field(default_factory=list)
    different: list[tuple[str, str]] = field(default_factory=list)


def closed(pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Transitive closure of a few axioms."""
    known = set(pairs)
    while new := {(a, d) for a, b in known for c, d in known if b == c} - known:
        known |= new
    return sorted(known)


def axioms(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split())))


def _typed(rows: DataFrame, subject: str, kind: str) -> DataFrame:
    return rows.select(F.col(subject).alias("s"), F.lit(TYPE).alias("p"), F.col(kind).alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"))


def _edge(rows: DataFrame, s: str, p: str, o: str) -> DataFrame:
    return rows.select(F.col(s).alias("s"), F.col(p).alias("p"), F.col(o).alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"))


def once(graph: DataFrame, onto: Ontology) -> DataFrame:
    """What one application of the rules that don't recurse on data derives from ``graph``."""
    spark, found = graph.sparkSession, []
    links = graph.where("o_kind = 'iri'")
    if onto.subproperty:
        rows = graph.join(axioms(spark, closed(onto.subproperty), "p q"), "p")
        found.append(rows.select("s", F.col("q").alias("p"), *TERM))
    if onto.inverse:
        both = sorted({*onto.inverse, *((b, a) for a, b in onto.inverse)})
        found.append(_edge(links.join(axioms(spark, both, "p q"), "p"), "o", "q", "s"))
    if onto.domain:
        found.append(_typed(graph.join(axioms(spark, onto.domain, "p c"), "p"), "s", "c"))
    if onto.range:
        found.append(_typed(links.join(axioms(spark, onto.range, "p c"), "p"), "o", "c"))
    if onto.has_value:
        table = axioms(spark, onto.has_value, "hp hv hc")
        found.append(_typed(links.join(table, (F.col("p") == F.col("hp")) & (F.col("o") == F.col("hv"))), "s", "hc"))
        members = links.where(F.col("p") == TYPE).join(table, F.col("o") == F.col("hc"))
        found.append(_edge(members, "s", "hp", "hv"))
    types = links.where(F.col("p") == TYPE).select(F.col("s").alias("o"), F.col("o").alias("oc"))
    if onto.some_values:
        free = [(p, c) for p, f, c in onto.some_values if f is None]
        if free:
            found.append(_typed(graph.join(axioms(spark, free, "p c"), "p"), "s", "c"))
        filled = [(p, f, c) for p, f, c in onto.some_values if f is not None]
        if filled:
            found.append(_typed(links.join(axioms(spark, filled, "p f c"), "p").join(types, "o").where("oc = f"), "s", "c"))
    if onto.implied_value:
        rows = links.join(axioms(spark, onto.implied_value, "p f q v"), "p").join(types, "o").where("oc = f")
        found.append(_edge(rows, "s", "q", "v"))
    if onto.subclass:
        rows = links.where(F.col("p") == TYPE).join(axioms(spark, closed(onto.subclass), "o d"), "o")
        found.append(_typed(rows, "s", "d"))
    out = spark.createDataFrame([], SCHEMA)
    for rows in found:
        out = out.unionByName(rows)
    return out


def paths(graph: DataFrame, delta: DataFrame, onto: Ontology) -> DataFrame:
    """Two-step derivations (chains and transitive properties) in which at least one step is new."""
    spark = graph.sparkSession
    rules = [*onto.chain, *((p, p, p) for p in onto.transitive)]
    if not rules:
        return spark.createDataFrame([], SCHEMA)
    table = axioms(spark, rules, "p q r")
    used = {p for r in rules for p in r[:2]}
    known, new = (x.where(F.col("p").isin(*used) & (F.col("o_kind") == "iri")).select("s", "p", "o") for x in (graph, delta))

    def two(a: DataFrame, b: DataFrame) -> DataFrame:
        second = b.select(F.col("s").alias("o"), F.col("p").alias("q"), F.col("o").alias("e"))
        return _edge(a.join(table, "p").join(second, ["o", "q"]), "s", "r", "e")

    return two(new, known).unionByName(two(known, new))


def materialize(graph: DataFrame, onto: Ontology) -> DataFrame:
    """The closure of ``graph`` under the rules, as a set of triples; equality is not replicated into triples."""

    def step(known: DataFrame, delta: DataFrame) -> DataFrame:
        derived = once(delta, onto).unionByName(paths(known, delta, onto))
        if onto.some_values or onto.implied_value:  # a new type of an old object
            fresh = delta.where(F.col("p") == TYPE).select(F.col("s").alias("o")).distinct()
            again = known.where("o_kind = 'iri'").join(fresh, "o", "left_semi").select(*known.columns)
            types = known.where(F.col("p") == TYPE).join(fresh.withColumnRenamed("o", "s"), "s", "left_semi").select(*known.columns)
            derived = derived.unionByName(once(again.unionByName(types), onto))
        return derived

    return fixpoint(dedup(graph), step, KEY)


def inferred(closure: DataFrame, base: DataFrame, local: str, trivial: tuple[str, ...] = ("owl:Thing",)) -> DataFrame:
    """Instance-level part of what was derived: not in the base, about local subjects, without trivial types and sameAs."""
    old = base.select(*(F.col(k).alias(f"_{k}") for k in KEY))
    same = F.lit(True)
    for k in KEY:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    rows = closure.join(old, same, "left_anti")
    return rows.where(F.col("s").startswith(local) & (F.col("p") != "owl:sameAs") & ~((F.col("p") == TYPE) & F.col("o").isin(*trivial)))


def same_as(graph: DataFrame, onto: Ontology) -> DataFrame:
    """Values that a functional property makes equal: ``node`` and ``label``, the smallest value of its equality class."""
    values = graph.where(F.col("p").isin(*onto.functional) & (F.col("o_kind") == "iri")).select("s", "p", "o").distinct()
    low = values.groupBy("s", "p").agg(F.min("o").alias("a"), F.count("*").alias("n")).where("n > 1")
    links = values.join(low, ["s", "p"]).where("o > a").select("a", F.col("o").alias("b"))
    return components(links)


def inconsistencies(closure: DataFrame, onto: Ontology) -> DataFrame:
    """``kind``, ``s``, ``a``, ``b``: disjoint classes, different values merged, functional literals with two values."""
    spark = closure.sparkSession
    types = cut(closure.where(F.col("p") == TYPE).select("s", "o").distinct())
    pairs = axioms(spark, [tuple(sorted(p)) for p in onto.disjoint] or [("", "")], "a b")
    one = types.select("s", F.col("o").alias("a")).join(pairs, "a").join(types.select("s", F.col("o").alias("b")), ["s", "b"])
    out = one.select(F.lit("disjoint").alias("kind"), "s", "a", "b")
    if onto.functional:
        literals = closure.where(F.col("p").isin(*onto.functional) & (F.col("o_kind") == "literal")).groupBy("s", "p").agg(F.min("o").alias("a"), F.max("o").alias("b")).where("a < b")
        out = out.unionByName(literals.select(F.lit("functional").alias("kind"), "s", "a", "b"))
        if onto.different:
            merged = same_as(closure, onto)
            differ = axioms(spark, [tuple(sorted(p)) for p in onto.different], "a b")
            equal = differ.join(merged.withColumnRenamed("node", "a"), "a").join(merged.withColumnRenamed("node", "b"), ["b", "label"])
            out = out.unionByName(equal.select(F.lit("different").alias("kind"), F.col("a").alias("s"), "a", "b"))
    nothing = types.where("o = 'owl:Nothing'").select(F.lit("nothing").alias("kind"), "s", F.col("o").alias("a"), F.col("o").alias("b"))
    return out.unionByName(nothing)
