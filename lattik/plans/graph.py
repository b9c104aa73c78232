"""Typed triples and the graph-pattern algebra over them.

A graph is a DataFrame ``s, p, o, o_kind, o_dt, o_lang`` with set semantics. Patterns become filters and projections of it, and
groups of patterns equi joins on shared variables, so that Catalyst pushes the predicates down and chooses the joins. A
solution sequence is a DataFrame with one column for each variable; unbound is null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.operators.closure import reach

NS = "urn:kg:"
TYPE, LABEL = "rdf:type", "rdfs:label"
TERM = ("o", "o_kind", "o_dt", "o_lang")
SCHEMA = "s string, p string, o string, o_kind string, o_dt string, o_lang string"


def iri(kind: str, key: Column | str) -> Column:
    return F.concat(F.lit(f"{NS}{kind}/"), (F.col(key) if isinstance(key, str) else key).cast("string"))


def fact(s: Column, p: str, o: Column, dt: str | None = None, lang: Column | str | None = None) -> Column:
    """A triple as a struct: an IRI object without ``dt`` and ``lang``, else a literal."""
    kind = "iri" if dt is None and lang is None else "literal"
    tag = F.lit(lang) if lang is None or isinstance(lang, str) else lang
    return F.struct(
        s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"),
        F.lit(dt).cast("string").alias("o_dt"), tag.cast("string").alias("o_lang"),
    )


def facts(df: DataFrame, *each: Column) -> DataFrame:
    """Triples of each row; a null object gives none."""
    return df.select(F.explode(F.array(*each)).alias("t")).select("t.*").where("o IS NOT NULL AND s IS NOT NULL")


def dedup(graph: DataFrame) -> DataFrame:
    return graph.dropDuplicates(["s", "p", *TERM])


@dataclass(frozen=True)
class Fact:
    """How the rows of one table give triples of one predicate: subjects and objects as a kind and a key column, or literals."""

    p: str
    s: tuple[str, Column]
    #: ``(kind, key)`` of an IRI, with an empty kind for a constant one or a class; else ``None``.
    o: tuple[str, Column] | None = None
    #: The value of a literal, its datatype and language.
    value: Column | None = None
    dt: str | None = None
    lang: str | None = None
    #: The object where it is the same in all rows.
    constant: str | None = None

    def subject(self) -> Column:
        return iri(self.s[0], self.s[1])

    def object(self) -> Column:
        if self.constant is not None:
            return F.lit(self.constant)
        return iri(*self.o) if self.o else self.value.cast("string")

    def triple(self) -> Column:
        return fact(self.subject(), self.p, self.object(), self.dt, self.lang)


class Graph:
    """A graph over tables, one projection for each predicate of each table.

    A pattern with a constant predicate reads only the tables and columns that give it, and a constant subject or object becomes
    a filter on a key column, which reaches the scan; ``frame`` is the whole graph as triples.
    """

    def __init__(self, parts: Sequence[tuple[DataFrame, Sequence[Fact]]]):
        self.parts = parts

    def frame(self) -> DataFrame:
        return reduce(DataFrame.unionByName, (facts(df, *(f.triple() for f in each)) for df, each in self.parts))

    def where(self, condition: Column) -> DataFrame:
        return self.frame().where(condition)

    def pattern(self, s: str, p: str, o: str, lang: str | None) -> DataFrame | None:
        """Triples ``s, o`` (and ``o_lang``) of a constant predicate; null if no table has it."""
        found = []
        for df, each in self.parts:
            for f in each:
                if f.p != p or lang is not None and f.lang != lang:
                    continue
                rows = df
                if not s.startswith("?"):
                    if not s.startswith(f"{NS}{f.s[0]}/"):
                        continue
                    rows = rows.where(f.s[1] == _typed(df, f.s[1], s[len(f"{NS}{f.s[0]}/") :]))
                if not o.startswith("?"):
                    if f.constant is not None:
                        if f.constant != o:
                            continue
                    elif f.o:
                        if not o.startswith(f"{NS}{f.o[0]}/"):
                            continue
                        rows = rows.where(f.o[1] == _typed(df, f.o[1], o[len(f"{NS}{f.o[0]}/") :]))
                    else:
                        rows = rows.where(f.object() == o)
                key = f.o[1] if f.o else f.value
                rows = rows if f.constant is not None else rows.where(key.isNotNull())
                found.append(rows.where(f.s[1].isNotNull()).select(f.subject().alias("s"), f.object().alias("o"), F.lit(f.lang).cast("string").alias("o_lang")))
        return reduce(DataFrame.unionByName, found) if found else None


def _typed(df: DataFrame, key: Column, text: str) -> Column:
    """A key's text as the key's own type, so that the comparison can be pushed down; null (no row) if it isn't one."""
    return F.lit(text).try_cast(df.select(key.alias("k")).schema["k"].dataType)


def star_schema(spark: SparkSession, sf_dir: str, kinds: Sequence[str] = ("customer", "supplier", "nation", "region")) -> Graph:
    """The star schema as a graph. ``kinds`` are the tables that belong to it."""
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    col = F.col

    def kind(s: tuple[str, Column], name: str) -> Fact:
        return Fact(TYPE, s, constant=name)

    def label(s: tuple[str, Column], name: str) -> Fact:
        return Fact(LABEL, s, value=col(name), lang="en")

    customer, supplier, nation, region = (("customer", col("c_custkey")), ("supplier", col("s_suppkey")), ("nation", col("n_nationkey")), ("region", col("r_regionkey")))
    order, part, line = ("order", col("o_orderkey")), ("part", col("p_partkey")), ("order", col("l_orderkey"))
    built = {
        "customer": lambda: (read("customer"), [
            kind(customer, "Customer"), label(customer, "c_name"), Fact("locatedIn", customer, ("nation", col("c_nationkey"))),
            Fact("inSegment", customer, ("segment", col("c_mktsegment"))), Fact("balance", customer, value=col("c_acctbal"), dt="decimal"),
        ]),
        "supplier": lambda: (read("supplier"), [
            kind(supplier, "Supplier"), label(supplier, "s_name"), Fact("locatedIn", supplier, ("nation", col("s_nationkey"))), Fact("balance", supplier, value=col("s_acctbal"), dt="decimal"),
        ]),
        "nation": lambda: (read("nation").withColumn("into", F.when((col("n_nationkey") >= 20) & (col("n_nationkey") % 2 == 1), col("n_nationkey") - 20)), [
            kind(nation, "Nation"), label(nation, "n_name"), Fact("partOf", nation, ("region", col("n_regionkey"))), Fact("mergedInto", nation, ("nation", col("into"))),
        ]),
        "region": lambda: (read("region"), [kind(region, "Region"), label(region, "r_name"), Fact("partOf", region, constant=f"{NS}world")]),
        "orders": lambda: (read("orders"), [
            kind(order, "Order"), Fact("placedBy", order, ("customer", col("o_custkey"))), Fact("status", order, value=col("o_orderstatus"), dt="string"),
            Fact("year", order, value=F.year("o_orderdate"), dt="integer"),
        ]),
        "part": lambda: (read("part"), [
            kind(part, "Part"), label(part, "p_name"), Fact("ofType", part, ("type", F.translate("p_type", " ", "_"))), Fact("brand", part, value=col("p_brand"), dt="string"),
        ]),
        "lineitem": lambda: (read("lineitem"), [Fact("offers", line, ("part", col("l_partkey"))), Fact("suppliedBy", line, ("supplier", col("l_suppkey")))]),
    }
    return Graph([built[k]() for k in kinds])


def star_frame(spark: SparkSession, sf_dir: str, kinds: Sequence[str] = ("customer", "supplier", "nation", "region")) -> DataFrame:
    """The whole graph as triples, for closures and rules."""
    return star_schema(spark, sf_dir, kinds).frame()


def match(graph: Graph | DataFrame, s: str, p: str, o: str, lang: str | None = None) -> DataFrame:
    """Solutions of one pattern; ``?x`` is a variable, ``?`` any term, all else a constant."""
    rows = graph.pattern(s, p, o, lang) if isinstance(graph, Graph) and not p.startswith("?") else None
    if rows is None:
        rows = graph.frame() if isinstance(graph, Graph) else graph
        for name, term in (("s", s), ("p", p), ("o", o)):
            if not term.startswith("?"):
                rows = rows.where(F.col(name) == term)
    if lang is not None:
        rows = rows.where(F.col("o_lang") == lang)
    names: dict[str, str] = {}
    for name, term in (("s", s), ("p", p), ("o", o)):
        if len(term) > 1 and term[0] == "?":
            if term[1:] in names:
                rows = rows.where(F.col(name) == F.col(names[term[1:]]))
            else:
                names[term[1:]] = name
    return rows.select(*(F.col(c).alias(v) for v, c in names.items()))


def join(*parts: DataFrame, one_row: bool = False) -> DataFrame:
    """Natural join, left to right; parts without a shared variable are an error unless one of them is declared to be one row."""

    def two(a: DataFrame, b: DataFrame) -> DataFrame:
        shared = [c for c in a.columns if c in b.columns]
        if not shared and not one_row:
            raise ValueError(f"no shared variable: {a.columns} and {b.columns}")
        return a.join(b, shared) if shared else a.crossJoin(F.broadcast(b))

    return reduce(two, parts)


def bgp(graph: DataFrame, *patterns: Sequence[str]) -> DataFrame:
    return join(*(match(graph, *p) for p in patterns))


def optional(a: DataFrame, b: DataFrame) -> DataFrame:
    """Left join on shared variables; conditions on the optional part belong into ``b``."""
    return a.join(b, [c for c in a.columns if c in b.columns], "left")


def exists(a: DataFrame, b: DataFrame, negated: bool = False) -> DataFrame:
    return a.join(b, [c for c in a.columns if c in b.columns], "left_anti" if negated else "left_semi")


def values(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """An inline table, as literals of the query."""
    return spark.createDataFrame(list(rows), ", ".join(f"`{n}` string" for n in names))


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def inverse(graph: DataFrame, p: str) -> DataFrame:
    return match(graph, "?o", p, "?s").select("s", "o")


def edges(graph: Graph | DataFrame, *predicates: str) -> DataFrame:
    """Alternation of predicates, as ``s``, ``o``."""
    if isinstance(graph, Graph):
        return reduce(DataFrame.unionByName, (match(graph, "?s", p, "?o") for p in predicates)).distinct()
    return graph.where(F.col("p").isin(*predicates) & (F.col("o_kind") == "iri")).select("s", "o").distinct()


def sequence(a: DataFrame, b: DataFrame) -> DataFrame:
    """Composition of two paths ``s``, ``o``."""
    return a.join(b.select(F.col("s").alias("o"), F.col("o").alias("end")), "o").select("s", F.col("end").alias("o"))


def star(path: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Zero or more steps: the closure and each node (of the path, or of ``nodes`` as ``s``) with itself."""
    own = nodes if nodes is not None else path.select("s").union(path.select(F.col("o").alias("s")))
    return reach(path).union(own.select("s", F.col("s").alias("o"))).distinct()


def ask(solutions: DataFrame) -> DataFrame:
    """One row: whether there is a solution."""
    return solutions.limit(1).agg((F.count("*") > 0).alias("answer"))


def construct(solutions: DataFrame, *template: Column) -> DataFrame:
    return dedup(facts(solutions, *template))


def describe(graph: Graph | DataFrame, uri: str, incoming: int = 1000) -> DataFrame:
    """Triples about a resource, and up to ``incoming`` of those that point to it (in order)."""
    out = graph.where(F.col("s") == uri)
    into = graph.where((F.col("o") == uri) & (F.col("o_kind") == "iri")).orderBy("s", "p").limit(incoming)
    return dedup(out.unionByName(into))


def group_concat(column: str, separator: str) -> Column:
    """Distinct values in order."""
    return F.array_join(F.array_sort(F.collect_set(column)), separator)
