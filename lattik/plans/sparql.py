"""Query text in a subset of SPARQL, compiled to DataFrames over a graph.

SELECT, ASK, CONSTRUCT and DESCRIBE with triple patterns, property paths, OPTIONAL, UNION, MINUS, FILTER (with EXISTS), BIND,
VALUES, sub-selects, grouping, HAVING, ordering, LIMIT and OFFSET. Text is parsed by recursive descent and nothing in it is ever
passed on as SQL. ``check`` is the policy for public queries: one read-only query, no remote parts, of bounded length.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattik.operators.closure import reach
from lattik.plans import graph as g

#: Characters of a public query, at most.
LONGEST = 20_000
FORBIDDEN = frozenset("SERVICE FROM INSERT DELETE LOAD CLEAR CREATE DROP COPY MOVE ADD WITH USING".split())
TOKEN = re.compile(
    r"""(?P<space>\s+|\#[^\n]*)|(?P<iri><[^<>\s"{}|^`\\]*>)|(?P<var>[?$]\w+)|(?P<str>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)"""
    r"""|(?P<num>\d+(?:\.\d+)?)|(?P<name>(?:[A-Za-z]\w*)?:(?:[\w%-](?:[\w%./-]*[\w%-])?)?)|(?P<word>[A-Za-z_]\w*)|(?P<op>\^\^|&&|\|\||!=|<=|>=|[{}()\[\].;,=<>!*+/|^?-])"""
)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
LANG = "__lang_"


class QueryError(ValueError):
    """A text that is no query of this subset, or one that the policy refuses."""


def tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            raise QueryError(f"unexpected {text[at:at + 20]!r}")
        if m.lastgroup != "space":
            out.append((m.lastgroup, m[0]))
        at = m.end()
    return out


def check(text: str) -> None:
    """Raise unless the text is one read-only query without remote parts."""
    if len(text) > LONGEST:
        raise QueryError("the query is too long")
    found = tokens(text)  # strings, names and comments are tokens of their own, so a word in them is no keyword
    bad = [v for k, v in found if k == "word" and v.upper() in FORBIDDEN]
    if bad:
        raise QueryError(f"not allowed: {bad[0]}")
    kinds = [v.upper() for k, v in found if k == "word" and v.upper() in ("SELECT", "ASK", "CONSTRUCT", "DESCRIBE")]
    if not kinds:
        raise QueryError("no SELECT, ASK, CONSTRUCT or DESCRIBE")


def run(spark: SparkSession, graph: g.Graph | DataFrame, text: str) -> DataFrame:
    """The solutions (SELECT), one row ``answer`` (ASK), or triples (CONSTRUCT, DESCRIBE) of a checked query."""
    check(text)
    return _Query(spark, graph, tokens(text)).query()


class _Query:
    def __init__(self, spark: SparkSession, graph: g.Graph | DataFrame, found: list[tuple[str, str]]):
        self.spark, self.graph, self.found, self.at = spark, graph, found, 0
        self.prefixes = {"rdf": "rdf:", "rdfs": "rdfs:", "owl": "owl:", "xsd": "xsd:"}

    # ---- tokens
    def peek(self, *values: str) -> bool:
        return self.at < len(self.found) and self.found[self.at][0] in ("word", "op") and self.found[self.at][1].upper() in values

    def kind(self) -> str:
        return self.found[self.at][0] if self.at < len(self.found) else "end"

    def take(self, *values: str) -> bool:
        if self.peek(*values):
            self.at += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise QueryError(f"expected {value}, found {self.found[self.at:self.at + 1]}")

    def next(self) -> str:
        if self.at >= len(self.found):
            raise QueryError("the query ends early")
        self.at += 1
        return self.found[self.at - 1][1]

    # ---- query forms
    def query(self) -> DataFrame:
        while self.take("PREFIX"):
            name = self.next()
            self.prefixes[name.rstrip(":")] = self.next()[1:-1]
        if self.peek("SELECT"):
            out = self.select()
        elif self.take("ASK"):
            self.take("WHERE")
            out = g.ask(self.group())
        elif self.take("CONSTRUCT"):
            self.need("{")
            template = self.triples_block()
            self.take("WHERE")
            rows = self.modifiers_after(self.group())
            out = g.construct(rows, *(g.fact(self.value(s), p, self.value(o), None if self.is_iri(o, rows) else "string") for s, p, o in template)).select("s", "p", "o")
        elif self.take("DESCRIBE"):
            out = g.describe(self.graph, self.term()).select("s", "p", "o")
        else:
            raise QueryError("no query form")
        if self.at < len(self.found):
            raise QueryError(f"unexpected {self.found[self.at][1]!r} behind the query")
        return out

    def value(self, term: str) -> Column:
        return F.col(term[1:]) if term.startswith("?") else F.lit(term)

    def is_iri(self, term: str, rows: DataFrame) -> bool:
        return not term.startswith(("?", '"'))

    def select(self) -> DataFrame:
        self.need("SELECT")
        distinct, star, out = self.take("DISTINCT", "REDUCED"), False, []
        while not self.peek("WHERE", "{"):
            if self.take("*"):
                star = True
            elif self.take("("):
                e = self.expression()
                self.need("AS")
                out.append((self.next()[1:], e))
                self.need(")")
            elif self.kind() == "var":
                name = self.next()[1:]
                out.append((name, ("var", name)))
            else:
                raise QueryError(f"unexpected {self.next()!r} in SELECT")
        self.take("WHERE")
        rows = self.group()
        keys, having, order, limit, offset = [], None, [], None, 0
        while True:
            if self.take("GROUP"):
                self.need("BY")
                while self.kind() == "var" or self.peek("("):
                    if self.take("("):
                        e = self.expression()
                        name = f"__key{len(keys)}"
                        if self.take("AS"):
                            name = self.next()[1:]
                        self.need(")")
                        rows = rows.withColumn(name, self.column(e, rows))
                        keys.append(name)
                    else:
                        keys.append(self.next()[1:])
            elif self.take("HAVING"):
                having = self.expression()
            elif self.take("ORDER"):
                self.need("BY")
                while self.kind() == "var" or self.peek("ASC", "DESC", "("):
                    down = self.peek("DESC")
                    self.take("ASC", "DESC")
                    order.append((self.expression_in_brackets() if self.peek("(") else ("var", self.next()[1:]), down))
            elif self.take("LIMIT"):
                limit = int(self.next())
            elif self.take("OFFSET"):
                offset = int(self.next())
            else:
                break
        if keys or any(self.aggregates(e) for _, e in out) or having:
            made = [self.column(e, rows).alias(n) for n, e in out if n not in keys]
            extra = [self.column(having, rows).alias("__having")] if having else []
            extra += [self.column(e, rows).alias(f"__order{k}") for k, (e, _) in enumerate(order) if self.aggregates(e)]
            rows = rows.groupBy(*keys).agg(*made, *extra) if made or extra else rows.select(*keys).distinct()
            if having:
                rows = rows.where("__having")
        elif not star:
            for name, e in out:
                if e != ("var", name):
                    rows = rows.withColumn(name, self.column(e, rows))
        names = [c for c in rows.columns if not c.startswith("__")] if star else [n for n, _ in out]
        by = [F.col(f"__order{k}") if f"__order{k}" in rows.columns else self.column(e, rows) for k, (e, _) in enumerate(order)]
        by = [c.desc_nulls_last() if down else c.asc_nulls_first() for c, (_, down) in zip(by, order)]
        if distinct:
            rows = rows.select(*names).distinct()
        if by:
            rows = rows.orderBy(*by)
        rows = rows.select(*names)
        if offset:
            rows = rows.offset(offset)
        return rows if limit is None else rows.limit(limit)

    def modifiers_after(self, rows: DataFrame) -> DataFrame:
        return rows.limit(int(self.next())) if self.take("LIMIT") else rows

    # ---- groups
    def group(self) -> DataFrame:
        self.need("{")
        if self.peek("SELECT"):
            rows = self.select()
            self.need("}")
            return rows
        rows, filters = None, []
        while not self.take("}"):
            if self.take("."):
                continue
            if self.take("OPTIONAL"):
                rows = self.left(rows, self.group())
            elif self.take("MINUS"):
                rows = g.exists(rows, self.visible(self.group()), negated=True)
            elif self.take("FILTER"):
                negated = self.peek("NOT")
                if negated or self.peek("EXISTS"):
                    self.take("NOT")
                    self.need("EXISTS")
                    filters.append((negated, self.group()))
                else:
                    filters.append(self.expression())
            elif self.take("BIND"):
                self.need("(")
                e = self.expression()
                self.need("AS")
                rows = rows.withColumn(self.next()[1:], self.column(e, rows))
                self.need(")")
            elif self.take("VALUES"):
                rows = self.both(rows, F.broadcast(self.values()))
            elif self.peek("{"):
                part = self.group()
                while self.take("UNION"):
                    part = g.union(part, self.group())
                rows = self.both(rows, part)
            else:
                for s, path, o in self.triples():
                    rows = self.both(rows, self.match(s, path, o))
        if rows is None:
            raise QueryError("an empty group")
        for f in filters:
            if isinstance(f[0], bool):
                other = self.visible(f[1])
                rows = g.exists(rows, other.select(*[c for c in other.columns if c in rows.columns]), negated=f[0])
            else:
                rows = rows.where(self.column(f, rows))
        return rows

    def visible(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[c for c in rows.columns if not c.startswith("__")])

    def both(self, a: DataFrame | None, b: DataFrame) -> DataFrame:
        if a is None:
            return b
        b = b.drop(*[c for c in b.columns if c.startswith("__") and c in a.columns])
        return g.join(a, b, one_row=not set(a.columns) & set(b.columns))

    def left(self, a: DataFrame, b: DataFrame) -> DataFrame:
        return g.optional(a, b.drop(*[c for c in b.columns if c.startswith("__") and c in a.columns]))

    def values(self) -> DataFrame:
        names = []
        if self.take("("):
            while not self.take(")"):
                names.append(self.next()[1:])
        else:
            names.append(self.next()[1:])
        single, rows = len(names) == 1, []
        self.need("{")
        while not self.take("}"):
            if self.take("("):
                row = []
                while not self.take(")"):
                    row.append(None if self.take("UNDEF") else self.term().lstrip('"'))
                rows.append(tuple(row))
            elif single:
                rows.append((self.term().lstrip('"'),))
        return g.values(self.spark, names, rows)

    # ---- patterns
    def term(self) -> str:
        """A variable (``?x``), an IRI or name, or a literal's text behind a quotation mark."""
        kind, text = self.kind(), self.next()
        if kind == "var":
            return "?" + text[1:]
        if kind == "iri":
            return text[1:-1]
        if kind == "name":
            prefix, _, local = text.partition(":")
            if prefix not in self.prefixes:
                raise QueryError(f"unknown prefix {prefix!r}")
            return self.prefixes[prefix] + local
        if kind == "str":
            if self.kind() == "lang":
                self.at += 1
            elif self.take("^^"):
                self.term()
            return '"' + re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text[1:-1])
        if kind == "num" or text in ("true", "false"):
            return '"' + text
        if text == "a":
            return g.TYPE
        raise QueryError(f"unexpected {text!r}")

    def triples(self) -> list[tuple]:
        """Patterns of one subject, with their ``;`` and ``,``."""
        out, s = [], self.term()
        while True:
            path = ("var", self.next()[1:]) if self.kind() == "var" else self.path()
            while True:
                out.append((s, path, self.term()))
                if not self.take(","):
                    break
            if not self.take(";") or self.peek(".", "}"):
                return out

    def triples_block(self) -> list[tuple[str, str, str]]:
        out = []
        while not self.take("}"):
            if not self.take("."):
                out += [(s, p[1], o) for s, p, o in self.triples()]
        return out

    def path(self) -> tuple:
        parts = [self.sequence()]
        while self.take("|"):
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self) -> tuple:
        parts = [self.step()]
        while self.take("/"):
            parts.append(self.step())
        return parts[0] if len(parts) == 1 else ("seq", parts)

    def step(self) -> tuple:
        if self.take("^"):
            return ("inv", self.step())
        if self.take("("):
            one = self.path()
            self.need(")")
        else:
            one = ("pred", self.term())
        for mark, kind in (("+", "plus"), ("*", "star"), ("?", "maybe")):
            if self.take(mark):
                one = (kind, one)
        return one

    def edges(self, path: tuple) -> DataFrame:
        kind, inner = path
        if kind == "pred":
            return g.match(self.graph, "?s", inner, "?o")
        if kind == "inv":
            return self.edges(inner).select(F.col("o").alias("s"), F.col("s").alias("o"))
        if kind in ("seq", "alt"):
            return reduce(g.sequence if kind == "seq" else DataFrame.unionByName, map(self.edges, inner))
        one = self.edges(inner).distinct()
        if kind == "plus":
            return reach(one)
        if kind == "star":
            return g.star(one)
        return one.union(one.select("s", F.col("s").alias("o"))).union(one.select(F.col("o").alias("s"), "o")).distinct()

    def match(self, s: str, path: tuple, o: str) -> DataFrame:
        plain = o.lstrip('"') if o.startswith('"') else o
        if path[0] == "pred" and isinstance(self.graph, g.Graph):
            rows = self.graph.pattern(s, path[1], plain, None)
            if rows is None:
                raise QueryError(f"no table has {path[1]}")
        elif path[0] in ("pred", "var"):
            rows = self.graph.frame() if isinstance(self.graph, g.Graph) else self.graph
            rows = rows.where(F.col("p") == path[1]) if path[0] == "pred" else rows
        else:
            rows = self.edges(path).withColumn("o_lang", F.lit(None).cast("string"))
        for c, term in (("s", s), ("o", plain)):
            if not term.startswith("?"):
                rows = rows.where(F.col(c) == term)
        out = {}
        for c, term in (("s", s), ("p", "?" + path[1] if path[0] == "var" else ""), ("o", plain)):
            if term.startswith("?"):
                if term[1:] in out:
                    rows = rows.where(F.col(c) == F.col(out[term[1:]]))
                out.setdefault(term[1:], c)
        picked = [F.col(c).alias(v) for v, c in out.items()]
        if plain.startswith("?"):
            picked.append(F.col("o_lang").alias(LANG + plain[1:]))
        return rows.select(*picked)

    # ---- expressions: tuples of an operator and its parts
    def expression_in_brackets(self) -> tuple:
        self.need("(")
        e = self.expression()
        self.need(")")
        return e

    def expression(self, level: int = 0) -> tuple:
        steps = ({"||"}, {"&&"}, {"=", "!=", "<", ">", "<=", ">="}, {"+", "-"}, {"*", "/"})
        if level == len(steps):
            return self.unary()
        left = self.expression(level + 1)
        while True:
            if level == 2 and self.peek("IN", "NOT"):
                negated = self.take("NOT")
                self.need("IN")
                self.need("(")
                items = []
                while not self.take(")"):
                    items.append(self.expression())
                    self.take(",")
                left = ("!", ("in", left, *items)) if negated else ("in", left, *items)
            elif self.kind() == "op" and self.found[self.at][1] in steps[level]:
                left = (self.next(), left, self.expression(level + 1))
            else:
                return left

    def unary(self) -> tuple:
        if self.take("!"):
            return ("!", self.unary())
        if self.take("-"):
            return ("-", ("num", "0"), self.unary())
        if self.peek("("):
            return self.expression_in_brackets()
        kind = self.kind()
        if kind == "var":
            return ("var", self.next()[1:])
        if kind == "num":
            return ("num", self.next())
        if kind in ("str", "iri") or kind == "name" and self.found[self.at + 1 : self.at + 2] != [("op", "(")]:
            return ("const", self.term().lstrip('"'))
        name = self.next().upper()
        if name in ("TRUE", "FALSE"):
            return ("bool", name == "TRUE")
        self.need("(")
        distinct, args, separator = self.take("DISTINCT"), [], " "
        while not self.take(")"):
            if self.take("*"):
                args.append(("all",))
            elif self.take(";"):
                self.need("SEPARATOR")
                self.need("=")
                separator = self.term()[1:]
            else:
                args.append(self.expression())
            self.take(",")
        return ("call", name, distinct, separator, *args)

    AGGREGATES = frozenset("COUNT SUM MIN MAX AVG SAMPLE GROUP_CONCAT".split())

    def aggregates(self, e: tuple) -> bool:
        return e[0] == "call" and e[1] in self.AGGREGATES or any(isinstance(x, tuple) and self.aggregates(x) for x in e)

    def number(self, e: tuple) -> bool:
        calls = ("COUNT", "SUM", "AVG", "ROUND", "ABS", "FLOOR", "CEIL", "STRLEN", "YEAR", "XSD:INTEGER", "XSD:DECIMAL", "XSD:DOUBLE")
        return e[0] in ("num", "+", "-", "*", "/") or e[0] == "call" and e[1] in calls

    def numeric(self, e: tuple, rows: DataFrame) -> Column:
        return self.column(e, rows).try_cast("double")

    def column(self, e: tuple, rows: DataFrame) -> Column:
        kind = e[0]
        if kind == "var":
            return F.col(e[1]) if e[1] in rows.columns else F.lit(None).cast("string")
        if kind == "const":
            return F.lit(e[1])
        if kind == "bool":
            return F.lit(e[1])
        if kind == "num":
            return F.lit(float(e[1]) if "." in e[1] else int(e[1]))
        if kind == "!":
            return ~self.column(e[1], rows)
        if kind in ("&&", "||"):
            a, b = self.column(e[1], rows), self.column(e[2], rows)
            return a & b if kind == "&&" else a | b
        if kind == "in":
            return self.column(e[1], rows).isin(*(x[1] for x in e[2:]))
        if kind in ("+", "-", "*", "/"):
            a, b = self.numeric(e[1], rows), self.numeric(e[2], rows)
            return {"+": a + b, "-": a - b, "*": a * b, "/": F.try_divide(a, b)}[kind]
        if kind != "call":
            of = self.numeric if self.number(e[1]) or self.number(e[2]) else self.column
            a, b = of(e[1], rows), of(e[2], rows)
            return {"=": a == b, "!=": a != b, "<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b}[kind]
        return self.call(e[1], e[2], e[3], e[4:], rows)

    def call(self, name: str, distinct: bool, separator: str, args: tuple, rows: DataFrame) -> Column:
        if name == "COUNT":
            if args[0] == ("all",):
                return F.count(F.lit(1))
            return (F.countDistinct if distinct else F.count)(self.column(args[0], rows))
        if name in ("SUM", "AVG"):
            return {"SUM": F.sum, "AVG": F.avg}[name](self.numeric(args[0], rows))
        if name == "LANG":
            return F.coalesce(F.col(LANG + args[0][1]), F.lit("")) if LANG + args[0][1] in rows.columns else F.lit("")
        if name in ("ROUND", "ABS", "FLOOR", "CEIL"):
            x = self.numeric(args[0], rows)
            return {"ROUND": F.floor(x + 0.5), "ABS": F.abs(x), "FLOOR": F.floor(x), "CEIL": F.ceil(x)}[name]
        if name in ("XSD:INTEGER", "XSD:DECIMAL", "XSD:DOUBLE"):
            return self.column(args[0], rows).try_cast({"I": "bigint", "D": "double"}[name[4]])
        c = [self.column(a, rows) for a in args]
        text = [x.cast("string") for x in c]
        simple = {
            "MIN": lambda: F.min(c[0]), "MAX": lambda: F.max(c[0]), "SAMPLE": lambda: F.min(c[0]),
            "GROUP_CONCAT": lambda: F.array_join(F.array_sort((F.collect_set if distinct else F.collect_list)(text[0])), separator),
            "BOUND": lambda: c[0].isNotNull(), "STR": lambda: text[0], "LCASE": lambda: F.lower(text[0]), "UCASE": lambda: F.upper(text[0]), "STRLEN": lambda: F.char_length(text[0]),
            "STRSTARTS": lambda: F.startswith(text[0], text[1]), "STRENDS": lambda: F.endswith(text[0], text[1]), "CONTAINS": lambda: F.contains(text[0], text[1]),
            "REGEX": lambda: text[0].rlike(("(?i)" if args[2:] and "i" in args[2][1] else "") + args[1][1]), "REPLACE": lambda: F.regexp_replace(text[0], args[1][1], args[2][1]),
            "SUBSTR": lambda: F.substring(text[0], int(args[1][1]), int(args[2][1]) if args[2:] else 1 << 30), "CONCAT": lambda: F.concat(*text), "COALESCE": lambda: F.coalesce(*c),
            "IF": lambda: F.when(c[0], c[1]).otherwise(c[2]), "ISIRI": lambda: F.startswith(text[0], F.lit(g.NS)), "NOW": lambda: F.current_timestamp(), "YEAR": lambda: F.year(c[0]),
        }
        if name not in simple:
            raise QueryError(f"unknown function {name}")
        return simple[name]()


def results_json(solutions: DataFrame) -> DataFrame:
    """One JSON object of bindings for each solution, as in SPARQL results; unbound variables are absent."""
    term = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.when(F.startswith(F.col(c).cast("string"), F.lit(g.NS)), "uri").otherwise("literal").alias("type"), F.col(c).cast("string").alias("value")))
    return solutions.select(F.to_json(F.struct(*(term(c).alias(c) for c in solutions.columns))).alias("value"))


def results_csv(solutions: DataFrame, separator: str = ",") -> DataFrame:
    """Lines of CSV (or TSV), without the header; values with separators, quotes or line ends are quoted."""

    def cell(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        return F.when(text.rlike(f'["\\r\\n{separator}]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return solutions.select(F.concat_ws(separator, *(cell(c) for c in solutions.columns)).alias("value"))
