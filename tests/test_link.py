"""Similarity join, best matches and leaders against brute force and SQL, on copies, repeated keys and nulls."""

import random
import re

import duckdb
from pyspark.sql import functions as F

import lattik.queries as engine
from lattik.operators import link


def brute(a, b, least):
    words = lambda x: {w for w in x.lower().split(" ") if w} if x is not None else set()
    out = []
    for i, x in a:
        for j, y in b:
            x_, y_ = words(x), words(y)
            if x_ and y_ and len(x_ & y_) / len(x_ | y_) >= least:
                out.append((i, j, len(x_ & y_) / len(x_ | y_)))
    return out


def test_joins_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = [(k, " ".join(rnd.sample("abcdefghijkl", rnd.randint(1, 10)))) for k in range(150)]
    rows += [(1000 + k, rows[k % 40][1]) for k in range(120)] + [(7, "a b c"), (7, "a b c"), (8, None), (9, ""), (2010, " - "), (11, "A a b C")]
    df = spark.createDataFrame(rows, "k long, label string").repartition(3)
    left = df.where("k % 3 = 0")
    for least in (0.5, 0.7, 0.8, 1.0):
        want = brute([r for r in rows if r[0] % 3 == 0], [r if r[1] != " - " else (r[0], "") for r in rows], least)
        got = [tuple(r) for r in link.token_pairs(left, df, "k", "label", least).collect()]
        assert sorted(got) == sorted(want)
        best = {}
        for a, b, s in want:
            if a != b:
                best[a] = max(best.get(a, (0, -1)), (s, b))
        assert {r["a"]: (r["score"], r["b"]) for r in link.best_match(left, df, "k", "label", least).collect()} == best


def test_best_match_makes_no_pairs_of_copies(spark):
    """200 copies of one text: two rows of a set at most leave the heads, never 200 x 200."""
    df = spark.range(200).select(F.col("id").alias("k"), F.lit("red ring").alias("label"))
    got = {r["a"]: r["b"] for r in link.best_match(df, df, "k", "label", 0.8).collect()}
    assert got == {k: 199 if k < 199 else 198 for k in range(200)}
    assert {(r["ca"], r["cb"]) for r in link.set_pairs(link.token_sets(df, "k", "label", "a"), link.token_sets(df, "k", "label", "b"), 0.8).collect()} == {("red-ring", "red-ring")}


def broadcast_explodes(spark, after):
    """Plans run since ``after`` that broadcast exploded rows: a Generate stands below a broadcast with no shuffle or scan between."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    found = []
    for i in range(runs.size()):
        if runs.apply(i).executionId() > after:
            nodes = re.findall(r"\b(BroadcastExchange|Exchange|Generate|Scan \w+) +\(\d+\)\n", runs.apply(i).physicalPlanDescription().split("\n\n\n")[0])
            found += [x for x in zip(nodes, nodes[1:]) if x == ("BroadcastExchange", "Generate")]
    return found


def test_similarity_join_broadcasts_no_exploded_rows(spark):
    """Spark takes the size of exploded sets for that of the sets, and so sends them through the driver's memory."""
    rnd = random.Random(3)
    rows = [(k, " ".join(f"w{rnd.randint(0, 400)}" for _ in range(12))) for k in range(600)]
    df = spark.createDataFrame(rows + [(600 + k, rows[k][1] + " more") for k in range(50)], "k long, label string")
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    last = max([-1, *(runs.apply(i).executionId() for i in range(runs.size()))])
    got = {(r["a"], r["b"]) for r in link.token_pairs(df.where("k % 20 = 0"), df, "k", "label", 0.8).collect()}
    assert {(k, 600 + k) for k in range(0, 50, 20)} <= got
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert not broadcast_explodes(spark, last)


def test_sweep_counts_without_a_join(spark):
    """Thresholds named twice count once; the matches aren't joined to them."""
    df = spark.createDataFrame([(0.8, True), (0.9, False), (1.0, True), (1.0, None), (None, True)], "score double, correct boolean")
    got = link.sweep(df, 4, (0.8, 0.8, 0.95, 1.5))
    assert sorted(tuple(r)[:3] for r in got.collect()) == [(0.8, 4, 2), (0.95, 2, 1), (1.5, 0, 0)]
    assert {r["theta"]: (r["precision"], r["recall"], r["f1"]) for r in got.collect()} == {0.8: (0.5, 0.5, 0.5), 0.95: (0.5, 0.25, 1 / 3), 1.5: (0.0, 0.0, 0.0)}
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r)[:3] for r in link.sweep(df.where("score > 2"), 4, (0.8,)).collect()] == [(0.8, 0, 0)]


def test_registered_joins_equal_sql_with_nulls(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 1 THEN p_name END AS p_name, CASE WHEN p_partkey % 11 <> 1 THEN p_type END AS p_type, p_brand
        FROM (SELECT p_partkey + i * 200 AS p_partkey, p_name, p_type, p_brand FROM '/root/testdata/sf0.001/part.parquet', range(3) r(i))) TO '{tmp_path}/part.parquet'""")
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    engine.load()
    for name in ("jon17_similarity_join", "win05_best_match", "agg22_sweep"):
        df = engine.QUERIES[name](spark, str(tmp_path))
        want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({engine.SQL[name]})").fetchall()
        assert sorted(tuple(r) for r in df.collect()) == sorted(want) and want


def test_leaders_equal_sql(spark, tmp_path):
    """A cent of balance is worth 10,000 keys; null names, balances and keys never lead."""
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * FROM (VALUES (900000, 'late', 1, 10.00::DOUBLE), (5, 'early', 1, 9.99), (6, NULL, 1, 99.0), (7, 'no balance', 1, NULL),
        (NULL, 'no key', 1, 98.0), (1, 'alone', 2, NULL), (2, 'nobody', 3, 1.0), (3, 'somebody', 3, 1.5), (4, 'stateless', NULL, 1.0)) t(c_custkey, c_name, c_nationkey, c_acctbal))
        TO '{tmp_path}/customer.parquet'""")
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet'")
    engine.load()
    df = engine.QUERIES["fus15_leaders"](spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({engine.SQL['fus15_leaders']})").fetchall()
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(want, key=key)
    assert {r[0]: r[1] for r in want}[1] == "early"
