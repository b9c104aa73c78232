"""``python -m lattik query.rq --tables DIR [--kinds customer,nation] [--format table|csv|json]``: run query text over the star schema."""

from __future__ import annotations

import argparse


def main() -> None:
    from pyspark.sql import SparkSession

    from lattik.plans import graph, sparql

    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("query")
    args.add_argument("--tables", required=True)
    args.add_argument("--kinds", default="customer,supplier,nation,region")
    args.add_argument("--format", choices=("table", "csv", "json"), default="table")
    args.add_argument("--rows", type=int, default=400, help="rows shown, at most")
    given = args.parse_args()
    with open(given.query, encoding="utf-8") as f:
        text = f.read()
    spark = SparkSession.builder.getOrCreate()
    rows = sparql.run(spark, graph.star_schema(spark, given.tables, given.kinds.split(",")), text).limit(given.rows)
    if given.format == "table":
        rows.show(given.rows, truncate=60)
        return
    if given.format == "csv":
        print(",".join(rows.columns))
    for line in (sparql.results_csv if given.format == "csv" else sparql.results_json)(rows).collect():  # ``--rows`` at most
        print(line["value"])


if __name__ == "__main__":
    main()
