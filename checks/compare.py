"""Run registered queries next to their SQL and compare the rows.

python -m checks.compare [sf_dir] [query ...]
"""

import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import statements
from grantline import catalog

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def expected_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        result = db.execute(sql)
        names = [column[0] for column in result.description]
        return names, result.fetchall()


def canonical(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in a fixed order."""
    order = sorted(range(len(names)), key=lambda n: names[n])
    ordered = [tuple(row[n] for n in order) for row in rows]
    return [names[n] for n in order], sorted(ordered, key=lambda row: tuple(map(repr, row)))


def compare(spark: SparkSession, sf_dir: str, name: str) -> str:
    """An empty text if rows and columns agree, else what differs."""
    result = catalog.queries()[name](spark, sf_dir)
    actual = canonical(result.columns, result.collect())
    expected = canonical(*expected_rows(sf_dir, statements()[name]))
    if actual[0] != expected[0]:
        return f"columns {actual[0]} instead of {expected[0]}"
    if actual[1] == expected[1]:
        return ""
    extra = [row for row in actual[1] if row not in set(expected[1])][:2]
    missing = [row for row in expected[1] if row not in set(actual[1])][:2]
    return f"{len(actual[1])} rows instead of {len(expected[1])}; extra {extra}, missing {missing}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalog.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")  # whole results are collected for the comparison
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="grantline-compare-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.perf_counter()
        try:
            difference = compare(spark, sf_dir, name)
        except Exception as error:  # report it and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(difference)
        print(f"{'FAIL' if difference else 'ok':4} {name} {time.perf_counter() - start:.2f}s {difference}")
    print(f"{len(names) - failed} of {len(names)} queries agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
