"""Run queries and their SQL side by side: ``python -m tests.compare DIR [NAME ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(spark_df, con, sql: str) -> str | None:
    """What differs between the two results, or None."""
    result = con.execute(sql)
    columns = [column[0] for column in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(columns)}"
    types = {column[0]: SPARK_TYPES.get(str(column[1]), str(column[1])) for column in result.description}
    if types != dict(spark_df.dtypes):
        return f"types {dict(spark_df.dtypes)} vs {types}"
    ours = spark_df.select(*columns).collect()
    left = sorted(map(repr, map(tuple, ours)))
    right = sorted(map(repr, expected))
    if left == right:
        return None
    only_left = sorted(set(left) - set(right))[:5]
    only_right = sorted(set(right) - set(left))[:5]
    return f"{len(left)} vs {len(right)} rows; only ours {only_left}; only SQL {only_right}"


def main() -> int:
    from namepulse.session import local_session
    from namepulse.plans import catalogue, oracles

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    failed = 0
    for name, build in catalogue.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        sql = oracles.oracle_sql().get(name)
        try:
            df = build(spark, sf_dir)
            problem = difference(df, con, sql) if sql else f"no SQL; {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = repr(error)[:800]
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
