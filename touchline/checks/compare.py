"""Run queries next to their oracles and report differences."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql) -> str | None:
    """None when both give the same columns and bag of rows; otherwise what differs."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]).upper() for c in result.description}
    expected = _bag(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    wrong = [
        (f.name, f.dataType.simpleString(), kinds[f.name])
        for f in spark_df.schema.fields
        if not _same_kind(f.dataType.simpleString(), kinds[f.name])
    ]
    if wrong:
        return f"types {wrong}"
    got = _bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got == expected:
        return None
    extra, lacking = got - expected, expected - got
    return (
        f"{sum(extra.values())} extra, {sum(lacking.values())} lacking; "
        f"e.g. {next(iter(extra), None)} / {next(iter(lacking), None)}"
    )


# Which DuckDB types stand for a Spark type.
KINDS = {
    "bigint": {"BIGINT", "NUMBER"},
    "int": {"INTEGER", "NUMBER"},
    "double": {"DOUBLE", "NUMBER"},
    "string": {"VARCHAR", "STRING"},
    "boolean": {"BOOLEAN", "BOOL"},
    "timestamp_ntz": {"TIMESTAMP", "DATETIME"},
}


def _same_kind(spark_type, duck_type):
    return duck_type in KINDS.get(spark_type, set())


def main(sf_dir: str, only: list[str]) -> int:
    from touchline.checks.oracles import ORACLES
    from touchline.checks.queries import QUERIES
    from touchline.checks.session import local_session

    spark, con, bad = local_session(), duck(sf_dir), 0
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        try:
            found = difference(query(spark, sf_dir), con, ORACLES[name])
        except Exception as e:  # noqa: BLE001 - a report, not a handler
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.perf_counter() - start:.2f}s {found or ''}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
