"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import decimal
from collections import Counter

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

# Spark type -> DuckDB types that hold the same values.
SAME_TYPES = {
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "date": {"DATE"},
    "boolean": {"BOOLEAN"},
    "decimal(38,0)": {"DECIMAL(38,0)"},
}


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    return value


def rows(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in data)


def difference(df, con, sql):
    """Problems found, as text; empty if both results are the same."""
    problems = []
    result = con.sql(sql)
    oracle_types = dict(zip(result.columns, map(str, result.types)))
    spark_types = dict(df.dtypes)
    if set(oracle_types) != set(spark_types):
        return [f"columns {sorted(set(spark_types) ^ set(oracle_types))}"]
    problems += [
        f"type of {c}: {t} / {oracle_types[c]}" for c, t in spark_types.items() if oracle_types[c] not in SAME_TYPES[t]
    ]
    mine = rows([tuple(r) for r in df.collect()], df.columns)
    theirs = rows(result.fetchall(), result.columns)
    if mine != theirs:
        problems.append(
            f"{sum(mine.values())} / {sum(theirs.values())} rows; only here {list((mine - theirs).items())[:2]}, "
            f"only there {list((theirs - mine).items())[:2]}"
        )
    return problems
