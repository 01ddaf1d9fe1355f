"""Side-by-side comparison of a Spark result with DuckDB SQL: names, types, rows and values."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
ALIASES = {"large_string": "string", "date32[day]": "date"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (decimal.Decimal, datetime.date)):
        return str(v)
    return v


def _rows(table):
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    kinds = [ALIASES.get(str(table.schema.field(n).type), str(table.schema.field(n).type)) for n in names]
    return names, kinds, Counter(zip(*columns)) if columns else Counter()


def differences(spark_table, duck_table) -> list[str]:
    a_names, a_kinds, a = _rows(spark_table)
    b_names, b_kinds, b = _rows(duck_table)
    found = []
    if a_names != b_names:
        return [f"columns {a_names} / {b_names}"]
    found += [f"type of {n}: {x} / {y}" for n, x, y in zip(a_names, a_kinds, b_kinds) if x != y]
    if sum(a.values()) != sum(b.values()):
        found.append(f"rows {sum(a.values())} / {sum(b.values())}")
    extra, missing = list((a - b).items()), list((b - a).items())
    if extra or missing:
        found.append(f"{len(extra)} rows only in Spark, e.g. {str(extra[:2])[:600]}; {len(missing)} only in SQL, e.g. {str(missing[:2])[:600]}")
    return found
