"""Compare a query with its SQL on the same tables: names, rows and values, in any order."""

import decimal

import duckdb

from shelf.session import TABLES

SF = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return f"{float(value):.9g}"
    if isinstance(value, (list, tuple)):
        return [plain(x) for x in value]
    return str(value)


def check(spark, query, sql, sf=SF):
    frame = query(spark, sf)
    names = sorted(frame.columns)
    got = sorted([plain(r[c]) for c in names] for r in frame.collect())
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    want = sorted([plain(r[columns.index(c)]) for c in names] for r in result.fetchall())
    assert got == want
