"""Comparison of two engines' rows, without order."""

import math


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(plain(v[k]) for k in order) for v in values)


def of_frame(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def of_duckdb(connection, sql):
    cursor = connection.execute(sql)
    return rows([d[0] for d in cursor.description], cursor.fetchall())
