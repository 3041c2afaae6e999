from __future__ import annotations

import datetime
import decimal


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v)


def table(cols, rows):
    """Order-insensitive, column-order-insensitive canonical form of a result."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])
