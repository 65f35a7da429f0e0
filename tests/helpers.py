import math


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def canon(rows, cols):
    return sorted(tuple(norm(r[c]) for c in cols) for r in rows)


def spark_rows(df):
    return [r.asDict() for r in df.collect()]


def duck_rows(con, sql):
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return cols, [dict(zip(cols, r)) for r in res.fetchall()]
