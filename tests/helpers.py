import math


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def same_rows(df_a, df_b):
    cols = df_a.columns
    a = canon([tuple(r) for r in df_a.collect()], cols)
    b = canon([tuple(r) for r in df_b.select(*cols).collect()], cols)
    return a == b, len(a), len(b)
