import math


def plain(v):
    """A value in a form in which Spark's and DuckDB's agree."""
    import pandas as pd

    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if hasattr(v, "item"):
        return plain(v.item())
    if isinstance(v, float) and v == int(v):
        return repr(int(v))
    return repr(v)


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(map(plain, r)) for r in pdf[cols].itertuples(index=False, name=None))
