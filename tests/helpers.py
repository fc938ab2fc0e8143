from collections import Counter


def rows(df):
    """Rows as tuples, in order."""
    return [tuple(r) for r in df.collect()]


def bag(df):
    """Rows as a multiset."""
    return Counter(rows(df))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def one(df):
    (row,) = df.collect()
    return row
