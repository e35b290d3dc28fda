def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(x is None, str(type(x)), x if x is not None else 0) for x in t])


def nodes(df):
    """Text of the physical plan."""
    return df._jdf.queryExecution().executedPlan().toString()
