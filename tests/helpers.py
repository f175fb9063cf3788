from __future__ import annotations


def rows(df):
    """All rows as a sorted list of tuples; nulls sort first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The physical plan after AQE has run it."""
    executed = df._jdf.queryExecution().executedPlan()
    executed.execute().count()
    return executed.toString().split("Initial Plan")[0]
