from __future__ import annotations


def physical_plan(df) -> str:
    """The plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan as it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
