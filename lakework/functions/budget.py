"""Cost of polling an API that charges per call."""

from pyspark.sql import functions as F

# Dollars per call, dollars per day.
COST_PER_CALL = 0.002
DAILY_BUDGET = 10


def call_budget(df, calls="calls", cost_per_call=COST_PER_CALL, daily_budget=DAILY_BUDGET):
    """Add what a round of ``calls`` costs and how many rounds the budget allows.

    Zero calls cost nothing and leave the number of rounds undefined (NULL).
    """
    cost = F.col(calls) * F.lit(cost_per_call)
    per_day = F.try_divide(F.lit(float(daily_budget)), cost)
    return df.withColumns({
        "cost_per_round": cost,
        "rounds_per_day": per_day,
        "rounds_per_hour": per_day / F.lit(24.0),
    })
