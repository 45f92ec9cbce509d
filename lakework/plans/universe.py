"""Which exchanges trade which pair, and what polling them costs."""

from pyspark.sql import functions as F

from lakework.functions.budget import call_budget
from lakework.operators.relational import funnel, members
from lakework.sources.responses import (
    PAIR_DETAIL, PAIRS, SUMMARY_URL, result_rows, with_data, with_url,
)

# The pairs of interest.
WANTED_PAIRS = (
    "btcusd", "btcchf", "btceur", "btcjpy", "btcbrl", "btcgbp", "btchkd", "btccny",
)


def has_fiat_side():
    return F.col("base.fiat") | F.col("quote.fiat")


def has_symbol(symbol):
    return (F.col("base.symbol") == symbol) | (F.col("quote.symbol") == symbol)


def wanted_pairs(responses, symbol="btc", wanted=WANTED_PAIRS):
    """The pairs that pass all three filters, from responses that list pairs."""
    pairs = result_rows(responses, PAIRS).where(has_fiat_side()).where(has_symbol(symbol))
    return members(pairs, "symbol", wanted)


def pair_funnel(pairs, symbol="btc", wanted=WANTED_PAIRS):
    """How many pairs are left after each filter, counted in one pass."""
    fiat = has_fiat_side()
    return funnel(
        pairs,
        fiat=fiat,
        symbol=fiat & has_symbol(symbol),
        wanted=fiat & has_symbol(symbol) & F.col("symbol").isin(list(wanted)),
    )


def pair_exchanges(details):
    """Pair detail responses as ``(pair, exchanges array)``; failed calls give no row."""
    parsed = with_data(details, PAIR_DETAIL)
    # Dropped as empty lists: a filter would be pushed below and parse the body again.
    known = F.filter(F.array("data.result"), lambda result: result.isNotNull())
    return parsed.select(F.explode(known).alias("result")).select(
        F.col("result.symbol").alias("pair"), F.col("result.markets.exchange").alias("exchanges")
    )


def exchange_rows(pairs):
    """``(pair, exchange)`` rows."""
    return pairs.select("pair", F.explode("exchanges").alias("exchange"))


def budget_per_pair(pairs):
    """Calls of one round and their cost per pair."""
    calls = pairs.groupBy("pair").agg(F.sum(F.size("exchanges")).cast("bigint").alias("calls"))
    return call_budget(calls)


def budget_total(pairs):
    """Calls of one round over all pairs and their cost."""
    return call_budget(pairs.agg(F.sum(F.size("exchanges")).cast("bigint").alias("calls")))


def polling_calls(listings, details, symbol="btc", wanted=WANTED_PAIRS):
    """The whole job, from listed pairs to the calls of a round: ``pair, exchange, url``, and
    for the pair the number of calls, their cost and how often the budget allows them.

    Only details of kept pairs are parsed: their envelopes, which name the pair, are joined with
    the kept ones first. A pair that several responses detail has each exchange once.
    """
    kept = wanted_pairs(listings, symbol, wanted).select("symbol")
    rows = exchange_rows(pair_exchanges(members(details, "pair", kept))).distinct()
    budget = call_budget(rows.groupBy("pair").agg(F.count(F.lit(1)).alias("calls")))
    return with_url(rows, SUMMARY_URL, ["exchange", "pair"]).join(budget, "pair")
