"""Rates, token usage and costs as column expressions; sums in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,18)"


def exact(c: Column) -> Column:
    """The shortest decimal that prints as the number does."""
    return c.cast("string").cast(EXACT)


def total_rate(kind: Column, fixed: Column, benchmark: Column, margin: Column, floor: Column) -> Column:
    """Fixed: the fixed rate. Else benchmark, at least the floor if there is one, plus margin; null if either is."""
    floating = F.when(benchmark.isNotNull() & margin.isNotNull(), (F.greatest(exact(benchmark), exact(floor)) + exact(margin)).cast(EXACT))
    return F.when(kind == "fixed", exact(fixed)).otherwise(floating)


def filled_total(stated: Column, status: Column, computed: Column, missing_inputs: Column) -> Column:
    """The computed total only where the stated one is missing and nothing it needs is."""
    return F.when((status == "missing") & (missing_inputs == 0) & computed.isNotNull(), computed).otherwise(exact(stated))


def valid_tokens(c: Column) -> Column:
    return F.when(c >= 0, c)


def million_price(tokens: Column, price: Column) -> Column:
    return tokens.cast(EXACT) * price / 1_000_000


def estimated_cost(input_tokens: Column, cached: Column, written: Column, output: Column, prices: dict[str, Column], cap: int) -> Column:
    """Price of uncached, cached and written input and of output; null if a count is missing, negative, more than the
    input it belongs to, or over the cap."""
    usable = (input_tokens >= 0) & (cached >= 0) & (written >= 0) & (output >= 0) & (cached + written <= input_tokens) & (input_tokens <= cap)
    parts = [(input_tokens - cached - written, prices["input"]), (cached, prices["cached"]), (written, prices["written"]), (output, prices["output"])]
    total = None
    for tokens, price in parts:
        part = tokens.cast("decimal(18,0)") * price.cast("decimal(9,4)")
        total = part if total is None else total + part
    return F.when(usable, (total / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(20,10)"))


def cost_choice(reported: Column, reported_currency: Column, estimated: Column) -> Column:
    """A reported amount, finite and with a currency, comes before an estimate."""
    finite = (reported >= 0) & (reported.cast("double") < float("inf"))
    return F.when(finite & (reported_currency != ""), reported).otherwise(estimated)


def usage_totals(style: Column, prompt: Column, completion: Column, cache_read: Column, cache_write: Column) -> Column:
    """Input and output tokens whatever the API calls them: one style counts cached input apart, so its parts add up,
    to nothing known if any part is not."""
    parts = [valid_tokens(c) for c in (prompt, cache_read, cache_write)]
    return F.struct(F.when(style == "messages", parts[0] + parts[1] + parts[2]).otherwise(parts[0]).alias("input_tokens"), valid_tokens(completion).alias("output_tokens"))


def is_retryable(http_status: Column, failure: Column) -> Column:
    return F.coalesce((http_status == 429) | (http_status >= 500), F.lit(False)) | F.coalesce(failure.isin("connection", "malformed"), F.lit(False))
