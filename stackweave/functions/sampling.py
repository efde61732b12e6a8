"""Which traces are chosen for call-graph snapshots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackweave.functions import ids

# The two decisions a trace carries downstream, and the default share.
SELECTED = "highest"
NOT_SELECTED = "off"
DEFAULT_PROBABILITY = 0.01


def ratio_selected(trace_id: Column, probability: float) -> Column:
    """True for a fixed share of trace ids, always the same for one id.

    The low 64 bits are uniform, so comparing their hex digits with the share of the
    64-bit range needs no unsigned arithmetic.
    """
    return _share_of(F.substring(ids.trace_hex(trace_id), 17, 16), probability)


def _share_of(digits: Column, probability: float) -> Column:
    """Whether 16 hex digits fall into the lower share of their range."""
    bound = round(min(max(probability, 0.0), 1.0) * 2**64)
    return F.lit(True) if bound >= 2**64 else digits < F.lit(f"{bound:016x}")


def random_selected(request: Column, probability: float, seed: int = 0) -> Column:
    """A coin toss for requests that carry no valid trace id yet.

    The coin is a hash of the request and a seed, so a task that runs again decides the same,
    and filters still pass through the expression.
    """
    coin = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(request.cast("string"), F.lit(""))).cast("binary"))
    return _share_of(F.substring(coin, 1, 16), probability)


def trace_volume(
    baggage: Column,
    trace_id: Column,
    probability: float = DEFAULT_PROBABILITY,
    request: Column | None = None,
    seed: int = 0,
) -> Column:
    """Keep an upstream decision; decide anew when it is absent or not understood.

    `request` tells requests without a valid trace id apart; without it, the id as it came does.
    """
    chosen = F.when(ids.is_valid_id(trace_id), ratio_selected(trace_id, probability)).otherwise(
        random_selected(trace_id if request is None else request, probability, seed)
    )
    return (
        F.when(baggage.isin(SELECTED, NOT_SELECTED), baggage)
        .when(chosen, F.lit(SELECTED))
        .otherwise(F.lit(NOT_SELECTED))
    )
