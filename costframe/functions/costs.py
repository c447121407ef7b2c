"""Cost per line and the three cost definitions used for spend questions.

All arithmetic stays in DECIMAL with twelve places: sums are exact and independent of task order,
and lines far below a micro-unit count.
Credits are summed inside the row with `aggregate` (no explode, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costframe.constants import PROMOTION_CREDIT_TYPE
from costframe.schema import WIDE_MONEY


def _zero() -> Column:
    return F.lit(0).cast(WIDE_MONEY)


def credits_sum(credits="credits", exclude_promotions: bool = False) -> Column:
    """Sum of credit amounts in the row; NULL array, NULL amounts and no credits give 0.

    With `exclude_promotions`, credits whose type is PROMOTION are left out; a credit with a
    NULL type is left out too (`type <> 'PROMOTION'` is NULL for it, as in SQL).
    """
    arr = F.col(credits) if isinstance(credits, str) else credits
    if exclude_promotions:
        arr = F.filter(arr, lambda c: c["type"] != F.lit(PROMOTION_CREDIT_TYPE))
    total = F.aggregate(arr, _zero(), lambda acc, c: (acc + F.coalesce(c["amount"], _zero())).cast(WIDE_MONEY))
    return F.coalesce(total, _zero())


def net_cost(cost="cost", credits="credits") -> Column:
    """`cost + COALESCE(SUM(credits.amount), 0)`; a NULL cost stays NULL."""
    c = F.col(cost) if isinstance(cost, str) else cost
    return (c + credits_sum(credits)).cast(WIDE_MONEY)


# cost mode -> description (user-facing)
COST_MODES = {
    "raw": "Cost without credits or promotions",
    "credits_no_promotions": "Cost with credits but without promotions",
    "all_credits": "Cost with both credits and promotions",
}


def cost_mode_sums(mode: str) -> Column:
    """Aggregate expression for a cost mode: SUM(cost) [+ SUM(credit sums)].

    Unlike `net_cost`, the credits are summed separately from the cost, so a line with a NULL
    cost still contributes its credits.
    """
    if mode not in COST_MODES:
        raise ValueError(f"unknown cost mode {mode!r}; one of {sorted(COST_MODES)}")
    raw = F.sum("cost")
    if mode == "raw":
        return raw
    return raw + F.sum(credits_sum("credits", exclude_promotions=(mode == "credits_no_promotions")))


def credit_sums_pair(credits="credits") -> Column:
    """Both credit sums of a row in ONE pass over the array: struct(all, no_promotions).

    A credit with a NULL type counts in `all` but not in `no_promotions` (its `type <> 'PROMOTION'`
    test is NULL), as in `credits_sum(exclude_promotions=True)`.
    """
    arr = F.col(credits) if isinstance(credits, str) else credits
    start = F.struct(_zero().alias("all"), _zero().alias("no_promotions"))

    def step(acc, c):
        amt = F.coalesce(c["amount"], _zero())
        keep = F.when(c["type"] != F.lit(PROMOTION_CREDIT_TYPE), amt).otherwise(_zero())
        return F.struct((acc["all"] + amt).cast(WIDE_MONEY).alias("all"),
                        (acc["no_promotions"] + keep).cast(WIDE_MONEY).alias("no_promotions"))

    return F.coalesce(F.aggregate(arr, start, step), start)
