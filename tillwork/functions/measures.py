"""Retail measures as column expressions.

Money is decimal(18,4). A ratio that is rounded is divided as a decimal, so the
half-up rounding is exact; a ratio that is not rounded is divided as a double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
# Wide enough for totals of money, narrow enough that the quotient keeps 16
# decimal places within Spark's 38 digits.
_OPERAND = "decimal(22,4)"

# Sales tax contained in the net price, stock level up to which an
# article counts as low, and the labels of the three stock states.
TAX_RATE = Decimal("0.19")
LOW_STOCK_UP_TO = 4
STOCK_STATES = ("IN_STOCK", "LOW_STOCK", "OUT_OF_STOCK")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded_ratio(num: Column | str, den: Column | str, places: int) -> Column:
    """num / den, half up; NULL when the denominator is 0 or NULL."""
    num, den = _col(num).cast(_OPERAND), _col(den).cast(_OPERAND)
    return F.round(num / F.nullif(den, F.lit(0)), places)


def plain_ratio(num: Column | str, den: Column | str) -> Column:
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return num / F.nullif(den, F.lit(0.0))


def _or_zero(value: Column, guard: Column | str) -> Column:
    """0 where ``guard`` is 0 or NULL, else the ratio itself."""
    return F.when(_col(guard) != 0, value).otherwise(F.lit(0))


def margin_amount(net: Column | str, cost: Column | str) -> Column:
    return F.round(_col(net) - _col(cost), 4)


def margin_pct(net: Column | str, cost: Column | str) -> Column:
    net = _col(net)
    return _or_zero(rounded_ratio(net - _col(cost), net, 6), net)


def discount_rate(discount: Column | str, gross: Column | str) -> Column:
    return _or_zero(plain_ratio(discount, gross), gross)


def avg_basket(net: Column | str, tickets: Column | str) -> Column:
    return _or_zero(plain_ratio(net, tickets), tickets)


def sales_m2(net: Column | str, area: Column | str) -> Column:
    return _or_zero(plain_ratio(net, area), area)


def variation_pct(now: Column | str, before: Column | str) -> Column:
    """Relative change; NULL without a base to compare with."""
    now, before = _col(now), _col(before)
    return rounded_ratio(now - before, before, 6)


def days_on_hand(on_hand: Column | str, sold: Column | str) -> Column:
    return rounded_ratio(on_hand, sold, 2)


def sell_through_pct(sold: Column | str, on_hand: Column | str) -> Column:
    handled = _col(on_hand) + _col(sold)
    return _or_zero(rounded_ratio(sold, handled, 6), handled)


def stock_value(on_hand: Column | str, unit_cost: Column | str) -> Column:
    return _col(on_hand) * _col(unit_cost)


def on_hand_cost(on_hand: Column | str, unit_cost: Column | str) -> Column:
    return F.round(_col(on_hand) * _col(unit_cost), 2).cast(MONEY)


def stock_state(on_hand: Column | str) -> Column:
    on_hand = _col(on_hand)
    plenty, low, none = STOCK_STATES
    return F.when(on_hand > LOW_STOCK_UP_TO, plenty).when(on_hand > 0, low).otherwise(none)


def budget_usage_pct(actual: Column | str, budget: Column | str) -> Column:
    return rounded_ratio(actual, budget, 6)


def budget_gap(actual: Column | str, budget: Column | str) -> Column:
    return _col(actual) - _col(budget)


def line_gross(price: Column | str, qty: Column | str, uom: Column | str, weight: Column | str) -> Column:
    """Weighed articles are priced by weight, all others by count."""
    price = _col(price)
    by_weight = F.round(price * _col(weight), 2)
    by_count = F.round(price * _col(qty), 2)
    return F.when(_col(uom) == "KG", by_weight).otherwise(by_count).cast(MONEY)


def line_discount(gross: Column | str, rate: Column | str) -> Column:
    return F.round(_col(gross) * _col(rate), 2).cast(MONEY)


def contained_tax(net: Column | str) -> Column:
    """Tax inside a net price that includes it."""
    # Multiply first: the quotient of the two short literals alone keeps 6 places.
    return F.round(_col(net) * F.lit(TAX_RATE) / F.lit(1 + TAX_RATE), 2).cast(MONEY)


def line_cost(unit_cost: Column | str, qty: Column | str) -> Column:
    return F.round(_col(unit_cost) * _col(qty), 2).cast(MONEY)
