"""Small scalar helpers shared by the operators."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


AUTO = "auto"  # a run id to be made


def ts_literal(value: str | _dt.datetime | None) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone; None: the time of this call, in UTC."""
    if value is None:
        value = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def run_id_literal(run_id: str) -> Column:
    """A run id as a constant; AUTO makes a new one, once per call, so all rows of a load carry the same."""
    return F.lit(str(uuid.uuid4()) if run_id == AUTO else run_id)


def nullifzero(c: Column) -> Column:
    """Zero becomes NULL, anything else is unchanged."""
    return F.nullif(c, F.lit(0))


def avg_exact(c: Column) -> Column:
    """AVG of integer (or rounded) values: exact sum, one division as double.

    Partial sums are exact wide decimals, which 64-bit values cannot overflow, so the result does not depend on how the
    rows were split over tasks; an empty or all-NULL group gives NULL.
    """
    return F.try_divide(F.sum(c.cast("decimal(20,0)")).cast("double"), F.count(c).cast("double"))


_LIMB = Decimal(10) ** 20


def limbs(c: Column) -> tuple[Column, Column]:
    """A decimal(38,0) as (high, low) with value = high * 10**20 + low, both of its sign: sums of each
    stay within 38 digits for more rows than any table has, where a sum of the values would not."""
    limb = F.lit(_LIMB).cast("decimal(21,0)")
    return F.call_function("div", c, limb).cast("decimal(28,0)"), (c % limb).cast("decimal(28,0)")


def limbs_total(high: Column, low: Column) -> tuple[Column, Column]:
    """The total of two limb sums: exactly as decimal(38,0) (NULL beyond 38 digits), and as double."""
    exact = F.try_add(F.try_multiply(high.cast("decimal(38,0)"), F.lit(_LIMB).cast("decimal(21,0)")).cast("decimal(38,0)"), low.cast("decimal(38,0)"))
    return exact, F.coalesce(exact.cast("double"), high.cast("double") * F.lit(1e20) + low.cast("double"))


def sum_wide(c: Column) -> Column:
    """Exact SUM of decimal(38,0) values, from two limbs; NULL only if the total itself has over 38 digits."""
    high, low = limbs(c)
    return limbs_total(F.sum(high), F.sum(low))[0]


def avg_wide(c: Column) -> Column:
    """AVG of decimal(38,0) values: exact limb sums, one division as double."""
    high, low = limbs(c)
    return F.try_divide(limbs_total(F.sum(high), F.sum(low))[1], F.count(c).cast("double"))


def seconds_between(start: Column, end: Column) -> Column:
    """DATEDIFF(second, start, end): the number of second boundaries crossed.

    Both ends are truncated to the second first, so .9 -> 1.1 counts as 1.
    """
    return F.timestamp_diff("SECOND", F.date_trunc("second", start), F.date_trunc("second", end))


def json_object(fields: Sequence[tuple[str, Column]]) -> Column:
    """An object built from (key, value) pairs, as JSON text; keys whose value is NULL are dropped."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields]))
