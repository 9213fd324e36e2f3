"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: order states that count as sales (fixed value of the data model)
PAID = ("paid", "completed")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_paid(status="status") -> Column:
    return col(status).isin(*PAID)


def safe_divide(a, b, default: float = 0.0) -> Column:
    """a / b, with ``default`` where b is 0 or either side is NULL."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b).cast("double")), F.lit(default))


def round_to(value, digits: int = 2) -> Column:
    """Round half away from zero, the same however a sum was partitioned.

    Sums of doubles differ in the last bits with the order of addition, which
    flips plain rounding at halves. Six spare decimal digits absorb that and
    nothing else: only values within 5e-7 of a unit of the last digit from a half
    count as the half. NaN and infinities give NULL.
    """
    exact = col(value).cast("double").try_cast(f"decimal(38,{digits + 6})")
    return F.round(exact, digits).cast("double")


def percent(a, b, digits: int = 2) -> Column:
    """100 * a / b rounded, 0 where b is 0."""
    return round_to(safe_divide(a, b) * 100, digits)


def change(current, previous) -> Column:
    """(current - previous) / previous; NULL where the base is NULL or 0."""
    cur, prev = col(current).cast("double"), col(previous).cast("double")
    return F.try_divide(cur - prev, prev)


def year_month(d) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def is_weekend(d) -> Column:
    return F.dayofweek(col(d)).isin(1, 7).cast("int")


def price_band(price, low: float = 100.0, high: float = 500.0, high_inclusive: bool = False) -> Column:
    """'low' / 'mid' / 'high'. ``high_inclusive`` puts price == high into 'mid'."""
    p = col(price)
    mid = p <= high if high_inclusive else p < high
    return F.when(p < low, "low").when(mid, "mid").otherwise("high")


def month_diff(later, earlier) -> Column:
    """Whole calendar months between two dates, ignoring the day of month."""
    a, b = col(later), col(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def stock(kind="movement_type", quantity="quantity", raw_sign: bool = False) -> Column:
    """Aggregate: quantity in minus quantity out.

    Outgoing quantities are stored negative. The default counts them by size;
    ``raw_sign`` subtracts the stored value, which adds them back instead.
    """
    q = col(quantity)
    out = q if raw_sign else F.abs(q)
    return F.sum(F.when(col(kind) == "in", q).otherwise(-out))


def format_money(value, currency: str = "¥") -> Column:
    return F.concat(F.lit(currency), F.format_number(F.coalesce(F.nanvl(col(value).cast("double"), F.lit(0.0)), F.lit(0.0)), 2))


def format_percent(value, digits: int = 2) -> Column:
    v = F.nanvl(col(value).cast("double"), F.lit(None).cast("double"))
    return F.when(v.isNull(), F.lit("0.00%")).otherwise(F.format_string(f"%.{digits}f%%", v * 100))


def parse_date(value) -> Column:
    """Date of a text or timestamp, NULL where it cannot be read."""
    return F.try_to_timestamp(col(value).cast("string")).cast("date")


def clean_number(value) -> Column:
    """NaN and infinities become NULL, as JSON has no such numbers."""
    v = col(value).cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(None)).otherwise(v)


def json_row(df) -> Column:
    """The whole row as JSON text, numbers cleaned."""
    fields = [clean_number(n).alias(n) if t in ("double", "float") else F.col(n) for n, t in df.dtypes]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def clip(value, low, high) -> Column:
    v = col(value)
    return F.when(v.isNull(), v).otherwise(F.greatest(F.least(v, col(high)), col(low)))
