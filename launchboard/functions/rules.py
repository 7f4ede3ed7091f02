"""Column rules of the dashboard, as Spark ``Column`` expressions.

All rules stay JVM-side (whole-stage codegen); no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from launchboard import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lcs_launch(launch, on_street) -> Column:
    """Early on-street date wins when it is not later than the launch date.
    A NULL launch stays NULL even when an on-street date exists."""
    launch, on_street = _c(launch), _c(on_street)
    return F.when(on_street.isNotNull() & (launch >= on_street), on_street).otherwise(launch)


def douyin_launch(brand, family) -> Column:
    """Earlier of the brand and family dates; either one when the other is NULL."""
    return F.least(_c(brand), _c(family))


def brand_launch(*dates) -> Column:
    """Earliest channel launch; NULL as soon as any channel date is NULL."""
    cols = [_c(d) for d in dates]
    all_set = cols[0].isNotNull()
    for c in cols[1:]:
        all_set = all_set & c.isNotNull()
    return F.when(all_set, F.least(*cols))


def age_mark_admitted(age_mark) -> Column:
    """Products whose trimmed age mark starts with a number (NULL: dropped)."""
    return F.coalesce(F.trim(_c(age_mark)).rlike(C.AGE_FILTER_PATTERN), F.lit(False))


def min_age(age_mark) -> Column:
    """'a b/c' -> a + b div c (integer arithmetic), else the leading digits;
    0 when nothing parses. Malformed parts and a zero denominator give 0."""
    t = F.trim(_c(age_mark))
    whole = F.split_part(t, F.lit(" "), F.lit(1)).try_cast("int")
    frac = F.split_part(t, F.lit(" "), F.lit(2))
    num = F.split_part(frac, F.lit("/"), F.lit(1)).try_cast("int")
    den = F.split_part(frac, F.lit("/"), F.lit(2)).try_cast("int")
    mixed = whole + _int_div(num, den)
    leading = F.regexp_replace(t, C.AGE_STRIP_PATTERN, "").try_cast("int")
    parsed = F.when(t.rlike(C.AGE_MIXED_FRACTION_PATTERN), mixed).otherwise(leading)
    return F.coalesce(parsed.cast("int"), F.lit(0))


def _int_div(num: Column, den: Column) -> Column:
    # integer division (operands are digit strings, so never negative);
    # NULL instead of an error on a zero denominator
    d = F.nullif(den, F.lit(0))
    return ((num - num % d) / d).cast("int")


def price_band(rsp) -> Column:
    rsp = _c(rsp)
    expr = None
    for label, lo, hi in C.PRICE_BANDS:
        cond = rsp >= lo if hi is None else (rsp >= lo) & (rsp < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def kids_vs_adult(min_age_col) -> Column:
    """ADULT from the adult age on; everything else, unknown age included, KIDS."""
    return F.when(_c(min_age_col) >= C.ADULT_MIN_AGE, C.ADULT).otherwise(C.KIDS)


def normalize_channel(raw) -> Column:
    raw = _c(raw)
    return F.when(raw.isin(*C.FOLDED_INTO_DOUYIN), C.CHANNEL_DOUYIN).otherwise(raw)


def omni_member_id(type_name, crm_id, type_value) -> Column:
    """CRM member id first, the channel's own id when missing; NULL for
    id types that do not identify a member (guests)."""
    return F.when(_c(type_name).isin(*C.MEMBER_ID_TYPES),
                  F.coalesce(_c(crm_id).cast("string"), _c(type_value).cast("string")))


def numeric_id(x) -> Column:
    """Id text compared as a number (malformed ids do not match anything)."""
    return _c(x).try_cast("bigint")


def or_default(x, default: str) -> Column:
    return F.coalesce(_c(x), F.lit(default))


def is_true(x) -> Column:
    """``x IS TRUE``: NULL counts as false."""
    return F.coalesce(_c(x), F.lit(False))


def safe_ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def zero_to_null(x) -> Column:
    return F.nullif(_c(x), F.lit(0))


def admitted_line(raw_channel, order_date, sales_type, order_type, as_of) -> Column:
    """Channel admission, closed days and the per-channel line rules."""
    raw = _c(raw_channel)
    cond = raw.isin(*C.ADMITTED_RAW_CHANNELS)
    if as_of is not None:
        cond = cond & (_c(order_date) < F.lit(as_of))
    else:
        cond = cond & (_c(order_date) < F.current_date())
    rules = ((raw == C.CHANNEL_LCS) & (_c(sales_type) != C.LCS_EXCLUDED_SALES_TYPE)) | (
        raw.isin(*C.MARKETPLACE_RAW_CHANNELS) & (_c(order_type) == C.MARKETPLACE_ORDER_TYPE))
    return cond & rules
