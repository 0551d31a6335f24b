"""Code -> label lookups and money rules.

The label tables are tiny fixed maps, applied as ``create_map`` literals so
the lookup stays a codegen'd expression (no join, nothing to broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daypulse.functions.dates import millis_to_date

# Server action names.
PAY_ACTION = "pay"
REFUND_SUCCESS = "refund_success"
REFUND_VERIFY_FAILURE = "refund_verify_failure"
REFUND_VERIFY_SUCCESS = "refund_verify_success"
REFUND_CANCEL = "refund_cancel"
REFUND_APPLY = "refund_apply"
STUDENT_ADD = "student_add"
SIGNUP_CLASS = "signup_class"

# Refund status labels and the default label.
TO_BE_VERIFIED = "待审核"
VERIFY_FAILED = "审核失败"
VERIFY_SUCCEEDED = "审核成功"
REFUNDED = "退费成功"
CASH_REFUNDED = "退费成功(线下)"
CANCELED = "已取消"
REFUND_IN_PROGRESS = "退费中"
ONLINE_REFUNDED = "退费成功(线上)"
WORK_IN_PROGRESS = "平台处理中"
UNKNOWN_STATUS = "未知状态"

# Pay channel code -> label.
PAY_CHANNELS = {
    2: "支付宝",
    43: "支付宝二维码",
    4: "微信JS",
    30: "微信二维码",
    27: "银联POS",
    28: "快钱POS",
    99: "POS",
    1: "现金",
}

# Refund action -> status label.
REFUND_ACTION_STATUS = {
    REFUND_APPLY: TO_BE_VERIFIED,
    REFUND_VERIFY_FAILURE: VERIFY_FAILED,
    REFUND_SUCCESS: REFUNDED,
    REFUND_CANCEL: CANCELED,
}

# Refund status code -> label (P9). Code 2 (verify succeeded)
# and unknown codes fall back to TO_BE_VERIFIED.
REFUND_STATUS_CODES = {
    0: TO_BE_VERIFIED,
    1: VERIFY_FAILED,
    3: CASH_REFUNDED,
    4: CANCELED,
    5: REFUND_IN_PROGRESS,
    6: ONLINE_REFUNDED,
    7: WORK_IN_PROGRESS,
}

# Actions routed to the refund table. ``refund_verify_success``
# is not among them, so such rows reach no table.
REFUND_ACTIONS = (REFUND_SUCCESS, REFUND_VERIFY_FAILURE, REFUND_APPLY, REFUND_CANCEL)

ROUTES = {
    "payment": (PAY_ACTION,),
    "refund": REFUND_ACTIONS,
    "student": (STUDENT_ADD,),
    "signup": (SIGNUP_CLASS,),
}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _map_literal(mapping: dict) -> Column:
    parts = []
    for k, v in mapping.items():
        parts += [F.lit(k), F.lit(v)]
    return F.create_map(*parts)


def lookup(col, mapping: dict, on_unknown: str = "label",
           default: str = UNKNOWN_STATUS) -> Column:
    """Map a code through a fixed table.

    ``on_unknown="label"`` gives ``default`` for codes not in the table;
    ``"error"`` fails the job, as the reference does. Null stays null.
    """
    c = _c(col)
    hit = F.try_element_at(_map_literal(mapping), c)
    if on_unknown == "error":
        fallback = F.raise_error(F.concat(F.lit("unknown code: "), c.cast("string")))
    else:
        fallback = F.lit(default)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(hit.isNull(), fallback).otherwise(hit)


def pay_channel_label(code, on_unknown: str = "label") -> Column:
    """P7."""
    return lookup(code, PAY_CHANNELS, on_unknown)


def refund_action_status(action, on_unknown: str = "label") -> Column:
    """P8."""
    return lookup(action, REFUND_ACTION_STATUS, on_unknown)


def refund_status_name(code) -> Column:
    """Never fails; unknown codes and code 2 read as 'to be verified'."""
    return lookup(code, REFUND_STATUS_CODES, "label", default=TO_BE_VERIFIED)


def route_of(action) -> Column:
    """Target table of a server action; null when it has none."""
    c = _c(action)
    out = F.lit(None).cast("string")
    for name, actions in reversed(list(ROUTES.items())):
        out = F.when(c.isin(*actions), F.lit(name)).otherwise(out)
    return out


def cents_to_units(cents) -> Column:
    """P10: whole units of an integer cent amount, per row, truncating
    toward zero (-199 -> -1): integer division, no decimal per row."""
    return F.call_function("div", _c(cents).cast("bigint"), F.lit(100).cast("bigint"))


def cents_exact(total_cents) -> Column:
    """P10, ``money="exact"``: a summed cent amount in units, 2 decimals."""
    return (_c(total_cents).cast("decimal(22,0)") / F.lit(100)).cast("decimal(22,2)")


def business_date(event_date, fallback_date) -> Column:
    """The business day of an event (a date), else the log day.

    For epoch-millisecond inputs pass ``millis_to_date(ms)``.
    """
    return F.coalesce(_c(event_date), _c(fallback_date))


__all__ = ["lookup", "pay_channel_label", "refund_action_status", "refund_status_name",
           "route_of", "cents_to_units", "cents_exact", "business_date", "millis_to_date"]
