"""Column expressions. All are built-in Spark functions, so they stay inside
whole-stage codegen; none needs a Python worker.

ANSI mode is on in Spark 4, so every parse and cast of dirty text uses the
``try_`` variants: a bad value becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import schemas as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _shape(fmt: str) -> str:
    """Regex of the zero-padded text a date pattern accepts, e.g. dd-MM-yyyy."""
    return "^" + fmt.replace("yyyy", r"\d{4}").replace("MM", r"\d{2}").replace("dd", r"\d{2}") + "$"


def _as_iso(text: Column, fmt: str) -> Column:
    """Re-arrange text of shape ``fmt`` into yyyy-MM-dd by position."""
    part = {tok: F.substring(text, fmt.index(tok) + 1, len(tok)) for tok in ("yyyy", "MM", "dd")}
    return F.concat_ws("-", part["yyyy"], part["MM"], part["dd"])


def parse_date(c: str | Column) -> Column:
    """First successful parse among the accepted shapes, else NULL.

    The shapes are mutually exclusive, so each value is matched against the
    shapes and parsed once: its digits are put in ISO order and cast to DATE
    (``try_cast`` gives NULL for impossible dates such as 2025-02-30). Only
    zero-padded values parse, exactly as with the patterns; a pattern parser
    would instead throw and catch an exception for every pattern a value does
    not match, which was most of the cleaning time.
    """
    text = col(c).cast("string")
    expr = None
    for fmt in S.DATE_FORMATS:
        matches = text.rlike(_shape(fmt))
        parsed = _as_iso(text, fmt).try_cast("date")
        expr = F.when(matches, parsed) if expr is None else expr.when(matches, parsed)
    return expr


def parse_iso_date(c: str | Column) -> Column:
    """Default date parse (P4): ISO text -> DATE, NULL when it does not parse."""
    return F.try_to_date(col(c).cast("string"))


def to_double(c: str | Column) -> Column:
    """Text or number -> DOUBLE, NULL on garbage.

    Only numbers pass: NaN and the infinities become NULL (NaN would sort above
    every number and so pass as a positive amount). No size is too large.
    """
    x = col(c).try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def to_int(c: str | Column) -> Column:
    """Text or number -> INT via DOUBLE, so '682.0' becomes 682."""
    return to_double(c).try_cast("int")


def ok(predicate: Column) -> Column:
    """Two-valued predicate: NULL counts as false.

    Splitting with ``filter(p)`` / ``filter(~p)`` loses every row where ``p`` is
    NULL; splitting on ``ok(p)`` / ``~ok(p)`` keeps every row in exactly one side.
    """
    return F.coalesce(predicate, F.lit(False))


#: From here on a double has no second decimal that rounding could change.
NO_DECIMALS = 1e15


def _rounded(x: Column, places: int) -> Column:
    x = x.cast("double")
    return F.when(F.abs(x) < NO_DECIMALS, F.round(x.try_cast("decimal(38,6)"), places).cast("double")).otherwise(x)


def round2(x: Column) -> Column:
    """Round half away from zero to 2 decimals on the decimal value (T6), at any size."""
    return _rounded(x, 2)


def round0(x: Column) -> Column:
    return _rounded(x, 0)


def flag(predicate: Column) -> Column:
    """Boolean -> INT 0/1; NULL stays NULL."""
    return predicate.cast("int")


def income_bracket(income: str | Column) -> Column:
    """<300k Low, <1M Medium, else High; NULL income falls into High."""
    inc = col(income)
    return (F.when(inc < S.INCOME_LOW_BELOW, "Low")
            .when(inc < S.INCOME_MEDIUM_BELOW, "Medium")
            .otherwise("High"))


def failed_rate(failed: str | Column, total: str | Column) -> Column:
    """failed / total, 0.0 when there are no transactions."""
    return F.when(col(total) > 0, col(failed) / col(total)).otherwise(F.lit(0.0))


def risk_score(credit_score: str | Column, failed_txn_rate: str | Column,
               defaulted: str | Column, overdue: str | Column) -> Column:
    """Explainable risk score, capped at 100, no lower clamp.

    credit 0-28 pts + failed-rate 0-12 pts + 32 per defaulted loan + 16 per
    overdue loan; ``least`` skips NULL, so a NULL score would read as 100 (T9).
    """
    credit_pts = (F.lit(S.RISK_BEST_CREDIT) - col(credit_score)) / S.RISK_CREDIT_SPAN * S.RISK_CREDIT_POINTS
    raw = (credit_pts + col(failed_txn_rate) * S.RISK_FAILED_POINTS
           + col(defaulted) * S.RISK_DEFAULT_POINTS + col(overdue) * S.RISK_OVERDUE_POINTS)
    return round2(F.least(F.lit(100.0), raw))


def risk_tier(score: str | Column) -> Column:
    """Tier of the *rounded* score."""
    s = col(score)
    return (F.when(s >= S.RISK_HIGH_AT, "High")
            .when(s >= S.RISK_MEDIUM_AT, "Medium")
            .otherwise("Low"))


def credit_band(score: str | Column) -> Column:
    """Five credit-score bands; NULL lands in '800+' (P23, T9)."""
    s = col(score)
    return (F.when(s < 500, "< 500")
            .when(s < 600, "500-599")
            .when(s < 700, "600-699")
            .when(s < 800, "700-799")
            .otherwise("800+"))


def pct(part: Column, whole: Column) -> Column:
    """round(part * 100.0 / whole, 2) as in the SQL questions."""
    return round2(F.try_divide(part.cast("double") * 100.0, whole))
