"""Conversions and domain derivations as Columns.

Malformed input becomes null, never an error (ANSI mode throws on plain casts), and null stays
apart from zero and false until an operator says otherwise.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelyard.plans import contract as C


def trimmed(c: Column) -> Column:
    return F.trim(c)


def parse_month(c: Column) -> Column:
    """``MMYYYY`` as the first day of the month; anything else is null."""
    t = F.trim(c)
    return F.when(F.length(t) == 6, F.try_to_timestamp(t, F.lit("MMyyyy")).cast("date"))


def to_number(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def to_int(c: Column) -> Column:
    return to_number(c).try_cast("int")


def clean_category(c: Column) -> Column:
    """Trimmed text; blank and null become ``Unknown``."""
    t = F.trim(c)
    return F.coalesce(F.when(t != "", t), F.lit(C.UNKNOWN))


def decode(c: Column, names: dict[str, str], default: str | None = C.UNKNOWN) -> Column:
    """The name of a trimmed code, or ``default``."""
    t, out = F.trim(c), None
    for code, name in names.items():
        out = F.when(t == code, name) if out is None else out.when(t == code, name)
    return out if default is None else out.otherwise(default)


def equals(c: Column, value: str) -> Column:
    return F.coalesce(F.trim(c) == value, F.lit(False))


def truth(c: Column) -> Column:
    """A condition with null read as false."""
    return F.coalesce(c, F.lit(False))


def flag(c: Column) -> Column:
    """A condition as 0 or 1, null as 0."""
    return truth(c).cast("int")


def ratio(a: Column, b: Column) -> Column:
    """``a / b``; null where ``b`` is zero or either is null."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def clip(c: Column, low: float, high: float) -> Column:
    """``c`` held inside the bounds; null stays null (greatest and least would skip it)."""
    return F.when(c < low, float(low)).when(c > high, float(high)).otherwise(c)


def round_scaled(c: Column, digits: int) -> Column:
    """``c`` times a power of ten rounded half away from zero, as SQL engines round doubles; Spark's ``round`` goes by the printed number, which can lie on the other side of a tie."""
    return F.round(c * 10.0**digits, 0) / 10.0**digits


def band(c: Column, bands: tuple[Sequence[float], Sequence[str]]) -> Column:
    """Left-closed, right-open bands; outside all of them or null is ``Unknown``."""
    edges, labels = bands
    out = F.when(c < edges[0], C.UNKNOWN)
    for high, label in zip(edges[1:], labels, strict=True):
        out = out.when(c < high, label)
    return out.otherwise(C.UNKNOWN)


def level(c: Column, levels: tuple[Sequence[float], Sequence[str]]) -> Column:
    """Labels by rising thresholds: below the first the first label; null stays null."""
    edges, labels = levels
    out = F.when(c.isNull(), None)
    for high, label in zip(edges, labels, strict=False):
        out = out.when(c < high, label)
    return out.otherwise(labels[-1])


def month_number(c: Column) -> Column:
    """Months since year 0, for whole-month differences."""
    return F.year(c) * 12 + F.month(c)


def delinquency_months(c: Column) -> Column:
    """Months from a delinquency code; blank, ``XX`` and anything unreadable are null, never zero."""
    return F.upper(F.trim(c)).try_cast("int")


def status(months: Column, zero_code: Column, default_months: int = C.DEFAULT_MONTHS) -> dict[str, Column]:
    """Status, flags and termination reason from delinquent months and the zero-balance code."""
    code = F.coalesce(F.trim(zero_code), F.lit(""))
    prepaid, credit, ended = code.isin(*C.PREPAID), code.isin(*C.CREDIT_EVENT), code != ""
    deep, late = truth(months >= default_months), truth(months >= C.DELINQUENT_MONTHS)
    return {
        "current_status": F.when(prepaid, "Prepaid").when(credit, "Default").when(ended, "Closed").when(deep, "Default")
        .when(late, "Delinquent").otherwise("Current"),
        "delinquency": late, "default_flag": deep | credit, "prepayment_flag": prepaid, "is_terminated": ended,
        "termination_reason": decode(code, C.ZERO_BALANCE, None),
    }


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


_LIMB = (1 << 22) - 1


def _times(x: Column, factor: int) -> Column:
    """The low 64 bits of an unsigned product, without overflow: limbs of 22 bits."""
    parts = [F.shiftrightunsigned(x, s).bitwiseAND(F.lit(_LIMB)) for s in (0, 22, 44)]
    ours = [factor & _LIMB, factor >> 22 & _LIMB, factor >> 44]
    low = parts[0] * ours[0]
    mid = parts[1] * ours[0] + parts[0] * ours[1] + F.shiftrightunsigned(low, 22)
    high = parts[2] * ours[0] + parts[1] * ours[1] + parts[0] * ours[2] + F.shiftrightunsigned(mid, 22)
    return F.shiftleft(high.bitwiseAND(F.lit((1 << 20) - 1)), 44).bitwiseOR(
        F.shiftleft(mid.bitwiseAND(F.lit(_LIMB)), 22)).bitwiseOR(low.bitwiseAND(F.lit(_LIMB)))


def hash_bucket(entity: Column, salt: str) -> Column:
    """A stable bucket in [0, 1000000) for an entity id: the SplitMix64 finaliser over id plus CRC-32 of the salt.

    Ids that are no non-negative integers count as 0.  Each step is bound once, so the expression stays small.
    """
    def folded(shift: int):
        return lambda x: x.bitwiseXOR(F.shiftrightunsigned(x, shift))

    def times(factor: int):
        return lambda x: _times(x, factor)

    def bucket(x):
        return (F.shiftrightunsigned(x, 1) % 500_000 * 2 + x.bitwiseAND(F.lit(1))) % 1_000_000

    x = F.coalesce(F.trim(entity.cast("string")).try_cast("long"), F.lit(0).cast("long")) + F.lit(zlib.crc32(salt.encode())).cast("long")
    # Shifts and multipliers of SplitMix64.
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = let(let(x, folded(shift)), times(factor))
    return let(let(x, folded(31)), bucket)


def sampled(entity: Column, rate: float, salt: str) -> Column:
    """Whether an entity is in the sample of this rate; all of them at 1 and above."""
    return F.lit(True) if rate >= 1 else hash_bucket(entity, salt) < round(rate * 1_000_000)
