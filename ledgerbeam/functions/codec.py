"""Category codes as column expressions.

A code is ``prefix * 100 + sub-code``.  Sub-codes 61, 62, 71 and 72 mark events
with three or more additional jets; they replace the sub-code of the standard
code, the prefix stays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sub-codes of events with at least three additional b jets (fixed values).
TTNB = (61, 62, 71, 72)
#: Categories by sub-code; 46 and 56 never occur (fixed values).
CATEGORIES = {"ttlf": (0,), "ttc": (41, 42, 43, 44, 45), "ttb": (51,), "tt2b": (52,), "ttbb": (53, 54, 55), "tt3b": (61, 62), "tt4b": (71, 72)}
#: Relative distance at which two momentum fractions count as the same.
CLOSE = 2.0**-10


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def idiv(x, n: int) -> Column:
    """Quotient truncated toward zero."""
    return F.call_function("div", _c(x).cast("bigint"), F.lit(n).cast("bigint"))


def prefix(code) -> Column:
    return idiv(code, 100)


def sub_code(code) -> Column:
    """Sub-code in 0..99, also of negative codes."""
    return F.pmod(_c(code), F.lit(100))


def raw_sub_code(code) -> Column:
    """Remainder with the sign of the code."""
    return _c(code) % 100


def want_sub(n, multi) -> Column:
    """The sub-code that n additional jets, multi of them with two or more hadrons, call for; null below three."""
    second = _c(multi) >= 1
    return F.when(_c(n) == 3, F.when(second, 62).otherwise(61)).when(_c(n) >= 4, F.when(second, 72).otherwise(71))


def expand(gen, n, multi) -> Column:
    """The expanded code."""
    return F.when(_c(n) <= 2, _c(gen)).otherwise(prefix(gen) * 100 + want_sub(n, multi)).cast("int")


def is_ttnb(code) -> Column:
    return sub_code(code).isin(*TTNB)


def category(code) -> Column:
    """Name of the category; null for sub-codes that never occur."""
    sub, out = sub_code(code), None
    for name, subs in CATEGORIES.items():
        out = F.when(sub.isin(*subs), name) if out is None else out.when(sub.isin(*subs), name)
    return out


def stitch_keep(dedicated: Column, code) -> Column:
    """The dedicated sample keeps the events with extra jets, every other sample the rest."""
    return dedicated == is_ttnb(code)


def near(x, y, relative: float = CLOSE) -> Column:
    """Equal, or both finite and within relative of the larger."""
    a, b = _c(x).cast("double"), _c(y).cast("double")
    finite = lambda v: ~F.isnan(v) & (F.abs(v) < float("inf"))
    return (a == b) | (finite(a) & finite(b) & (F.abs(a - b) <= relative * F.greatest(F.abs(a), F.abs(b))))


#: How far floats that agree may lie apart, as a share of the first one or of 1.
TOLERANCE = 5e-4


def agrees(a, b, tolerance: float = TOLERANCE) -> Column:
    """Float agreement of two columns: both NaN, equal, or closer than tolerance times max(1, |a|)."""
    x, y = _c(a).cast("double"), _c(b).cast("double")
    return (F.isnan(x) & F.isnan(y)) | (x == y) | (F.abs(x - y) < tolerance * F.greatest(F.lit(1.0), F.abs(x)))


def round_mantissa(bits, kept: int = 14) -> Column:
    """Float32 bits with kept mantissa bits: rounded up on the first dropped bit, truncated where that would overflow."""
    drop = 23 - kept
    b = _c(bits).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    cut = F.shiftright(b, drop)
    up = F.shiftright(b, drop - 1).bitwiseAND(F.lit(1)) == 1
    full = cut.bitwiseAND(F.lit((1 << kept) - 1)) >= (1 << kept) - 2
    return F.shiftleft(F.when(up & ~full, cut + 1).otherwise(cut), drop)


def unsigned(bits) -> Column:
    """32-bit numbers as unsigned ones, for ordering."""
    return _c(bits).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))


def float_bits(x) -> Column:
    """Bits of float32 values, so that NaN and signed zeros keep their identity; the one Arrow function of this engine."""
    @F.pandas_udf("int")
    def bits(col: pd.Series) -> pd.Series:
        return pd.Series(col.to_numpy(np.float32).view(np.int32))

    return bits(_c(x).cast("float"))
