"""Numeric, text and colour column functions used by the map products."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres per pixel of a 256-pixel web tile at zoom 0, the squared
# pixel allowance of thinning, and the metres in a degree of the sphere.
METRES_PER_PIXEL_Z0 = 156543.03390625
THINNING_PIXELS = 7
METRES_PER_DEGREE = 2.0 * math.pi * 6378137.0 / 360.0
LOW_POP_COLOUR = "#422"
DEFAULT_RAMP = ("#1f1f1f", "#e45427")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even_int(value: Column | str) -> Column:
    """Double to integer as SQL databases do it: ties go to the even neighbour."""
    return F.rint(_col(value)).cast("int")


def round_half_up_int(value: Column | str) -> Column:
    """Decimal to integer: ties go away from zero."""
    return F.round(_col(value)).cast("int")


def ratio(numerator: Column | str, denominator: Column | str, on_zero: str = "error") -> Column:
    """Division that either raises on a zero denominator or returns NULL."""
    top, bottom = _col(numerator).cast("double"), _col(denominator).cast("double")
    return top / bottom if on_zero == "error" else F.try_divide(top, bottom)


# --- zoom levels --------------------------------------------------------------


def zoom_tolerance(zoom: Column | str) -> Column:
    """Area tolerance in square metres for thinning at a zoom level."""
    metres = F.lit(METRES_PER_PIXEL_Z0) / F.pow(F.lit(2.0), _col(zoom) + 1)
    return F.pow(metres, F.lit(2.0)) * THINNING_PIXELS


def zoom_decimals(zoom: Column | str) -> Column:
    """Decimal places worth keeping in coordinates at a zoom level."""
    degrees = F.lit(METRES_PER_PIXEL_Z0) / F.pow(F.lit(2.0), _col(zoom)) / METRES_PER_DEGREE
    fraction = F.substring_index(F.format_string("%.9f", degrees), ".", -1)
    return F.length(F.regexp_extract(fraction, "^0*", 0)) + 1


# --- numbers as text ------------------------------------------------------------


def tenths(value: Column | str) -> Column:
    """``value`` to one decimal place, times ten, as an integer.

    Ties are decided on the exact binary value (12.35 is stored below the tie, so
    it gives 123): ``20 * value`` is formed as a sum with its rounding error.
    """
    v = _col(value).cast("double")
    size = F.abs(v)
    candidate = F.floor(size * 10.0 + 0.5)
    a, b = size * 16.0, size * 4.0
    total = a + b
    spill = total - a
    error = (a - (total - spill)) + (b - spill)
    tie = candidate * 2.0 - 1.0
    exact = F.when((total - tie) + error < 0, candidate - 1).otherwise(candidate)
    return (F.when(v < 0, -exact).otherwise(exact)).cast("long")


def one_decimal(value: Column | str) -> Column:
    t = tenths(value)
    sign = F.when((_col(value) < 0) & (t != 0), "-").otherwise("")
    size = F.abs(t)
    return F.concat(sign, F.floor(size / 10).cast("string"), F.lit("."), (size % 10).cast("string"))


def number_text(value: Column | str, maptype: Column | str, stat_type: Column | str) -> Column:
    """Display text: thousands separators, ``$`` for ``$/`` types, ``%`` for percents."""
    v, kind = _col(value), _col(maptype)
    grouped = F.call_function("format_number", F.round(v, 3), F.lit("#,##0.###"))
    money = F.when(F.instr(_col(stat_type), "$/") > 0, F.lit("$")).otherwise(F.lit(""))
    return F.when(kind == "values", F.concat(money, grouped)).otherwise(
        F.concat(one_decimal(v), F.lit("%"))
    )


# --- colours --------------------------------------------------------------------


def _channels(colour: str) -> tuple[int, int, int]:
    digits = colour[-6:]
    return tuple(int(digits[i : i + 2], 16) for i in (0, 2, 4))


def colour_ramp(
    value: Column | str,
    low: Column | str,
    high: Column | str,
    colours: Sequence[str] = DEFAULT_RAMP,
    on_flat: str = "error",
) -> Column:
    """Hex colour of ``value`` on a linear ramp over ``[low, high]``.

    Values outside the domain take the end colours. More than two colours share
    the domain in equal segments. A domain with ``high <= low`` has no ramp: it
    raises, or gives the first colour with ``on_flat='start'``.
    """
    if len(colours) < 2:
        raise ValueError("a ramp needs two or more colours")
    v, lo, hi = _col(value).cast("double"), _col(low).cast("double"), _col(high).cast("double")
    segments = len(colours) - 1
    width = (hi - lo) / segments
    inside = F.least(F.greatest(v, lo), hi)
    index = F.least(F.floor(F.try_divide(inside - lo, width)), F.lit(segments - 1)).cast("int")

    def channel(which: int) -> Column:
        result = None
        for i in range(segments):
            start, end = _channels(colours[i])[which], _channels(colours[i + 1])[which]
            seg_lo, seg_hi = lo + width * i, lo + width * (i + 1)
            held = F.least(F.greatest(inside, seg_lo), seg_hi)
            level = F.floor(F.try_divide(F.lit(float(end - start)), seg_hi - seg_lo) * (held - seg_lo) + start + 0.5)
            result = F.when(index == i, level) if result is None else result.when(index == i, level)
        return F.lower(F.lpad(F.hex(result), 2, "0"))

    ramp = F.concat(F.lit("#"), channel(0), channel(1), channel(2))
    if on_flat == "start":
        flat = F.lit("#" + colours[0][-6:].lower())
    else:
        flat = F.raise_error(F.lit("colour ramp domain needs high > low")).cast("string")
    return F.when(v.isNull() | lo.isNull() | hi.isNull(), F.lit(None)).when(hi > lo, ramp).otherwise(flat)
