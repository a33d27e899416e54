"""Per-pixel maps as column expressions; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log1p(v: Column) -> Column:
    return F.log1p(v)


def expm1(v: Column) -> Column:
    return F.expm1(v)


def clip(v: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(v, F.lit(low)), F.lit(high))


def to_uint16(v: Column) -> Column:
    """Clipped to 0..65535, then truncated."""
    return clip(v, 0, 65535).cast("int")


def to_uint8(v: Column, shift: int | None, is_uint8: bool = False) -> Column:
    """16-bit values shifted right; what would vanish but isn't 0 becomes 1; clipped to 255. uint8 stays as it is."""
    if is_uint8:
        return v
    b = 8 if shift is None else shift
    if not 0 <= b <= 8:
        raise ValueError("the bit shift must be 0 to 8")
    return F.least(F.when((v > 0) & (v < 2**b), 1).otherwise(F.shiftright(v, b)), F.lit(255)).cast("int")


def shift_saturate(v: Column, shift: int, bits: int) -> Column:
    """A plain right shift with saturation at the type's maximum."""
    return F.least(F.shiftright(v, shift), F.lit(2**bits - 1))


def subtract_dark(v: Column, dark: float) -> Column:
    """v - dark above dark, else 0; unchanged if dark isn't positive."""
    return F.when(v > dark, v - dark).otherwise(F.lit(0)) if dark > 0 else v


def flat_field(v: Column, flat: Column) -> Column:
    """Division by the flat image (normalised by its maximum); pixels without a flat value stay."""
    return F.when(flat.isNull(), v).otherwise(v / flat)


def sigmoid(v: Column) -> Column:
    return 0.5 * (F.tanh(0.5 * v) + 1)


def foreground_fraction(v: Column, threshold: float, crossover: float) -> Column:
    """Soft membership of the foreground; not blurred, as the blur of the reference behaviour has no effect."""
    return sigmoid((v - threshold) / crossover)


def round_to(v: Column, low: int, high: int) -> Column:
    """Half to even, clipped, as a whole number."""
    return clip(F.rint(v), low, high).cast("int")


def truncate_to(v: Column, low: int, high: int) -> Column:
    return clip(v, low, high).cast("int")


def rescale(v: Column, dmin: float | Column, dmax: float | Column, scale: float, amplification: float) -> Column:
    """Stretch to [0, scale]: from dmin if it is positive, else from 0; less `amplification`; half away from zero; clipped."""
    dmin, dmax = (x if isinstance(x, Column) else F.lit(float(x)) for x in (dmin, dmax))
    stretched = F.when(dmin > 0, (v - dmin) * scale * amplification / (dmax - dmin)).otherwise(v * scale * amplification / dmax)
    return clip(F.round(stretched - amplification), 0.0, float(scale))


def enhance(v: Column, points: list[tuple[float, float]]) -> Column:
    """Piecewise-linear map through (from, to) points in order; flat outside them."""
    out = F.when(v <= points[0][0], F.lit(float(points[0][1])))
    for (a, p), (b, q) in zip(points[:-1], points[1:], strict=True):
        out = out.when(v <= b, p + (v - a) * ((q - p) / (b - a)))
    return out.otherwise(F.lit(float(points[-1][1])))


def reliability(peak: Column, width: Column, invalid: Column | int = 30) -> Column:
    """Of a displacement: half from the narrowness of its peak, as a share of the edge's invalid width, half from its height."""
    narrow = (100 - width * 100.0 / invalid) / 100
    return F.sqrt(0.5 * narrow * narrow + 0.5 * peak * peak)


def sphere_volume(radius: Column) -> Column:
    return 4.0 / 3.0 * F.lit(3.141592653589793) * F.pow(radius, F.lit(3.0))


def sphere_radius(volume: Column) -> Column:
    return F.cbrt(3.0 * volume / (4.0 * F.lit(3.141592653589793)))


def taper(c: Column, n: int, width: int) -> Column:
    """1 inside, a linear ramp at both ends of an axis of n places: 0 at the first, 1 `width` places on, and down to 1 / width
    at the last. A width of over half the axis counts as half."""
    width = min(width, n // 2)
    return F.least(F.lit(1.0), c / float(width), (n - c) / float(width)) if width > 0 else F.lit(1.0)


def blend(mask: Column, inner: Column, blurred: Column) -> Column:
    return mask * inner + (1 - mask) * blurred


def composite(channels: list[Column]) -> Column:
    """Channels as the planes of a colour image: two get a third of zeros, three are reordered red last to first, four stay."""
    if len(channels) == 2:
        return F.array(*channels, F.lit(0))
    return F.array(*(reversed(channels) if len(channels) == 3 else channels))


def relabel(label: Column, mapping: dict[int, int], inside: Column) -> Column:
    """Labels of the mapping changed where `inside` is false."""
    out = F.when(inside, label)
    for a, b in mapping.items():
        out = out.when(label == a, F.lit(b))
    return out.otherwise(label)
