"""Whole-plane kernels in numpy, applied to plane rows in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..model import PLANES


# wavelets


@cache
def daubechies(n: int) -> np.ndarray:
    """The scaling filter with n vanishing moments, by spectral factorisation: the roots inside the unit circle."""
    poly = np.array([comb(n - 1 + k, k) for k in range(n)][::-1], float)
    roots = []
    for y in np.roots(poly) if n > 1 else []:
        b = 1 - 2 * y  # z + 1/z = 2 - 4y
        z = b + np.sqrt(b * b - 1 + 0j)
        roots.append(z if abs(z) < 1 else 1 / z)
    q = np.real(np.poly(roots)) if roots else np.ones(1)
    h = q
    for _ in range(n):
        h = np.convolve(h, [1, 1])
    return h / h.sum() * np.sqrt(2)


def _filters(wavelet: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rec_lo = daubechies(1 if wavelet == "haar" else int(wavelet.removeprefix("db")))
    sign = np.where(np.arange(len(rec_lo)) % 2 == 0, 1.0, -1.0)
    rec_hi = sign * rec_lo[::-1]
    return rec_lo[::-1], rec_hi[::-1], rec_lo, rec_hi


def dwt(x: np.ndarray, wavelet: str, axis: int) -> tuple[np.ndarray, np.ndarray]:
    """Approximation and detail along an axis, with half-sample symmetric edges."""
    lo, hi, _, _ = _filters(wavelet)
    x, f = np.moveaxis(x, axis, -1), len(lo)
    n = x.shape[-1]
    at = 2 * np.arange((n + f - 1) // 2)[:, None] + 1 - np.arange(f)[None, :]
    at = np.mod(at, 2 * n)
    at = np.where(at < n, at, 2 * n - 1 - at)
    wide = x[..., at]
    return np.moveaxis(wide @ lo, -1, axis), np.moveaxis(wide @ hi, -1, axis)


def idwt(a: np.ndarray, d: np.ndarray, wavelet: str, axis: int) -> np.ndarray:
    _, _, lo, hi = _filters(wavelet)
    a, d = np.moveaxis(a, axis, -1), np.moveaxis(d, axis, -1)
    m, f = a.shape[-1], len(lo)
    out = np.zeros((*a.shape[:-1], 2 * m + f - 2))
    for k in range(f):
        out[..., k : k + 2 * m : 2] += a * lo[k] + d * hi[k]
    return np.moveaxis(out[..., f - 2 : 2 * m], -1, axis)


def most_levels(n: int, wavelet: str) -> int:
    f = len(_filters(wavelet)[0])
    return max(0, int(np.floor(np.log2(n / (f - 1))))) if n >= f - 1 > 0 else 0


def wavedec2(x: np.ndarray, wavelet: str, level: int | None = None) -> list:
    """[approximation, (H, V, D) of the coarsest level, .., of the finest]."""
    level = most_levels(min(x.shape), wavelet) if level is None else level
    out = []
    for _ in range(level):
        lo, hi = dwt(x, wavelet, -2)
        (x, v), (h, d) = dwt(lo, wavelet, -1), dwt(hi, wavelet, -1)
        out.append((h, v, d))
    return [x, *out[::-1]]


def waverec2(parts: list, wavelet: str) -> np.ndarray:
    x = parts[0]
    for h, v, d in parts[1:]:
        x = x[: h.shape[0], : h.shape[1]]
        x = idwt(idwt(x, v, wavelet, -1), idwt(h, d, wavelet, -1), wavelet, -2)
    return x


# stripes


def notch(length: int, sigma: float) -> np.ndarray:
    """1 - exp(-i^2 / 2 sigma^2), a gap around frequency 0."""
    if length <= 0:
        raise ValueError("the length must be positive")
    if sigma <= 0:
        raise ValueError("sigma must be positive")
    i = np.arange(length, dtype=float)
    return 1 - np.exp(-(i**2) / (2 * sigma**2))


def filter_coefficients(x: np.ndarray, width: float, axis: int) -> np.ndarray:
    """Coefficients with their low frequencies damped along an axis. Place i of the packed spectrum
    (c0, re c1, im c1, re c2, ..) is weighted by the notch at i; its sigma grows with the other axis."""
    x = np.moveaxis(x, axis, -1)
    n = x.shape[-1]
    spectrum = np.fft.rfft(x, axis=-1)
    g = notch(n, width * x.shape[0 if x.ndim == 2 else -2])
    k = np.arange(spectrum.shape[-1])
    re, im = g[np.maximum(0, 2 * k - 1)], np.where(2 * k < n, g[np.minimum(2 * k, n - 1)], 0.0)
    return np.moveaxis(np.fft.irfft(spectrum.real * re + 1j * spectrum.imag * im, n, axis=-1), -1, axis)


def destripe_band(x: np.ndarray, sigma: float, wavelet: str = "db9", level: int | None = None, axes: tuple[int, ...] = (-1,)) -> np.ndarray:
    """Stripes removed in the detail bands: the horizontal one along -1, the vertical one along -2."""
    parts = wavedec2(x, wavelet, level)
    width = sigma / min(x.shape)
    out = [parts[0]]
    for h, v, d in parts[1:]:
        out.append((filter_coefficients(h, width, -1) if -1 in axes else h, filter_coefficients(v, width, -2) if -2 in axes else v, d))
    return waverec2(out, wavelet)[: x.shape[0], : x.shape[1]]


def destripe_dual(x: np.ndarray, sigmas: tuple[float, float], **kw) -> np.ndarray:
    """One pass for equal sigmas, else a pass of each in turn."""
    if sigmas[0] == sigmas[1] > 0:
        return destripe_band(x, sigmas[0], **kw)
    return destripe_band(destripe_band(x, sigmas[0], **kw), sigmas[1], **kw)


#: Fixed value: places of a padded plane that memory must hold at most.
PADDED_PLACES = 5e14


def pad_size(sigma: float, rise: float = 0.5, shape: tuple[int, int] | None = None) -> int:
    """Even padding that reaches the notch's given height, lowered to two digits where a plane of that shape would not fit
    with it; 0 for sigma 0."""
    if sigma == 0:
        return 0
    if shape:
        y, x = shape[0] + 1, shape[1] + 1
        fits = (x + y - np.sqrt((x - y) ** 2 + 4 * PADDED_PLACES)) / 2  # minus the widest padding, doubled
        rise = min(round(1 - float(np.exp(fits / (2 * sigma**2))), 2) - 0.01, rise)
    return int(np.sqrt(-2 * sigma**2 * np.log(1 - rise)) + 0.5) // 2 * 2


def lowpass(x: np.ndarray, cutoff: float) -> np.ndarray:
    """First-order Butterworth along the last axis, forwards and backwards; cutoff in units of half the sampling rate.
    Edges are extended by odd reflection."""
    k = np.tan(np.pi * cutoff / 2)
    b, a1 = k / (1 + k), (k - 1) / (1 + k)
    pad = min(6, x.shape[-1] - 1)

    def run(y: np.ndarray) -> np.ndarray:
        out = np.empty_like(y)
        state = (b - a1 * b) / (1 + a1) * y[..., 0]  # at rest on the first value
        for i in range(y.shape[-1]):
            out[..., i] = b * y[..., i] + state
            state = b * y[..., i] - a1 * out[..., i]
        return out

    front = 2 * x[..., :1] - x[..., pad:0:-1]
    back = 2 * x[..., -1:] - x[..., -2 : -pad - 2 : -1]
    y = np.concatenate([front, x, back], axis=-1).astype(float)
    y = run(run(y)[..., ::-1])[..., ::-1]
    return y[..., pad : pad + x.shape[-1]]


def correct_bleach(x: np.ndarray, cutoff: float, low: float, middle: float, high: float, by_maximum: bool = False) -> np.ndarray:
    """Even out slow changes of brightness along the last axis, or by the outer product of both axes' maxima; x is on the log
    scale. Zeros count as the middle value."""
    tame = lambda v: lowpass(np.clip(np.where(v == 0, middle, v), max(low, np.log1p(1)), high), cutoff)
    soft = np.outer(tame(x.max(axis=1)), tame(x.max(axis=0))) if by_maximum else tame(x)
    return x / soft * soft.max()


def remove_streaks(image: np.ndarray, sigmas: tuple[float, float], wavelet: str = "db9", level: int | None = None, axes: tuple[int, ...] = (-1,), bleach: float | None = None, clips: tuple[float, float, float] | None = None) -> np.ndarray:
    """Destripe a plane on the log scale and come back to its pixel type."""
    if sigmas == (0, 0) and bleach is None:
        return image
    x = np.log1p(image.astype(float))
    if sigmas != (0, 0):
        h, w = x.shape
        pad = max(34, pad_size(max(sigmas), shape=x.shape))
        wide = np.pad(x, ((pad, pad + h % 2), (pad, pad + w % 2)), mode="reflect" if min(h, w) > pad + 1 else "edge")
        x = destripe_dual(wide, sigmas, wavelet=wavelet, level=level, axes=axes)[pad : pad + h, pad : pad + w]
    if bleach is not None:
        lit = x[x > 0]
        low, middle, high = clips or (tuple(np.percentile(lit, [1, 50, 99])) if lit.size else (np.log1p(1),) * 3)
        x = correct_bleach(x, bleach, low, middle, high)
    out = np.expm1(x)
    if np.issubdtype(image.dtype, np.integer):
        top = np.iinfo(image.dtype)
        return np.clip(np.rint(out), top.min, top.max).astype(image.dtype)
    return out.astype(image.dtype)


def subtract_background(image: np.ndarray, sheet: np.ndarray, background: np.ndarray, k: float) -> np.ndarray:
    """The lesser of the sheet's and k times the background's local percentile comes off, never below 0."""
    x = image.astype(float)
    return x - np.minimum(x, np.minimum(sheet, background * k))


def local_percentile(image: np.ndarray, half: tuple[int, int], spacing: int, step: int, percent: float) -> np.ndarray:
    """Percentile of the rectangle around each place of a grid, brought back to all places linearly."""
    h, w = image.shape
    ys, xs = np.arange(0, h + spacing, spacing).clip(max=h - 1), np.arange(0, w + spacing, spacing).clip(max=w - 1)
    ys, xs = np.unique(ys), np.unique(xs)
    grid = np.array([[np.percentile(image[max(0, y - half[0]) : y + half[0] + 1 : step, max(0, x - half[1]) : x + half[1] + 1 : step], percent * 100) for x in xs] for y in ys])
    rows = np.array([np.interp(np.arange(w), xs, g) for g in grid])
    return np.array([np.interp(np.arange(h), ys, c) for c in rows.T]).T


# smoothing and shape


def gaussian_kernel(sigma: float, radius: int | None = None) -> np.ndarray:
    radius = int(np.ceil(3 * sigma)) if radius is None else radius
    i = np.arange(-radius, radius + 1)
    k = np.exp(-(i**2) / (2 * sigma**2))
    return k / k.sum()


def convolve_axis(x: np.ndarray, kernel: np.ndarray, axis: int) -> np.ndarray:
    """Along one axis with the edge values repeated."""
    r = len(kernel) // 2
    wide = np.pad(x, [(r, r) if a == axis % x.ndim else (0, 0) for a in range(x.ndim)], mode="edge")
    n = x.shape[axis]
    return sum(k * np.take(wide, np.arange(i, i + n), axis=axis) for i, k in enumerate(kernel))


def gaussian(x: np.ndarray, sigma: float | tuple[float, ...], size: int | tuple[int, ...] | None = None) -> np.ndarray:
    """Separable Gaussian over all axes."""
    sigmas = np.broadcast_to(sigma, x.ndim)
    sizes = [None] * x.ndim if size is None else np.broadcast_to(size, x.ndim)
    out = x.astype(float)
    for axis, (s, n) in enumerate(zip(sigmas, sizes, strict=True)):
        if s > 0:
            out = convolve_axis(out, gaussian_kernel(float(s), None if n is None else int(n) // 2), axis)
    return out


def convolve(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Direct 3-D (or n-D) convolution with the edge values repeated."""
    r = [n // 2 for n in kernel.shape]
    wide = np.pad(x, [(a, n - 1 - a) for a, n in zip(r, kernel.shape, strict=True)], mode="edge").astype(float)
    flipped = kernel[tuple(slice(None, None, -1) for _ in kernel.shape)]
    out = np.zeros(x.shape)
    for at in np.ndindex(*kernel.shape):
        out += flipped[at] * wide[tuple(slice(a, a + n) for a, n in zip(at, x.shape, strict=True))]
    return out


def sobel(x: np.ndarray) -> np.ndarray:
    """Gradient magnitude by 3x3 differences."""
    smooth, slope = np.array([1.0, 2, 1]), np.array([-1.0, 0, 1])
    gy = convolve_axis(convolve_axis(x.astype(float), slope, 0), smooth, 1)
    gx = convolve_axis(convolve_axis(x.astype(float), slope, 1), smooth, 0)
    return np.hypot(gx, gy)


def resize(x: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """Linear resampling on pixel centres; axes that shrink are smoothed first."""
    out = x.astype(float)
    for axis, (n, m) in enumerate(zip(x.shape, shape, strict=True)):
        if m < n:
            out = convolve_axis(out, gaussian_kernel(max((n / m - 1) / 2, 1e-3)), axis)
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        lo = np.floor(at).astype(int)
        hi, w = np.minimum(lo + 1, n - 1), at - lo
        w = w.reshape([-1 if a == axis else 1 for a in range(x.ndim)])
        out = np.take(out, lo, axis=axis) * (1 - w) + np.take(out, hi, axis=axis) * w
    return out


def morph(mask: np.ndarray, size: int, grow: bool) -> np.ndarray:
    """Box dilation or erosion."""
    r = size // 2
    wide = np.pad(mask, r, mode="constant", constant_values=not grow)
    parts = [wide[i : i + mask.shape[0], j : j + mask.shape[1]] for i in range(size) for j in range(size)]
    return np.logical_or.reduce(parts) if grow else np.logical_and.reduce(parts)


def closed_opened(mask: np.ndarray, size: int = 3) -> np.ndarray:
    closed = morph(morph(mask, size, True), size, False)
    return morph(morph(closed, size, False), size, True)


def lit_slice(profile: np.ndarray, noise: float, cutoff: float = 0.1) -> tuple[int, int]:
    """First and last-plus-one place of a profile whose low-passed value exceeds the noise."""
    at = np.flatnonzero(lowpass(profile.astype(float), cutoff) > noise)
    return (int(at[0]), int(at[-1]) + 1) if len(at) else (0, 0)


def process_plane(image: np.ndarray, flat: np.ndarray | None = None, reduce: tuple[int, int] | None = None, how: str = "max", sigmas: tuple[float, float] = (0, 0), bleach: float | None = None, dark: float = 0, background: float | None = None, new_shape: tuple[int, int] | None = None, shift: int | None = None, flip: bool = False, turn: int = 0) -> np.ndarray:
    """A plane through the fixed order of steps: blank test, flat field, reduction, stripes and bleach, dark, background, size, type, flip, turn."""
    kind = image.dtype
    if image.size == 0 or image.min() == image.max():
        h, w = image.shape
        if reduce:
            h, w = -(-h // reduce[0]), -(-w // reduce[1])
        h, w = new_shape or (h, w)
        blank = np.zeros((h, w), np.uint8 if shift is not None else kind)
        return blank if turn % 180 == 0 else blank.T
    x = image.astype(float)
    if flat is not None and flat.shape == x.shape:
        x = x / flat
    if reduce:
        fy, fx = reduce
        h, w = -(-x.shape[0] // fy), -(-x.shape[1] // fx)
        wide = np.pad(x, ((0, h * fy - x.shape[0]), (0, w * fx - x.shape[1])))
        x = getattr(np, how)(wide.reshape(h, fy, w, fx), axis=(1, 3))
    x = remove_streaks(x, sigmas, bleach=bleach)
    if dark > 0:
        x = np.where(x > dark, x - dark, 0)
    if background is not None:
        x = subtract_background(x, local_percentile(x, (0, 75), 25, 2, 0.25), local_percentile(x, (100, 100), 25, 2, 0.25), background)
    if new_shape is not None:
        x = resize(x, new_shape)
    if shift is not None:
        v = np.clip(x, 0, 65535).astype(np.int64)
        out = np.minimum(np.where((v > 0) & (v < 2**shift), 1, v >> shift), 255).astype(np.uint8)
    elif np.issubdtype(kind, np.integer):
        top = np.iinfo(kind)
        out = np.clip(x, top.min, top.max).astype(kind)
    else:
        out = x.astype(kind)
    if flip:
        out = np.flipud(out)
    return np.rot90(out, turn // 90)


def map_planes(planes: DataFrame, kernel: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """The kernel on each plane row; rows with null pixels stay as they are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                if r.pixels is None or r.height != r.height:
                    rows.append(r._asdict())
                    continue
                out = kernel(np.frombuffer(r.pixels, r.dtype).reshape(int(r.height), int(r.width)))
                rows.append(r._asdict() | {"height": out.shape[0], "width": out.shape[1], "dtype": out.dtype.name, "pixels": np.ascontiguousarray(out).tobytes()})
            yield pd.DataFrame(rows, columns=list(b.columns))

    return planes.select(*PLANES.names).mapInPandas(run, PLANES)
