"""Blockwise Richardson-Lucy deconvolution."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import mirrored
from ..functions.pixel import rescale
from .kernels import convolve, destripe_band, gaussian
from .spatial import halo

EPS = float(np.finfo(np.float32).eps)


def fast_length(n: int) -> int:
    """The least number from n on whose only primes are 2, 3, 5 and 7."""
    while True:
        m = n
        for p in (2, 3, 5, 7):
            while m % p == 0:
                m //= p
        if m == 1:
            return n
        n += 1


def block_shape(volume: tuple[int, int, int], pad: tuple[int, int, int], most_voxels: int) -> tuple[int, int, int]:
    """The largest core (x, y, z; x = y) whose padded size, at fast lengths, stays within the bound; the flattest of ties."""
    best, top = (1, 1, 1), 0
    for z in range(1, volume[2] + 1):
        fz = fast_length(z + 2 * pad[2])
        lo, hi = 1, max(volume[:2])
        while lo < hi:
            mid = (lo + hi + 1) // 2
            size = fast_length(min(mid, volume[0]) + 2 * pad[0]) * fast_length(min(mid, volume[1]) + 2 * pad[1]) * fz
            lo, hi = (mid, hi) if size <= most_voxels else (lo, mid - 1)
        core = (min(lo, volume[0]), min(lo, volume[1]), z)
        size = fast_length(core[0] + 2 * pad[0]) * fast_length(core[1] + 2 * pad[1]) * fz
        if size <= most_voxels and core[0] * core[1] * core[2] > top:
            best, top = core, core[0] * core[1] * core[2]
    return best


def bessel_j0(x: np.ndarray) -> np.ndarray:
    """J0 by its integral over half a turn."""
    t = (np.arange(256) + 0.5) / 256 * np.pi
    return np.cos(np.multiply.outer(x, np.sin(t))).mean(axis=-1)


def light_psf(z: np.ndarray, r: np.ndarray, na: float, wavelength: float, index: float) -> np.ndarray:
    """Intensity at axial distance z and radius r by the scalar diffraction integral over the pupil."""
    p = (np.arange(200) + 0.5) / 200
    k = 2 * np.pi / wavelength
    phase = np.exp(-0.5j * k * np.multiply.outer(z, p**2) * na**2 / index**2)
    field = (bessel_j0(k * na * np.multiply.outer(r, p) / index) * phase * p).mean(axis=-1)
    return np.abs(2 * field) ** 2


def make_psf(shape: tuple[int, int, int], voxel: tuple[float, float, float], na: float, emission: float, sheet_na: float, excitation: float, index: float) -> np.ndarray:
    """(z, y, x) kernel of odd sizes, sum 1: detection times light sheet, one octant computed and mirrored."""
    half = [n // 2 for n in shape]
    z, y, x = (np.arange(h + 1) * v for h, v in zip(half, voxel, strict=True))
    zz, yy, xx = np.meshgrid(z, y, x, indexing="ij")
    octant = light_psf(zz, np.hypot(yy, xx), na, emission, index) * light_psf(xx, zz, sheet_na, excitation, index)
    whole = octant
    for axis in range(3):
        whole = np.concatenate([np.flip(np.take(whole, np.arange(1, whole.shape[axis]), axis=axis), axis), whole], axis=axis)
    return whole / whole.sum()


def taper_mask(shape: tuple[int, ...], widths: tuple[int, ...]) -> np.ndarray:
    out = np.ones(shape)
    for axis, (n, w) in enumerate(zip(shape, widths, strict=True)):
        i, w = np.arange(n), min(w, n // 2)
        ramp = np.minimum(1.0, np.minimum(i, n - i) / w) if w > 0 else np.ones(n)
        out = out * ramp.reshape([-1 if a == axis else 1 for a in range(len(shape))])
    return out


def edge_taper(x: np.ndarray, psf: np.ndarray) -> np.ndarray:
    """Edges fade into a blurred copy over the kernel's half size, eight places at least."""
    m = taper_mask(x.shape, tuple(max(8, (n + 1) // 2) for n in psf.shape))
    return m * x + (1 - m) * convolve(x, psf / psf.sum())


def otf(psf: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """The kernel's transform, centred at the origin."""
    wide = np.zeros(shape)
    wide[tuple(slice(n) for n in psf.shape)] = psf
    return np.fft.rfftn(np.roll(wide, [-(n // 2) for n in psf.shape], range(psf.ndim)))


@dataclass(frozen=True)
class Plan:
    """smooth_every: rounds between smoothings, neither in the first nor the last. damping: share that the estimate's 26-neighbour
    mean gets in those rounds. stop: percentage of change that ends it, from the second round. classical: divide the fixed
    data, not the current estimate."""

    rounds: int = 6
    smooth_every: int = 0
    damping: float = 0.0
    stop: float = 0.0
    classical: bool = False
    update_psf: bool = False


def _box(x: np.ndarray) -> np.ndarray:
    k = np.ones((3, 3, 3)) / 26
    k[1, 1, 1] = 0
    return convolve_same(x, k)


def convolve_same(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Convolution of the same size with zeros beyond the edges."""
    wide = [a + b - 1 for a, b in zip(x.shape, kernel.shape, strict=True)]
    out = np.fft.irfftn(np.fft.rfftn(x, wide, range(x.ndim)) * np.fft.rfftn(kernel, wide, range(x.ndim)), wide, range(x.ndim))
    return out[tuple(slice(k // 2, k // 2 + n) for k, n in zip(kernel.shape, x.shape, strict=True))]


def deconvolve(block: np.ndarray, psf: np.ndarray, plan: Plan = Plan(), fourier: bool = True) -> np.ndarray:
    """Multiplicative updates x <- |x . (psf* (x / psf x))| of the block with tapered edges: the numerator is the current
    estimate unless `classical`. In the frequency domain the block is periodic, in space there are zeros beyond it."""
    data = x = edge_taper(block.astype(float), psf)
    inverse = psf[::-1, ::-1, ::-1]
    norm = np.linalg.norm(x)
    for k in range(1, plan.rounds + 1):
        smoothing = 0 < plan.smooth_every < plan.rounds and 1 < k < plan.rounds and k % plan.smooth_every == 0
        if smoothing:
            x = gaussian(x, 0.5)
        if fourier:
            h = otf(psf, x.shape)
            apply = lambda v: np.fft.irfftn(np.fft.rfftn(v) * h, v.shape, range(3))  # noqa: B023, E731
            back = lambda v: np.fft.irfftn(np.fft.rfftn(v) * np.conj(h), v.shape, range(3))  # noqa: B023, E731
        else:
            apply, back = lambda v: convolve_same(v, psf), lambda v: convolve_same(v, inverse)  # noqa: B023, E731
        numerator = data if plan.classical else x
        new = x * back(numerator / np.maximum(apply(x), EPS))
        if smoothing and plan.damping > 0:
            new = (1 - plan.damping) * new + plan.damping * _box(x)
        new = np.abs(new)
        if plan.update_psf:
            fx, fy = np.fft.rfftn(new), np.fft.rfftn(data)
            wide = np.fft.irfftn(fy * np.conj(fx) / np.maximum(np.abs(fx) ** 2, EPS), new.shape, range(3))
            near = np.roll(wide, [n // 2 for n in psf.shape], range(3))[tuple(slice(n) for n in psf.shape)]
            near = np.maximum(near, 0)
            psf = near / near.sum() if near.sum() > 0 else psf
            inverse = psf[::-1, ::-1, ::-1]
        x = new
        now = np.linalg.norm(x)
        if plan.stop and k > 1 and norm > 0 and abs(now - norm) / norm * 100 <= plan.stop:
            break
        norm = now
    return x


def destripe_z(block: np.ndarray, sigma: float, wavelet: str = "db9") -> np.ndarray:
    """Stripes along z: each (x, z) slice of the log of the block."""
    x = np.log1p(np.moveaxis(block.astype(float), 1, 0))
    out = np.stack([destripe_band(s, sigma, wavelet, axes=(-2,)) for s in x])
    return np.moveaxis(np.expm1(out), 0, 1)


def by_block(px: DataFrame, shape: dict[str, int], block: dict[str, int], pad: dict[str, int], kernel: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(z, y, x, v) of a kernel run on padded blocks of (z, y, x, v); the padding goes again. Outside the volume the padding
    mirrors it. A group is one padded block, whose size the caller sets."""
    names = ("z", "y", "x")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        at = dict(zip(names, key, strict=True))
        lo = {c: at[c] * block[c] - pad[c] for c in names}
        n = tuple(min((at[c] + 1) * block[c], shape[c]) + pad[c] - lo[c] for c in names)
        index = [np.arange(lo[c], lo[c] + m) for c, m in zip(names, n, strict=True)]
        inside = [np.where(i < 0, -1 - i, np.where(i >= shape[c], 2 * shape[c] - 1 - i, i)) for i, c in zip(index, names, strict=True)]
        base = {c: int(i.min()) for c, i in zip(names, inside, strict=True)}
        cube = np.zeros([int(i.max()) - base[c] + 1 for i, c in zip(inside, names, strict=True)])
        keep = np.ones(len(pdf), bool)
        for c, s in zip(names, cube.shape, strict=True):
            keep &= ((pdf[c] >= base[c]) & (pdf[c] < base[c] + s)).to_numpy()
        p = pdf[keep]
        cube[tuple((p[c] - base[c]).to_numpy() for c in names)] = p.v.to_numpy()
        out = kernel(cube[np.ix_(*[i - base[c] for i, c in zip(inside, names, strict=True)])])
        core = out[tuple(slice(pad[c], m - pad[c]) for c, m in zip(names, n, strict=True))]
        zz, yy, xx = np.meshgrid(*[np.arange(m) + at[c] * block[c] for c, m in zip(names, core.shape, strict=True)], indexing="ij")
        return pd.DataFrame({"z": zz.ravel(), "y": yy.ravel(), "x": xx.ravel(), "v": core.ravel()})

    wide = halo(px.select("z", "y", "x", F.col("v").cast("double").alias("v")), block, pad, shape)
    return wide.groupBy("bz", "by", "bx").applyInPandas(run, "z int, y int, x int, v double")


def normalised(px: DataFrame, scale: float, amplification: float, percents: tuple[float, float] | None = None) -> DataFrame:
    """Deconvolved values on the output scale, by the global bounds (or percentiles), as one aggregate that is joined back."""
    bounds = px.agg(*(F.percentile("v", F.lit(p)).alias(n) for p, n in zip(percents, ("lo", "hi"), strict=True))) if percents else px.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    return px.crossJoin(F.broadcast(bounds)).withColumn("v", rescale(F.col("v"), F.col("lo"), F.col("hi"), scale, amplification)).drop("lo", "hi")  # bounds are one row


__all__ = ["Plan", "block_shape", "by_block", "deconvolve", "destripe_z", "edge_taper", "fast_length", "make_psf", "mirrored", "normalised", "otf", "taper_mask"]
