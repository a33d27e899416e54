from __future__ import annotations

import numpy as np
import pytest

from voxelloom.model import PLANES
from voxelloom.operators import decon, kernels


@pytest.fixture
def rng():
    return np.random.default_rng(42)


@pytest.mark.parametrize("n", [1, 2, 4, 9])
def test_daubechies_filters_are_orthonormal(n):
    h = kernels.daubechies(n)
    assert len(h) == 2 * n and abs(h.sum() - np.sqrt(2)) < 1e-9
    for shift in range(n):
        assert abs(np.dot(h[2 * shift :], h[: len(h) - 2 * shift]) - (shift == 0)) < 1e-6


def test_db2_values():
    r = np.sqrt(3)
    assert np.allclose(kernels.daubechies(2), np.array([1 + r, 3 + r, 3 - r, 1 - r]) / (4 * np.sqrt(2)))


@pytest.mark.parametrize("shape", [(32, 32), (33, 47), (64, 19)])
@pytest.mark.parametrize("wavelet", ["haar", "db2", "db9"])
def test_wavelets_invert(rng, shape, wavelet):
    x = rng.normal(size=shape)
    assert np.allclose(kernels.waverec2(kernels.wavedec2(x, wavelet), wavelet)[: shape[0], : shape[1]], x, atol=1e-6)


def test_notch_and_its_limits():
    g = kernels.notch(8, 2.0)
    assert g[0] == 0 and np.allclose(g, [1 - np.exp(-(i**2) / 8) for i in range(8)])
    for bad in ((0, 1.0), (4, 0.0)):
        with pytest.raises(ValueError):
            kernels.notch(*bad)


@pytest.mark.parametrize("n", [7, 8])
def test_packed_spectrum(rng, n):
    x = rng.normal(size=(3, n))
    g, s = kernels.notch(n, 0.5 * 3), np.fft.rfft(x, axis=-1)
    packed = np.zeros((3, n))
    packed[:, 0] = s[:, 0].real
    for i in range(1, n):
        packed[:, i] = s[:, (i + 1) // 2].real if i % 2 else s[:, i // 2].imag
    packed *= g
    back = np.zeros_like(s)
    back[:, 0] = packed[:, 0]
    for i in range(1, n):
        back[:, (i + 1) // 2] += packed[:, i] if i % 2 else 1j * packed[:, i]
    assert np.allclose(kernels.filter_coefficients(x, 0.5, -1), np.fft.irfft(back, n, axis=-1))


def test_streaks_go_and_uniform_planes_stay(rng):
    image = np.full((96, 96), 1000.0) + np.linspace(0, 50, 96)[:, None] * 0
    streaked = image + np.where(np.arange(96) % 12 == 0, 300, 0)[:, None]
    out = kernels.remove_streaks(streaked.astype(np.uint16), (64, 64), wavelet="db2", axes=(-1,))
    assert out.dtype == np.uint16 and out.std() < 0.6 * streaked.std()
    assert kernels.remove_streaks(streaked, (0, 0)) is streaked
    blank = kernels.process_plane(np.zeros((10, 7), np.uint16), reduce=(2, 2), turn=90)
    assert blank.shape == (4, 5) and not blank.any()


def test_lowpass_keeps_constants_and_smooths(rng):
    assert np.allclose(kernels.lowpass(np.full((2, 30), 5.0), 0.1), 5)
    noise = rng.normal(size=500)
    assert kernels.lowpass(noise, 0.05).std() < 0.5 * noise.std()
    x = rng.normal(size=40)
    assert np.allclose(kernels.lowpass(x, 0.2), kernels.lowpass(x[::-1], 0.2)[::-1], atol=0.35)


def test_bleach_evens_brightness():
    slope = np.log1p(np.outer(np.linspace(500, 1000, 64), np.ones(64)))
    out = kernels.correct_bleach(slope, 0.05, 0.0, float(np.median(slope)), 20.0)
    assert out.std() < 0.5 * slope.std()


def test_separable_and_direct_convolution_agree(rng):
    x = rng.normal(size=(8, 9, 10))
    k = kernels.gaussian_kernel(0.8, 2)
    cube = k[:, None, None] * k[None, :, None] * k[None, None, :]
    assert np.allclose(kernels.gaussian(x, 0.8, 5), kernels.convolve(x, cube), atol=1e-10)
    assert np.allclose(kernels.convolve(np.ones((4, 4, 4)), cube), 1)


def test_resize_and_sobel(rng):
    ramp = np.tile(np.arange(16.0), (16, 1))
    assert np.allclose(kernels.resize(ramp, (16, 16)), ramp)
    assert np.allclose(kernels.resize(ramp, (8, 8)).mean(), ramp.mean(), atol=0.2)
    assert np.allclose(kernels.sobel(ramp)[1:-1, 1:-1], 8)


def test_morphology():
    m = np.zeros((9, 9), bool)
    m[3:6, 3:6] = True
    m[0, 8] = True
    assert kernels.closed_opened(m).sum() == 9


def test_process_plane_order():
    image = np.arange(64, dtype=np.uint16).reshape(8, 8) * 20
    out = kernels.process_plane(image, reduce=(2, 2), dark=100, shift=2, flip=True, turn=180)
    small = image.reshape(4, 2, 4, 2).max(axis=(1, 3)).astype(int)
    small = np.where(small > 100, small - 100, 0)
    want = np.minimum(np.where((small > 0) & (small < 4), 1, small >> 2), 255)
    assert (out == np.rot90(np.flipud(want), 2)).all() and out.dtype == np.uint8


def test_map_planes(spark):
    a = np.arange(12, dtype=np.uint16).reshape(3, 4)
    rows = [("c", 0, 0, 1, 3, 4, "uint16", bytearray(a.tobytes())), ("c", 0, 0, 2, None, None, "uint16", None)]
    got = {r.z: r for r in kernels.map_planes(spark.createDataFrame(rows, PLANES), lambda p: np.rot90(p)).collect()}
    assert (np.frombuffer(got[1].pixels, np.uint16).reshape(4, 3) == np.rot90(a)).all() and got[2].pixels is None


def test_psf_is_a_symmetric_distribution():
    p = decon.make_psf((5, 7, 7), (1.0, 0.4, 0.4), 0.4, 0.6, 0.1, 0.5, 1.33)
    assert p.shape == (5, 7, 7) and abs(p.sum() - 1) < 1e-9 and np.allclose(p, p[::-1, ::-1, ::-1]) and p.argmax() == p.size // 2
    assert abs(decon.bessel_j0(np.array([2.404825557695773]))[0]) < 1e-9


def test_deconvolution_sharpens(rng):
    truth = np.zeros((16, 16, 16))
    truth[8, 8, 8], truth[4, 10, 6] = 100, 60
    psf = kernels.gaussian_kernel(1.0, 2)
    psf = psf[:, None, None] * psf[None, :, None] * psf[None, None, :]
    blurred = np.maximum(np.fft.irfftn(np.fft.rfftn(truth) * decon.otf(psf, truth.shape), truth.shape, range(3)), 0)
    out = decon.deconvolve(blurred, psf, decon.Plan(rounds=30, classical=True))
    assert out.max() > 3 * blurred.max() and np.unravel_index(out.argmax(), out.shape) == (8, 8, 8)
    inner = decon.deconvolve(blurred, psf, decon.Plan(rounds=2), fourier=False)[3:-3, 3:-3, 3:-3]
    assert np.allclose(inner, decon.deconvolve(blurred, psf, decon.Plan(rounds=2))[3:-3, 3:-3, 3:-3], atol=0.5)


def test_edge_taper(rng):
    x, psf = rng.random((20, 18, 16)), np.full((5, 5, 5), 1 / 125)
    out = decon.edge_taper(x, psf)
    assert np.allclose(out[8:13, 8:11, 8:9], x[8:13, 8:11, 8:9]) and np.allclose(out[0], kernels.convolve(x, psf)[0]) and np.allclose(decon.edge_taper(np.ones((8, 8, 8)), psf), 1)


def test_blocks_give_what_the_whole_does(spark, rng):
    cube = rng.random((6, 9, 10))
    rows = [(int(z), int(y), int(x), float(v)) for (z, y, x), v in np.ndenumerate(cube)]
    px = spark.createDataFrame(rows, "z int, y int, x int, v double")
    box = np.full((3, 3, 3), 1 / 27)
    got = decon.by_block(px, {"z": 6, "y": 9, "x": 10}, {"z": 4, "y": 4, "x": 5}, {"z": 1, "y": 1, "x": 1}, lambda b: kernels.convolve(b, box)).collect()
    out = np.full(cube.shape, np.nan)
    for r in got:
        out[r.z, r.y, r.x] = r.v
    want = kernels.convolve(np.pad(cube, 1, mode="symmetric"), box)[1:-1, 1:-1, 1:-1]
    assert np.allclose(out, want)


def test_block_shapes():
    assert decon.fast_length(11) == 12 and decon.fast_length(121) == 125
    x, y, z = decon.block_shape((100, 100, 50), (4, 4, 4), 200_000)
    assert x == y and decon.fast_length(x + 8) ** 2 * decon.fast_length(z + 8) <= 200_000
