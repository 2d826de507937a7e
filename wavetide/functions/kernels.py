"""NumPy kernels over batches of windows: one window per row unless said otherwise."""

from __future__ import annotations

import functools

import numpy as np


def detrended(x: np.ndarray) -> np.ndarray:
    """Each row without its mean and its least-squares line."""
    n = x.shape[-1]
    y = x - x.mean(-1, keepdims=True)
    if n < 2:
        return y
    t = np.arange(n) - (n - 1) / 2
    return y - (y @ t / (t @ t))[..., None] * t


def tapered(x: np.ndarray, rate: float, share: float = 0.05, longest_s: float = 10.0) -> np.ndarray:
    """Hann taper over ``share`` of each end, ``longest_s`` seconds at most."""
    n = x.shape[-1]
    m = min(int(share * n), int(longest_s * rate), n // 2)
    if m < 1:
        return x
    ramp = 0.5 * (1 - np.cos(np.pi * np.arange(m) / m))
    gain = np.ones(n)
    gain[:m], gain[n - m :] = ramp, ramp[::-1]
    return x * gain


def finite_or_zero(x: np.ndarray) -> np.ndarray:
    return np.where(np.isfinite(x), x, 0.0)


@functools.lru_cache(maxsize=64)
def butterworth(rate: float, low: float | None, high: float | None, order: int = 4) -> np.ndarray:
    """Second-order sections (b0 b1 b2 a1 a2 per row) of a Butterworth filter; a side without corner is open.

    Poles of the analogue prototype are moved to the wanted band and mapped to the z-plane by the bilinear transform.
    """
    warp = lambda f: 2 * rate * np.tan(np.pi * f / rate)
    poles = np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))
    if low and high:
        a, b = warp(low), warp(high)
        half, centre = poles * (b - a) / 2, a * b
        poles = np.concatenate([half + np.sqrt(half**2 - centre), half - np.sqrt(half**2 - centre)])
        zeros, at = np.repeat([1.0, -1.0], order), np.sqrt(low * high)
    elif low:
        poles, zeros, at = warp(low) / poles, np.full(order, 1.0), rate / 2
    elif high:
        poles, zeros, at = warp(high) * poles, np.full(order, -1.0), 0.0
    else:
        return np.zeros((0, 5))
    z = (2 * rate + poles) / (2 * rate - poles)
    z = np.concatenate([z[z.imag > 1e-14], np.sort(z[np.abs(z.imag) <= 1e-14].real)])
    pairs, k = [], 0
    while k < len(z):
        real = abs(z[k].imag) <= 1e-14
        pairs.append((z[k], (z[k + 1] if k + 1 < len(z) else 0.0) if real else z[k].conj()))
        k += 2 if real else 1
    ups, downs = list(zeros[zeros > 0]), list(zeros[zeros < 0])
    if low and high:
        centre_hz = np.arctan(np.sqrt(warp(low) * warp(high)) / (2 * rate)) * rate / np.pi
        at = centre_hz
    sections = []
    for p, q in pairs:
        zz = [(ups or downs).pop(), (downs or ups).pop()] if len(ups) + len(downs) > 1 else [(ups or downs).pop(), 0.0]
        sections.append([1.0, -(zz[0] + zz[1]), zz[0] * zz[1], -(p + q).real, (p * q).real])
    sos = np.array(sections)
    e = np.exp(-2j * np.pi * at / rate * np.arange(3))
    gain = np.prod(np.abs(sos[:, :3] @ e) / np.abs(np.column_stack([np.ones(len(sos)), sos[:, 3:]]) @ e))
    sos[0, :3] /= gain
    return sos


def filtered(x: np.ndarray, sos: np.ndarray) -> np.ndarray:
    """Causal filter of each row from rest, as a convolution with as much of the impulse response as the rows are long."""
    n = x.shape[-1]
    if not len(sos) or not n:
        return np.array(x, np.float64)
    room = 1 << (n - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(x, 2 * room) * _response(np.asarray(sos, np.float64).tobytes(), room), 2 * room)[..., :n]


@functools.lru_cache(maxsize=32)
def _response(sections: bytes, n: int) -> np.ndarray:
    """Spectrum (of 2 n samples) of the first ``n`` samples of the impulse response of second-order sections."""
    y = [1.0] + [0.0] * (n - 1)
    for b0, b1, b2, a1, a2 in np.frombuffer(sections).reshape(-1, 5).tolist():
        s1 = s2 = 0.0
        for t, v in enumerate(y):
            y[t] = w = b0 * v + s1
            s1, s2 = b1 * v - a1 * w + s2, b2 * v - a2 * w
    return np.fft.rfft(y, 2 * n)


#: The spline's moments answer a kink at one knot with SPLINE_DECAY ** distance; beyond SPLINE_REACH knots that is below rounding.
SPLINE_DECAY, SPLINE_REACH = 3**0.5 - 2, 30


def _moments(x: np.ndarray) -> np.ndarray:
    """Second derivatives at even knots of the cubic spline through each row whose third derivative is continuous at the
    second and last but one knot.

    Inner knots obey m[k - 1] + 4 m[k] + m[k + 1] = 6 (x[k - 1] - 2 x[k] + x[k + 1]). One solution of that is the right side
    summed with decaying weights; a decaying term from each end, set by its condition, makes it the spline's.
    """
    n, z = x.shape[-1], SPLINE_DECAY
    kink = np.zeros(x.shape)
    kink[..., 1:-1] = 6 * np.diff(x, 2, axis=-1)
    m = kink.copy()
    for d in range(1, min(SPLINE_REACH, n - 1) + 1):
        m[..., d:] += z**d * kink[..., :-d]
        m[..., :-d] += z**d * kink[..., d:]
    m /= 12**0.5
    bend = lambda a, b, c: (a - 2 * b + c)[..., None] / (1 - z) ** 2
    left, right = bend(m[..., 0], m[..., 1], m[..., 2]), bend(m[..., -1], m[..., -2], m[..., -3])
    far = z ** (n - 3)
    reach = z ** np.arange(n, dtype=np.float64)
    return m - (left - far * right) / (1 - far * far) * reach - (right - far * left) / (1 - far * far) * reach[::-1]


def interpolated(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cubic spline through the samples of each row (knots 0, 1, ...) at the places ``at``."""
    n = x.shape[-1]
    if n < 4:
        return np.stack([np.interp(at, np.arange(n), r) for r in x.reshape(-1, n)]).reshape(*x.shape[:-1], len(at))
    m = _moments(x)
    k = np.clip(np.floor(at).astype(int), 0, n - 2)
    u = at - k
    v = 1 - u
    return v * x[..., k] + u * x[..., k + 1] + ((v**3 - v) * m[..., k] + (u**3 - u) * m[..., k + 1]) / 6


def sliding_moments(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population variance of all stretches of ``size`` samples, by prefix sums about the row's mean."""
    centre = x.mean(-1, keepdims=True)
    y = x - centre
    mean = _window_sums(y, size) / size
    return mean + centre, np.maximum(_window_sums(y * y, size) / size - mean * mean, 0.0)


def _window_sums(z: np.ndarray, size: int) -> np.ndarray:
    total = np.concatenate([np.zeros((*z.shape[:-1], 1)), np.cumsum(z, -1)], -1)
    return total[..., size:] - total[..., :-size]


def correlation(data: np.ndarray, template: np.ndarray) -> np.ndarray:
    """Normalised correlation (rows, lags) of templates with sliding stretches, both (rows, channels, samples).

    Each channel is normalised on its own, what is not finite becomes 0, then the channels' mean is taken. The first lag
    is left out, so there are data - template lags and lag 0 is the stretch that starts at sample 1.
    """
    size, n = template.shape[-1], data.shape[-1]
    zero = template - template.mean(-1, keepdims=True)
    length = 1 << int(n + size - 1).bit_length()
    spectrum = np.fft.rfft(data - data.mean(-1, keepdims=True), length) * np.conj(np.fft.rfft(zero, length))
    raw = np.fft.irfft(spectrum, length)[..., 1 : n - size + 1]
    _, var = sliding_moments(data, size)
    scale = np.maximum(np.square(data).mean(-1, keepdims=True), 1e-300)
    std = np.sqrt(np.where(var <= 1e-12 * scale, 0.0, var))[..., 1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        cc = raw / (size * std * zero.std(-1, keepdims=True))
    return finite_or_zero(cc).mean(1)


def peaks(cc: np.ndarray, separation: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greatest absolute value, its first lag, and how far it stands out: (peak - lower median) / MAD of the absolute
    values more than ``separation`` lags away (NaN if there are none; the MAD is at least float32's epsilon)."""
    size = np.abs(cc)
    lag = size.argmax(1)
    peak = size[np.arange(len(cc)), lag]
    far = np.abs(np.arange(cc.shape[1]) - lag[:, None]) > separation
    n = far.sum(1)
    middle = np.maximum(n - 1, 0) // 2
    pick = lambda x: np.sort(np.where(far, x, np.inf), 1)[np.arange(len(x)), middle]
    median = pick(size)
    with np.errstate(invalid="ignore"):
        mad = pick(np.abs(size - np.where(n > 0, median, 0)[:, None]))
        contrast = np.where(n > 0, (peak - median) / np.maximum(mad, np.finfo(np.float32).eps), np.nan)
    return peak, lag, contrast
