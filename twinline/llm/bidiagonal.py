"""Singular values and right singular vectors of a small matrix: Householder bidiagonal form, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
TINY = np.finfo(np.float64).tiny
# Steps of dqds per singular value before it counts as not converging.
STEPS = 60
# Eigenvalues closer than this, relatively, get their vectors made orthogonal to each other.
CLOSE = 1e-5


def reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """``v, tau, alpha`` with ``(I - tau v v') x = alpha e1``."""
    scale = np.abs(x).max(initial=0)
    v = np.zeros_like(x)
    v[:1] = 1
    if scale == 0:
        return v, 0.0, 0.0
    y = x / scale
    norm = np.sqrt(y @ y)
    if norm == abs(y[0]):
        return v, 0.0, float(x[0])
    alpha = -np.copysign(norm, y[0])
    v = y.copy()
    v[0] -= alpha
    tau = float(-v[0] / alpha)
    return v / v[0], tau, float(alpha * scale)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal ``a``, superdiagonal ``b`` and orthogonal ``right`` with ``r = left @ B @ right.T`` for a square ``r``."""
    work = np.array(r, dtype=np.float64)
    n = len(work)
    right = np.eye(n)
    for k in range(n):
        v, tau, _ = reflector(work[k:, k])
        work[k:, k:] -= tau * np.outer(v, v @ work[k:, k:])
        if k + 2 < n:
            v, tau, _ = reflector(work[k, k + 1 :])
            work[k:, k + 1 :] -= tau * np.outer(work[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= tau * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(work).copy(), np.diag(work, 1).copy(), right


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One step: the qd array of ``B B' - shift``, and the smallest ``d`` on the way; negative or NaN where the shift was too large."""
    n = len(q)
    out_q, out_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        out_q[i] = d + e[i]
        ratio = q[i + 1] / out_q[i] if out_q[i] else np.inf if q[i + 1] else 0.0
        out_e[i] = e[i] * ratio if e[i] else 0.0
        d = (d * ratio if d else 0.0) - shift
        least = d if not d >= least else least
    out_q[n - 1] = d
    return out_q, out_e, least


def singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All singular values of a bidiagonal matrix, largest first, each to high relative accuracy.

    Squares form a qd array; differential steps with shifts that keep every entry positive let the last diagonal entry
    converge to the smallest square less the shifts so far. Blocks between entries that became negligible go on apart.
    """
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if scale == 0:
        return np.zeros(len(a))
    squares = []
    blocks = [((a / scale) ** 2, (b / scale) ** 2, 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        stay = 0
        while len(q):
            n = len(q)
            cuts = np.flatnonzero(e <= EPS**2 * (sigma + np.minimum(q[:-1], q[1:])))
            if len(cuts):
                k = int(cuts[-1]) + 1
                if k < n - 1:
                    blocks.append((q[:k].copy(), e[: k - 1].copy(), sigma))
                    q, e, stay = q[k:], e[k:], 0
                    continue
                squares.append(sigma + q[-1])
                q, e, stay = q[:-1], e[:-1], 0
                continue
            if n == 1:
                squares.append(sigma + q[0])
                break
            stay += 1
            if stay > STEPS * n:
                raise ArithmeticError("dqds did not converge")
            shift = _shift(q, e)
            new_q, new_e, least = _dqds(q, e, shift)
            for _ in range(8):
                if least >= 0 and np.isfinite(new_q).all() and np.isfinite(new_e).all():
                    break
                shift = max(0.0, shift + least) / 2 if least > -shift and np.isfinite(least) else shift / 8
                new_q, new_e, least = _dqds(q, e, shift)
            else:
                shift = 0.0
                new_q, new_e, least = _dqds(q, e, shift)
            q, e, sigma = new_q, new_e, sigma + shift
    return np.sort(np.sqrt(np.maximum(squares, 0)))[::-1] * scale


def _shift(q: np.ndarray, e: np.ndarray) -> float:
    """A lower bound of the smallest square: of the last two rows, kept below Gershgorin's bound of the whole array."""
    total = q[-2] + e[-1] + q[-1]
    gap = total * total - 4 * q[-2] * q[-1]
    small = 2 * q[-2] * q[-1] / (total + np.sqrt(max(gap, 0.0)))
    coupling = np.sqrt(q[:-1] * e)
    middle = q + np.append(e, 0.0)
    discs = middle - np.append(coupling, 0.0) - np.append(0.0, coupling)
    bound = float(discs.min())
    return max(bound, 0.0) if 0 < bound else max(0.0, 0.98 * small * (1 - np.sqrt(min(1.0, e[-1] / max(total, TINY)))))


def twisted_vector(q: np.ndarray, e: np.ndarray, square: float) -> tuple[np.ndarray, float, float]:
    """Eigenvector of ``B'B`` (qd array ``q``, ``e``) for an eigenvalue, its residual norm, and the correction of the eigenvalue.

    The stationary transform factors ``B'B - square`` from the top, the progressive one from the bottom; they are joined
    where the pivot that remains is smallest, and the vector follows from there both ways by multiplications alone.
    """
    n = len(q)
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    tiny = TINY / EPS
    s[0] = -square
    for i in range(n - 1):
        pivot = s[i] + q[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        down[i] = np.sqrt(q[i] * e[i]) / pivot
        s[i + 1] = e[i] * (s[i] / pivot) - square if np.isfinite(s[i]) else e[i] - square
    p[n - 1] = q[n - 1] - square
    for i in range(n - 2, -1, -1):
        pivot = e[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        up[i] = np.sqrt(q[i] * e[i]) / pivot
        p[i] = q[i] * (p[i + 1] / pivot) - square
    gamma = s + p + square
    twist = int(np.abs(gamma).argmin())
    z = np.zeros(n)
    z[twist] = 1
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    norm = z @ z
    return z / np.sqrt(norm), abs(gamma[twist]) / np.sqrt(norm), gamma[twist] / norm


def _solved(q: np.ndarray, e: np.ndarray, square: float, v: np.ndarray) -> np.ndarray:
    """A step of inverse iteration with ``B'B - square``, by elimination with row exchanges."""
    n = len(q)
    main = q + np.append(0.0, e) - square
    main = np.where(np.abs(main) > 0, main, EPS * square + TINY)
    off = np.sqrt(q[:-1] * e)
    low, diag, high, far, x = off.copy(), main.copy(), off.copy(), np.zeros(max(n - 2, 0)), v.copy()
    least = EPS * (square + np.abs(main).max(initial=0)) + TINY
    for i in range(n - 1):
        if abs(low[i]) > abs(diag[i]):
            diag[i], low[i] = low[i], diag[i]
            high[i], diag[i + 1] = diag[i + 1], high[i]
            if i < n - 2:
                far[i], high[i + 1] = high[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(diag[i]) < least:
            diag[i] = least
        f = low[i] / diag[i]
        diag[i + 1] -= f * high[i]
        if i < n - 2:
            high[i + 1] -= f * far[i]
        x[i + 1] -= f * x[i]
    for i in range(n - 1, -1, -1):
        if abs(diag[i]) < least:
            diag[i] = least
        rest = x[i] - (high[i] * x[i + 1] if i < n - 1 else 0) - (far[i] * x[i + 2] if i < n - 2 else 0)
        x[i] = rest / diag[i]
    return x / np.abs(x).max()


def right_vectors(a: np.ndarray, b: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest singular values of a bidiagonal matrix and their right vectors, as columns."""
    n = len(a)
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if scale == 0:
        return np.zeros(count), np.eye(n)[:, :count]
    a, b = a / scale, b / scale
    # entries that do not matter to any singular value split the matrix: vectors of one part are zero on the others
    b = np.where(np.abs(b) <= EPS / 4 * np.minimum(np.abs(a[:-1]), np.abs(a[1:])), 0.0, b)
    found = []
    bounds = [0, *(np.flatnonzero(b == 0) + 1), n]
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        part_a, part_b = a[first:last], b[first : last - 1]
        for value in singular_values(part_a, part_b):
            found.append((value, first, last))
    found.sort(key=lambda x: (-x[0], x[1]))
    out = np.zeros((n, count))
    values = np.zeros(count)
    rng = np.random.default_rng(0)
    for k, (value, first, last) in enumerate(found[:count]):
        part_a, part_b = a[first:last], b[first : last - 1]
        # signs of B only change signs of the vector
        q, e = part_a**2, part_b**2
        square = value * value
        z, residual, step = twisted_vector(q, e, square)
        for _ in range(3):
            if not np.isfinite(z).all() or abs(step) <= 2 * EPS * square or abs(step) > 1e-8 * square:
                break
            again = twisted_vector(q, e, square + step)
            if not again[1] < residual:
                break
            square += step
            z, residual, step = again
        near = [j for j in range(k) if found[j][1] == first and values[j] - value <= CLOSE * value]
        if near or not np.isfinite(z).all():
            others = _signed(out[first:last, near], part_a, part_b)
            z = z if np.isfinite(z).all() else rng.normal(size=last - first)
            for step_no in range(4):
                z = z - others @ (others.T @ z)
                z = z - others @ (others.T @ z)
                if np.sqrt(z @ z) < 1e-3 and step_no < 3:
                    z = rng.normal(size=last - first)
                    z = z - others @ (others.T @ z)
                z = _solved(q, e, square, z / np.sqrt(z @ z))
            z = z - others @ (others.T @ z)
        z = z / np.sqrt(z @ z)
        out[first:last, k] = _signed(z[:, None], part_a, part_b)[:, 0]
        values[k] = np.sqrt(square)
    return values * scale, out


def _signed(z: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Vectors of the matrix with positive entries as those of the given signs, and back."""
    turns = np.sign(np.where(a[:-1] * b == 0, 1.0, a[:-1] * b))
    return z * np.append(1.0, np.cumprod(turns))[:, None]


def decompose(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``count`` largest singular values of a square matrix, their right vectors as columns, and the sum of all squares."""
    if not len(r):
        return np.zeros(0), np.zeros((0, 0)), 0.0
    a, b, right = bidiagonal(r)
    values, vectors = right_vectors(a, b, min(count, len(r)))
    return values, right @ vectors, float((np.asarray(r) ** 2).sum())
