"""Exact spectra of symmetric integer matrices without negative eigenvalues.

The characteristic polynomial is found modulo many primes and put together by Chinese remainders. All its roots are
real, so that the sign changes among the coefficients of p(x + a) count the roots beyond ``a`` exactly, with
multiplicity: bisection with that count isolates the largest roots. Simple roots are refined by exact signs, and
eigenvectors come from inverse iteration in long decimals. Sizes depend on the dimension alone, not on any table.
"""

from __future__ import annotations

from decimal import Decimal, localcontext

import numpy as np

#: Digits carried in inverse iteration.
DIGITS = 90
#: Roots closer than this share of the trace (in bits) count as one root of higher multiplicity.
SAME_BITS = 120
#: Bits to which simple roots are known, as a share of the trace.
ROOT_BITS = 190


# --- the polynomial -----------------------------------------------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test with bases that decide for all numbers below 2**32."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(matrix: list[list[int]]) -> list[int]:
    """Primes below 2**31 whose product exceeds twice every coefficient of the characteristic polynomial.

    Eigenvalues aren't negative, so the coefficients' sizes add up to the product of 1 + eigenvalue, which is at most
    (1 + trace / d) ** d.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bits = 2 + d * (1 + trace // d + 1).bit_length()
    found, candidate = [], 2**31 - 1
    while len(found) * 30 < bits:
        if _is_prime(candidate):
            found.append(candidate)
        candidate -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of det(x - matrix) modulo a prime below 2**31, by Hessenberg reduction."""
    h = matrix.copy() % p
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factors = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factors[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factors % p).sum(axis=1)) % p
    # Polynomials of the leading blocks: row k holds that of the first k rows and columns.
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(d):
        weights, chain = np.zeros(k + 1, np.int64), 1
        weights[k] = h[k, k]
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            weights[i] = int(h[i, k]) * chain % p
        spent = (weights[:, None] * blocks[: k + 1] % p).sum(axis=0) % p
        blocks[k + 1, 1:] = blocks[k, :-1]
        blocks[k + 1] = (blocks[k + 1] - spent) % p
    return blocks[d]


def from_residues(residues: dict[int, list[int]]) -> list[int]:
    """The signed integers with the given residues modulo each prime (Chinese remainders)."""
    modulus = 1
    for p in residues:
        modulus *= p
    length = len(next(iter(residues.values())))
    total = [0] * length
    for p, values in residues.items():
        others = modulus // p
        unit = others * pow(others, -1, p)
        for i, value in enumerate(values):
            total[i] += unit * int(value)
    reduced = [t % modulus for t in total]
    return [t - modulus if 2 * t > modulus else t for t in reduced]


# --- its roots ----------------------------------------------------------------------------------------------------


def _shifted(poly: list[int], a: int) -> list[int]:
    """Coefficients of p(x + a)."""
    out = list(poly)
    if a:
        for i in range(len(out) - 1):
            for j in range(len(out) - 2, i - 1, -1):
                out[j] += a * out[j + 1]
    return out


def roots_beyond(poly: list[int], a: int) -> int:
    """How many roots of a polynomial with real roots only are greater than ``a``, multiple ones counted as often."""
    signs = [c > 0 for c in _shifted(poly, a) if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2**bits times as large."""
    d = len(poly) - 1
    return [c << bits * (d - k) for k, c in enumerate(poly)]


def _sign_at(poly: list[int], numerator: int, bits: int) -> int:
    """Sign of p(numerator / 2**bits), exactly."""
    total, d = 0, len(poly) - 1
    for k in range(d, -1, -1):
        total = total * numerator + (poly[k] << bits * (d - k))
    return (total > 0) - (total < 0)


def largest_roots(poly: list[int], count: int, trace: int) -> list[tuple[int, int, int]]:
    """``(numerator, bits, multiplicity)`` of the largest positive roots, falling; together ``count`` or all there are.

    A root lies at numerator / 2**bits, off by at most a share of 2**-ROOT_BITS of the trace; roots closer than
    2**-SAME_BITS of it are given as one.
    """
    zeros = next(i for i, c in enumerate(poly) if c)
    poly = poly[zeros:]
    size = trace.bit_length()
    found, held = [], 0
    # Intervals (low, high] at a scale of 2**bits with a known number of roots, the highest last.
    open_parts = [(0, trace + 1, 0, len(poly) - 1)] if len(poly) > 1 else []
    while open_parts and held < count:
        low, high, bits, inside = open_parts.pop()
        if inside == 1:
            found.append((*_refined(poly, low, high, bits, max(0, ROOT_BITS - size)), 1))
            held += 1
        elif high - low > 1:
            middle = (low + high) // 2
            upper = roots_beyond(_scaled(poly, bits), middle) - roots_beyond(_scaled(poly, bits), high)
            open_parts += [part for part in ((low, middle, bits, inside - upper), (middle, high, bits, upper)) if part[3]]
        elif bits + size < SAME_BITS:
            open_parts.append((low << 32, high << 32, bits + 32, inside))
        else:
            found.append((low + high, bits + 1, inside))
            held += inside
    return found


def _refined(poly: list[int], low: int, high: int, bits: int, wanted: int) -> tuple[int, int]:
    """The only, simple root in (low, high] at 2**bits, to at least ``wanted`` bits behind the point."""
    side = _sign_at(poly, high, bits)
    if side == 0:
        return high, bits
    while high - low > 1 or bits < wanted:
        if high - low == 1:
            step = max(1, min(16, wanted - bits))
            low, high, bits = low << step, high << step, bits + step
        middle = (low + high) // 2
        sign = _sign_at(poly, middle, bits)
        if sign == 0:
            return middle, bits
        low, high = (low, middle) if sign == side else (middle, high)
    return low + high, bits + 1


# --- its vectors --------------------------------------------------------------------------------------------------


def eigenvectors(matrix: list[list[int]], roots: list[tuple[int, int, int]]) -> list[tuple[Decimal, list[Decimal]]]:
    """``(eigenvalue, unit vector)`` for every root as often as its multiplicity; vectors of one root are orthogonal.

    Inverse iteration: the matrix less the root is all but singular, so that a solution of any right side lies in the
    null space up to the root's error over its distance to the next one. The largest component is positive.
    """
    d = len(matrix)
    out = []
    with localcontext() as context:
        context.prec = DIGITS
        whole = np.array([[Decimal(v) for v in row] for row in matrix], dtype=object)
        least = sum((abs(whole[i, i]) for i in range(d)), Decimal(1)) * Decimal(10) ** -(DIGITS - 5)
        for numerator, bits, copies in roots:
            root = Decimal(numerator) / Decimal(2**bits)
            shifted = whole.copy()
            for i in range(d):
                shifted[i, i] -= root
            lower, order = _decomposed(shifted, least)
            own: list[np.ndarray] = []
            for copy in range(copies):
                vector = np.array([Decimal((i * 7919 + copy * 104729 + i * i * copy) % 1009 + 1) for i in range(d)], dtype=object)
                for _ in range(3):
                    vector = _solved(lower, order, vector)
                    for _ in range(2):
                        for other in own:
                            vector = vector - other * (other * vector).sum()
                        vector = vector / (vector * vector).sum().sqrt()
                own.append(vector)
            for vector in own:
                lead = max(range(d), key=lambda i: abs(vector[i]))
                out.append((root, list(vector if vector[lead] > 0 else -vector)))
    return out


def _decomposed(a: np.ndarray, least: Decimal) -> tuple[np.ndarray, np.ndarray]:
    """LU decomposition in place with row exchanges; a pivot of zero is replaced by ``least``."""
    d = len(a)
    order = np.arange(d)
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
        if abs(a[k, k]) < least:
            a[k, k] = least
        if k + 1 < d:
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - a[k + 1 :, k][:, None] * a[k, k + 1 :][None, :]
    return a, order


def _solved(lu: np.ndarray, order: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = right[order].copy()
    for k in range(1, len(x)):
        x[k] -= (lu[k, :k] * x[:k]).sum()
    for k in range(len(x) - 1, -1, -1):
        if k + 1 < len(x):
            x[k] -= (lu[k, k + 1 :] * x[k + 1 :]).sum()
        x[k] = x[k] / lu[k, k]
    return x
