"""Leading eigenpairs of an integer covariance, from its exact characteristic polynomial.

The polynomial of a symmetric integer matrix is found modulo many primes: Hessenberg form by
similarity, then the recurrence of its leading minors; Chinese remaindering joins the residues,
as many as a bound on the coefficients asks for. Every prime is on its own, so Spark runs them
as rows. All roots are real, and so, by Descartes' rule, the sign changes of the
polynomial shifted to a are exactly the number of roots above a, multiples counted. Halving
intervals by that count isolates the roots; signs of the square-free value, or that
count, narrow them to DIGITS digits. A root's null space comes by inverse iteration in
decimal arithmetic of twice the digits, so roots need not be well apart; roots that agree in
all DIGITS digits count as one of that multiplicity and share an orthonormal basis.
"""

from __future__ import annotations

import decimal
from decimal import Decimal

import numpy as np

#: Primes lie below 2^31, so that products of residues fit in 64 bits.
PRIME_BELOW = 2**31
#: Decimal digits to which roots are known.
DIGITS = 60


def _is_prime(n: int) -> bool:
    """Miller-Rabin, exact below 3.4e14 with these bases."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7, 11, 13, 17)):
        return n in (2, 3, 5, 7, 11, 13, 17)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7, 11, 13, 17):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest primes below PRIME_BELOW whose product is over ``bound``."""
    found, product, n = [], 1, PRIME_BELOW - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def coefficient_bound(matrix: list[list[int]]) -> int:
    """Twice what no coefficient exceeds: elementary symmetric means are at most powers of the mean."""
    size = len(matrix)
    mean = sum(matrix[i][i] for i in range(size)) // max(1, size) + 1
    return 2 * max((_choose(size, k) * mean**k for k in range(size + 1)), default=1) + 2


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def polynomial_modulo(matrix: list[list[int]], prime: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo a prime, constant first."""
    size = len(matrix)
    h = np.array([[x % prime for x in row] for row in matrix], np.int64).reshape(size, size)
    for k in range(size - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, prime) % prime
        # Rows below lose a multiple of the pivot's row; its column gains what they lost.
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % prime) % prime
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % prime).sum(axis=1)) % prime
    minors = [np.zeros(size + 1, np.int64)]
    minors[0][0] = 1
    for k in range(size):
        p = np.roll(minors[k], 1)
        p = (p - int(h[k, k]) * minors[k]) % prime
        along = 1
        for i in range(k - 1, -1, -1):
            along = along * int(h[i + 1, i]) % prime
            if along == 0:
                break
            p = (p - int(h[i, k]) * along % prime * minors[i]) % prime
        minors.append(p)
    return minors[size]


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """Whole coefficients, negative ones included, from those modulo each prime."""
    product, values = 1, [0] * len(residues[0][1])
    for prime, rest in residues:
        inverse = pow(product % prime, -1, prime)
        values = [v + product * ((r - v) * inverse % prime) for v, r in zip(values, rest)]
        product *= prime
    return [v - product if 2 * v > product else v for v in values]


def _shifted(p: list[int], by: int) -> list[int]:
    """Coefficients of p(x + by)."""
    out = list(p)
    for i in range(len(out) - 1):
        for j in range(len(out) - 2, i - 1, -1):
            out[j] += by * out[j + 1]
    return out


def _changes(p: list[int]) -> int:
    signs = [c > 0 for c in p if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


class Roots:
    """Roots of a polynomial whose roots are all real, scaled by 2^bits to whole numbers."""

    def __init__(self, p: list[int], bits: int) -> None:
        size = len(p) - 1
        # q(y) = 2^(bits * size) p(y / 2^bits) has the roots times 2^bits.
        self.q = [c << (bits * (size - k)) for k, c in enumerate(p)]
        self.bits = bits
        self._known: dict[int, int] = {}

    def above(self, y: int) -> int:
        """How many roots are larger than y, multiples counted."""
        if y not in self._known:
            self._known[y] = _changes(_shifted(self.q, y))
        return self._known[y]

    def _sign(self, y: int) -> int:
        value = 0
        for c in reversed(self.q):
            value = value * y + c
        return (value > 0) - (value < 0)

    def largest(self, count: int, top: int, digits: int) -> list[tuple[int, int]]:
        """(root, multiplicity) of the ``count`` largest, falling; ``top`` is no less than any of them."""
        found: list[tuple[int, int]] = []
        stack = [(0, top)]  # intervals (low, high], the highest last
        taken = 0
        while stack and taken < count:
            low, high = stack.pop()
            held = self.above(low) - self.above(high)
            if not held:
                continue
            if held == 1:
                found.append((self._narrow(low, high, digits), 1))
                taken += 1
            elif (high - low) * 10**digits <= high or high - low <= 1:
                found.append((high, held))
                taken += held
            else:
                middle = (low + high) // 2
                stack += [(low, middle), (middle, high)]
        return found

    def _narrow(self, low: int, high: int, digits: int) -> int:
        """The one root in (low, high], to so many digits, by the sign of the value."""
        at_high = self._sign(high)
        if at_high == 0:
            return high
        while high - low > 1 and (high - low) * 10**digits > high:
            middle = (low + high) // 2
            sign = self._sign(middle)
            if sign == 0:
                return middle
            if sign == at_high:
                high = middle
            else:
                low = middle
        return (low + high + 1) // 2


def leading_roots(p: list[int], count: int, trace: int, digits: int = DIGITS) -> list[tuple[Decimal, int]]:
    """The largest positive roots with multiplicities, at least ``count`` in all if there are as many."""
    zeros = next((k for k, c in enumerate(p) if c), len(p))
    q = p[zeros:]
    if len(q) < 2:
        return []
    size = len(q) - 1
    # No root is below |constant| / trace^(size - 1), so the loop ends.
    bits = int(digits * 3.33) + 8
    while True:
        found = Roots(q, bits).largest(min(count, size), trace << bits, digits)
        least = min(root for root, _ in found)
        if least >= 10**digits:
            break
        bits += max(64, int(digits * 3.33) + 8 - least.bit_length())
    with decimal.localcontext() as context:
        context.prec = 2 * digits + 20
        return [(Decimal(r) / Decimal(1 << bits), m) for r, m in found]


def null_space(matrix: list[list[int]], root: Decimal, multiplicity: int, digits: int = DIGITS) -> np.ndarray:
    """Orthonormal columns that span what ``matrix`` multiplies by ``root``."""
    size = len(matrix)
    with decimal.localcontext() as context:
        context.prec = 2 * digits + 20
        # A shift off the root by less than its last digit keeps the system regular.
        shift = root * (1 + Decimal(10) ** -(digits + digits // 2))
        a = np.array([[Decimal(x) for x in row] for row in matrix], object).reshape(size, size)
        a[np.arange(size), np.arange(size)] -= shift
        order = np.arange(size)
        for k in range(size):
            pivot = k + int(np.argmax([abs(x) for x in a[k:, k]]))
            if a[pivot, k] == 0:
                a[pivot, k] = root * Decimal(10) ** -(2 * digits)
            if pivot != k:
                a[[k, pivot]] = a[[pivot, k]]
                order[[k, pivot]] = order[[pivot, k]]
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[None, k, k + 1 :]
        columns: list[np.ndarray] = []
        # Starts with no direction of their own: a fixed stream of signs and sizes.
        draws = np.random.default_rng(size).integers(1, 1 << 20, (multiplicity, size)) * 2 - (1 << 20) - 1
        for start in draws:
            v = np.array([Decimal(int(x)) for x in start], object)
            for _ in range(3):
                v = v[order]
                for k in range(1, size):
                    v[k] -= a[k, :k] @ v[:k]
                for k in range(size - 1, -1, -1):
                    v[k] = (v[k] - (a[k, k + 1 :] @ v[k + 1 :] if k + 1 < size else 0)) / a[k, k]
                v = v / max(abs(x) for x in v)
                for other in columns:
                    v = v - other * (other @ v)
                v = v / (v @ v).sqrt()
            columns.append(v)
    return np.array([[float(x) for x in v] for v in columns]).T.reshape(size, multiplicity)
