"""Exact integer matrix products by residues: float32 products modulo small primes, put together again.

An integer is known by its remainders modulo several primes as soon as the
primes' product exceeds the range it lies in. For each prime both matrices are
reduced to symmetric remainders, so small that a float32 product of them, and
the sum over a run of columns, is exact (below 2 to the 24th). The products'
remainders give the digits of a mixed-radix number with digits of either sign
(Chinese remaindering after Garner), whose value is the signed result.
"""

from __future__ import annotations

import numpy as np

#: A float32 holds every whole number up to here.
EXACT = 1 << 24
#: No remainder is larger than this, whatever the number of columns.
LARGEST_PRIME, SMALLEST_PRIME = 1021, 127


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def primes_for(bound: int, columns: int) -> list[int]:
    """Primes whose product tells all numbers of at most ``bound`` in size apart.

    They are the largest ones for which all columns can be summed at once, but
    not below ``SMALLEST_PRIME``; beyond that the columns are cut into runs.
    """
    half = int(((EXACT - 1) / max(1, columns)) ** 0.5)
    prime, product, chosen = min(LARGEST_PRIME, max(SMALLEST_PRIME, 2 * half + 1)), 1, []
    while product <= 2 * bound + 1:
        while not _is_prime(prime):
            prime -= 1
        if prime < 3:
            raise ValueError(f"no primes are left for numbers up to {bound}")
        chosen.append(prime)
        product *= prime
        prime -= 1
    return chosen


def symmetric(x: np.ndarray, prime: int) -> np.ndarray:
    """Remainders between -prime/2 and prime/2."""
    half = prime // 2
    return (x + half) % prime - half


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The matrix modulo each prime, in float32."""
    return [symmetric(matrix, p).astype(np.float32) for p in primes]


def product_modulo(left: np.ndarray, right: np.ndarray, prime: int) -> np.ndarray:
    """``left @ right.T`` modulo the prime, as symmetric remainders."""
    run = (EXACT - 1) // (prime // 2) ** 2
    total = np.zeros((len(left), len(right)), dtype=np.int32)
    for start in range(0, left.shape[1], run):
        part = left[:, start : start + run] @ right[:, start : start + run].T
        total = symmetric(total + part.astype(np.int32), prime)
    return total


def exact_product(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed products of two matrices given by their residues, as 64-bit integers.

    The digits' weights may pass 64 bits; they wrap, and so does the sum, back to the true value.
    """
    digits: list[np.ndarray] = []
    value, weight = 0, 1
    for k, prime in enumerate(primes):
        digit = product_modulo(left[k], right[k], prime).astype(np.int64)
        for earlier, smaller in zip(digits, primes):
            digit = symmetric((digit - earlier) * pow(smaller, -1, prime), prime)
        digits.append(digit)
        value = value + digit * np.uint64(weight % (1 << 64)).astype(np.int64)
        weight *= prime
    return value
