"""SHA-256 over many messages at once, with states that can be stored and resumed.

A state is what the hash function holds after whole blocks of 64 bytes: eight 32-bit words. Arrays hold
one message per column: states and digests are ``(8, n)``, blocks ``(16, n)``, all ``uint32``.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

DIGEST_BYTES = 32


def _cube_root(number: int) -> int:
    """The largest whole number whose cube is not above ``number``."""
    low, high = 0, 1 << (number.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= number else (low, middle - 1)
    return low


_PRIMES = [p for p in range(2, 312) if all(p % d for d in range(2, isqrt(p) + 1))]
# The first 32 bits of the fractional parts of square roots and cube roots of primes.
START = np.array([[isqrt(p << 64) & 0xFFFFFFFF] for p in _PRIMES[:8]], np.uint32)
_ROUNDS = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _PRIMES], np.uint32)
# Four hexadecimal digits of every 16-bit number, as one word of text.
_HEX = np.frombuffer("".join(f"{i:04x}" for i in range(1 << 16)).encode(), ">u4").astype(np.uint32)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint32(bits)) | (x << np.uint32(32 - bits))


def resumed(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states after one more block each."""
    words = list(blocks)
    a, b, c, d, e, f, g, h = states
    for i in range(64):
        if i > 15:
            x, y = words[i - 15], words[i - 2]
            x = _turned(x, 7) ^ _turned(x, 18) ^ (x >> np.uint32(3))
            y = _turned(y, 17) ^ _turned(y, 19) ^ (y >> np.uint32(10))
            words.append(words[i - 16] + x + words[i - 7] + y)
        chosen = g ^ (e & (f ^ g))
        first = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + chosen + _ROUNDS[i] + words[i]
        second = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h])


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """The lowercase hexadecimal texts of digests; one fills a block."""
    blocks = np.empty((16, digests.shape[1]), np.uint32)
    blocks[0::2], blocks[1::2] = _HEX[digests >> np.uint32(16)], _HEX[digests & np.uint32(0xFFFF)]
    return blocks


def finished(states: np.ndarray, blocks_before: np.ndarray) -> np.ndarray:
    """The digests of messages that end after ``blocks_before`` whole blocks."""
    last = np.zeros((16, states.shape[1]), np.uint32)
    last[0], last[15] = 1 << 31, blocks_before * 512
    return resumed(states, last)


def to_bytes(digests: np.ndarray) -> bytes:
    """One digest or state after another."""
    return np.ascontiguousarray(digests.T, ">u4").tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, ">u4").reshape(-1, 8).T.astype(np.uint32)
