"""Sets of five-word shingles of texts, as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
#: Lower case for A-Z, one blank for all ASCII white space; other bytes stay.
_BYTES = bytes(32 if i in (32, 9, 10, 11, 12, 13) else i + 32 if 65 <= i <= 90 else i for i in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_INVERSE = _U(_inverse(int(_BASE)))


def shingle_sets(texts: list[str | bytes | None]) -> list[np.ndarray]:
    """For each text its distinct shingles, sorted; the whole sequence of fewer than WIDTH words is one."""
    coded = (t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass") for t in texts)
    data = b" ".join(t.translate(_BYTES).replace(b"\0", b"\1\1") + b" \0" for t in coded)
    raw = np.frombuffer(b" " + data + b" ", dtype=np.uint8)
    inside = raw != 32
    start, end = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1, np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    power = np.full(len(raw), _BASE)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(raw.astype(np.uint64) * power, dtype=np.uint64)))
    back = np.full(len(raw), _INVERSE)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    word = mixed((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    # a zero byte, which no text holds here, stands alone after each text
    stops = np.flatnonzero(raw[start] == 0)
    first = np.concatenate(([0], stops[:-1] + 1))
    many = np.zeros(max(0, len(word) - WIDTH + 1), dtype=np.uint64)
    for i in range(WIDTH):
        many = many * _BASE + word[i : i + len(many)]
    many = mixed(many)
    out = []
    for a, b in zip(first, stops, strict=True):
        n = b - a
        if n >= WIDTH:
            out.append(np.unique(many[a : b - WIDTH + 1]))
        elif n:
            whole = np.array([n], dtype=np.uint64)
            for w in word[a:b]:
                whole = mixed(whole * _BASE + w)
            out.append(whole)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits by which equal sets are known, as two signed longs."""
    a, b = mixed(shingles + _U(1)), mixed(shingles * _BASE + _U(2))
    return int(a.sum(dtype=np.uint64).astype(np.int64)), int(b.sum(dtype=np.uint64).astype(np.int64))
