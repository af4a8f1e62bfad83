"""Word shingles as 64-bit hashes, and SetSketch registers over them (numpy).

Words are the runs of ``[^\\x20\\x09-\\x0D]`` after A-Z are lower-cased: exactly
``bytes.lower().split()`` on the UTF-8 text.
"""

from __future__ import annotations

import numpy as np

K = 5
# Sketch parameters: base of the register scale, rate, largest register value.
BASE = 1.02
RATE = 20.0
TOP = 4095

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_CHUNK = 1 << 20


def _finish(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _mixed(n: int, salt: int) -> np.ndarray:
    return _finish(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


# A word's hash is a polynomial over its bytes (random byte values, odd base mod 2^64), then mixed.
_BYTE = _mixed(256, 11)
_IS_WS = np.zeros(256, dtype=bool)
_IS_WS[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    step = np.uint64(base)
    while len(out) < n:
        out = np.concatenate([out, out * step])
        step = step * step
    return out[:n]


_BASE = 0x9FB21C651E98DF25
_POW: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW["up"]) < n:
        size = 1 << max(20, int(n).bit_length())
        with np.errstate(over="ignore"):
            _POW["up"] = _powers(_BASE, size)
            _POW["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _POW["up"], _POW["down"]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of ``data`` (already lower-cased)."""
    buf = np.frombuffer(data, dtype=np.uint8)
    ws = np.ones(len(buf) + 2, dtype=np.int8)
    ws[1:-1] = _IS_WS[buf]
    edge = np.diff(ws)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power_tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=total[1:])
    return start, _finish((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its 5-word shingles.

    A text with fewer words is one shingle; a text without words has none.
    Texts are hashed together in chunks of about a megabyte.
    """
    out: list[np.ndarray] = []
    at = 0
    raw = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
    while at < len(raw):
        to, size = at, 0
        while to < len(raw) and (to == at or size + len(raw[to]) <= _CHUNK):
            size += len(raw[to]) + 1
            to += 1
        out += _chunk_sets(raw[at:to])
        at = to
    return out


def _chunk_sets(raw: list[bytes]) -> list[np.ndarray]:
    start, w = word_hashes(b" ".join(raw))
    begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    first = np.searchsorted(start, begins)
    n = len(w) - K + 1
    if n > 0:
        acc = np.full(n, np.uint64(K), dtype=np.uint64)
        for i in range(K):
            acc = (acc ^ w[i:i + n]) * _MIX[i]
            acc ^= acc >> np.uint64(29)
        acc = _finish(acc)
    out = []
    for i in range(len(raw)):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= K:
            x = acc[a:b - K + 1].copy()
            x.sort()
            if len(x) > 1:
                keep = np.empty(len(x), dtype=bool)
                keep[0] = True
                np.not_equal(x[1:], x[:-1], out=keep[1:])
                x = x[keep]
        elif b > a:
            x = np.full(1, np.uint64(b - a), dtype=np.uint64)
            for j in range(a, b):
                x = _finish((x ^ w[j]) * _MIX[j - a])
        else:
            x = np.empty(0, dtype=np.uint64)
        out.append(x)
    return out


def shingle_set(text: str | None) -> np.ndarray:
    return shingle_sets([text])[0]


def seeds(m: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed odd multipliers and offsets of the ``m`` registers."""
    x = _mixed(2 * m, 23)
    return (x[:m] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (x[m:] >> np.uint64(32)).astype(np.uint32)


def registers(hashes: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set: per register the truncated, exponentially
    spaced minimum ``floor(1 - log_b(min h))`` of hash values h ~ Exp(rate).

    The register is monotone in the minimum, so the minimum of the uniform
    hashes is taken first and moved to the register scale once.  The registers
    of a union are the element-wise maxima.
    """
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.empty(len(mul), dtype=np.uint32)
    if len(x) * len(mul) <= 1 << 16:
        part = mul[:, None] * x[None, :]
        part += add[:, None]
        part.min(axis=1, out=low) if len(x) else low.fill(0xFFFFFFFF)
    else:
        buf = np.empty(len(x), dtype=np.uint32)
        for i in range(len(mul)):
            np.multiply(x, mul[i], out=buf)
            buf += add[i]
            low[i] = buf.min()
    return _to_scale(low)


def _to_scale(low: np.ndarray) -> np.ndarray:
    u = (low.astype(np.float64) + 0.5) / 4294967296.0
    h = -np.log1p(-u) / RATE
    return np.clip(np.floor(1.0 - np.log(h) / np.log(BASE)), 0, TOP).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


# Grid of the joint likelihood; dense where decisions fall.
GRID = np.concatenate([np.linspace(0.0, 0.6, 25), np.linspace(0.61, 1.0, 79)])


def log_likelihood(above: np.ndarray, below: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
                   j: float) -> np.ndarray:
    """Log-likelihood of Jaccard ``j`` given how many registers of A are above,
    below and equal to those of B and the two (exactly known) set sizes."""
    u = n_a / (n_a + n_b)
    v = 1.0 - u
    j = np.minimum(j, np.minimum(u / v, v / u))
    up = np.clip(_p(np.maximum(u - v * j, 0.0)), 1e-9, 1.0)
    down = np.clip(_p(np.maximum(v - u * j, 0.0)), 1e-9, 1.0)
    same = np.clip(1.0 - up - down, 1e-9, 1.0)
    return above * np.log(up) + below * np.log(down) + equal * np.log(same)


def plausible(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: float,
              slack: float) -> np.ndarray:
    """Whether some Jaccard of at least ``least`` is within ``slack`` of the
    largest log-likelihood over all Jaccards."""
    m = regs_a.shape[1]
    above = (regs_a > regs_b).sum(axis=1)
    below = (regs_a < regs_b).sum(axis=1)
    equal = m - above - below
    best = np.full(len(above), -np.inf)
    good = np.full(len(above), -np.inf)
    for j in GRID:
        ll = log_likelihood(above, below, equal, n_a, n_b, j)
        np.maximum(best, ll, out=best)
        if j >= least:
            np.maximum(good, ll, out=good)
    return good >= best - slack


def jaccard_at_least(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """``den * |A & B| >= num * |A | B|`` on sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0 or den * len(a) < num * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    inter = int((b[at] == a).sum())
    return den * inter >= num * (len(a) + len(b) - inter)
