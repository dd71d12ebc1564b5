"""Vectorised helpers over the UTF-8 bytes of many texts at once (numpy, inside Arrow tasks)."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {"up": np.empty(0, np.uint64), "down": np.empty(0, np.uint64)}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in lower-cased text (every byte of a non-ASCII character counts).
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes of words [^\x20\x09-\x0D]+.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)  # changed in place below
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        base = int(_BASE) | 1
        inverse = pow(base, -1, 1 << 64)
        for name, b in (("up", base), ("down", inverse)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] the polynomial hash of data[s:e], shifted by s (see ``span_hash``)."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal bytes give equal hashes wherever they stand."""
    _, down = _powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def rolling_hash(prefix: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all strings of ``size`` bytes; equal to ``span_hash`` of each."""
    n = len(prefix) - size
    _, down = _powers(len(prefix))
    return mix((prefix[size:] - prefix[:n]) * down[:n])


def join_texts(texts: list[bytes], separator: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, each followed by ``separator``, and where each starts."""
    data = np.frombuffer(separator.join([*texts, b""]), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64) + len(separator)
    return data, np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64) if len(texts) else np.empty(0, np.int64)


def runs(member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs."""
    edge = np.flatnonzero(np.diff(np.r_[False, member, False].astype(np.int8)))
    return edge[0::2], edge[1::2]


def owner_counts(begins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many of the sorted span ``starts`` belong to each text that begins at ``begins``."""
    at = np.searchsorted(starts, np.r_[begins, np.iinfo(np.int64).max])
    return np.diff(at)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, by doubling."""
    if width > len(x):
        return x[:0]
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def groups(sizes: list[int], limit: int):
    """Ranges of consecutive items of about ``limit`` bytes, at least one item each."""
    begin = 0
    while begin < len(sizes):
        stop, total = begin, 0
        while stop < len(sizes) and (stop == begin or total + sizes[stop] <= limit):
            total += sizes[stop]
            stop += 1
        yield begin, stop
        begin = stop


_FACTORS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def gram_hash(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive word hashes (k <= 64)."""
    n = len(codes) - k + 1
    if n <= 0:
        return codes[:0]
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += codes[j:j + n] * _FACTORS[j]
    return mix(out)


def text_groups(batch, column: int, limit: int):
    """(first row, last row + 1, texts) of one batch, in groups of about ``limit`` bytes of text; only a group at a
    time becomes Python strings."""
    import pyarrow.compute as pc

    texts = batch.column(column)
    for lo, hi in groups(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), limit):
        yield lo, hi, texts.slice(lo, hi - lo).to_pylist()
