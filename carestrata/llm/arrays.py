"""Texts of an Arrow batch as flat arrays: tokens, hashes and sliding minima without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SPACE, WORD, MARK = 0, 1, 2


def byte_classes() -> np.ndarray:
    """Class of each UTF-8 byte: white space, word (letters, digits, all of non-ASCII) or mark."""
    kinds = np.full(256, MARK, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = SPACE
    kinds[128:] = WORD
    for first, last in ("09", "AZ", "az"):
        kinds[ord(first) : ord(last) + 1] = WORD
    return kinds


def lower_bytes() -> np.ndarray:
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    return low


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 places where texts begin; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def chunks(raw: np.ndarray, at: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `size` bytes: first, last + 1, their bytes, places relative to these bytes."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64; the table grows to the longest text met, and long ones aren't retained."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            have = np.full(size, base, np.uint64)
            have[0] = 1
            have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[:n]


@dataclass
class Tokens:
    """Tokens of some texts, in order: byte ranges, hashes, and for each text the place of its first token."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def tokens(data: np.ndarray, at: np.ndarray, kinds: np.ndarray, fold: np.ndarray | None = None, marks: bool = True) -> Tokens:
    """Maximal runs of one byte class; white space is left out, and marks too if not wanted. No run spans two texts."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Tokens(none, none, np.zeros(0, np.uint64), np.zeros(len(at), np.int64))
    kind = kinds[data]
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[at[:-1][at[:-1] < n]] = True
    start = np.flatnonzero(edge)
    end = np.append(start[1:], n)
    keep = kind[start] != SPACE if marks else kind[start] == WORD
    start, end = start[keep], end[keep]
    value = (data if fold is None else fold[data]).astype(np.uint64) + np.uint64(1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(value * powers(BASE, n), out=total[1:])
    h = (total[end] - total[start]) * powers(INVERSE, n)[start]
    return Tokens(start, end, mixed(h), np.searchsorted(start, at))


def grams(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k following tokens within one text, and the place of each gram's first token."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + h[j : n + j]
    whole = np.ones(n, bool)
    for j in range(1, k):
        cut = first[1:-1] - j
        whole[cut[(cut >= 0) & (cut < n)]] = False
    place = np.flatnonzero(whole)
    return mixed(out[place]), place


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by doubling."""
    out, span = v, 1
    while span < w:
        step = min(span, w - span)
        out = np.minimum(out[: len(out) - step], out[step:])
        span += step
    return out


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of token values in each text; 0 where it has none."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
