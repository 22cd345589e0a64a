"""Word shingles of a text as 64-bit hashes, in numpy."""

import hashlib

import numpy as np

#: Bytes hashed at a time; a longer text is cut at white space.
PIECE = 1 << 20

#: Words of so many bytes are hashed one by one: sums modulo 2**64 meet in some long words.
LONG_WORD = 256

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_RANDOM = np.random.default_rng(20240)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, np.uint64)
_STEP = 0x9E3779B97F4A7C15
_STEP_BACK = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = [_powers(_STEP, 1 << 16), _powers(_STEP_BACK, 1 << 16)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece_words(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    white = _WHITE[raw]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    edge = np.concatenate([[0] * (not white[0]), edge, [len(raw)] * (not white[-1])]).astype(int)
    starts, ends = edge[0::2], edge[1::2]
    if len(raw) > len(_POWERS[0]):
        size = 1 << int(len(raw)).bit_length()
        _POWERS[:] = [_powers(_STEP, size), _powers(_STEP_BACK, size)]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _POWERS[0][: len(raw)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _POWERS[1][starts])
    for k in np.flatnonzero(ends - starts >= LONG_WORD):
        word = hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest()
        hashes[k] = int.from_bytes(word, "little")
    return hashes


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words, runs of anything but space and tab to carriage return, in order.

    A-Z count as a-z. Null gives none.
    """
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    if len(data) <= PIECE:
        return _piece_words(data) if data else np.zeros(0, np.uint64)
    found, start = [], 0
    while start < len(data):
        end = start + PIECE
        while end < len(data) and not _WHITE[data[end]]:
            end += 1
        found.append(_piece_words(data[start:end]))
        start = end
    return np.concatenate(found)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for every ``size`` words in a row; fewer words count as one window."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, np.uint64(size), np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(_STEP) + words[k : len(words) - size + 1 + k])
    return out


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles, sorted."""
    return np.unique(windows(word_hashes(text), size))
