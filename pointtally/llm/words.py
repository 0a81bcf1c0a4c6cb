"""Words of many texts at once, in numpy: positions and 64-bit hashes.

Texts are joined into one UTF-8 buffer; a word is a run of bytes outside a set
of ASCII separators (bytes of other scripts are always word bytes), with A-Z
lower-cased.  Equal words have equal hashes; different words differ but for a
chance of 2^-64 per pair.
"""

from __future__ import annotations

import hashlib

import numpy as np

# Separators of a shingle word (white space), and of a benchmark word (every
# ASCII character but digits and letters).
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NON_ALNUM = bytes(b for b in range(0x80) if not chr(b).isalnum())

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SEGMENT = 1 << 20


def _byte_table() -> np.ndarray:
    """A 64-bit value per byte, A-Z as a-z, derived from SHA-256."""
    values = [int.from_bytes(hashlib.sha256(bytes([b])).digest()[:8], "little") for b in range(256)]
    for b in range(0x41, 0x5B):
        values[b] = values[b + 32]
    return np.array(values, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """Splits and hashes; holds the tables a task needs."""

    def __init__(self, separators: bytes):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        self.values = _byte_table()
        self.up = _powers(_BASE, SEGMENT)
        self.down = _powers(_INVERSE, SEGMENT)

    def split(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(buffer, word starts, word ends, first word of each text and the total)``."""
        joined = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(joined, np.uint8)
        inside = self.is_word[buf]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        starts, ends = edge[0::2], edge[1::2]
        first_byte = np.concatenate([[0], np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))])
        return buf, starts, ends, np.searchsorted(starts, first_byte)

    def hashes(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash per word, in segments of bounded size."""
        out = np.empty(len(starts), np.uint64)
        k = 0
        while k < len(starts):
            base = int(starts[k])
            j = int(np.searchsorted(ends, base + SEGMENT, side="right"))
            if j == k:  # a word longer than a segment
                word = bytes(buf[base : int(ends[k])]).translate(_LOWER)
                out[k] = int.from_bytes(hashlib.sha256(word).digest()[:8], "little")
                k += 1
                continue
            stop = int(ends[j - 1])
            run = np.cumsum(self.values[buf[base:stop]] * self.up[: stop - base])
            s, e = starts[k:j] - base, ends[k:j] - base
            total = run[e - 1] - np.where(s > 0, run[s - 1], np.uint64(0))
            out[k:j] = mix(total * self.down[s] + (e - s).astype(np.uint64))
            k = j
        return out


_LOWER = bytes(b + 32 if 0x41 <= b < 0x5B else b for b in range(256))
