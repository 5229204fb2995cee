"""Hashed character n-gram models, scored over whole batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_MIX = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393], dtype=np.uint32)


def _lower(t: str) -> str:
    """Lower case, character for character, so that offsets stay those of the text."""
    low = t.lower()
    return low if len(low) == len(t) else "".join(x if len(x := c.lower()) == 1 else c for c in t)


@lru_cache(1)
def _lowered() -> tuple[np.ndarray, frozenset[str]]:
    """By code point its lower case, digits as 0; and the characters whose lower case is longer or hangs on what stands around them."""
    cased = "".join(map(chr, range(0x20000)))
    odd = frozenset(c for c in cased if len(c.lower()) > 1) | {"\u03a3"}
    out = np.arange(0x110000, dtype=np.uint32)
    out[: len(cased)] = np.frombuffer("".join([c if c in odd else c.lower() for c in cased]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out[48:58] = 48
    return out, odd


#: What follows every text of a batch; no n-gram of up to five characters reaches past it.
END = "\n\0\0\0\0"


class Batch:
    """Lower-cased texts with digits as 0, joined into one array of code points.

    ``starts`` are the offsets of the texts; every text is followed by ``END``, so its n-grams are its own.
    """

    def __init__(self, texts: list[str]):
        joined = END.join([*texts, ""])
        table, odd = _lowered()
        if any(c in joined for c in odd):
            low = joined.lower()
            joined = low if len(low) == len(joined) else "".join([_lower(t) + END for t in texts])
        self.codes = table.take(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
        self.starts = np.concatenate([[0], np.cumsum([len(t) + len(END) for t in texts])]).astype(np.int64)

    def hashes(self, order: int, bits: int) -> np.ndarray:
        """The n-gram that ends at each place; 0, which counts for nothing, where it is mostly what lies between texts."""
        h = np.zeros(len(self.codes), dtype=np.uint32)
        for k in range(min(order, len(self.codes))):
            h[k:] += self.codes[: len(self.codes) - k] * _MIX[k] if k else self.codes * _MIX[0]
        h ^= h >> np.uint32(15)
        h *= np.uint32(2246822519)
        h ^= h >> np.uint32(13)
        h &= np.uint32((1 << bits) - 1)
        for k in range(2 - len(END), order - 3):
            h[self.starts[1:] + k if k < 0 else self.starts[:-1] + k] = 0
        return h.astype(np.intp)

    def counts(self, order: int, bits: int) -> np.ndarray:
        """How often each hashed n-gram occurs."""
        n = np.bincount(self.hashes(order, bits), minlength=1 << bits)
        n[0] = 0
        return n


def chunks(texts: list[str], chars: int = 1 << 18) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) in pieces of about so many characters, whose arrays stay in a core's cache."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def ratios(p: np.ndarray, q: np.ndarray, smooth: float = 1.0, scale: float = 2e5) -> np.ndarray:
    """log(p / q) of each hashed n-gram, shrunk towards 0 where both are rare; counts of a small text are raised fourfold at most."""
    p, q = p * min(4.0, scale / max(1, p.sum())), q * min(4.0, scale / max(1, q.sum()))
    return np.log((p + smooth) / (q + smooth)).astype(np.float32)
