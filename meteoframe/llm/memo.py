"""Bounded per-worker memory of what has been computed for a word."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable

import pyarrow as pa

_HELD: tuple | None = None


class Memo:
    """word -> value in two generations: when the young one is full it becomes
    the old one, and words used again move over. ``compute`` gets a list of new
    words and returns their values; it must depend on the word alone. Words
    longer than ``longest`` are computed each time and not kept."""

    def __init__(self, compute: Callable[[list], Iterable], capacity: int, longest: int = 256,
                 together: int = 1 << 15):
        self.compute, self.capacity, self.longest, self.together = compute, capacity, longest, together
        self.young: dict = {}
        self.old: dict = {}

    def values(self, texts: list[list]) -> list[list]:
        """The values of the words of each text, in order. New words are
        computed for about ``together`` words at a time (fewer calls, or fewer
        words met twice before they are known)."""
        out, at = [], 0
        while at < len(texts):
            stop, words = at, 0
            while stop < len(texts) and (words < self.together or stop == at):
                words += len(texts[stop])
                stop += 1
            out += self._values(texts[at:stop])
            at = stop
        return out

    def _values(self, texts: list[list]) -> list[list]:
        if len(self.young) > self.capacity:
            self.old, self.young = self.young, {}
        young, get = self.young, self.young.get
        found = [list(map(get, words)) for words in texts]
        short = [i for i, own in enumerate(found) if None in own]
        if not short:
            return found
        new = dict.fromkeys([w for i in short for w, v in zip(texts[i], found[i]) if v is None])
        if self.old:
            for word in [w for w in new if w in self.old]:
                young[word] = self.old[word]
                del new[word]
        young.update(zip(new, self.compute(list(new)) if new else ()))
        for i in short:
            found[i] = [get(w) if v is None else v for w, v in zip(texts[i], found[i])]
        for word in [w for w in new if len(w) > self.longest]:
            del young[word]
        return found


def _trim() -> None:
    """Ask the C library to return free memory to the system, if it can."""
    import ctypes

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def release() -> None:
    """Give back what another operator's tasks left in this Python worker, for
    tasks that need the memory for themselves."""
    global _HELD
    if _HELD is not None:
        _HELD = None
        gc.collect()
        pa.default_memory_pool().release_unused()
        _trim()


def held(key: tuple, make: Callable):
    """``make()``, kept in this Python worker until another key is asked for."""
    global _HELD
    if _HELD is None or _HELD[0] != key:
        release()
        _HELD = (key, make())
    return _HELD[1]
