"""64-bit hashes of words, computed once per distinct word and worker process."""

from itertools import chain

import numpy as np
import xxhash

from hazline.llm.common import shared

ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche over unsigned 64-bit integers (splitmix64's constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """Cache of word hashes with at most `entries` words, and none of over 64 characters."""

    def __init__(self, entries: int = 500_000):
        self.known: dict[str, int] = {}
        self.entries = entries

    def of(self, docs: list[list[str]]) -> np.ndarray:
        """Hashes of all words of all documents, one after another."""
        known = self.known
        if len(known) > self.entries:
            known.clear()
        new = [w for w in set().union(*docs) if w not in known]
        for word in new:
            known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        found = np.fromiter(map(known.__getitem__, chain.from_iterable(docs)), np.uint64)
        for word in new:
            if len(word) > 64:
                del known[word]
        return found


def shared_hashes() -> WordHashes:
    return shared("words", None, WordHashes)
