"""Sets of word shingles as sorted 64-bit hashes, for many texts at once.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased, as in
``[^\\x20\\x09-\\x0D]+``. A shingle's hash mixes the hashes of its words in order.
"""

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x):
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """Remembers the hash of each word up to a bound; the hash depends on the word alone."""

    KEPT = 150_000

    def __init__(self):
        self.known = {}

    def of(self, words):
        missing = list(set(words).difference(self.known))
        if missing:
            self.known.update(zip(missing, word_hashes(missing).tolist(), strict=True))
        found = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        if len(self.known) > self.KEPT:
            for word in missing:
                del self.known[word]
        return found


def word_hashes(words):
    """64-bit hashes of non-empty byte strings: polynomials over their bytes, mixed."""
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    powers = mixed((np.arange(int(sizes.max(initial=0))).astype(np.uint64) + np.uint64(1)) * _STEP)
    terms = mixed(powers[place] ^ (data.astype(np.uint64) + np.uint64(1)) * _M2)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    return mixed(sums[ends] - sums[starts] + sizes.astype(np.uint64) * _STEP)


def shingle_sets(texts, size, hashes):
    """The sorted distinct shingle hashes of each text (bytes or None).

    A text with fewer than ``size`` words has its whole sequence as one shingle; one
    without words has none.
    """
    words, counts = [], []
    for text in texts:
        found = text.lower().split() if text else []
        words += found
        counts.append(len(found))
    each, sets, at = hashes.of(words), [], 0
    rolled = np.zeros(max(0, len(each) - size + 1), np.uint64)
    for k in range(size):
        rolled = mixed(rolled * _M1 + each[k:k + len(rolled)] + _STEP)
    for n in counts:
        if n >= size:
            sets.append(np.unique(rolled[at:at + n - size + 1]))
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for h in each[at:at + n]:
                    whole = mixed(whole * _M1 + h + _STEP)
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += n
    return sets
