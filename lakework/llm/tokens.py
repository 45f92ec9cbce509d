"""Token ids of whole texts, with each distinct word encoded once per worker."""

import functools
from array import array

import numpy as np
from tokenizers import Tokenizer

#: Ends every document.
END = 1
#: Words, with and without marks, that a worker keeps; others are looked up anew in each chunk.
KEPT = 700_000
#: Stands between words that are encoded in one call; no word that holds it is.
MARK = b"\x01"
#: Marks that part from a letter before them, whatever follows.
TAIL = b".,;:!?*%&$#-()|"
#: The marks that close a sentence.
CLOSING = ".!?…"


def _parted(piece):
    """The word and the marks after it, where the tokenizer parts them too."""
    head = piece.rstrip(TAIL)
    if len(head) == len(piece) or not head or not head.decode()[-1].isalpha():
        return piece, b""
    return head, piece[len(head):]


class Encoder:
    """Encodes UTF-8 texts for a tokenizer that never joins words over white space.

    Splitting at ASCII white space and folding ASCII capitals then changes no id,
    nor does parting a letter from the marks behind it, so a word's ids can be kept.
    A text in which a special token may stand goes through the tokenizer whole.
    """

    def __init__(self, path):
        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids[0]
        # Word 0 is the end of a document.
        self.words, self.ids, self.starts = {None: 0}, array("i", [END]), array("q", [0, 1])
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.array(sorted(
            i for t, i in vocabulary.items()
            if t.endswith("</w>") and t[:-4] and set(t[:-4]) <= set(CLOSING)), dtype=np.int32)
        #: Whether an id ends a word.
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _ids(self, text):
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, dtype=np.int32)

    def _keep(self, words, ids, sizes):
        first = len(self.starts) - 1
        self.words.update(zip(words, range(first, first + len(words)), strict=True))
        self.starts.frombytes((np.cumsum(sizes) + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.tobytes())

    def _learn_words(self, new):
        plain, other = [], []
        for word in new:
            if word.isalpha() or word.decode().isalpha():
                plain.append(word)
            elif MARK in word or b"<|" in word:
                ids = self._ids(word.decode())
                self._keep([word], ids, [len(ids)])
            else:
                other.append(word)
        for i in range(0, len(plain), 20_000):
            some = plain[i:i + 20_000]
            # One call for many words: letters alone are one word to the tokenizer, too.
            ids = self._ids(b" ".join(some).decode())
            at = np.flatnonzero(self.last[ids])
            if len(at) == len(some):
                self._keep(some, ids, np.diff(at, prepend=-1))
            else:  # some letter becomes more than a letter when it is folded
                other += some
        for i in range(0, len(other), 20_000):
            some = other[i:i + 20_000]
            # The mark behind each word is a token of its own.
            ids = self._ids((b" " + MARK + b" ").join([*some, b""]).decode())
            at = np.flatnonzero(ids == self.mark)
            self._keep(some, ids[ids != self.mark], np.diff(at, prepend=-1) - 1)

    def _learn(self, new):
        whole, marked = [], []
        for word in new:
            head, tail = _parted(word) if word[-1] in TAIL else (word, b"")
            if tail:
                marked.append((word, head, tail))
            else:
                whole.append(word)
        parts = {p for _, *both in marked for p in both}.difference(self.words, whole)
        self._learn_words([*whole, *parts])
        if marked:
            number = self.words.__getitem__
            at = np.fromiter((number(p) for _, *both in marked for p in both), np.int64, 2 * len(marked))
            ids, sizes = _gathered(self.ids, self.starts, at)
            self._keep([word for word, _, _ in marked], ids, sizes[::2] + sizes[1::2])

    def _forget(self, words):
        """Back to the table of before a chunk, which refers to nothing learned since."""
        while len(self.words) > words:
            self.words.popitem()
        del self.starts[words + 1:]
        del self.ids[self.starts[-1]:]

    def encode(self, texts):
        """Ids of all ``texts`` (bytes or None) in a row, each ended by END, and their bounds."""
        pieces, counts = [], []
        for text in texts:
            first = len(pieces)
            if text:
                if b"<|" in text:
                    pieces.append(text)
                else:
                    pieces += text.lower().split()
            pieces.append(None)
            counts.append(len(pieces) - first)
        before = len(self.words)
        self._learn(list(set(pieces).difference(self.words)))
        at = np.fromiter(map(self.words.__getitem__, pieces), np.int64, len(pieces))
        ids, sizes = _gathered(self.ids, self.starts, at)
        bounds = np.zeros(len(counts) + 1, dtype=np.int64)
        if counts:
            bounds[1:] = np.cumsum(sizes)[np.cumsum(counts) - 1]
        if len(self.words) > KEPT:
            self._forget(before)
        return ids, bounds


def _gathered(ids, starts, at):
    """The ids of the entries ``at`` in a row, and how many each has."""
    starts = np.array(starts)
    sizes = np.diff(starts)[at]
    take = np.repeat(starts[at] - np.cumsum(sizes) + sizes, sizes)
    take += np.arange(len(take))
    return np.array(ids, dtype=np.int32)[take], sizes


@functools.lru_cache(maxsize=2)
def encoder(path):
    """The worker's encoder for a vocabulary file."""
    return Encoder(path)
