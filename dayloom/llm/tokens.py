"""Token ids of a word tokenizer's file, with a bounded memory of words already seen."""

from __future__ import annotations

import json
import os
from array import array
from itertools import chain

import numpy as np
import regex

# The pattern by which the tokenizer's file cuts lower-cased text, and the
# characters that stand for bytes in its vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in set(_PLAIN)]
BYTE_NAMES = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(_OTHERS)}

#: Code points of signs and Latin letters, by what the pattern takes them for; 0: all others.
_LETTER, _NUMBER, _SIGN = 1, 2, 3
_KINDS = np.zeros(0x180, np.uint8)
for _c in [*range(0x21, 0x7F), *range(0xA1, 0x180)]:
    _KINDS[_c] = next(k for k, p in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SIGN, ".")) if regex.match(p, chr(_c)))

#: Words remembered: so many for good, and as many again until they are forgotten together.
WORDS = 200_000
#: Longer words go through the whole tokenizer, since all words learned at once take as many
#: rounds as the longest has merges.
LONGEST = 64


class Merges:
    """The merges of the tokenizer's model, for many pieces at once."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str = ""):
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.inner, self.last = (
            np.array([vocabulary[BYTE_NAMES[b] + end] for b in range(256)], np.int64) for end in ("", suffix)
        )
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.none = len(pairs)
        # open addressing: a pair lies at the first place of its row that was free
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.base = np.int64(max(vocabulary.values()) + 1)
        keys = np.array([vocabulary[a] * int(self.base) + vocabulary[b] for a, b in pairs], np.int64)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, self.none, np.int64)
        left, place = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = self.keys[place] < 0
            _, pick = np.unique(place[free], return_index=True)
            put = np.flatnonzero(free)[pick]
            self.keys[place[put]], self.ranks[place[put]] = keys[left[put]], left[put]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, place = left[rest], (place[rest] + 1) & (len(self.keys) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Numbers of the merges of symbols, ``none`` where there is none."""
        keys = left * self.base + right
        place = self._place(keys)
        found = self.keys[place]
        out = np.where(found == keys, self.ranks[place], self.none)
        at = np.flatnonzero((found != keys) & (found >= 0))
        place, keys = place[at], keys[at]
        while len(at):
            place = (place + 1) & (len(self.keys) - 1)
            found = self.keys[place]
            same = found == keys
            out[at[same]] = self.ranks[place[same]]
            more = ~same & (found >= 0)
            at, place, keys = at[more], place[more], keys[more]
        return out

    def apply(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, and how many of them each piece has; pieces begin at ``first``.
        In every round each piece makes its first merge of the least number."""
        sizes = np.diff(np.append(first, len(symbols)))
        n, piece, done = len(first), np.repeat(np.arange(len(first)), sizes), []
        rank = np.full(len(symbols), self.none, np.int64)
        inside = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inside] = self.rank(symbols[inside], symbols[inside + 1])
        while len(symbols):
            first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            best = np.minimum.reduceat((rank << 32) | np.arange(len(rank)), first)
            at, goes_on = best & 0xFFFFFFFF, best >> 32 < self.none
            if not goes_on.all():
                stay = np.repeat(goes_on, np.diff(np.append(first, len(symbols))))
                done.append((piece[~stay], symbols[~stay]))
                at = (np.cumsum(stay) - 1)[at[goes_on]]
                symbols, piece, rank = symbols[stay], piece[stay], rank[stay]
            symbols[at] = self.made[rank[at]]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            at = at - np.arange(len(at))  # one symbol of each piece before goes
            symbols, piece, rank = symbols[kept], piece[kept], rank[kept]
            ended = np.append(piece[1:] != piece[:-1], True)
            rank[at] = self.none
            for x in (at[~ended[at]], at[(at > 0) & ~ended[at - 1]] - 1):
                rank[x] = self.rank(symbols[x], symbols[x + 1])
        if not done:
            return symbols, np.zeros(n, np.int64)
        piece, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(piece, kind="stable")
        return symbols[order], np.bincount(piece, minlength=n)


class WordTokens(dict):
    """Numbers of words (bytes), under which their ids are remembered. Text is cut at ASCII white
    space first, which the tokenizer drops and never joins over, so the ids of a text are those of
    its words one after the other. New words of Latin letters and signs go through the merges of
    the tokenizer's model together, all others through the whole tokenizer."""

    def __init__(self, path: str):
        super().__init__()
        self.path, self.whole = path, None
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.cut = regex.compile(PATTERN)
        self.old: dict[bytes, int] = {}
        self.new: list[bytes] = []
        self._clear()

    def _clear(self) -> None:
        if not self.old and len(self):
            self.old, self.kept = dict(self), (len(self.ids), len(self.first))
        self.clear()
        if self.old:
            self.update(self.old)
            del self.ids[self.kept[0] :], self.first[self.kept[1] :], self.size[self.kept[1] :]
        else:
            self.ids, self.first, self.size = array("I"), array("I"), array("I")

    def _by_tokenizer(self, word: bytes) -> list[int]:
        if self.whole is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return self.whole.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids

    def _by_merges(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a word is of signs and Latin letters, how many ids it has then, and all these ids."""
        text = b"\n".join([*words, b""]).decode("utf-8", "replace").lower()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        ends = np.flatnonzero(points == 10)
        word = np.repeat(np.arange(len(words)), np.diff(ends, prepend=-1))
        kind = np.where(points < len(_KINDS), _KINDS[np.minimum(points, len(_KINDS) - 1)], 0)
        other = (kind == 0) & (points != 10)
        other[:-1] |= (points[:-1] == ord("<")) & (points[1:] == ord("|"))  # may be a token of its own
        ok = np.bincount(word[other], minlength=len(words)) == 0
        ok &= np.diff(ends, prepend=-1) - 1 <= LONGEST
        new = np.append(True, kind[1:] != kind[:-1]) | (kind == _NUMBER)
        # few words have an apostrophe, which may begin a piece with the letters after it
        begins = np.append(0, ends + 1)
        for i in np.unique(word[points == ord("'")]).tolist():
            if ok[i]:
                new[begins[i] : ends[i]] = False
                new[[begins[i] + m.start() for m in self.cut.finditer(text[begins[i] : ends[i]])]] = True
        kept = ok[word] & (points != 10)
        points, word, new = points[kept], word[kept], new[kept]
        if not len(points):
            return ok, np.zeros(len(words), np.int64), points.astype(np.int64)
        # UTF-8: all these have one byte or two
        wide = points >= 0x80
        at = np.cumsum(1 + wide) - 1
        data = np.empty(int(at[-1]) + 1, np.int64)
        data[at] = np.where(wide, 0x80 | (points & 0x3F), points)
        data[at[wide] - 1] = 0xC0 | (points[wide] >> 6)
        first = (at - wide)[new]
        symbols = self.merges.inner[data]
        last = np.append(first[1:], len(data)) - 1
        symbols[last] = self.merges.last[data[last]]
        ids, sizes = self.merges.apply(symbols, first)
        return ok, np.bincount(word[new], sizes, len(words)).astype(np.int64), ids

    def _learn(self) -> None:
        """Ids of the new words."""
        words, self.new = self.new, []
        if not words:
            return
        ok, sizes, ids = self._by_merges(words)
        if not ok.all():
            others = [self._by_tokenizer(words[i]) for i in np.flatnonzero(~ok).tolist()]
            owner = np.append(np.repeat(np.arange(len(words)), sizes), np.repeat(np.flatnonzero(~ok), [len(x) for x in others]))
            ids = np.append(ids, np.array([*chain.from_iterable(others)], np.int64))
            ids, sizes = ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))
        first = np.cumsum(sizes) - sizes + len(self.ids)
        for values, found in ((self.first, first), (self.size, sizes), (self.ids, ids)):
            values.frombytes(found.astype(np.uint32).tobytes())

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self.first) + len(self.new)
        self.new.append(word)
        return at

    def encode_all(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self) > WORDS * (2 if self.old else 1):
            self._clear()
        words = [text.split() for text in texts]
        number = np.array([len(x) for x in words], np.int64)
        codes = np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, int(number.sum()))
        self._learn()
        size = _take(self.size, codes)
        before = np.append(0, np.cumsum(size))
        where = np.repeat(_take(self.first, codes) - before[:-1], size) + np.arange(before[-1])
        ids = _take(self.ids, where).astype(np.uint32)
        return np.split(ids, before[np.cumsum(number)[:-1]]) if texts else []

    def encode(self, text: bytes) -> np.ndarray:
        """The ids of a text."""
        return self.encode_all([text])[0]


def _take(values: array, at: np.ndarray) -> np.ndarray:
    """Elements of an array; the view is gone afterwards, so that the array can grow."""
    view = np.frombuffer(values, np.uint32) if len(values) else np.empty(0)
    out = view[at].astype(np.int64)
    del view
    return out
