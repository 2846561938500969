"""Token ids of whole texts by the `tokenizers` library, each distinct word encoded once.

Both vocabularies cut a text before every blank or line feed that a visible character
follows, whatever stands around, so a text's ids are the ids of such pieces end to end.
Pieces repeat, and a worker remembers the ids of those it has seen. Texts in which a blank or
line feed is followed by anything but printable ASCII or a Latin-1 letter are encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from slotstream.llm.tables import HELD

# a piece after the blank before it, if a text may be cut there
SURE = re.compile(r"\n?[!-~À-ÖØ-öø-ÿ]")
# pieces a worker remembers, and their code points together; when there are more, it keeps the half
# that it met most often
REMEMBERED, REMEMBERED_CHARS = 500_000, 16 << 20
# code points of a piece that is remembered at most; texts with a longer one are encoded whole
LONGEST = 200
# first pieces of texts that a worker remembers, which are apart from the others
FIRSTS = 50_000
# new pieces encoded in one call
TOGETHER = 4_000


class Numbers(dict):
    """Numbers pieces as they come; `new` has those to encode. Pieces at which a text may not
    be cut, and long ones, get -1."""

    def __init__(self, names: list[str]):
        super().__init__()
        self.names = names
        self.chars = sum(map(len, names))
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        if len(piece) > LONGEST or not SURE.match(piece):
            return -1
        self.chars += len(piece)
        number = self[piece] = len(self.names)
        self.names.append(piece)
        # a line feed was set off by a blank that is not in the text
        self.new.append(piece if piece[0] == "\n" else " " + piece)
        return number


class Growing:
    """An array that values are added to, with room to spare."""

    def __init__(self, kind: type, values: np.ndarray):
        self.held, self.n = np.zeros(max(1024, 2 * len(values)), kind), 0
        self.add(values)

    def add(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self.held):
            room = np.zeros(2 * end, self.held.dtype)
            room[: self.n] = self.values
            self.held = room
        self.held[self.n : end] = values
        self.n = end

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.n]


class Encoder:
    """Ids of texts, as `Tokenizer.encode(text, add_special_tokens=False)` gives them."""

    def __init__(self, path: str, remembered: int = REMEMBERED, chars: int = REMEMBERED_CHARS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered, self.chars = remembered, chars
        self.names: list[str] = []
        self.words = Numbers(self.names)
        # whether an id's token begins with the byte symbol of a blank or a line feed
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token[:1] in "ĠĊ"]] = True
        # byte-level vocabularies keep blanks, so every piece shows where it begins
        self.shown = self.begins[self._ids(" a,\nb")].tolist().count(True) == 2
        self.firsts: dict[str, np.ndarray] = {}
        self.starts = Growing(np.int64, np.zeros(1))
        self.pool = Growing(np.uint32, np.zeros(0))
        self.met = Growing(np.int64, np.zeros(0))

    def _forget(self) -> None:
        """Keeps the pieces met most often, and what is known of them."""
        met = self.met.values
        often = np.argsort(-met, kind="stable")[: self.remembered // 2]
        sizes = np.fromiter((len(self.names[i]) for i in often), np.int64, len(often))
        kept = np.sort(often[np.cumsum(sizes) <= self.chars // 2])
        names = [self.names[i] for i in kept]
        place, lengths = self._places(kept)
        self.pool = Growing(np.uint32, self.pool.values[place])
        self.starts = Growing(np.int64, np.concatenate([[0], np.cumsum(lengths)]))
        self.met = Growing(np.int64, met[kept] // 2)
        self.names = names
        self.words = Numbers(names)
        self.words.update(zip(names, range(len(names)), strict=True))

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of these pieces lie in the pool, end to end, and how many each has."""
        starts = self.starts.values
        start, length = starts[numbers], starts[numbers + 1] - starts[numbers]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return np.arange(total) + np.repeat(start - ends + length, length), length

    def _learn(self) -> None:
        """Encodes the new pieces. A call costs more than a piece, so many share one."""
        words, self.words.new = self.words.new, []
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            text = "".join(some)
            if self.shown:
                found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
                ids = np.array(found.ids, np.uint32)
                begins = np.flatnonzero(self.begins[ids])
            else:
                found = self.tokenizer.encode(text, add_special_tokens=False)
                ids = np.array(found.ids, np.uint32)
                first = np.fromiter((x[0] for x in found.offsets), np.int64, len(ids))
                sizes = [len(x) for x in some]
                begins = np.searchsorted(first, np.cumsum(sizes) - sizes)
            self.starts.add(self.pool.n + np.append(begins[1:], len(ids)))
            self.pool.add(ids)

    def _first(self, piece: str) -> np.ndarray:
        """Ids of the piece that begins a text."""
        found = self.firsts.get(piece)
        if found is None:
            found = self._ids(piece)
            if len(piece) <= LONGEST:
                if len(self.firsts) >= FIRSTS:
                    self.firsts.clear()
                self.firsts[piece] = found
        return found

    def _numbers(self, texts: list[str]) -> list[tuple[str, np.ndarray] | None]:
        """For each text its first piece and the numbers of the others, or None if it is to be
        encoded whole."""
        if len(self.names) > self.remembered or self.words.chars > self.chars:
            self._forget()
        get = self.words.__getitem__
        out: list[tuple[str, np.ndarray] | None] = []
        for text in texts:
            first, *others = text.replace("\n", " \n").split(" ")
            numbers = np.fromiter(map(get, others), np.int64, len(others))
            whole = len(numbers) and numbers.min() < 0
            out.append(None if whole else (first, numbers))
        self._learn()
        self.met.add(np.zeros(len(self.names) - self.met.n))
        if used := [x[1] for x in out if x]:
            np.add.at(self.met.values, np.concatenate(used), 1)
        return out

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        numbers = self._numbers(texts)
        cut = [x[1] for x in numbers if x]
        place, lengths = self._places(np.concatenate([*cut, np.zeros(0, np.int64)]))
        ids = self.pool.values[place]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = iter(ends[np.cumsum([len(x) for x in cut], dtype=np.int64)])
        out, begin = [], 0
        for x, text in zip(numbers, texts, strict=True):
            if not x:
                out.append(self._ids(text))
                continue
            end = int(next(bounds))
            out.append(np.concatenate([self._first(x[0]), ids[begin:end]]))
            begin = end
        return out

    def counts(self, texts: list[str]) -> list[int]:
        numbers = self._numbers(texts)
        size = np.diff(self.starts.values)
        return [
            int(size[x[1]].sum()) + len(self._first(x[0])) if x else len(self._ids(text))
            for x, text in zip(numbers, texts, strict=True)
        ]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker process, for the vocabulary used last."""
    return Encoder(path)


HELD.append(encoder.cache_clear)
