"""Tokenizing whole texts with a public tokenizer file, and the memory of pieces already seen."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable
from itertools import islice, repeat

import numpy as np
import pandas as pd

from tidemark.llm.textblocks import SPACES, lowered, word_spans

# White space that a tokenizer's ``\s`` may or may not count, outside [\x20\x09-\x0D].
ODD_SPACE = [
    chr(c).encode()
    for c in [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029]
    + [0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
]
# Spaces with the run of other characters after them; spaces at the end.
PIECE = re.compile(rb"\s*\S+|\s+")
MEMORY = 600_000


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, once per worker process, without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Memory:
    """Ids of pieces of text, encoded by the library once and then looked up.

    It holds ``MEMORY`` pieces at most, as a worker process keeps it while it serves other tasks. When
    full it keeps the pieces it learned first, a third, among which the common ones are. Pieces have
    to be cut where the tokenizer's own splitting always cuts, so that ids of a text are those of its
    pieces.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        mark = max(special, key=special.get)
        self.mark, self.mark_id = mark.encode(), special[mark]
        self.place: dict[bytes, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _keep(self, number: int) -> None:
        """Forget all but the pieces learned first."""
        end = int(self.starts[number]) if number < len(self.starts) else len(self.pool)
        self.place = dict(islice(self.place.items(), number))
        self.starts, self.counts = self.starts[:number].copy(), self.counts[:number].copy()
        self.pool = self.pool[:end].copy()

    def places(self, pieces: list[bytes]) -> np.ndarray:
        """The place of each piece in ``counts`` and ``starts``."""
        found = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(found < 0)
        if not len(unknown):
            return found
        new = list({pieces[i] for i in unknown.tolist()})
        for number in (MEMORY // 3, 0):
            if len(self.place) + len(new) > MEMORY and self.place:
                self._keep(number)
                found = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))
                unknown = np.flatnonzero(found < 0)
                new = list({pieces[i] for i in unknown.tolist()})
        self._learn(new)
        found[unknown] = [self.place[pieces[i]] for i in unknown.tolist()]
        return found

    def _learn(self, new: list[bytes]) -> None:
        """Encode pieces in one go, the special token of the file between them.

        The library cuts a text at special strings before anything else, so each piece is
        encoded by itself. Pieces that might hold such a string go one by one.
        """
        plain = [p for p in new if b"<|" not in p]
        other = [p for p in new if b"<|" in p]
        ids = np.zeros(0, np.int32)
        counts = np.zeros(0, np.int64)
        if plain:
            joined = self.mark.join(plain).decode()
            found = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)
            ids = np.array(found[0].ids, np.int32)
            cuts = np.flatnonzero(ids == self.mark_id)
            counts = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
            ids = np.delete(ids, cuts)
        for piece in other:
            alone = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
            ids = np.append(ids, np.array(alone, np.int32))
            counts = np.append(counts, len(alone))
        first = len(self.pool) + np.cumsum(counts) - counts
        self.place.update(zip(plain + other, range(len(self.place), len(self.place) + len(new))))
        self.starts = np.append(self.starts, first)
        self.counts = np.append(self.counts, counts)
        self.pool = np.append(self.pool, ids)

    def ids(self, places: np.ndarray) -> np.ndarray:
        """All ids of pieces at these places, in order."""
        counts = self.counts[places]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.starts[places] - (ends - counts), counts)
        return self.pool[shift + np.arange(total)]


# Words that the word tokenizer cuts as ``PARTS`` says, whatever its tables of letters: visible ASCII
# without capitals and apostrophes, and Latin letters that no normal form changes.
LATIN = re.compile(r"[!-&(-@\[-~\xdf-\xf6\xf8-\xff]+")
LETTERS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")
PARTS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
# The same for bytes: what a byte is in a part. Latin letters have two bytes, and are set apart from OTHER.
SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
KINDS = np.full(256, OTHER, np.uint8)
for _byte in range(128):
    if SPACES[_byte]:
        KINDS[_byte] = SPACE
    elif LATIN.fullmatch(chr(_byte)):
        KINDS[_byte] = LETTER if chr(_byte).isalpha() else DIGIT if chr(_byte).isdigit() else SIGN


class WordMemory(Memory):
    """The same for a tokenizer that marks the ends of words and drops white space.

    New words are encoded many at a time with spaces between them: the marks tell which ids belong
    to which word, as a word has as many as it has parts. Words of ``LATIN`` skip the file's
    normaliser and its splitting, which would do no more to them than to cut the parts. If ever the
    marks did not add up, and for all other words, each is encoded by itself.
    """

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer, pre_tokenizers

        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.final = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.final[i] = token.endswith("</w>")

    def _learn(self, new: list[bytes]) -> None:
        letters, mixed, other = [], [], []
        for word in new:
            if word.isalpha() and word.islower():
                letters.append(word)
            elif b"<|" in word or not word:
                other.append(word)
            else:
                text = word.decode("utf-8", "replace")
                (letters if LETTERS.fullmatch(text) else mixed if LATIN.fullmatch(text) else other).append(word)
        if letters:
            other += self._together(letters, b" ".join(letters).decode(), np.arange(1, len(letters) + 1))
        if mixed:
            parts = [PARTS.findall(word.decode()) for word in mixed]
            joined = " ".join(part for found in parts for part in found)
            other += self._together(mixed, joined, np.cumsum([len(found) for found in parts]))
        if other:
            super()._learn(other)

    def _together(self, words: list[bytes], joined: str, wanted: np.ndarray) -> list[bytes]:
        """Learn words whose parts are joined by spaces, ``wanted`` parts up to the end of each word.

        Returns the words that could not be told apart.
        """
        ids = np.array(self.bare.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(self.final[ids])
        if len(ends) != wanted[-1] or ends[-1] != len(ids) - 1:
            return words
        stops = ends[wanted - 1] + 1
        counts = np.diff(np.append(0, stops))
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.starts = np.append(self.starts, len(self.pool) + stops - counts)
        self.counts = np.append(self.counts, counts)
        self.pool = np.append(self.pool, ids)
        return []


@functools.lru_cache(maxsize=4)
def word_memory(path: str) -> WordMemory:
    """The memory of a word tokenizer file, kept by a worker process from task to task."""
    return WordMemory(path)


@functools.lru_cache(maxsize=4)
def memory(path: str) -> Memory:
    """The memory of a tokenizer file, kept by a worker process from task to task."""
    return Memory(path)


def _part_cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where parts of words begin inside them, in words that are cut as ``PARTS`` says.

    Those are the words of ``LATIN`` without ``<|``; no other is cut.
    """
    kinds = np.frombuffer(bytearray(data.tobytes().translate(KINDS.tobytes())), np.uint8)
    leads = np.flatnonzero(data[:-1] == 0xC3)
    follow = data[leads + 1]
    leads = leads[(follow >= 0x9F) & (follow <= 0xBF) & (follow != 0xB7)]
    kinds[leads] = kinds[leads + 1] = LETTER
    changes = kinds[1:] != kinds[:-1]
    changes |= kinds[1:] == DIGIT
    changes &= (kinds[1:] != SPACE) & (kinds[:-1] != SPACE)
    cuts = np.flatnonzero(changes) + 1
    marks = np.flatnonzero(data[:-1] == ord("<"))
    whole = np.append(np.flatnonzero(kinds == OTHER), marks[data[marks + 1] == ord("|")])
    if not len(whole) or not len(cuts):
        return cuts
    kept = np.zeros(len(starts), dtype=bool)
    kept[np.searchsorted(starts, whole, side="right") - 1] = True
    return cuts[~kept[np.searchsorted(starts, cuts, side="right") - 1]]


def word_ids(known: Memory, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block of texts, and where those of each text begin (one more at the end).

    For a tokenizer that drops white space and ignores case: every word is encoded by itself, and
    each different word of the block (told apart by 64-bit hashes) is looked up once. Words that the
    tokenizer is known to cut are looked up in parts, as far fewer parts than words are new. Texts that
    may hold a special string keep their case, as such strings do not ignore it.
    """
    lower = lowered(data)
    whole = data.tobytes()
    if b"<|" in whole:
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if b"<|" in whole[a:b]:
                lower[a:b] = data[a:b]
    hashes, starts, lengths, bounds = word_spans(lower, offsets, lambda starts: _part_cuts(lower, starts))
    codes, _ = pd.factorize(hashes)
    first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))  # codes follow first places
    whole = lower.tobytes()
    begins = starts[first]
    words = [whole[a:b] for a, b in zip(begins.tolist(), (begins + lengths[first]).tolist())]
    places = known.places(words)[codes]
    edges = np.append(0, np.cumsum(known.counts[places]))[bounds]
    return known.ids(places), edges


def has_odd_space(text: bytes) -> bool:
    """Whether any of ``ODD_SPACE`` occurs."""
    return any(space in text for space in ODD_SPACE)


def sums_by(lengths: Iterable[int], values: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given lengths, empty runs included."""
    ends = np.cumsum(np.fromiter(lengths, np.int64))
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return total[ends] - total[np.append(0, ends[:-1])] if len(ends) else ends
