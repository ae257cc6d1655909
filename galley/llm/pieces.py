"""Whole-text encoding with a byte-level tokenizer file, one encoding per distinct word.

The splitter of such a file ends a word before every space that a visible character follows, whatever
stands before the space. So the ids of a text are those of its pieces, cut at these spaces, one after
another; a piece holds the space before it, unless it is the first of its text. Pieces are remembered
with their ids. New pieces of plain characters are cut into the splitter's words, and only words that
are not remembered go to the library's model; new pieces with other characters go to the library joined
into one text. A text that is not cut safely, or a file with another splitter, goes there whole.
"""

from __future__ import annotations

import json
import os
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces, and words, remembered by a worker before it forgets those used once; this bounds memory only.
REMEMBERED = 400_000
#: Pieces joined into one text for the library.
JOINED = 20_000

# Kinds of bytes. Plain are letters, digits, signs and blanks of ASCII without the apostrophe, and the letters
# from U+00C0 to U+027F, whose bytes all count as letters; `_other` finds the two signs in that range.
LETTER, DIGIT, SIGN, BLANK, SPACE, OTHER = range(6)
KINDS = np.full(256, OTHER, np.uint8)
KINDS[0x21:0x7F] = SIGN
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = LETTER
KINDS[0x30:0x3A] = DIGIT
KINDS[0x09:0x0E] = BLANK
KINDS[0x20] = SPACE
KINDS[ord("'")] = OTHER


def _other(data: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Places of bytes that are not plain. A byte above 0x7F that starts no character follows one that does."""
    other = kinds == OTHER
    # the signs of multiplication and division
    other[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    return np.flatnonzero(other)


def _characters(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings one after another, and where each begins and the last ends."""
    if not len(strings):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    strings = strings.cast(pa.large_string())
    _, bounds, data = strings.buffers()
    bounds = np.frombuffer(bounds, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable Latin-1, else the next free one."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Numbers(dict):
    """Words numbered in order of appearance."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Memory:
    """Strings, numbered in order of appearance, and their ids; pieces are marked if it is unsafe to cut at them."""

    def __init__(self):
        self.numbers = Numbers()
        self.flat, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.unsafe, self.uses = np.empty(0, bool), np.empty(0, np.int64)

    def look_up(self, strings: pa.Array) -> np.ndarray:
        """Number of each string; those of ``new`` have no ids yet."""
        coded = strings.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        return numbers[coded.indices.to_numpy()]

    def new(self) -> list[str]:
        return list(islice(self.numbers, len(self.sizes), None))

    def add(self, flat: list[np.ndarray], starts: np.ndarray, sizes: np.ndarray, unsafe: np.ndarray) -> None:
        """Ids of the new strings: ``sizes`` of them from ``starts`` in the arrays of ``flat``."""
        self.starts = np.concatenate([self.starts, starts + len(self.flat)])
        self.flat = np.concatenate([self.flat, *flat])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.unsafe = np.concatenate([self.unsafe, unsafe])
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int64)])

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the strings one after another, and the number of ids before each and before the end."""
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        sizes = self.sizes[numbers]
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        return self.flat[np.arange(before[-1]) + np.repeat(self.starts[numbers] - before[:-1], sizes)], before

    def forget(self) -> None:
        """Keep the strings used more than once since the last time, at most half of what may be remembered."""
        if len(self.numbers) <= REMEMBERED:
            return
        strings = list(self.numbers)
        often = np.flatnonzero(self.uses > 1)
        if len(often) > REMEMBERED // 2:
            often = np.sort(often[np.argsort(-self.uses[often], kind="stable")[: REMEMBERED // 2]])
        sizes = self.sizes[often]
        starts = np.cumsum(sizes) - sizes
        self.flat = self.flat[np.repeat(self.starts[often] - starts, sizes) + np.arange(sizes.sum())]
        self.starts, self.sizes, self.unsafe = starts, sizes, self.unsafe[often]
        self.uses = np.ones(len(often), np.int64)
        self.numbers = Numbers(zip([strings[i] for i in often.tolist()], range(len(often))))


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.special = sorted(token.content for token in self.tokenizer.get_added_tokens_decoder().values())
        self.cuts = self._cuts_at_spaces() and not any(" " in s for s in self.special)
        self.pieces, self.words = Memory(), Memory()

    def _cuts_at_spaces(self) -> bool:
        """Whether the file splits by the byte-level pattern alone."""
        told = json.loads(self.tokenizer.to_str())
        splitter, model = told["pre_tokenizer"] or {}, told["model"]
        level = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
        return bool(level) and not told["normalizer"] and model.get("type") == "BPE" and not model.get("dropout")

    def _learn(self) -> None:
        """Encode the pieces numbered since the last call."""
        new = self.pieces.new()
        if not new:
            return
        data, bounds = _characters(pa.array(new, pa.large_string()))
        kinds = KINDS[data]
        spaced, single = kinds[bounds[:-1]] == SPACE, np.diff(bounds) == 1
        plain = np.ones(len(new), bool)
        plain[np.searchsorted(bounds, _other(data, kinds), "right") - 1] = False
        # unsafe: a blank behind the space, or a special token
        unsafe = spaced & (single | (kinds[np.minimum(bounds[:-1] + 1, len(data) - 1)] == BLANK))
        unsafe[[i for i in np.flatnonzero(spaced & ~plain).tolist() if new[i][1:2].isspace()]] = True
        for mark in self.special:
            if mark.encode() in data.tobytes():
                unsafe |= np.array([mark in p for p in new], bool)
        starts, sizes, flat, length = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), [], 0

        some = np.flatnonzero(plain & ~unsafe)
        ids, before = self._by_words(data, bounds, kinds, plain & ~unsafe)
        starts[some], sizes[some] = before[:-1], np.diff(before)
        flat.append(ids)
        length += len(ids)
        inner = np.flatnonzero(~plain & ~unsafe & spaced)
        for at in range(0, len(inner), JOINED):
            some = inner[at : at + JOINED]
            text = "".join([new[i] for i in some.tolist()])
            ids = self._encoded(text)
            # tokens end where pieces end, so their bytes tell to which piece they belong
            ends = np.cumsum(np.diff(bounds)[some])
            stops = np.searchsorted(np.cumsum(self.byte_lengths()[ids]), ends, "right")
            starts[some], sizes[some] = length + np.append(0, stops[:-1]), np.diff(stops, prepend=0)
            flat.append(ids)
            length += len(ids)
        heads = np.flatnonzero(~plain & ~unsafe & ~spaced).tolist()
        for i, encoding in zip(heads, self.tokenizer.encode_batch_fast([new[i] for i in heads], add_special_tokens=False)):
            flat.append(np.array(encoding.ids, np.int32))
            starts[i], sizes[i] = length, len(flat[-1])
            length += len(flat[-1])
        self.pieces.add(flat, starts, sizes, unsafe)

    def _by_words(self, data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the ``wanted`` pieces, which are plain, and the number of ids before each and before the end."""
        first = np.zeros(len(data), bool)
        first[bounds[:-1]] = True
        # a word is a run of one kind, with the space before it; the last of several blanks before a visible character is a word
        begins = first.copy()
        begins[1:] |= (kinds[1:] != kinds[:-1]) & (kinds[:-1] != SPACE)
        begins[:-1] |= (kinds[:-1] == BLANK) & (kinds[1:] != BLANK) & ~first[1:]
        cuts = np.append(np.flatnonzero(begins), len(data))
        counts = np.diff(np.searchsorted(cuts, bounds))
        words = _strings(data, cuts).filter(pa.array(np.repeat(wanted, counts)))
        self.words.forget()
        numbers = self.words.look_up(words)
        new = self.words.new()
        if new:
            # the model takes words in an alphabet of a character a byte; no plain word holds a zero
            spelled = "\0".join(new).encode().decode("latin-1").translate(_ALPHABET).split("\0")
            tokenize = self.model.tokenize
            found = [[token.id for token in tokenize(word)] for word in spelled]
            sizes = np.array([len(ids) for ids in found], np.int64)
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
            self.words.add([flat], np.cumsum(sizes) - sizes, sizes, np.zeros(len(new), bool))
        ids, before = self.words.ids(numbers)
        return ids, before[np.concatenate([np.zeros(1, np.int64), np.cumsum(counts[wanted])])]

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def byte_lengths(self) -> np.ndarray:
        """Bytes of text behind each id. A token of a byte-level vocabulary has a character a byte."""
        if not hasattr(self, "_lengths"):
            lengths = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
            for token, number in self.tokenizer.get_vocab(with_added_tokens=True).items():
                lengths[number] = len(token)
            self._lengths = lengths
        return self._lengths

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has. Null is empty."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        texts = pc.fill_null(texts, "")
        if not self.cuts:
            found = [self._encoded(text) for text in texts.to_pylist()]
            return np.concatenate([np.empty(0, np.int32), *found]), np.array([len(x) for x in found], np.int64)
        self.pieces.forget()
        data, bounds = _characters(texts)
        begins = data == 32
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        cuts = np.append(np.flatnonzero(begins), len(data))
        numbers = self.pieces.look_up(_strings(data, cuts))
        self._learn()
        ids, before = self.pieces.ids(numbers)
        places = np.searchsorted(cuts, bounds)
        odd = np.unique(np.searchsorted(places, np.flatnonzero(self.pieces.unsafe[numbers]), "right")) - 1
        found = np.diff(before[places])
        if not len(odd):
            return ids, found
        whole = {i: self._encoded(texts[i].as_py()) for i in odd.tolist()}
        parts = [whole[i] if i in whole else ids[before[places[i]] : before[places[i + 1]]] for i in range(len(texts))]
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


_ALPHABET = {byte: character for byte, character in enumerate(byte_characters()) if byte}

_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
