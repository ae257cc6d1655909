"""Byte-pair encoding with a tokenizer file, by an index of pair occurrences, and decoding.

A task numbers the distinct words of up to 16 MB of text, less if many are new, and encodes the new ones
together, about a megabyte at a time, which bounds what a worker holds. The
symbols of these words lie in one array with links to their neighbours. An index maps the rank of
each mergeable pair to all positions at which the pair stands. Ranks are taken in ascending order from
a heap; one step merges a pair at all of its positions, relinks the neighbours and enters the pairs
that arise into the lists of their ranks. The documents' ids are then gathered from their words' ids.

The file must describe BPE over byte-level characters, with words split by a pattern and a mark at the
end of each word; normalization and splitting of texts beyond plain Latin go through the file's own
normalizer and splitter. Strings of special tokens inside a text become their ids, as that is what the
file asks for. Decoding joins the tokens' strings with blanks, as the file names no decoder.

Null and empty texts have no ids and decode to the empty string. Repeated rows are encoded each on its
own. Other columns are kept only if asked for. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import ddl, fresh, slices
from galley.llm.memory import tidied
from galley.llm.pieces import Numbers, byte_characters

#: Letters of plain Latin.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
#: Fixed value: the pattern by which the word-level file splits lower-cased text, over the characters
#: below. Letters come first, as nothing else starts like them. The rest is dropped.
PATTERN = rf"[{LETTERS}]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\s0-9{LETTERS}]+"
#: Plain Latin without raised digits and fractions: lower-casing is one to one, composition changes nothing.
_OTHER = re.compile("[^\t\n\r -~¡-±´-¸º»¿-įı-ſ]")
#: Ranks and positions are 32-bit integers: a text has fewer than 2**31 bytes.
_NEVER = np.int32(np.iinfo(np.int32).max)
#: Text bytes, and new words, after which a block of documents is given out, and words remembered by a worker.
BLOCK_BYTES = 16 << 20
NEW_WORDS = 100_000
REMEMBERED = 100_000
#: Bytes of new words whose symbols lie in one array. It bounds memory, not the work.
TOGETHER_BYTES = 1 << 20
#: Text bytes split into words at a time.
SLICE = 1 << 20


class PairIndex:
    """Merges of a tokenizer file, applied to many words at once."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        characters = byte_characters()
        self.inner = np.array([vocabulary[c] for c in characters], np.int32)
        self.final = np.array([vocabulary[c + suffix] for c in characters], np.int32)
        self.width = max(vocabulary.values()) + 1
        pairs = np.array([vocabulary[a] * self.width + vocabulary[b] for a, b in merges], np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int32)
        # of a pair listed twice the later rank holds, as in a mapping filled in order
        order = np.lexsort((np.arange(len(pairs)), pairs))
        last = np.append(pairs[order][1:] != pairs[order][:-1], True)
        self.keys, self.ranks = pairs[order][last], order[last].astype(np.int32)
        #: Whether merging at a rank can give a pair of a lower rank.
        lowest = np.full(self.width, _NEVER)
        for side in (self.keys // self.width, self.keys % self.width):
            np.minimum.at(lowest, side, self.ranks)
        self.backward = lowest[self.merged] < np.arange(len(pairs))
        self.twin = pairs // self.width == pairs % self.width

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], _NEVER)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all (non-empty) words one after another, and how many each word has."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        n, ends = len(data), np.cumsum(sizes) - 1
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        symbol = self.inner[data]
        symbol[ends] = self.final[data[ends]]
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends], before[np.append(0, ends[:-1] + 1)] = -1, -1
        rank, alive = np.full(n, _NEVER, np.int32), np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(positions: np.ndarray) -> None:
            found = self._rank(symbol[positions], symbol[after[positions]])
            rank[positions] = found
            positions, found = positions[found < _NEVER], found[found < _NEVER]
            order = np.argsort(found, kind="stable")
            positions, found = positions[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            for r, list_ in zip(found[np.append(0, cuts)].tolist() if len(found) else (), np.split(positions, cuts)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(list_)

        enter(np.flatnonzero(after >= 0).astype(np.int32))
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            here = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            here = here[rank[here] == r]
            if not len(here):
                continue
            if self.backward[r]:  # one merge a word, as a lower rank may arise beside it
                first = np.append(True, word[here][1:] != word[here][:-1])
                if not first.all():
                    index[r] = [here[~first]]
                    heapq.heappush(heap, r)
                    here = here[first]
            elif self.twin[r]:  # every other one in a run of overlapping pairs
                steps = np.arange(len(here))
                starts = np.append(True, after[here[:-1]] != here[1:])
                here = here[(steps - np.maximum.accumulate(np.where(starts, steps, 0))) % 2 == 0]
            gone = after[here]
            beyond = after[gone]
            symbol[here], after[here] = self.merged[r], beyond
            alive[gone], rank[gone] = False, _NEVER
            inside = beyond >= 0
            before[beyond[inside]] = here[inside]
            rank[here[~inside]] = _NEVER
            previous = before[here]
            enter(np.unique(np.concatenate([here[inside], previous[previous >= 0]])))
        return symbol[alive], np.bincount(word[alive], minlength=len(words))


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, tool = described["model"], Tokenizer.from_file(path)
        self.normalize, self.split_other = tool.normalizer.normalize_str, tool.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.index = PairIndex(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.split = re.compile(PATTERN).findall
        self.bytes_of = {c: b for b, c in enumerate(byte_characters())}
        self.tokens = {number: token for token, number in [*model["vocab"].items(), *self.special.items()]}
        self.forget()

    def forget(self) -> None:
        self.numbers = Numbers()
        self.flat, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    def words(self, text: str) -> list[str]:
        """Words of a text; a special token is a word that starts with a line feed."""
        if not _OTHER.search(text) and "<|" not in text:
            return self.split(text.lower())
        found = []
        for number, part in enumerate(self.special_pattern.split(text)):
            if number % 2:
                found.append("\n" + part)
            elif part:
                for word, _ in self.split_other(self.normalize(part)):
                    found.append(bytes(self.bytes_of[c] for c in word).decode("utf-8", "surrogateescape"))
        return found

    def new(self) -> int:
        """How many words have been numbered since the last call of ``learn``."""
        return len(self.numbers) - (len(self.starts) - 1)

    def learn(self) -> None:
        """Encode the words numbered since the last call."""
        flat, sizes = [self.flat], [np.empty(0, np.int64)]
        for words in _lots(islice(self.numbers, len(self.starts) - 1, None)):
            ids, counts = self._encoded(words)
            flat.append(ids)
            sizes.append(counts)
        self.flat = np.concatenate(flat)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each word has."""
        special = np.array([w[:1] == b"\n" for w in words])
        plain = [w for w in words if w[:1] != b"\n"]
        ids, sizes = self.index.encode(plain) if plain else (np.empty(0, np.int32), np.empty(0, np.int64))
        if len(plain) < len(words):
            parts, full = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else ()), np.ones(len(words), np.int64)
            ids = np.concatenate([np.array([self.special[w[1:].decode()]], np.int32) if w[:1] == b"\n" else next(parts) for w in words])
            full[~special] = sizes
            sizes = full
        return ids, sizes

    def gather(self, numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words ``numbers``, and the offsets in them of the documents whose words end at ``ends``."""
        sizes = self.starts[numbers + 1] - self.starts[numbers]
        at = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.arange(at[-1]) + np.repeat(self.starts[numbers] - at[:-1], sizes)]
        return ids, at[np.concatenate([[0], ends])]


def _lots(words: Iterable[str]) -> Iterator[list[bytes]]:
    """The words' bytes in lists of about ``TOGETHER_BYTES``, or with one word that is longer."""
    lot, size = [], 0
    for word in words:
        lot.append(word.encode("utf-8", "surrogateescape"))
        size += len(lot[-1])
        if size >= TOGETHER_BYTES:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode(
    docs: DataFrame, tokenizer: str, text: str = "text", columns: list[str] | None = None, ids: str = "ids", as_bytes: bool = False, decoded: str | None = None
) -> DataFrame:
    """``columns`` (default: all but the text) and the ids of the whole text, ``array<int>``.

    With ``as_bytes`` the ids are little-endian unsigned 32-bit integers in a binary column; with
    ``decoded`` a column of that name holds the text decoded from the ids. New columns get underscores
    if their names are taken.
    """
    columns = [c for c in docs.columns if c != text] if columns is None else columns
    ids = fresh(ids, columns)
    decoded = decoded and fresh(decoded, [*columns, ids])
    carried = list(dict.fromkeys([*columns, text]))
    names = [*columns, ids, *([decoded] if decoded else [])]

    def emit(tool, held):
        tool.learn()
        for batch, numbers, ends in held:
            flat, offsets = tool.gather(numbers, ends)
            places = pa.array(offsets, pa.int32())
            if as_bytes:
                data = pa.py_buffer(flat.astype("<u4").tobytes())
                found = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.array(4 * offsets, pa.int32()).buffers()[1], data])
            else:
                found = pa.ListArray.from_arrays(places, pa.array(flat, pa.int32()))
            out = [*(batch.column(c) for c in columns), found]
            if decoded:
                tokens, cuts = list(map(tool.tokens.__getitem__, flat.tolist())), offsets.tolist()
                out.append(pa.array([" ".join(tokens[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names)

    def run(batches):
        tool, held, size = encoder(tokenizer), [], 0
        for batch in slices(batches, text, SLICE):
            words = [tool.words(value or "") for value in batch.column(text).to_pylist()]
            ends = np.cumsum([len(x) for x in words])
            numbers = np.fromiter((n for x in words for n in map(tool.numbers.__getitem__, x)), np.int32, int(ends[-1]))
            size += pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
            # a copy, as a slice would keep the texts of its whole batch
            held.append((batch if text in columns else batch.drop_columns([text]).take(np.arange(batch.num_rows)), numbers, ends))
            if size > BLOCK_BYTES or tool.new() > NEW_WORDS:
                yield from emit(tool, held)
                held, size = [], 0
                if len(tool.numbers) > REMEMBERED:
                    tool.forget()
        yield from emit(tool, held)

    kept = docs.select(*[F.col(f"`{c}`") for c in carried])
    more = [f"`{ids}` {'binary' if as_bytes else 'array<int>'}", *([f"`{decoded}` string"] if decoded else [])]
    return kept.mapInArrow(tidied(run), ddl(kept.select(*[F.col(f"`{c}`") for c in columns]), *more))


def decode(tokens: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns and the text of the ids, special tokens included; null ids decode to the empty text."""
    names = tokens.columns
    decoded = fresh(decoded, names)

    def run(batches):
        token = encoder(tokenizer).tokens.__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [" ".join(map(token, x or ())) for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, decoded])

    return tokens.mapInArrow(tidied(run), ddl(tokens, f"`{decoded}` string"))
