"""Repeated passages: suffixes sorted by most-significant-digit passes, only through ``length`` tokens.

A passage is a run of ``length`` tokens, bytes or words, that also starts in a document with a smaller id.
All tokens of all such runs are marked; overlaps count, and runs are judged on the input.

Sorting every suffix would move every position of the corpus, so the first digit is chosen to separate
nearly all of them at a small cost:

1. Digit one of a suffix is the smallest hash among the ``KEY``-token strings inside its first ``length``
   tokens. Neighbouring suffixes share it, so a document has one digit for about twelve positions. Per
   digit only 32 bits and the number of the document's block are shuffled. A digit met in one document
   cannot repeat; each block learns which of its digits are met elsewhere.
2. For those, a block sends its tokens around the digit, once for copies inside the block: a later copy
   of the same tokens is marked at once. A digit met very often is split further, by the hash of all
   ``length`` tokens, so that no task gathers the occurrences of a frequent string.
3. Where the digits meet, suffixes are sorted by the next eight bytes, groups of one document are dropped,
   and so on through ``length`` tokens. The groups left are the repeated runs; all of a group that are not
   in its smallest document are marked.
4. The marks return to the blocks, which merge them document by document.

Documents are dealt to blocks of about ``BLOCK_BYTES`` by a hash of their id, so a task holds one block,
one bucket of digits, or one document if that is longer.

Words are runs of characters other than blanks, compared by 64-bit hashes of their bytes. Hashes of whole runs
only propose equal ones; their tokens are compared before a mark counts. Null texts are empty. Rows that
share an id do not mark each other. Rows without an id come after all others. Repeated rows give repeated
results; other columns are ignored by ``repeated`` and kept by ``remove_repeated``. An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import ddl, fresh, slices, texts_as_bytes
from galley.llm.memory import hand_back, tidied
from galley.llm.near_dup import NO_ID, mix

KEY_SHARE = 0.56
BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 4 << 20
SLICE = 1 << 20
#: Occurrences from which a digit is split by all its tokens.
FREQUENT = 20_000
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * _P)
_WORD_GAP = np.zeros(256, bool)
_WORD_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.uint64(0xFFFFFFFF)


# --- tokens -------------------------------------------------------------------------------------


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one byte of each word."""
    gap = _WORD_GAP[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _word_codes(text: bytes) -> np.ndarray:
    """A 64-bit hash for each word, from the sums of its hashed bytes and places."""
    first, stop = word_bounds(text)
    if not len(first):
        return np.empty(0, np.uint64)
    data = np.frombuffer(text, np.uint8)
    starts = np.append(0, first[first > 0])
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    hashed = mix(_BYTE_HASH[data] + place.astype(np.uint64) * _Q)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed)])
    return mix(sums[stop] - sums[first])


def tokens(text: bytes, unit: str) -> np.ndarray:
    return np.frombuffer(text, np.uint8) if unit == "bytes" else _word_codes(text)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    value = a * _P + b
    value ^= value >> np.uint64(29)
    value *= _Q
    value ^= value >> np.uint64(32)
    return value


class Windows:
    """Hashes of all windows of ``length`` tokens of some documents laid end to end."""

    def __init__(self, docs: list[np.ndarray], length: int):
        key = max(1, int(length * KEY_SHARE))
        self.data = np.concatenate(docs) if docs else np.empty(0, np.uint8)
        sizes = np.array([len(d) for d in docs], np.int64)
        self.first = np.cumsum(sizes) - sizes
        one = _BYTE_HASH[self.data] if self.data.dtype == np.uint8 else mix(self.data * _P + _Q)
        spans = {1: one}
        size = 1
        while 2 * size <= length:
            spans[2 * size] = _join(spans[size][: len(spans[size]) - size], spans[size][size:]) if len(spans[size]) > size else spans[size][:0]
            size *= 2
        of = lambda n: self._overlap(spans[1 << (n.bit_length() - 1)], n, _join)
        keys = of(key)
        self.whole = of(length)  # a hash of all tokens of each window
        lowest, step, reach = keys, 1, length - key + 1
        while 2 * step <= reach:
            lowest = np.minimum(lowest[: max(0, len(lowest) - step)], lowest[step:])
            step *= 2
        lowest = np.minimum(lowest[: max(0, len(lowest) - (reach - step))], lowest[reach - step :]) if reach > step else lowest
        valid = np.repeat(sizes - length + 1, np.maximum(sizes, 0)) > np.arange(len(self.data)) - np.repeat(self.first, sizes)
        at = np.flatnonzero(valid)
        digit = mix(lowest[at])
        row = np.repeat(np.arange(len(docs)), sizes)[at]
        new = np.ones(len(at), bool)
        new[1:] = (digit[1:] != digit[:-1]) | (row[1:] != row[:-1])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(at))
        #: Runs of neighbouring windows with the same digit: document, first window, last window, digit.
        self.row, self.begin, self.end, self.digit = row[start], at[start], at[stop - 1] if len(at) else at, digit[start]

    @staticmethod
    def _overlap(values: np.ndarray, n: int, join) -> np.ndarray:
        size = 1 << (n.bit_length() - 1)
        return values if size == n else join(values[: max(0, len(values) - (n - size))], values[n - size :])


# --- packed columns -----------------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, or a last one of bytes, each with its bytes transposed, compressed."""
    parts = []
    for array in arrays:
        raw = np.ascontiguousarray(array)
        parts.append(raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes() if raw.itemsize > 1 and len(raw) else raw.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(blob: bytes, n: int, *types: str) -> list[np.ndarray]:
    """``n`` values of each type; what is left comes last, as bytes."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    out, at = [], 0
    for kind in types:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * width].reshape(width, n).T).view(kind).ravel())
        at += n * width
    return [*out, data[at:]]


_PACKED = "bucket long, block long, kind int, n long, payload binary"
_PACKED_NAMES = ["bucket", "block", "kind", "n", "payload"]


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _PACKED_NAMES)


def _cuts(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, first, stop) of each run in sorted keys."""
    if len(keys):
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        yield from zip(keys[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)])


def _by_key(batches, key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each key, from batches sorted by it."""
    held, current = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != current and held:
                yield current, held
                held = []
            current = row[key]
            held.append(row)
    if held:
        yield current, held


# --- steps --------------------------------------------------------------------------------------


def _bucket(digit: np.ndarray, buckets: int) -> np.ndarray:
    return (digit >> np.uint64(32)) % np.uint64(buckets)


def _digits(docs: DataFrame, length: int, unit: str, buckets: int) -> DataFrame:
    """Step 1, out: per bucket the digits' low halves with the blocks of their documents."""

    def flush(held):
        digit, block = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        order = np.lexsort((block, digit))
        digit, block = digit[order], block[order]
        new = np.ones(len(digit), bool)
        new[1:] = (digit[1:] != digit[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        seen = np.minimum(np.diff(np.append(first, len(digit))), 2)  # two documents are as good as many
        digit, block = np.repeat(digit[first], seen), np.repeat(block[first], seen)
        bucket, low = _bucket(digit, buckets), (digit & _LOW).astype(np.uint32)
        order = np.lexsort((low, bucket))
        bucket, low, block = bucket[order], low[order], block[order].astype(np.uint32)
        rows = []
        for key, a, b in _cuts(bucket):
            steps = np.diff(low[a:b], prepend=np.uint32(0))
            rows.append((key, 0, 0, b - a, _pack(steps, block[a:b])))
        return _packed_batch(rows)

    def run(batches):
        held, size = [], 0
        for batch in slices(batches, "text", SLICE):
            texts = texts_as_bytes(batch.column("text"))
            found = Windows([tokens(t, unit) for t in texts], length)
            order = np.lexsort((found.digit, found.row))
            row, digit = found.row[order], found.digit[order]
            new = np.ones(len(row), bool)
            new[1:] = (digit[1:] != digit[:-1]) | (row[1:] != row[:-1])
            held.append((digit[new], batch.column("block").to_numpy()[row[new]]))
            size += sum(map(len, texts))
            if size > BLOCK_BYTES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return docs.select("block", "text").mapInArrow(tidied(run), _PACKED)


def _repeated_digits(digits: DataFrame) -> DataFrame:
    """Step 1, in: for each block the digits that stand in more than one document."""

    def run(batches):
        for bucket, rows in _by_key(batches, "bucket"):
            parts = []
            for row in rows:
                steps, block, _ = _unpack(row["payload"], row["n"], "u4", "u4")
                parts.append((np.cumsum(steps, dtype=np.uint32), block))
            low, block = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            _, place, count = np.unique(low, return_inverse=True, return_counts=True)
            again = count[place] > 1
            low, block, often = low[again], block[again], (count[place][again] > FREQUENT).astype(np.uint8)
            order = np.lexsort((low, block))
            low, block, often = low[order], block[order], often[order]
            new = np.ones(len(low), bool)
            new[1:] = (low[1:] != low[:-1]) | (block[1:] != block[:-1])
            low, block, often = low[new], block[new], often[new]
            yield _packed_batch([(bucket, key, 0, b - a, _pack(low[a:b], often[a:b])) for key, a, b in _cuts(block)])

    return digits.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(run), _PACKED)


def _ordered(left: pa.Table) -> pa.Table:
    return left.sort_by([("id", "ascending"), ("digest", "ascending")])


def _asked(length: int, unit: str, buckets: int):
    """Step 2: what a block sends on: tokens around repeated digits, and marks of copies inside it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        hand_back()
        rows = []
        known, often = [np.empty(0, np.uint64)], [np.empty(0, bool)]
        for r in right.to_pylist():
            low, flag, _ = _unpack(r["payload"], r["n"], "u4", "u1")
            known.append((np.uint64(r["bucket"]) << np.uint64(32)) | low)
            often.append(flag > 0)
        known, often = np.concatenate(known), np.concatenate(often)
        order = np.argsort(known)
        known, often = known[order], often[order]
        if len(left) and len(known):
            left = _ordered(left)
            block = left.column("block")[0].as_py()
            ids = left.column("id").to_numpy()
            found, base = [], 0
            for batch in slices(left.select(["text"]).to_batches(), "text", SLICE):
                found.append(_around(batch, base, ids, length, unit, buckets, known, often))
                base += batch.num_rows
            rows = _sent(found, block, buckets, length)
        return pa.Table.from_batches([_packed_batch(rows)])

    return run


def _around(batch, base, ids, length, unit, buckets, known, often):
    windows = Windows([tokens(t, unit) for t in texts_as_bytes(batch.column("text"))], length)
    place = (_bucket(windows.digit, buckets) << np.uint64(32)) | (windows.digit & _LOW)
    at = np.minimum(np.searchsorted(known, place), len(known) - 1)
    hit = known[at] == place
    row, begin, end, place, split = windows.row[hit], windows.begin[hit], windows.end[hit], place[hit], often[at[hit]]
    # text of a short period has one digit throughout: pieces of up to ``length`` windows, whose first and
    # last window hold all tokens; where the digit is split, one piece for each window, placed by all its tokens
    step = np.where(split, 1, length)
    sizes = -(-(end - begin + 1) // step)
    own = np.repeat(np.arange(len(row)), sizes)
    shift = (np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) * step[own]
    row, split, place, begin, end = row[own], split[own], place[own], begin[own] + shift, np.minimum(begin[own] + shift + step[own] - 1, end[own])
    if split.any():
        spread = mix(place ^ windows.whole[begin])
        place = np.where(split, (_bucket(spread, buckets) << np.uint64(32)) | (spread & _LOW), place)
    size = end - begin + length
    source = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    content = _join(windows.whole[begin], windows.whole[end]) + (end - begin).astype(np.uint64)
    return place, content, ids[base + row], base + row, begin - windows.first[row], size, windows.data[source]


def _equal_runs(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` values of ``data`` from ``a`` on are those from ``b`` on, for each pair."""
    equal = np.ones(len(a), bool)
    for part in np.split(np.arange(len(a)), np.flatnonzero(np.diff(np.cumsum(size) // SLICE)) + 1):
        if len(part):
            width = size[part]
            first = np.cumsum(width) - width
            step = np.arange(width.sum()) - np.repeat(first, width)
            equal[part] = ~np.logical_or.reduceat(data[np.repeat(a[part], width) + step] != data[np.repeat(b[part], width) + step], first)
    return equal


def _groups(place: np.ndarray, content: np.ndarray, ids: np.ndarray, size: np.ndarray, offset: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by place, content and id, the first of each group of equal tokens in it, and the contents told apart.

    Tokens of one hash are compared with the first of their group; where they differ the hash is changed,
    so that they form a group of their own.
    """
    while True:
        order = np.lexsort((ids, content, place))
        new = np.ones(len(order), bool)
        new[1:] = (place[order][1:] != place[order][:-1]) | (content[order][1:] != content[order][:-1])
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        pair = order != first
        same_size = size[order] == size[first]
        check = np.flatnonzero(pair & same_size)
        differs = pair & ~same_size
        differs[check] = ~_equal_runs(data, offset[order[check]], offset[first[check]], size[order[check]])
        if not differs.any():
            return order, new, content
        content = content.copy()
        content[order[differs]] = mix(content[order[differs]] + _P)


def _sent(found, block, buckets, length):
    place, content, ids, row, start, size = (np.concatenate([f[i] for f in found]) for i in range(6))
    data = np.concatenate([f[6] for f in found])
    offset = np.cumsum(size) - size
    order, new, content = _groups(place, content, ids, size, offset, data)
    group = np.cumsum(new) - 1
    lowest = ids[order][new][group] if len(order) else ids
    later = ids[order] > lowest
    marks = order[later]
    rows = [(block % buckets, block, 1, len(marks), _pack_marks(row[marks], start[marks], start[marks] + size[marks]))] if len(marks) else []
    order = order[~later]
    for bucket, a, b in _cuts((place[order] >> np.uint64(32)).astype(np.int64)):
        part = order[a:b]
        width = size[part]
        source = np.repeat(offset[part] - (np.cumsum(width) - width), width) + np.arange(width.sum())
        payload = _pack(
            (place[part] & _LOW).astype(np.uint32), content[part], ids[part].astype(np.int64), row[part].astype(np.uint32),
            start[part].astype(np.uint32), width.astype(np.uint32), np.frombuffer(data[source].tobytes(), np.uint8),
        )
        rows.append((bucket, block, 0, b - a, payload))
    return rows


def _pack_marks(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    order = np.lexsort((start, row))
    return _pack(*(a[order].astype(np.uint32) for a in (row, start, stop)))


def _sorted_groups(groups: np.ndarray, at: np.ndarray, ids: np.ndarray, data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Step 3: numbers of the suffixes in repeated runs, and the smallest document of each one's run.

    One pass a digit of eight bytes, most significant first, over suffixes that start at byte ``at``;
    groups of one document are dropped after each pass. The last digit may be shorter.
    """
    eight = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))
    left = np.arange(len(at))
    lowest = ids
    for shift in range(0, width, 8):
        value = eight[at[left] + shift].astype(np.uint64) >> np.uint64(max(0, 8 * (shift + 8 - width)))
        order = np.lexsort((value, groups))
        left, groups, value = left[order], groups[order], value[order]
        new = np.ones(len(left), bool)
        new[1:] = (groups[1:] != groups[:-1]) | (value[1:] != value[:-1])
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        if len(first):
            lowest = np.minimum.reduceat(ids[left], first)[number]
            several = (np.maximum.reduceat(ids[left], first)[number]) > lowest
            left, groups, lowest = left[several], number[several], lowest[several]
    return left, lowest


def _compared(length: int, unit: str):
    """Steps 2 and 3, in: marks for each block from the tokens that met in a bucket."""
    item = 1 if unit == "bytes" else 8

    def resolve(rows: list[dict]) -> list[tuple]:
        parts = [_unpack(r["payload"], r["n"], "u4", "u8", "i8", "u4", "u4", "u4") for r in rows]
        place, content, ids, row, start, size = (np.concatenate([p[i] for p in parts]) for i in range(6))
        size, start = size.astype(np.int64), start.astype(np.int64)
        data = np.concatenate([*(p[6] for p in parts), np.zeros(8, np.uint8)])
        block = np.repeat([r["block"] for r in rows], [r["n"] for r in rows])
        offset = (np.cumsum(size) - size) * item
        order, new, content = _groups(place, content, ids, size * item, offset, data)
        place, content, ids, row, start, size, block, offset = (a[order] for a in (place, content, ids, row, start, size, block, offset))
        number = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        later = ids > ids[first][number]
        marks = [(block[later], row[later], start[later], start[later] + size[later])]
        # different tokens around one digit: sort the suffixes of one occurrence of each
        fresh_place = np.append(True, place[first][1:] != place[first][:-1])
        group = np.cumsum(fresh_place) - 1
        several = np.bincount(group)[group] > 1
        chosen, group = first[several], group[several]
        count = size[chosen] - length + 1
        owner = np.repeat(np.arange(len(chosen)), count)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        if len(owner):
            found, lowest = _sorted_groups(group[owner], offset[chosen][owner] + item * shift, ids[chosen][owner], data, item * length)
            found = np.sort(found[ids[chosen][owner[found]] > lowest])
            begin = np.ones(len(found), bool)
            begin[1:] = (owner[found][1:] != owner[found][:-1]) | (shift[found][1:] != shift[found][:-1] + 1)
            at = np.flatnonzero(begin)
            from_, to = shift[found][at], shift[found][np.append(at[1:], len(found)) - 1] + length if len(at) else at
            run_owner = chosen[owner[found[at]]]
            # every occurrence in the same document has the same marks
            same = np.bincount(number[~later], minlength=len(first))[number[run_owner]]
            which = np.repeat(np.arange(len(run_owner)), same)
            member = run_owner[which] + np.arange(len(which)) - np.repeat(np.cumsum(same) - same, same)
            marks.append((block[member], row[member], start[member] + from_[which], start[member] + to[which]))
        block, row, start, stop = (np.concatenate([m[i] for m in marks]) for i in range(4))
        order = np.argsort(block, kind="stable")
        block, row, start, stop = (a[order] for a in (block, row, start, stop))
        return [(0, key, 1, b - a, _pack_marks(row[a:b], start[a:b], stop[a:b])) for key, a, b in _cuts(block)]

    def run(batches):
        for _, rows in _by_key(batches, "bucket"):
            out = [tuple(r[c] for c in _PACKED_NAMES) for r in rows if r["kind"] == 1]
            if asked := [r for r in rows if r["kind"] == 0]:
                out += resolve(asked)
            yield _packed_batch(out)

    return run


def _merged(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals by row: touching ones are one."""
    order = np.lexsort((start, row))
    row, start, stop = row[order].astype(np.int64), start[order].astype(np.int64), stop[order].astype(np.int64)
    far = np.int64(1) << 32  # rows laid one behind another, so that one running maximum serves all
    reach = np.maximum.accumulate(row * far + stop) if len(row) else row
    new = np.ones(len(row), bool)
    new[1:] = row[1:] * far + start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(row)) - 1
    return row[at], start[at], (reach[last] - row[at] * far) if len(at) else at


def _marked(length: int, unit: str, finish):
    """Step 4: ``finish(table, spans)`` for a block; ``spans`` maps a row to byte offsets [[start, stop]]."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        hand_back()
        left = _ordered(left)
        parts = [_unpack(r["payload"], r["n"], "u4", "u4", "u4")[:3] for r in right.to_pylist()]
        spans: dict[int, np.ndarray] = {}
        if parts and len(left):
            row, start, stop = _merged(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
            text = left.column("text")
            for key, a, b in _cuts(row):
                pair = np.stack([start[a:b], stop[a:b]], 1)
                if unit == "words":
                    first, last = word_bounds((text[key].as_py() or "").encode())
                    pair = np.stack([first[pair[:, 0]], last[pair[:, 1] - 1]], 1)
                spans[key] = pair
        return finish(left, spans)

    return run


def _cut(text: bytes, spans: np.ndarray | None) -> bytes:
    if spans is None:
        return text
    at, kept = 0, []
    for start, stop in spans.tolist():
        kept.append(text[at:start])
        at = stop
    return b"".join([*kept, text[at:]])


def _plan(docs: DataFrame, carried: list[str], doc_id: str, text: str, length: int, unit: str, finish, schema: str) -> DataFrame:
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    blocks, buckets = -(-total // BLOCK_BYTES) or 1, -(-total // BUCKET_BYTES) or 1
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID))
    own = F.struct(*[F.col(f"`{c}`") for c in carried])
    # the id also takes part in the digest: equal digests are equal rows, whichever comes first
    frame = docs.select(
        F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"),
        key.alias("id"),
        F.xxhash64(F.col(f"`{text}`"), own).alias("digest"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        own.alias("own"),
    )
    repeated_digits = _repeated_digits(_digits(frame, length, unit, buckets))
    asked = frame.groupBy("block").cogroup(repeated_digits.groupBy("block")).applyInArrow(_asked(length, unit, buckets), _PACKED)
    answers = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(_compared(length, unit)), _PACKED)
    return frame.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_marked(length, unit, finish), schema)


def repeated(docs: DataFrame, length: int = 50, unit: str = "bytes", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256``.

    ``spans`` are the byte offsets of the marked runs, ``kept_sha256`` is of the bytes outside of them.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>, kept_sha256 string"

    def finish(left: pa.Table, spans: dict[int, np.ndarray]) -> pa.Table:
        out = {name: [] for name in ("doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")}
        row = 0
        for batch in left.select(["id", "text"]).to_batches(max_chunksize=500):
            for number, value in zip(batch.column("id").to_pylist(), texts_as_bytes(batch.column("text"))):
                found = spans.get(row)
                kept = _cut(value, found)
                out["doc_id"].append(None if number == NO_ID else number)
                out["n_bytes"].append(len(value))
                out["n_removed"].append(len(value) - len(kept))
                out["n_spans"].append(0 if found is None else len(found))
                out["spans"].append([] if found is None else [{"start": a, "stop": b} for a, b in found.tolist()])
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                row += 1
        pair = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pair), pa.string()]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    return _plan(docs, [doc_id], doc_id, text, length, unit, finish, schema)


def remove_repeated(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the marked runs of ``length`` words cut from the text; null texts stay null."""
    names = docs.columns
    cut = fresh("cut", names)
    schema = ddl(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("own")), f"`{cut}` string")

    def finish(left: pa.Table, spans: dict[int, np.ndarray]) -> pa.Table:
        texts = left.column("text").to_pylist()
        new = [_cut(t.encode(), spans[row]).decode() if row in spans else None for row, t in enumerate(texts)]
        return pa.table([left.column("own"), pa.array(new, pa.string())], names=["own", cut])

    found = _plan(docs, names, doc_id, text, length, "words", finish, schema)
    own = [F.coalesce(F.col(cut), F.col(f"own.`{c}`")).alias(c) if c == text else F.col(f"own.`{c}`") for c in names]
    return found.select(*own)
