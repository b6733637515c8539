"""Suffix arrays by induced sorting, and exact removal of long byte strings that repeat across a corpus.

A suffix array of the whole corpus would be one unbounded sort. Here each window of ``length`` bytes is
assigned to an anchor inside it: the byte 24-gram with the smallest hash. Equal windows have equal
anchors, so an anchor's hash names the shard in which all copies of a window meet, and anchors that
occur once leave early. A shard holds each different stretch of text around an anchor once, sorts
its suffixes by induced sorting, and reads repeated windows off the permuted common prefixes.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from caskline.llm.common import WORD, make_folder, new_folder, open_shared, powers, slices, spread, staged, text_bytes, written_shared

LENGTH, GRAM = 100, 24
#: Text of a block, of which a task handles one at a time; text whose anchors form a shard; bytes sorted at once.
BLOCK_BYTES, SHARD_BYTES, SORT_BYTES = 2 << 20, 32 << 20, 2 << 20
#: From so many occurrences on, an anchor's windows are told apart one by one, each in a shard of its own.
HOT = 50_000
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


# Suffix arrays


def _split(targets: np.ndarray, values: np.ndarray, queues: list[list[np.ndarray]]) -> None:
    """Append values to the queues of their characters, in the order given."""
    order = np.argsort(targets, kind="stable")
    targets, values = targets[order], values[order]
    cuts = np.flatnonzero(targets[1:] != targets[:-1]) + 1
    for part, c in zip(np.split(values, cuts), targets[np.concatenate([[0], cuts])].tolist(), strict=True):
        queues[c].append(part)


def _induce(text: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, width: int) -> np.ndarray:
    """Sort all suffixes, given the leftmost S-type ones in ``seeds`` in their order.

    L-type suffixes are induced from the smallest character up, S-type ones from the largest down. A
    character's bucket is complete before its suffixes induce others, so each bucket is one vector step
    (and one more for every repetition of the character).
    """
    none = np.empty(0, np.int64)
    ahead: list[list[np.ndarray]] = [[] for _ in range(width)]
    stems: list[list[np.ndarray]] = [[] for _ in range(width)]
    if len(seeds):
        _split(text[seeds], seeds, stems)
    larger: list[np.ndarray] = [none] * width
    for c in range(width):
        wave, bucket = np.concatenate(ahead[c]) if ahead[c] else none, []
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            before = before[~is_s[before]]
            same = text[before] == c
            if not same.all():
                _split(text[before[~same]], before[~same], ahead)
            wave = before[same]
        larger[c] = np.concatenate(bucket) if bucket else none
        for stem in stems[c]:
            before = stem[stem > 0] - 1
            before = before[~is_s[before]]
            if len(before):
                _split(text[before], before, ahead)
    behind: list[list[np.ndarray]] = [[] for _ in range(width)]
    out: list[np.ndarray] = [none] * width
    for c in range(width - 1, -1, -1):
        wave, bucket = np.concatenate(behind[c]) if behind[c] else none, []
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            before = before[is_s[before]]
            same = text[before] == c
            if not same.all():
                _split(text[before[~same]], before[~same], behind)
            wave = before[same]
        back = larger[c][::-1]
        before = back[back > 0] - 1
        before = before[is_s[before]]
        if len(before):
            _split(text[before], before, behind)
        smaller = np.concatenate(bucket)[::-1] if bucket else none
        out[c] = np.concatenate([larger[c], smaller])
    # The end mark is the smallest suffix; nothing stands after it that could induce it.
    out[0] = np.concatenate([[len(text) - 1], out[0][out[0] != len(text) - 1]])
    return np.concatenate(out)


def _names(text: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number sorted substrings (start -> inclusive end), equal ones alike."""
    n = len(text)
    a, b = order[:-1], order[1:]
    length = ends[a] - a
    differ = length != ends[b] - b
    left = np.flatnonzero(~differ)
    step = 0
    while len(left):
        unequal = text[np.minimum(a[left] + step, n - 1)] != text[np.minimum(b[left] + step, n - 1)]
        differ[left[unequal]] = True
        left = left[~unequal & (length[left] > step)]
        step += 1
    return np.concatenate([[0], np.cumsum(differ)])


def _rank(names: np.ndarray, rounds: int) -> np.ndarray:
    """Order of the suffixes of a string of names: each level names neighbouring pairs, which halves the
    string that is left to tell apart, until all differ or ``rounds`` levels are told apart."""
    step = 1
    for _ in range(rounds):
        if len(names) == 0 or names.max() == len(names) - 1:
            break
        following = np.zeros(len(names), np.int64)
        following[:-step] = names[step:] + 1
        names = np.unique(names * np.int64(len(names) + 1) + following, return_inverse=True)[1]
        step *= 2
    return np.argsort(names, kind="stable")


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix array of small non-negative integers by induced sorting.

    Suffixes are classified, the leftmost S-type substrings sorted by induction and named, the string of
    names sorted by prefix doubling (``_rank``; the dealt method recurses here), and all suffixes induced from it. With ``depth``, suffixes that agree in so
    many characters may stand in any order.
    """
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    text = np.concatenate([text.astype(np.int32) + 1, [0]]).astype(np.int32)
    width = int(text.max()) + 1
    text = text.astype(np.uint16) if width < 1 << 16 else text
    change = np.flatnonzero(text[1:] != text[:-1])
    rising = text[change + 1] > text[change]
    is_s = np.ones(n + 1, bool)
    is_s[:-1] = rising[np.searchsorted(change, np.arange(n))]
    left = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    first = _induce(text, is_s, left, width)
    is_left = np.zeros(n + 1, bool)
    is_left[left] = True
    order = first[is_left[first]]
    ends = np.zeros(n + 1, np.int64)
    ends[left] = np.append(left[1:], n)
    named = np.zeros(n + 1, np.int64)
    named[order] = _names(text, order, ends)
    # A leftmost S-type substring advances two characters at least.
    rounds = 64 if depth is None else max(1, int(np.ceil(np.log2(depth / 2 + 1))) + 1)
    seeds = left[_rank(named[left], rounds)]
    return _induce(text, is_s, seeds, width)[1:]


def permuted_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each position of the text, the bytes its suffix shares with the one before it in the suffix
    array, at most ``most`` (rounded down to whole steps of 8 where fewer)."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, data.dtype)]).astype(np.uint64)
    word = np.zeros(n + most + 16, np.uint64)
    for k in range(8):
        word[:n] = (word[:n] << _U(8)) | padded[k : k + n]
    previous = np.full(n, -1, np.int64)
    previous[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    at = np.flatnonzero(previous >= 0)
    for step in [*range(0, most - 7, 8), most - 8]:
        at = at[word[at + step] == word[previous[at] + step]]
        out[at] = step + 8
    return out


# Anchors


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first smallest value in every stretch of ``width``."""
    index, size = np.arange(len(values), dtype=np.int32), 1
    while 2 * size <= width:
        later = values[size:] < values[:-size]
        index = np.where(later, index[size:], index[:-size])
        values = np.where(later, values[size:], values[:-size])
        size *= 2
    rest = width - size
    return np.where(values[rest:] < values[:-rest], index[rest:], index[:-rest]) if rest else index


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    parts, size = {1: data.astype(np.uint64) + _U(1)}, 1
    while 2 * size <= k:
        x = parts[size]
        parts[2 * size] = x[:-size] + x[size:] * _U(pow(_BASE, size, 1 << 64))
        size *= 2
    out, done = parts[size], size
    n = len(data) - k + 1
    for bit in sorted(parts, reverse=True):
        if done + bit <= k:
            out = out[: len(parts[bit]) - done] + parts[bit][done:][: len(out)] * _U(pow(_BASE, done, 1 << 64))
            done += bit
    return spread(out[:n])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first window, last window) of every anchor; each window of each text has one anchor."""
    sizes = np.maximum(np.diff(bounds) - length + 1, 0)
    none = np.empty(0, np.int64)
    if not sizes.any():
        return none.astype(np.uint64), none, none, none
    hashes = _gram_hashes(data, gram)
    lowest = _minima(hashes, length - gram + 1)
    window = np.repeat(bounds[:-1] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    anchor = lowest[window]
    row = np.repeat(np.arange(len(sizes)), sizes)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))
    last = np.append(new[1:], len(anchor)) - 1
    return hashes[anchor[new]], row[new], window[new], window[last]


class _Stretches:
    """Hashes of any stretches of a text."""

    def __init__(self, data: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + _U(1)) * powers(len(data), _BASE), dtype=np.uint64)])
        self.back = powers(len(data) + 1, pow(_BASE, -1, 1 << 64))

    def hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        lengths = (end - begin).astype(np.uint64)
        return spread((self.sums[end] - self.sums[begin]) * self.back[begin] + lengths * _U(0xD6E8FEB86659FD93))


# Blocks of texts in the shared folder


def _read_block(path: str) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    with open_shared(path) as source:
        rows = pq.read_table(source)
    data, bounds = text_bytes(rows.column("text").combine_chunks())
    return rows, data, bounds


def _doc_order(rows: pa.Table) -> np.ndarray:
    """Rank of each row by id (null last), then by text hash; rows that repeat both share a rank."""
    missing = rows.column("id").is_null().to_numpy()
    ids = rows.column("id").fill_null(0).to_numpy()
    prints = rows.column("print").to_numpy()
    order = np.lexsort((prints, ids, missing))
    keys = np.stack([missing, ids, prints])[:, order]
    ranks = np.empty(len(ids), np.int64)
    ranks[order] = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(0))])[: len(ids)]
    return ranks


def _bytes(values: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _frame(rows: list[tuple], names: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names.split())


def _write_blocks(folder: str, shards: int, length: int, gram: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for number, batch in enumerate(slices(batches, "text", block_bytes)):
            path = f"{folder}/{part:06d}-{number:05d}"
            buffer = io.BytesIO()
            pq.write_table(pa.Table.from_batches([batch]), buffer, compression="zstd", compression_level=1)
            with written_shared(path) as out:
                out.write(buffer.getvalue())
            data, bounds = text_bytes(batch.column("text"))
            hashes, counts = np.unique(anchors(data, bounds, length, gram)[0], return_counts=True)
            home = (hashes % _U(shards)).astype(np.int64)
            present = np.unique(home).tolist() or [0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path] * len(present)),
                    pa.array(present, pa.int32()),
                    pa.array([_bytes(hashes[home == s], np.uint64) for s in present], pa.binary()),
                    pa.array([_bytes(counts[home == s], np.uint32) for s in present], pa.binary()),
                ],
                names=["block", "shard", "hashes", "counts"],
            )

    return run


def _find_repeated(hot: int):
    """Which of a shard's anchors occur again (1) or very often (2)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, np.uint64) for x in group["hashes"]]
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in group["counts"]]).astype(np.int64)
        _, which = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(which, counts, 1)[which] if len(which) else np.empty(0)
        marks = (total > 1).astype(np.uint8) + (total >= hot).astype(np.uint8)
        cuts = np.cumsum([len(x) for x in parts])[:-1]
        return _frame(
            [(b, s, m.tobytes()) for b, s, m in zip(group["block"], group["shard"], np.split(marks, cuts), strict=True)], "block shard marks"
        )

    return run


def _list_units(shards: int, length: int, gram: int):
    """Of a block's repeated anchors: stretches that first occur here go to their shards; others are
    known to be copies. The list of stretches is kept beside the block."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        (path,) = key
        rows, data, bounds = _read_block(path)
        hashes, row, begin, last = anchors(data, bounds, length, gram)
        known, which = np.unique(hashes, return_inverse=True)
        home = (known % _U(shards)).astype(np.int64)
        marks = np.zeros(len(known), np.uint8)
        for shard, mark in zip(group["shard"], group["marks"], strict=True):
            marks[home == shard] = np.frombuffer(mark, np.uint8)
        mark = marks[which] if len(known) else np.empty(0, np.uint8)
        text = _Stretches(data)
        usual, often = np.flatnonzero(mark == 1), np.flatnonzero(mark == 2)
        sizes = (last - begin + 1)[often]
        window = np.repeat(begin[often] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        begin = np.concatenate([begin[usual], window]).astype(np.int64)
        end = np.concatenate([last[usual] + length, window + length]).astype(np.int64)
        row = np.concatenate([row[usual], np.repeat(row[often], sizes)]).astype(np.int64)
        print_ = text.hash(begin, end)
        anchor = np.concatenate([hashes[usual], spread(print_[len(usual) :] ^ _U(_BASE))])
        place = begin - bounds[row]
        rank = _doc_order(rows)[row]
        order = np.lexsort((place, rank, print_, anchor))
        same = (anchor[order][1:] == anchor[order][:-1]) & (print_[order][1:] == print_[order][:-1])
        head = np.flatnonzero(np.concatenate([[True], ~same]))[: len(order)]
        leader = order[np.repeat(head, np.diff(np.append(head, len(order))))]
        first = np.ones(len(order), bool)
        first[order] = (rank[order] == rank[leader]) & (place[order] == place[leader])
        where = (anchor % _U(shards)).astype(np.int64)
        sent = np.flatnonzero(first)
        sent = sent[np.argsort(where[sent], kind="stable")]
        buffer = io.BytesIO()
        np.savez(buffer, begin=begin.astype(np.int32 if len(data) < 1 << 31 else np.int64), end=end.astype(np.int32 if len(data) < 1 << 31 else np.int64), row=row.astype(np.int32), sent=sent.astype(np.int32), first=first, home=where[sent].astype(np.int32))
        with written_shared(f"{path}.units") as out:
            out.write(buffer.getvalue())
        missing = rows.column("id").is_null().to_numpy()
        ids, prints = rows.column("id").fill_null(0).to_numpy(), rows.column("print").to_numpy()
        found = []
        for shard in np.unique(where[sent]).tolist() or [0]:
            u = sent[where[sent] == shard]
            found.append(
                (path, shard, _bytes(anchor[u], np.uint64), _bytes(print_[u], np.uint64), _bytes(missing[row[u]], np.uint8), _bytes(ids[row[u]], np.int64), _bytes(prints[row[u]], np.int64), _bytes(place[u], np.int64))
            )
        return _frame(found, "block shard anchors prints missing ids texts places")

    return run


_UNITS = "block string, shard int, anchors binary, prints binary, missing binary, ids binary, texts binary, places binary"


def _joined(column: pd.Series, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in column]) if len(column) else np.empty(0, kind)


def _find_first(group: pd.DataFrame) -> pd.DataFrame:
    """Of a shard's stretches: 1 if the same occurs earlier, 2 if it is first and others have its anchor,
    0 if it is first and alone. With 2 comes what to group the sorting by."""
    anchor, print_ = _joined(group["anchors"], np.uint64), _joined(group["prints"], np.uint64)
    by = [_joined(group["places"], np.int64), _joined(group["texts"], np.int64), _joined(group["ids"], np.int64), _joined(group["missing"], np.uint8)]
    order = np.lexsort((*by, print_, anchor))
    change = lambda x: x[order][1:] != x[order][:-1]
    new_anchor = np.concatenate([[True], change(anchor)])[: len(order)]
    new_print = new_anchor | np.concatenate([[True], change(print_)])[: len(order)]
    head = np.flatnonzero(new_print)
    leader = order[np.repeat(head, np.diff(np.append(head, len(order))))]
    later = np.zeros(len(order), bool)
    for x in by:
        later |= x[order] != x[leader]
    group_of = np.cumsum(new_anchor) - 1
    kinds = np.bincount(group_of, new_print) if len(order) else np.empty(0)
    flags = np.empty(len(order), np.uint8)
    flags[order] = np.where(later, 1, np.where(kinds[group_of] > 1, 2, 0) if len(order) else 0)
    cuts = np.cumsum([len(x) // 8 for x in group["anchors"]])[:-1]
    found = []
    for b, s, f, a in zip(group["block"], group["shard"], np.split(flags, cuts), np.split(anchor, cuts), strict=True):
        keys = (spread(a[f == 2]) >> _U(32)).astype(np.uint32)
        found.append((b, s, f.tobytes(), keys.tobytes(), len(keys)))
    return _frame(found, "block shard flags keys open")


def _send_stretches(sorts: int):
    """The bytes of a block's stretches whose windows must be sorted, by sorting group."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        (path,) = key
        names = "sort block units missing ids texts places sizes bytes"
        if not group["open"].sum():
            return _frame([], names)
        rows, data, bounds = _read_block(path)
        with open_shared(f"{path}.units") as source:
            u = np.load(io.BytesIO(source.read()))
        missing = rows.column("id").is_null().to_numpy()
        ids, prints = rows.column("id").fill_null(0).to_numpy(), rows.column("print").to_numpy()
        units, homes = [], []
        for shard, flags, keys in zip(group["shard"], group["flags"], group["keys"], strict=True):
            own = u["sent"][u["home"] == shard]
            units.append(own[np.frombuffer(flags, np.uint8) == 2])
            homes.append(np.frombuffer(keys, np.uint32) % sorts)
        unit, home = np.concatenate(units), np.concatenate(homes)
        begin, end, row = u["begin"][unit].astype(np.int64), u["end"][unit].astype(np.int64), u["row"][unit]
        found = []
        for s in np.unique(home).tolist():
            k = np.flatnonzero(home == s)
            r = row[k]
            found.append(
                (s, path, _bytes(unit[k], np.int32), _bytes(missing[r], np.uint8), _bytes(ids[r], np.int64), _bytes(prints[r], np.int64), _bytes(begin[k] - bounds[r], np.int64), _bytes(end[k] - begin[k], np.int32), b"".join(data[b:e].tobytes() for b, e in zip(begin[k].tolist(), end[k].tolist(), strict=True)))
            )
        return _frame(found, names)

    return run


def repeated_windows(data: np.ndarray, sizes: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, first, last) of runs of windows that also occur in a stretch of smaller rank.

    ``data`` holds the stretches one after another. A mark between them ends every suffix, so windows
    with the same bytes stand together in the suffix array.
    """
    n = len(sizes)
    starts = np.cumsum(sizes) - sizes
    shift = np.repeat(np.arange(n), sizes)
    text = np.zeros(len(data) + n, np.int32)
    at = np.arange(len(data)) + shift
    text[at] = data.astype(np.int32) + 1
    begins = starts + np.arange(n)
    is_window = np.zeros(len(text), bool)
    many = sizes - length + 1
    windows = np.repeat(begins - np.cumsum(many) + many, many) + np.arange(many.sum())
    is_window[windows] = True
    owner = np.zeros(len(text), np.int64)
    owner[at] = shift
    order = suffix_array(text, length)
    plain = np.zeros(len(text), np.uint8)
    plain[at] = data
    shared = permuted_prefixes(plain, order, length)
    order = order[is_window[order]]
    # Windows with equal bytes are neighbours, and no other suffix stands between them.
    new = shared[order] < length
    new[:1] = True
    head = np.flatnonzero(new)
    least = np.minimum.reduceat(rank[owner[order]], head)[np.cumsum(new) - 1]
    copied = np.zeros(len(text) + 1, bool)
    copied[order] = rank[owner[order]] > least
    edge = np.diff(np.concatenate([[False], copied]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    # Stretches lie apart by more than a window's start, so a run lies in one of them.
    of = owner[first]
    return of, first - begins[of], last - begins[of]


def _sort_stretches(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sizes = _joined(group["sizes"], np.int32).astype(np.int64)
        by = [_joined(group["places"], np.int64), _joined(group["texts"], np.int64), _joined(group["ids"], np.int64), _joined(group["missing"], np.uint8)]
        order = np.lexsort(by)
        new = np.zeros(len(order), bool)
        for x in by:
            new[1:] |= x[order][1:] != x[order][:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        of, first, last = repeated_windows(_joined(group["bytes"], np.uint8), sizes, rank, length)
        unit = _joined(group["units"], np.int32)
        block = np.repeat(np.arange(len(group)), [len(x) // 4 for x in group["units"]])[of]
        found = []
        for b in np.unique(block).tolist():
            k = block == b
            found.append((group["block"].iloc[b], _bytes(unit[of[k]], np.int32), _bytes(first[k], np.int32), _bytes(last[k], np.int32)))
        return _frame(found, "block units firsts lasts")

    return run


def _cut_out(length: int):
    """Remove what is covered, and describe what is left of each row of a block."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        path = key[0].as_py()
        rows, data, bounds = _read_block(path)
        with open_shared(f"{path}.units") as source:
            u = np.load(io.BytesIO(source.read()))
        begin, end = u["begin"].astype(np.int64), u["end"].astype(np.int64)
        whole = ~u["first"]
        depth = np.zeros(len(data) + 1, np.int64)
        for x in group.to_pylist():
            if x["flags"] is not None:
                whole[u["sent"][u["home"] == x["shard"]][np.frombuffer(x["flags"], np.uint8) == 1]] = True
            else:
                unit = np.frombuffer(x["units"], np.int32)
                np.add.at(depth, begin[unit] + np.frombuffer(x["firsts"], np.int32), 1)
                np.add.at(depth, begin[unit] + np.frombuffer(x["lasts"], np.int32) + length, -1)
        np.add.at(depth, begin[whole], 1)
        np.add.at(depth, end[whole], -1)
        gone = np.cumsum(depth)[:-1] > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = bounds[:-1][bounds[:-1] < len(data)]
        opens[inner] = gone[inner]
        totals = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[bounds])
        kept = [data[b:e][~gone[b:e]].tobytes() for b, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        out = {
            "row": rows.column("row"),
            "n_bytes": np.diff(bounds),
            "n_removed": totals(gone),
            "n_spans": totals(opens),
            "kept": pa.array(kept, pa.binary()),
            "kept_text": pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()),
        }
        return pa.table(out)

    return run


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Remove every byte of every text that a string of ``length`` bytes covers which also starts earlier:
    in a text of smaller id, or further ahead in the same text. Strings are judged on the input.

    Returns row (a struct of the row's columns but the text), n_bytes, n_removed, n_spans, kept (the
    bytes that stay; a cut may fall inside a character) and kept_text (without such parts). Null and empty texts keep nothing of nothing; texts shorter than
    ``length`` stay whole. A null id comes after all others; texts of one id follow each other by their
    hash; rows that repeat id and text count once, and each gives that one result.

    Texts are written as blocks to the shared folder and read from there by each step; what travels
    between steps is 8 bytes for each anchor, then a record for each stretch around a repeated anchor, and
    the bytes of those whose windows only sorting can tell. The order of rows in a scan is the blocks'.
    """
    spark = docs.sparkSession
    others = [docs[c] for c in docs.columns if c != text_col]
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("print"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.struct(*others).alias("row"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    folder = new_folder(spark, "suffix-blocks")
    make_folder(folder)
    written = rows.mapInArrow(_write_blocks(folder, shards, length, gram, block_bytes), "block string, shard int, hashes binary, counts binary")
    marks = staged(written.groupBy("shard").applyInPandas(_find_repeated(hot), "block string, shard int, marks binary"), "suffix-marks")
    units = marks.groupBy("block").applyInPandas(_list_units(shards, length, gram), _UNITS)
    flags = staged(units.groupBy("shard").applyInPandas(_find_first, "block string, shard int, flags binary, keys binary, open long"), "suffix-flags")
    still = flags.agg(F.sum("open")).first()[0] or 0
    sorts = max(1, -(-still * (length + (length - gram) // 2) // SORT_BYTES))
    sent = flags.groupBy("block").applyInPandas(
        _send_stretches(sorts), "sort int, block string, units binary, missing binary, ids binary, texts binary, places binary, sizes binary, bytes binary"
    )
    runs = staged(sent.groupBy("sort").applyInPandas(_sort_stretches(length), "block string, units binary, firsts binary, lasts binary"), "suffix-runs")
    none = F.lit(None).cast("binary")
    parts = flags.select("block", "shard", "flags", none.alias("units"), none.alias("firsts"), none.alias("lasts")).unionByName(
        runs.select("block", F.lit(None).cast("int").alias("shard"), none.alias("flags"), "units", "firsts", "lasts")
    )
    row = rows.schema["row"].dataType.simpleString()
    return parts.groupBy("block").applyInArrow(
        _cut_out(length), f"row {row}, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string"
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with what stays of their texts; rows of which no word stays are left out."""
    cut = remove_repeats(docs, id_col=id_col, text_col=text_col, **how)
    left = cut.where(F.col("kept_text").rlike(WORD))
    return left.select(*[(F.col("kept_text") if c == text_col else F.col(f"row.{c}")).alias(c) for c in docs.columns])
