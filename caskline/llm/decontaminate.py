"""Benchmark decontamination by latent semantic retrieval, subsequence and answer checks."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType

from caskline.llm.common import make_folder, new_folder, open_shared, slices, staged, text_bytes, word_hashes, written_shared

#: Words of half a window; a window is two halves, and windows overlap by one.
HALF = 16
#: Words of a benchmark passage at most, passages that share a latent space, and the space's rank at most
#: (a quarter of its passages if they are fewer: a rank near theirs would only give the cosines of their words).
PASSAGE, BANK, RANK = 64, 256, 64
#: Words in more than these shares of all documents and of all different items (three at least) carry no weight.
COMMON, COMMON_ITEMS = 0.2, 0.05
#: Least cosine of a candidate; common subsequence that is a leak by itself; and one that is with the answer.
COSINE, SURE, LIKELY = 0.4, 0.8, 0.6
#: Passages of up to so many words are leaks where all their words stand in a row, and not otherwise.
FEW = 8
_PIECE = 2 << 20
#: Numbers gathered at once, and bytes of banks that a task keeps; further banks are read for every piece of text.
_GATHER, _KEEP = 1 << 18, 64 << 20

_CODE = np.arange(256)
_IS_WORD = ((_CODE >= 0x30) & (_CODE <= 0x39)) | ((_CODE | 0x20) >= 0x61) & ((_CODE | 0x20) <= 0x7A) | (_CODE >= 0x80)
_LOWER = np.where((_CODE >= 0x41) & (_CODE <= 0x5A), _CODE | 0x20, _CODE).astype(np.uint8)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(column)
    return word_hashes(_LOWER[data], bounds, _IS_WORD)


class Vocabulary:
    """Numbers for the words of the benchmark (64-bit hashes), found by a table of their low bits."""

    def __init__(self, words: np.ndarray):
        self.words = np.unique(words)
        self.bits = np.uint64((1 << max(12, int(4 * len(self.words)).bit_length())) - 1)
        self.table = np.zeros(int(self.bits) + 1, np.int32)
        low = self.words & self.bits
        self.table[low] = np.arange(len(self.words), dtype=np.int32) + 1
        lost = self.words[self.table[low] - 1] != self.words
        self.rest = dict(zip(self.words[lost].tolist(), np.flatnonzero(lost).tolist(), strict=True))
        self.rest_low = np.unique(low[lost])

    def __len__(self) -> int:
        return len(self.words)

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words of no benchmark item."""
        if not len(self.words):
            return np.full(len(words), -1, np.int32)
        low = words & self.bits
        out = self.table[low] - 1
        out[self.words[out] != words] = -1
        if self.rest:
            odd = np.flatnonzero((out < 0) & np.isin(low, self.rest_low))
            out[odd] = [self.rest.get(w, -1) for w in words[odd].tolist()]
        return out


def document_frequencies(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all documents each word of the vocabulary stands, and the number of documents.

    Counts are summed in each task and then by word; one number for each word of the benchmark returns.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows, size = np.zeros(len(vocabulary), np.int64), 0, max(1, len(vocabulary))
        for batch in slices(batches, text_col, _PIECE):
            words, first = _words(batch.column(text_col))
            number = vocabulary.numbers(words)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            found = number >= 0
            seen = np.unique(row[found] * size + number[found])
            total += np.bincount(seen % size, minlength=size)[: len(total)]
            rows += len(first) - 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"word": np.append(some, -1), "n": np.append(total[some], rows)})

    counts = np.zeros(len(vocabulary), np.int64)
    rows = 0
    for r in docs.select(text_col).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        if r["word"] < 0:
            rows = r["n"]
        else:
            counts[r["word"]] = r["n"]
    return counts, rows


def randomised_svd(spark, passages: Sequence[np.ndarray], width: int, rank: int, extra: int = 10, powers: int = 2, seed: int = 3) -> np.ndarray:
    """Right singular vectors (width x rank) of sparse rows, by random projection and power iterations.

    ``passages`` are rows of (column, weight) pairs. Spark multiplies its parts of the rows; the driver
    adds the parts' products and orthogonalises, so it holds width x (rank + extra) numbers, never rows.
    """
    if not len(passages):
        return np.zeros((width, 0))
    size = min(rank + extra, width, len(passages))
    parts = min(4, len(passages))
    frame = staged(
        spark.createDataFrame([(k, r["column"].tolist(), r["weight"].tolist()) for k, r in enumerate(passages)], "k int, c array<int>, w array<double>"),
        "svd-rows",
    ).repartition(parts)

    def product(basis: np.ndarray, gram: bool) -> np.ndarray:
        """A'A basis, or with ``gram`` the small matrix (A basis)'(A basis)."""

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((basis.shape[1] if gram else width, basis.shape[1]))
            for batch in batches:
                for c, w in zip(batch.column("c").to_pylist(), batch.column("w").to_pylist(), strict=True):
                    y = np.asarray(w) @ basis[c]
                    if gram:
                        out += np.outer(y, y)
                    else:
                        out[c] += np.outer(w, y)
            yield pa.RecordBatch.from_pydict({"part": pa.array([out.tobytes()], pa.binary())})

        total = sum(np.frombuffer(r["part"]) for r in frame.mapInArrow(multiply, "part binary").collect())
        return total.reshape(-1, basis.shape[1])

    basis = np.random.default_rng(seed).standard_normal((width, size))
    for _ in range(powers):
        basis = np.linalg.qr(product(basis, False))[0]
    values, turn = np.linalg.eigh(product(basis, True))
    keep = np.argsort(-values)[:rank]
    keep = keep[values[keep] > 1e-9 * max(values.max(), 1e-300)]
    return basis @ turn[:, keep]


@dataclass
class Item:
    """A benchmark passage: item id, numbers of its words and of its answer's, and the place of its rarest word."""

    item: int | str
    words: np.ndarray
    answer: np.ndarray
    rarest: int


def _in_a_row(number: np.ndarray, first: np.ndarray, items: Sequence[Item]) -> Iterator[tuple[int, int, int]]:
    """(item's place, row, first word) wherever all words of an item stand in a row in one text.

    Only places of an item's rarest word are looked at.
    """
    if not len(items) or not len(number):
        return
    wanted = np.array([item.words[item.rarest] for item in items])
    rare = np.zeros(max(int(wanted.max()), int(number.max())) + 2, bool)
    rare[wanted] = True  # words of no item are -1 and read the last entry
    at = np.flatnonzero(rare[number])
    at = at[np.argsort(number[at], kind="stable")]
    lows, highs = (np.searchsorted(number[at], wanted, side=side) for side in ("left", "right"))
    for k in np.flatnonzero(highs > lows).tolist():
        own = items[k].words
        begin = at[lows[k] : highs[k]] - items[k].rarest
        row = np.searchsorted(first, begin + items[k].rarest, side="right") - 1
        inside = (begin >= first[row]) & (begin + len(own) <= first[row + 1])
        begin, row = begin[inside], row[inside]
        for j, word in enumerate(own.tolist()):
            if not len(begin):
                break
            same = number[begin + j] == word
            begin, row = begin[same], row[same]
        for r, b in zip(row.tolist(), begin.tolist(), strict=True):
            yield k, r, b


def subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence (bit-parallel: a bit for each element of ``a``)."""
    where: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = row & where.get(x, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _items(benchmark: DataFrame, answer_col: str | None) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], list[np.ndarray]]:
    """(item, words, answer words) of all different passages of all items, and the words of all different
    texts, which passages and repeated rows share; a benchmark is read whole."""
    columns = ["item_id", "text", *([answer_col] if answer_col else [])]
    rows = benchmark.select(*columns).where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).orderBy(*columns).collect()
    out: dict[tuple, tuple[int, np.ndarray, np.ndarray]] = {}
    texts: dict[bytes, np.ndarray] = {}
    for r in rows:
        words, _ = _words(pa.array([r["text"]], pa.string()))
        if len(words):
            texts[words.tobytes()] = np.unique(words)
        if answer_col and r[answer_col]:
            answer, _ = _words(pa.array([r[answer_col]], pa.string()))
        else:
            answer = words[-max(1, len(words) // 8) :]
        parts = max(1, -(-len(words) // PASSAGE))
        for part in np.array_split(words, parts):
            if len(part):
                out[r["item_id"], part.tobytes(), answer.tobytes()] = (r["item_id"], part, answer)
    return list(out.values()), list(texts.values())


@dataclass
class Bank:
    """Passages of one latent space: their places in the list of items, the numbers of their words, and what
    each of these words adds to the product of a window with each passage: first with the passages' own words,
    then, in further columns, with their images in the latent space."""

    near: np.ndarray
    words: np.ndarray
    per_word: np.ndarray

    def write(self, path: str) -> None:
        out = io.BytesIO()
        for part in (self.near, self.words, self.per_word):
            np.save(out, part)
        with written_shared(path) as target:
            target.write(out.getvalue())

    @classmethod
    def read(cls, path: str) -> Bank:
        with open_shared(path) as source:
            parts = io.BytesIO(source.read())
        return cls(*(np.load(parts) for _ in range(3)))


def _banks(spark, items: list[Item], weight: np.ndarray, size: int) -> list[str]:
    """Fit a space for every ``size`` passages, on their own words only, and write it to the shared folder."""
    near = [k for k, item in enumerate(items) if len(item.words) > FEW]
    folder = new_folder(spark, "latent-banks")
    make_folder(folder)
    paths = []
    for k in range(0, len(near), size):
        part = np.array(near[k : k + size])
        words = np.unique(np.concatenate([items[i].words for i in part]))
        rows = []
        for i in part:
            column, times = np.unique(np.searchsorted(words, items[i].words), return_counts=True)
            rows.append({"column": column, "weight": times * weight[words[column]]})
        latent = randomised_svd(spark, rows, len(words), max(1, min(RANK, len(rows) // 4)))
        # Folding a window in and comparing it with an item is a sum over its words of one number each.
        folded = np.stack([r["weight"] @ latent[r["column"]] for r in rows])
        folded /= np.maximum(np.linalg.norm(folded, axis=1, keepdims=True), 1e-12)
        own = np.zeros((len(words), len(rows)))
        for j, r in enumerate(rows):
            own[r["column"], j] = r["weight"] / max(np.linalg.norm(r["weight"]), 1e-12)
        per_word = weight[words][:, None] * np.concatenate([own, latent @ folded.T], axis=1)
        paths.append(f"{folder}/{len(paths):06d}")
        Bank(part, words, per_word.astype(np.float32)).write(paths[-1])
    return paths


class _Halves:
    """Half windows of a piece of texts that hold words with weight: made once, compared with every bank."""

    def __init__(self, number: np.ndarray, first: np.ndarray, weight: np.ndarray):
        at = np.flatnonzero(number >= 0)
        at = at[weight[number[at]] > 0]
        self.number = number[at]
        row = np.searchsorted(first, at, side="right") - 1
        # Halves are numbered through the piece with a gap after each text.
        halves = -(-np.diff(first) // HALF) + 1
        begins = np.cumsum(halves) - halves
        half = begins[row] + (at - first[row]) // HALF
        new = half[1:] != half[:-1]
        self.starts = np.flatnonzero(np.concatenate([[True], new])) if len(at) else at
        self.which = np.concatenate([[0], np.cumsum(new)]) if len(at) else at
        ids, self.row = half[self.starts], row[self.starts]
        self.place = first[self.row] + (ids - begins[self.row]) * HALF
        # A window is a half and the next, if that has weight too.
        self.joined = np.append(ids[1:] == ids[:-1] + 1, False)[: len(ids)]
        square = weight[self.number] ** 2
        power = np.add.reduceat(square, self.starts) if len(at) else square
        power[:-1] += np.where(self.joined[:-1], power[1:], 0)
        self.norm = np.sqrt(power).astype(np.float32)

    def near(self, bank: Bank, local: np.ndarray, cosine: float) -> Iterator[tuple[int, np.ndarray]]:
        """(item's column, windows) of all windows near an item of the bank, by their words or by their images in
        its latent space. ``local`` numbers the bank's words. Sums are made in another order than those of
        ``cosines``, so a window within rounding of the limit is given too."""
        own = local[self.number]
        held = np.flatnonzero(own >= 0)
        if not len(held):
            return
        own, which = own[held], self.which[held]
        starts = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
        slots, size = which[starts], np.diff(np.append(starts, len(own)))
        items = len(bank.near)
        least = np.float32(cosine) * self.norm * np.float32(1 - 1e-4) - np.float32(1e-6)
        # A window is a half of the bank and the next; one that ends with such a half may be near too.
        paired = np.append((slots[1:] == slots[:-1] + 1) & self.joined[slots[:-1]], False)
        before = np.maximum(slots - 1, 0)
        lone = (slots > 0) & self.joined[before] & ~np.append(False, paired[:-1])
        hits = []
        step = max(16, _GATHER // bank.per_word.shape[1] // 4)
        for k in range(0, len(starts), step):
            m = min(step, len(starts) - k)
            score = self._sums(bank.per_word, own, starts[k : k + m + 1], size[k : k + m + 1])
            alone = np.flatnonzero(lone[k : k + m])
            if len(alone):
                hits.append(self._over(score[alone], least[before[k + alone]], before[k + alone], items))
            follow = np.zeros_like(score[:m])
            follow[: len(score) - 1] = score[1 : m + 1]
            follow *= paired[k : k + m, None]
            follow += score[:m]
            hits.append(self._over(follow, least[slots[k : k + m]], slots[k : k + m], items))
        item, home = (np.concatenate(x) for x in zip(*hits, strict=True))
        order = np.argsort(item, kind="stable")
        item, home = item[order], home[order]
        cuts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else item
        for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(item)], strict=False):
            yield int(item[begin]), home[begin:end]

    @staticmethod
    def _sums(per_word: np.ndarray, own: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sums of the rows of each half's words: first words of all halves, then second ones of those that have any."""
        order = np.argsort(-size, kind="stable")
        begins, ends = starts[order], np.searchsorted(-size[order], -np.arange(1, size.max() + 1), side="right").tolist()
        total = per_word[own[begins]]
        for j, end in enumerate(ends[1:], 1):
            total[:end] += per_word[own[begins[:end] + j]]
        out = np.empty_like(total)
        out[order] = total
        return out

    @staticmethod
    def _over(score: np.ndarray, least: np.ndarray, slots: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray]:
        near = score >= least[:, None]
        window, item = np.divmod(np.flatnonzero(near[:, :items] | near[:, items:]), items)
        return item, slots[window]

    def cosines(self, bank: Bank, local: np.ndarray, column: int, slots: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Cosines of windows with an item's words, and whether that or the one in the latent space reaches ``cosine``."""
        columns = [column, column + len(bank.near)]
        bounds = np.append(self.starts, len(self.number))
        score = np.zeros((len(slots), 2), np.float32)
        for half, among in ((slots, np.arange(len(slots))), (slots + 1, np.flatnonzero(self.joined[slots]))):
            half = half[among]
            size = bounds[half + 1] - bounds[half]
            owner = np.repeat(among, size)
            word = local[self.number[np.arange(len(owner)) + np.repeat(bounds[half] - np.cumsum(size) + size, size)]]
            owner, word = owner[word >= 0], word[word >= 0]
            if len(owner):
                opens = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                score[owner[opens]] += np.add.reduceat(bank.per_word[word[:, None], columns], opens, axis=0)
        norm = self.norm[slots]
        return score[:, 0] / norm, (score >= np.float32(cosine) * norm[:, None]).any(axis=1)


class _Blocks:
    """The words of a piece in blocks of HALF, to leave out at once most stretches that hold too few words of an item."""

    def __init__(self, number: np.ndarray, vocabulary: int):
        held = np.full(-(-len(number) // HALF) * HALF, vocabulary, np.intp)  # one more number, for words of no item
        held[: len(number)] = np.where(number < 0, vocabulary, number)
        self.words = np.ascontiguousarray(held.reshape(-1, HALF).T)
        self.bit = np.zeros(vocabulary + 1, np.uint64)
        self.mask = np.zeros(self.words.shape[1], np.uint64)
        self.asked = np.zeros(self.words.shape[1], bool)

    def may_hold(self, item: Item, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which stretches low..high lie in blocks that hold at least LIKELY of an item's words, in any order."""
        known, times = np.unique(item.words, return_counts=True)
        begin, end = low // HALF, (high - 1) // HALF
        at = np.minimum(begin + np.arange(int((end - begin).max()) + 1)[:, None], end)
        self.asked[at] = True
        asked = np.flatnonzero(self.asked)
        self.asked[asked] = False
        words = np.take(self.words, asked, axis=1)
        held = np.zeros(len(low), np.int64)
        for k in range(0, len(known), 64):
            some, often = known[k : k + 64], times[k : k + 64]
            bits = np.uint64(1) << np.arange(len(some), dtype=np.uint64)
            self.bit[some] = bits
            self.mask[asked] = np.bitwise_or.reduce(self.bit[words], axis=0)
            self.bit[some] = 0
            found = np.bitwise_or.reduce(self.mask[at], axis=0)
            for n in range(1, int(often.max()) + 1):
                held += np.bitwise_count(found & np.bitwise_or.reduce(bits[often >= n]))
        return held >= LIKELY * len(item.words)


def _worth_comparing(item: Item, number: np.ndarray, low: np.ndarray, high: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Which stretches low..high of the words hold at least LIKELY of an item's words, in any order: no other
    can have a common subsequence of that share. ``index`` is a table of zeros, given back as such."""
    known, times = np.unique(item.words, return_counts=True)
    index[known] = np.arange(1, len(known) + 1)
    out = np.empty(len(low), bool)
    for k in range(0, len(low), 4096):
        begin, end = low[k : k + 4096, None], high[k : k + 4096, None]
        at = begin + np.arange(int((end - begin).max()))
        held = np.zeros((len(at), len(known) + 1), bool)
        held[np.arange(len(at))[:, None], np.where(at < end, index[number[np.minimum(at, len(number) - 1)]], 0)] = True
        out[k : k + 4096] = held[:, 1:] @ times >= LIKELY * len(item.words)
    index[known] = 0
    return out


def _search(docs: DataFrame, id_col: str, text_col: str, vocabulary: Vocabulary, weight: np.ndarray, items: list[Item], banks: list[str], cosine: float, item_kind: DataType) -> DataFrame:
    """Windows of all texts whose fold-in is near an item's, with the checks of all their words, and the
    items that stand there word by word. One pass over the texts, whatever the number of banks."""
    kind = docs.schema[id_col].dataType.simpleString()
    item_type = to_arrow_type(item_kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, Bank] = {}
        index = np.zeros(len(vocabulary) + 1, np.int32)  # the last entry is for words of no item, -1

        def each() -> Iterator[Bank]:
            for path in banks:
                bank = kept.get(path)
                if bank is None:
                    bank = Bank.read(path)
                    if sum(b.per_word.nbytes for b in kept.values()) + bank.per_word.nbytes <= _KEEP:
                        kept[path] = bank
                yield bank

        for batch in slices(batches, text_col, _PIECE):
            words, first = _words(batch.column(text_col))
            number = vocabulary.numbers(words)
            halves, blocks = _Halves(number, first, weight), _Blocks(number, len(vocabulary))

            def stretch(own: Item, r: np.ndarray, begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
                slack = 2 * len(own.words)
                return np.maximum(first[r], begin - slack), np.minimum(first[r + 1], begin + size + slack)

            def answered(own: Item, here: np.ndarray) -> bool:
                return not len(own.answer) or subsequence(own.answer, here) == len(own.answer)

            found: dict[tuple[int, int], tuple] = {}
            for bank in each():
                local = np.full(len(vocabulary), -1, np.int32)
                local[bank.words] = np.arange(len(bank.words), dtype=np.int32)
                for column, slots in halves.near(bank, local, cosine):
                    own = items[bank.near[column]]
                    low, high = stretch(own, halves.row[slots], halves.place[slots], 2 * HALF)
                    held = np.flatnonzero(blocks.may_hold(own, low, high))
                    held = held[_worth_comparing(own, number, low[held], high[held], index)]
                    if not len(held):
                        continue
                    c, close = halves.cosines(bank, local, column, slots[held], cosine)
                    r, low, high, c = halves.row[slots[held[close]]], low[held[close]], high[held[close]], c[close]
                    for k in range(len(c)):
                        here = number[low[k] : high[k]]
                        share = subsequence(own.words, here) / len(own.words)
                        if share < LIKELY:
                            continue
                        known = answered(own, here)
                        if share < SURE and not known:
                            continue
                        key = (int(r[k]), own.item)
                        best = (share, float(c[k]), known)
                        if key not in found or best > found[key]:
                            found[key] = best
            for i, r, begin in _in_a_row(number, first, items):
                own = items[i]
                key = (r, own.item)
                if key not in found or found[key][0] < 1:
                    low, high = stretch(own, r, begin, len(own.words))
                    found[key] = (1.0, 1.0, answered(own, number[low:high]))
            if found:
                rows = sorted(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(id_col).take(pa.array([r for r, _ in rows], pa.int64())),
                        pa.array([x for _, x in rows], item_type),
                        pa.array([found[x][1] for x in rows], pa.float64()),
                        pa.array([found[x][0] for x in rows], pa.float64()),
                        pa.array([found[x][2] for x in rows], pa.bool_()),
                    ],
                    names=[id_col, "item_id", "cosine", "lcs", "answered"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, item_id {item_kind.simpleString()}, cosine double, lcs double, answered boolean")


def benchmark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    answer_col: str | None = None,
    cosine: float = COSINE,
    bank: int = BANK,
) -> DataFrame:
    """Pairs of documents and benchmark items they give away.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lowered. Benchmark passages
    (items, long ones cut) are TF-IDF rows over the benchmark's words; document frequencies come from all
    documents; words in over a fifth of them and in many different items carry no weight, but all words
    of a passage that would lose most of its own keep theirs. A randomised SVD gives the latent space
    of up to ``bank`` passages, of a rank well below theirs, in which words that share passages come near
    each other. Every window of 32 words of every text is folded in. Candidates of a cosine of ``cosine`` or
    more in this space or by the words themselves are checked on all
    words of the passage, also those without weight: a common subsequence with 80% of them, or with 60%
    and the answer (``answer_col``, else the item's last words) in the same order, is a leak. A passage
    whose words all stand in a row is one at any cosine (given as 1 if no window holds so much of it);
    for passages of up to 8 words nothing else is, as a few of their words in order prove nothing. All banks are searched in one
    pass over the documents: a space is written to the shared folder over its own words, and tasks get the
    words of the benchmark and read one space after the other.

    Returns id, item_id, cosine, lcs, answered, one row a pair; ids may be numbers or texts. Null and empty texts and items match
    nothing, nor do items without a word. Repeated rows give one pair. Documents with
    a null id are one document. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    raw, texts = _items(benchmark, answer_col)
    vocabulary = Vocabulary(np.concatenate([w for _, w, _ in raw] + [a for _, _, a in raw]) if raw else np.empty(0, np.uint64))
    counts, n = document_frequencies(docs, vocabulary, text_col)
    weight = np.log((n + 1) / (counts + 1)) + 1
    # A passage given away by very many documents is no common wording: that stands in many items too.
    within = np.bincount(np.concatenate([vocabulary.numbers(w) for w in texts] or [np.empty(0, int)]), minlength=len(vocabulary))
    common = (counts > COMMON * n) & (within >= max(3, COMMON_ITEMS * len(texts)))
    # A passage that items share is in many items and may be given away by many documents: its words stay.
    kept = [own for own in (vocabulary.numbers(w) for _, w, _ in raw) if 2 * common[own].sum() > len(own)]
    common[np.concatenate(kept or [np.empty(0, int)])] = False
    weight[common] = 0
    items = []
    for item, words, answer in raw:
        own, last = vocabulary.numbers(words), vocabulary.numbers(answer)
        items.append(Item(item, own, last, int(np.argmin(counts[own]))))
    item_kind = benchmark.schema["item_id"].dataType
    item_kind = LongType() if item_kind.typeName() in ("byte", "short", "integer") else item_kind
    out = _search(docs, id_col, text_col, vocabulary, weight, items, _banks(spark, items, weight, bank), cosine, item_kind)
    best = F.max(F.struct("lcs", "cosine", "answered")).alias("b")
    return out.groupBy(id_col, "item_id").agg(best).select(id_col, "item_id", "b.cosine", "b.lcs", "b.answered")
