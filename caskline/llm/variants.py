"""Spelling variants: words one edit apart, found by a trie of letter-group counts."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from caskline.llm.common import slices, staged

#: What words are made of; only A to Z are lower-cased.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_SMALL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Words count from this length and this often; a slip is planted in every 97th word on average.
LENGTH, OFTEN, SLIP = 5, 3, 97
#: Levels of the trie, of which the first stand for one letter each, the most frequent.
LEVELS, SINGLE = 16, 10
#: Words that a shard, a part of the trie that one task searches, holds at most, and searches made at once.
SHARD, SEARCHES = 20_000, 8192
#: Text bytes handled at a time, words a task counts before it passes them on, letters compared at a time.
PIECE, COUNTED, CELLS = 1 << 20, 300_000, 1 << 22
_SURPLUS, _DEFICIT = 1, 2
_HELD, _AT_HOME, _VISITS = 0, 1, 2


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, often: int = OFTEN) -> DataFrame:
    """(word, n): the words of all whole texts, with a slip where the CRC-32 of ``id:run`` is divisible by 97.

    Null and empty texts have none; a null id reads as ``null``. Words are counted inside the tasks, then by
    Spark, so that a very frequent one sends a row for each task and no more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
            total.clear()
            return out

        for batch in slices(batches, "_text", PIECE):
            for name, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                text = (text or "").encode().translate(_SMALL).decode()
                runs = Counter(RUN.findall(text) if len(text) <= PIECE else (match.group() for match in RUN.finditer(text)))
                start = crc32(f"{name}:".encode())
                for word, n in runs.items():
                    code = crc32(word.encode(), start)
                    if code % SLIP == 0:
                        at = code % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= length:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield flush()
        yield flush()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("_id"), F.col(text_col).alias("_text"))
    counted = rows.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def letter_groups(vocabulary: DataFrame, levels: int = LEVELS, single: int = SINGLE) -> list[str]:
    """The letters that each level counts: the most frequent ones alone, the others dealt to the rest."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count()
    # A row for each letter of the alphabet that words are made of.
    order = [r.letter for r in sorted(letters.collect(), key=lambda r: (-r["count"], r.letter))]
    groups = [""] * levels
    for k, letter in enumerate(order):
        groups[k if k < single else single + (k - single) % (levels - single)] += letter
    return groups


def _counts(groups: Sequence[str]) -> list[Column]:
    """A word's frequency vector, a column for each level."""
    return [
        F.length("word") - F.length(F.translate("word", letters, "")) if letters else F.lit(0) for letters in groups
    ]


def _key(counts: Sequence[Column]) -> Column:
    return F.concat_ws(",", F.lit("t"), *[c.cast("string") for c in counts])


def _depth(vectors: DataFrame, levels: int, shard: int) -> int:
    """The first depth at which no branch of the trie has more than ``shard`` words, or the last."""
    leaves = vectors.groupBy("_vector").count()
    at = leaves.select(F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("depth"), "_vector", "count")
    sizes = at.groupBy("depth", F.slice("_vector", F.lit(1), F.col("depth")).alias("_top")).agg(F.sum("count").alias("words"))
    most = dict(sizes.groupBy("depth").agg(F.max("words")).collect())
    return next((d for d in range(levels) if most.get(d, 0) <= shard), levels)


def _pairs(asking: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(size)), size)
    return asking[owner], np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + first[owner]


class Trie:
    """Words arranged by their counts of successive letter groups, all levels as sorted arrays.

    A node's key is its parent's number and its count. A search goes down the levels with a budget of one
    surplus and one deficit: from a node to the child with the word's own count, and, each once, to that
    with one more or one less. Searches run side by side, a block of them to the leaves before the next.
    """

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1]) if len(vectors) else np.empty(0, np.int64)
        vectors = vectors[self.order]
        self.base = int(vectors.max(initial=0)) + 3
        node = np.zeros(len(vectors), np.int64)
        self.levels = []
        for level in range(vectors.shape[1]):
            key = node * self.base + vectors[:, level]
            opens = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
            self.levels.append(key[opens])
            node = np.cumsum(opens) - 1
        leaf = np.searchsorted(node, np.arange(len(self.levels[-1]) + 1 if self.levels else 1))
        self.first, self.size = leaf[:-1], np.diff(leaf)

    def search(self, vectors: np.ndarray, budget: int = _SURPLUS | _DEFICIT) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a searching row and a word that is within its budget."""
        row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        left = np.full(len(vectors), budget)
        for level, keys in enumerate(self.levels):
            rows, nodes, budgets = [], [], []
            for step, cost in ((0, 0), (1, _SURPLUS), (-1, _DEFICIT)):
                able = np.flatnonzero(left & cost == cost)
                count = vectors[row[able], level] + step
                # Counts from -1 to base - 1 can't run into a neighbour's keys; greater ones have no child.
                key = np.where((count >= 0) & (count < self.base), node[able] * self.base + count, -1)
                at = np.searchsorted(keys, key)
                at[at == len(keys)] = 0
                hit = keys[at] == key if len(keys) else np.zeros(len(at), bool)
                rows.append(row[able[hit]])
                nodes.append(at[hit])
                budgets.append(left[able[hit]] & ~cost)
            row, node, left = np.concatenate(rows), np.concatenate(nodes), np.concatenate(budgets)
        asking, place = _pairs(row, self.first[node], self.size[node])
        return asking, self.order[place]


class Words:
    """Words as code points one after the other, with their bounds."""

    def __init__(self, words: Sequence[str], letters: np.ndarray, group: np.ndarray, levels: int):
        self.flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.length = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.vectors = np.zeros((len(words), levels), np.int64)
        at = np.searchsorted(letters, self.flat)
        np.add.at(self.vectors, (np.repeat(np.arange(len(words)), self.length), group[at]), 1)
        wide = self.flat.astype(np.uint64)
        end = self.first + self.length
        self.head = wide[self.first] << np.uint64(32) | wide[self.first + 1]
        self.tail = wide[end - 2] << np.uint64(32) | wide[end - 1]

    def cells(self, which: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(which), width), np.uint32)
        row, place = _pairs(np.arange(len(which)), self.first[which], self.length[which])
        out[row, place - self.first[which][row]] = self.flat[place]
        return out


def one_edit(a: Words, x: np.ndarray, b: Words, y: np.ndarray) -> np.ndarray:
    """For pairs of words (of at least 5 letters), whether one letter put in, left out or changed makes them equal."""
    # One edit leaves the first two or the last two letters as they are.
    likely = np.flatnonzero(
        ((a.head[x] == b.head[y]) | (a.tail[x] == b.tail[y])) & (np.abs(a.length[x] - b.length[y]) <= 1)
    )
    width = np.maximum(a.length[x[likely]], b.length[y[likely]]) + 1
    likely, width = likely[order := np.argsort(width, kind="stable")], width[order]
    found = np.zeros(len(x), bool)
    start = 0
    while start < len(likely):
        stop = start + max(1, int(np.searchsorted(width[start:] * np.arange(1, len(width) - start + 1), CELLS, side="right")))
        part = likely[start:stop]
        wide = int(width[stop - 1])
        left, right = a.cells(x[part], wide), b.cells(y[part], wide)
        m, n = a.length[x[part]][:, None], b.length[y[part]][:, None]
        column = np.arange(wide)
        same = left == right
        agree = np.argmin(same | (column >= np.minimum(m, n)), axis=1)[:, None]
        agree = np.where((same | (column >= np.minimum(m, n))).all(1)[:, None], np.minimum(m, n), agree)
        changed = (m == n) & (same | (column <= agree)).all(1)[:, None] & (agree < m)
        column = column[:-1]
        more = (n == m + 1) & ((left[:, :-1] == right[:, 1:]) | (column < agree) | (column >= m)).all(1)[:, None]
        less = (m == n + 1) & ((left[:, 1:] == right[:, :-1]) | (column < agree) | (column >= n)).all(1)[:, None]
        found[part] = (changed | more | less)[:, 0]
        start = stop
    return found


def near_words(vocabulary: DataFrame, levels: int = LEVELS, single: int = SINGLE, shard: int = SHARD) -> DataFrame:
    """(word, links, best): of each word with a near word, how many it has, and (-n, word) of the most frequent.

    The trie is split below its first levels, as many as leave no more than ``shard`` words in a branch, and a
    branch is one task's. A word searches its own branch, and those that its top counts reach by one surplus,
    or one surplus before one deficit, where that part of the budget is spent on the way down; words on
    the other side search in turn, so each pair is met once. Branches that are still larger at the last level
    (words of the same letters in other orders) are cut by hash into a grid of cells, each with some of
    the words and some of the searches. Counts and best words are folded inside the task.
    """
    groups = letter_groups(vocabulary, levels, single)
    counts = _counts(groups)
    vectors = vocabulary.select("word", "n", F.array(*counts).alias("_vector"))
    depth = _depth(vectors, levels, shard)
    top = [F.col("_vector")[k] for k in range(depth)]
    rows = staged(vectors.withColumn("_key", _key(top)), "words")
    branches = rows.groupBy("_key").agg(F.ceil(F.count("*") / shard).cast("int").alias("_parts"))

    def reach(more: int, less: int | None = None) -> Column:
        changed = [c + 1 if k == more else c - 1 if k == less else c for k, c in enumerate(top)]
        able = F.lit(True) if less is None else top[less] > 0
        return F.when(able, F.struct(_key(changed).alias("key"), F.lit(_VISITS).alias("role")))

    visits = [F.struct(F.col("_key").alias("key"), F.lit(_AT_HOME).alias("role"))]
    visits += [reach(i) for i in range(depth)]
    visits += [reach(i, j) for i in range(depth) for j in range(i + 1, depth)]
    asking = rows.select("word", "n", F.explode(F.array(*visits)).alias("to")).where("to is not null")
    asking = asking.select("word", "n", F.col("to.key").alias("_key"), F.col("to.role").alias("_role"))
    held = rows.select("word", "n", "_key", F.lit(_HELD).alias("_role"))
    placed = held.unionByName(asking).join(branches, "_key")
    own = F.pmod(F.xxhash64("word"), F.col("_parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    cells = placed.withColumn("_own", own).withColumn("_other", other).select(
        "_key",
        F.when(F.col("_role") == _HELD, F.col("_own")).otherwise(F.col("_other")).alias("_row"),
        F.when(F.col("_role") == _HELD, F.col("_other")).otherwise(F.col("_own")).alias("_column"),
        "word",
        "n",
        "_role",
    )
    points = sorted((ord(c), k) for k, letters in enumerate(groups) for c in letters)
    letters, group = np.array([p for p, _ in points], np.uint32), np.array([k for _, k in points], np.int64)

    def find(table: pa.Table) -> pa.Table:
        role = table.column("_role").to_numpy()
        words = np.array(table.column("word").to_pylist(), object)
        n = table.column("n").to_numpy()
        here, ask = np.flatnonzero(role == _HELD), np.flatnonzero(role != _HELD)
        links, best_n, best = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), None, object)
        if len(here) and len(ask):
            a, b = Words(words[ask], letters, group, levels), Words(words[here], letters, group, levels)
            trie = Trie(b.vectors)
            order = np.argsort(np.argsort(words))  # of str: by code point
            for at in range(0, len(ask), SEARCHES):
                block = slice(at, at + SEARCHES)
                x, y = trie.search(a.vectors[block])
                x += at
                # A branch's own words meet both ways there; one of them counts.
                once = (role[ask[x]] == _VISITS) | (order[ask[x]] < order[here[y]])
                x, y = x[once], y[once]
                near = one_edit(a, x, b, y)
                x, y = ask[x[near]], here[y[near]]
                for one, two in ((x, y), (y, x)):
                    np.add.at(links, one, 1)
                    ranked = np.lexsort((order[two], -n[two], one))
                    one, two = one[ranked], two[ranked]
                    leads = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]])[: len(one)])
                    for p, q in zip(one[leads].tolist(), two[leads].tolist(), strict=True):
                        if best[p] is None or (-n[q], words[q]) < (-best_n[p], best[p]):
                            best_n[p], best[p] = n[q], words[q]
        some = np.flatnonzero(links)
        return pa.table(
            {
                "word": pa.array(words[some].tolist(), pa.string()),
                "links": links[some],
                "most": best_n[some],
                "near": pa.array(best[some].tolist(), pa.string()),
            }
        )

    met = cells.groupBy("_key", "_row", "_column").applyInArrow(find, "word string, links bigint, most bigint, near string")
    return met.groupBy("word").agg(
        F.sum("links").alias("links"), F.min(F.struct((-F.col("most")).alias("minus"), F.col("near").alias("word"))).alias("best")
    )


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to, from rows (word, form).

    A form is at least twice as frequent as its word, so ways are short and have no circle. Each round
    doubles how far every word has come: as many rounds as the logarithm of the longest way.
    """
    reached = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = staged(reached.join(onward, "root", "left"), "roots")
        if step.where("_next is not null").isEmpty():
            return reached
        reached = step.select("word", F.coalesce("_next", "root").alias("root"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each word's more frequent form and the root that forms lead to.

    Returns word, form, root, n, n_near, form_n. A word's form is the most frequent word one edit away
    (the smallest of equally frequent ones), if it is at least twice as frequent. Null and empty texts
    have no words and an empty table no rows; repeated rows count each. A very long text is read match by
    match; its words are counted, not kept in order. Columns but id and text aren't read, so
    their names can't clash.
    """
    vocabulary = staged(count_words(docs, id_col, text_col), "vocabulary")
    none = F.lit(None).cast("struct<minus:bigint,word:string>")
    both = vocabulary.select("word", "n", F.lit(0).cast("long").alias("links"), none.alias("best")).unionByName(
        near_words(vocabulary).select("word", F.lit(None).cast("long").alias("n"), "links", "best")
    )
    met = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("links").alias("n_near"), F.min("best").alias("best"))
    has = -F.col("best.minus") >= 2 * F.col("n")
    formed = staged(
        met.select("word", "n", "n_near", F.when(has, F.col("best.word")).alias("form"), F.when(has, -F.col("best.minus")).alias("form_n")),
        "forms",
    )
    roots = follow(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
