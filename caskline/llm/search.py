"""Ranked lexical search over an index of documents grouped by equal length normaliser."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from caskline.llm.common import new_folder, slices, staged, text_bytes

#: What a term is, in UTF-8 bytes whose letters A to Z are small; and for each byte whether it is part of one.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_INSIDE = np.array([bool(re.match(rb"[0-9A-Za-z\x80-\xff]", bytes([b]))) for b in range(256)])
_SMALL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Documents, and pairs of term and document, of a block: a stratum, or a part of a large one.
BLOCK_DOCS, BLOCK_PAIRS = 256, 200_000
#: Blocks that are visited first for each item, to learn what a document must reach.
FIRST = 4
#: Items, and their different terms, that one pass over the index answers.
BANK_ITEMS, BANK_TERMS = 4096, 200_000
#: A table of the documents' lengths up to this many rows is broadcast (16 bytes a row).
LENGTHS = 500_000
#: Text bytes handled at a time, and contributions to scores made at a time.
PIECE, CHUNK = 1 << 20, 1 << 18


def terms_of(text: str | None) -> Counter[bytes]:
    """The terms of a text and how often each occurs. A long text is counted match by match."""
    data = (text or "").encode().translate(_SMALL)
    return Counter(_TERM.findall(data) if len(data) <= PIECE else (match.group() for match in _TERM.finditer(data)))


def count_terms(texts: pa.Array) -> np.ndarray:
    """The number of terms of each text, repeats counted."""
    data, bounds = text_bytes(texts)
    opens = np.zeros(len(data) + 1, bool)
    opens[:-1] = _INSIDE[data]
    inside = opens.copy()
    opens[1:] &= ~inside[:-1]
    firsts = bounds[:-1][np.diff(bounds) > 0]
    opens[firsts] = inside[firsts]  # a text's first byte has none before it
    return np.diff(np.concatenate([[0], np.cumsum(opens[:-1], dtype=np.int64)])[bounds])


def _with_length(rows: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Add ``_n``, the number of terms of ``_text``; rows without a term go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", PIECE):
            n = count_terms(batch.column("_text"))
            some = pa.array(n > 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).filter(some) for c in kept), pa.array(n[n > 0])], names=[*kept, "_n"]
            )

    return rows.mapInArrow(run, rows.select(*kept).schema.add("_n", "long"))


def normaliser(n: Column, docs: int, terms: int) -> Column:
    return F.lit(75) + F.call_function("div", F.lit(25).cast("long") * n * F.lit(docs).cast("long"), F.lit(terms).cast("long"))


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _block(m: int, name: str, ids: pa.Array, counts: list[Counter[bytes]]) -> dict:
    """A block's postings: by term, then by falling tf, the documents' places; a run for each tf."""
    numbers: dict[bytes, int] = {}
    sizes = [len(c) for c in counts]
    term = np.fromiter((numbers.setdefault(t, len(numbers)) for c in counts for t in c), np.int64, sum(sizes))
    tf = np.fromiter((n for c in counts for n in c.values()), np.int64, len(term))
    doc = np.repeat(np.arange(len(counts)), sizes)
    names = sorted(numbers)
    place = np.empty(len(names), np.int64)
    place[[numbers[t] for t in names]] = np.arange(len(names))
    term = place[term]
    order = np.lexsort((doc, -tf, term))
    term, tf, doc = term[order], tf[order], doc[order]
    opens = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])]))
    firsts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    return {
        "block": name,
        "m": m,
        "ids": ids,
        "terms": [t.decode() for t in names],
        "dfs": np.diff(np.append(firsts, len(term))),
        "max_tfs": tf[firsts],
        "run_tfs": tf[opens],
        "run_docs": np.diff(np.append(opens, len(term))),
        "docs": doc,
    }


def _batch(blocks: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    lists = {"ids": kind, "terms": pa.string()} | dict.fromkeys(("dfs", "max_tfs", "run_tfs", "run_docs", "docs"), pa.int32())
    columns = {"block": pa.array([b["block"] for b in blocks], pa.string()), "m": pa.array([b["m"] for b in blocks], pa.int64())}
    for name, of in lists.items():
        columns[name] = pa.array([b[name] for b in blocks], pa.list_(of))
    return pa.RecordBatch.from_pydict(columns)


@dataclass
class Index:
    """A folder of blocks: (block, m, ids, terms, dfs, max_tfs, run_tfs, run_docs, docs)."""

    path: str
    documents: int

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> Index:
    """Index every document that has a term, grouped into strata of equal normaliser m.

    Lengths are counted first, since m follows from the mean length. Then each document goes to its
    stratum; one with many documents (copies of one page, say) is cut into parts by hash, so that neither a
    task nor a block grows with it. A block holds at most BLOCK_DOCS documents and, but for a single very
    long one, BLOCK_PAIRS postings. All documents of a block share m, so an impact follows from tf alone.
    Null, empty and blank texts aren't held, repeated rows and ids are held as often as they come, null
    ids as null. Columns but id and text aren't read. The folder (new, in the shared folder, if not
    given) is written once and read by every search.
    """
    spark = docs.sparkSession
    path = path or new_folder(spark, "lexical-index")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    lengths = staged(_with_length(rows.select("_text"), []).groupBy("_n").agg(F.count("*").alias("_docs")), "lengths")
    count, total, different = lengths.agg(F.sum("_docs"), F.sum(F.col("_n") * F.col("_docs")), F.count("*")).first()
    count, total = count or 0, total or 0
    m = normaliser(F.col("_n"), count, max(total, 1))
    strata = lengths.withColumn("_m", m)
    parts = strata.groupBy("_m").agg(F.ceil(F.sum("_docs") / BLOCK_DOCS).alias("_parts"))
    strata = strata.join(parts, "_m").select("_n", "_m", "_parts")
    salt = F.pmod(F.xxhash64("_id", "_text", F.spark_partition_id()), F.col("_parts"))
    dealt = (
        _with_length(rows, ["_id", "_text"])
        .join(F.broadcast(strata) if different <= LENGTHS else strata, "_n")
        .select("_id", "_text", "_m", salt.alias("_part"))
        .repartition("_m", "_part")
        .sortWithinPartitions("_m", "_part")
    )
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        counts: list[Counter[bytes]] = []
        ready: list[dict] = []
        stratum, pairs, held, cuts = None, 0, 0, 0
        of = None

        def close() -> None:
            nonlocal pairs, held, cuts
            if counts:
                ready.append(_block(stratum[0], f"{stratum[0]}-{stratum[1]}-{cuts}", pa.concat_arrays(ids), list(counts)))
                held += pairs
                cuts, pairs = cuts + 1, 0
                ids.clear()
                counts.clear()

        for batch in slices(batches, "_text", PIECE):
            of = batch.schema.field("_id").type
            keys = zip(batch.column("_m").to_pylist(), batch.column("_part").to_pylist(), strict=True)
            for row, (key, text) in enumerate(zip(keys, batch.column("_text").to_pylist(), strict=True)):
                found = terms_of(text)
                if key != stratum or len(counts) >= BLOCK_DOCS or pairs + len(found) > BLOCK_PAIRS:
                    close()
                    if key != stratum:
                        stratum, cuts = key, 0
                ids.append(batch.column("_id").slice(row, 1))
                counts.append(found)
                pairs += len(found)
            if held >= BLOCK_PAIRS:
                yield _batch(ready, of)
                ready.clear()
                held = 0
        close()
        if ready:
            yield _batch(ready, of)

    whole = "terms array<string>, dfs array<int>, max_tfs array<int>, run_tfs array<int>, run_docs array<int>, docs array<int>"
    blocks = dealt.mapInArrow(run, f"block string, m bigint, ids array<{kind}>, {whole}")
    # Row groups stay small, so that readers hold few blocks at a time.
    blocks.write.option("parquet.block.size", 8 << 20).option("parquet.block.size.row.check.min", 4).parquet(path)
    return Index(path, count)


@dataclass
class _Bank:
    """Items that are searched together: their terms, and for each term its items and weights."""

    names: list
    terms: pa.Array
    first: np.ndarray
    item: np.ndarray
    often: np.ndarray
    weights: np.ndarray | None = None

    @classmethod
    def of(cls, rows: Sequence[Row]) -> _Bank:
        numbers: dict[str, int] = {}
        pairs = [(numbers.setdefault(t, len(numbers)), k, n) for k, row in enumerate(rows) for t, n in zip(row.terms, row.tfs, strict=True)]
        term, item, often = np.array(sorted(pairs), np.int64).reshape(-1, 3).T
        first = np.searchsorted(term, np.arange(len(numbers) + 1))
        return cls([row.item for row in rows], pa.array(list(numbers), pa.string()), first, item, often)


def _spread(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges (first, size): the number of each element's range, and the element."""
    owner = np.repeat(np.arange(len(size)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + first[owner]


def _bounds(bank: _Bank, terms: pa.Array, max_tfs: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most that a document of the block can score for each item; the terms that both have, by their
    number in the bank and their place in the block."""
    number = pc.index_in(terms, value_set=bank.terms)
    place = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
    number = number.drop_null().to_numpy().astype(np.int64)
    most = bank.weights[number] * impact(max_tfs[place], m)
    owner, pair = _spread(bank.first[number], bank.first[number + 1] - bank.first[number])
    bounds = np.zeros(len(bank.names), np.int64)
    np.add.at(bounds, bank.item[pair], bank.often[pair] * most[owner])
    return bounds, number, place


def _scores(bank: _Bank, wanted: np.ndarray, number: np.ndarray, place: np.ndarray, block: dict[str, np.ndarray], m: int) -> np.ndarray:
    """Scores of the block's documents (columns) for the wanted items (rows)."""
    row_of = np.full(len(bank.names), -1)
    row_of[wanted] = np.arange(len(wanted))
    # One impact for each run of equal tf; every document of the run shares it.
    impacts = np.repeat(impact(block["run_tfs"], m), block["run_docs"])
    begin = np.cumsum(block["dfs"]) - block["dfs"]
    owner, pair = _spread(bank.first[number], bank.first[number + 1] - bank.first[number])
    here = row_of[bank.item[pair]] >= 0
    owner, pair = owner[here], pair[here]
    size = block["dfs"][place[owner]].astype(np.int64)
    scores = np.zeros((len(wanted), block["n"]), np.int64)
    flat = scores.reshape(-1)
    ends = np.cumsum(size)
    start = 0
    while start < len(size):
        stop = max(int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CHUNK, side="right")), start + 1)
        part = slice(start, stop)
        pair_of, posting = _spread(begin[place[owner[part]]], size[part])
        worth = bank.often[pair[part]] * bank.weights[number[owner[part]]]
        cell = row_of[bank.item[pair[part]]] * block["n"]
        np.add.at(flat, cell[pair_of] + block["docs"][posting], worth[pair_of] * impacts[posting])
        start = stop
    return scores


def _best(table: pa.Table, k: int) -> pa.Table:
    """Of each item, the k rows of highest value, equal ones by name (nulls last)."""
    order = pc.sort_indices(table, [("item", "ascending"), ("value", "descending"), ("name", "ascending")], null_placement="at_end")
    table = table.take(order)
    item = table.column("item").to_numpy()
    opens = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.empty(0, np.int64)
    rank = np.arange(len(item)) - np.repeat(opens, np.diff(np.append(opens, len(item))))
    return table.filter(pa.array(rank < k))


def _rows(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple[str, int, pa.RecordBatch, dict[str, np.ndarray]]]:
    for batch in batches:
        for k, (name, m) in enumerate(zip(batch.column("block").to_pylist(), batch.column("m").to_pylist(), strict=True)):
            yield name, m, batch.slice(k, 1), {c: batch.column(c)[k].values.to_numpy() for c in columns}


def _leading_blocks(blocks: DataFrame, bank: _Bank, first: int) -> DataFrame:
    """(item, name, value): each task's blocks of highest bound for every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for name, m, row, found in _rows(batches, ["max_tfs"]):
            bounds, _, _ = _bounds(bank, row.column("terms")[0].values, found["max_tfs"], m)
            item = np.flatnonzero(bounds > 0)
            held.append(pa.table({"item": item, "name": pa.array([name] * len(item), pa.string()), "value": bounds[item]}))
            if sum(map(len, held)) > 4 * first * len(bank.names):
                held = [_best(pa.concat_tables(held), first)]
        if held:
            yield from _best(pa.concat_tables(held), first).to_batches()

    return blocks.select("block", "m", "terms", "max_tfs").mapInArrow(run, "item bigint, name string, value bigint")


def _visit(blocks: DataFrame, bank: _Bank, k: int, least: np.ndarray, chosen: dict[str, list[int]], inside: bool) -> DataFrame:
    """(item, name, value): each task's best documents for every item.

    ``inside`` visits the chosen blocks for their items, else all others. A block is left out for an item
    if its bound is below ``least``, or below the k-th best score that the task has found.
    """
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach, best = least.copy(), None
        for name, m, row, found in _rows(batches, ["dfs", "max_tfs", "run_tfs", "run_docs", "docs"]):
            mine = chosen.get(name, [])
            if inside and not mine:
                continue
            bounds, number, place = _bounds(bank, row.column("terms")[0].values, found["max_tfs"], m)
            visit = bounds >= reach
            if inside:
                asked = np.zeros(len(visit), bool)
                asked[mine] = True
                visit &= asked
            else:
                visit[mine] = False
            wanted = np.flatnonzero(visit)
            if not len(wanted):
                continue
            ids = row.column("ids")[0].values
            scores = _scores(bank, wanted, number, place, found | {"n": len(ids)}, m)
            item, doc = np.nonzero(scores >= reach[wanted][:, None])
            table = pa.table({"item": wanted[item], "name": ids.take(pa.array(doc)), "value": scores[item, doc]})
            best = _best(table if best is None else pa.concat_tables([best, table]), k)
            held = best.column("item").to_numpy()
            full = np.flatnonzero(np.bincount(held, minlength=len(reach)) >= k)
            last = np.searchsorted(held, full, side="right") - 1
            reach[full] = np.maximum(reach[full], best.column("value").to_numpy()[last])
        if best is not None:
            yield from best.to_batches()

    columns = ["block", "m", "ids", "terms", "dfs", "max_tfs", "run_tfs", "run_docs", "docs"]
    return blocks.select(*columns).mapInArrow(run, f"item bigint, name {kind}, value bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("value").desc(), F.col("name").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _banks(items: DataFrame) -> Iterator[_Bank]:
    """The items, read one after the other and cut into banks of bounded size."""
    rows, terms = [], 0
    for row in items.toLocalIterator():
        if rows and (len(rows) >= BANK_ITEMS or terms + len(row.terms) > BANK_TERMS):
            yield _Bank.of(rows)
            rows, terms = [], 0
        rows.append(row)
        terms += len(row.terms)
    if rows:
        yield _Bank.of(rows)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, terms, tfs) of every row with a term; a row that comes twice is asked twice."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", PIECE):
            found = [terms_of(text) for text in batch.column("_text").to_pylist()]
            table = pa.table(
                {
                    "item": batch.column("_item"),
                    "terms": pa.array([[t.decode() for t in c] for c in found], pa.list_(pa.string())),
                    "tfs": pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
                }
            )
            yield from table.filter(pa.array([bool(c) for c in found], pa.bool_())).to_batches()

    rows = items.select(F.col(id_col).alias("_item"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"item {kind}, terms array<string>, tfs array<bigint>")


def search(index: Index, items: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """Each item's k documents of highest score above 0, equal scores by ascending id.

    Items are answered in banks of bounded size, each with the same steps over the index: document
    frequencies of the bank's terms; each block's bound for each item (all its terms at the block's highest
    tf); the few blocks of highest bound, which give the score that a document must reach; then every other
    block whose bound reaches it, and no document of the rest can be among the first k. Results are exact.

    Returns item, rank (int), document, score (long). Null and empty items, and items none of whose terms
    occurs, have no rows; a repeated item row gives its rows again, a repeated document row counts as
    two documents. Columns but id and text aren't read, so their names can't clash.
    """
    spark = items.sparkSession
    blocks = index.blocks(spark)
    kinds = items.schema[id_col].dataType.simpleString(), blocks.schema["ids"].dataType.elementType.simpleString()
    out = None
    for bank in _banks(staged(item_terms(items, id_col, text_col), "item-terms")):
        asked = spark.createDataFrame(list(enumerate(bank.terms.to_pylist())), "number int, term string")
        held = blocks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("of")).select(F.col("of.terms").alias("term"), "of.dfs")
        # Bounded by BANK_TERMS on both ways: sent to the tasks and collected.
        dfs = dict(held.join(F.broadcast(asked), "term").groupBy("number").agg(F.sum("dfs")).collect())
        bank.weights = np.array([weight(dfs[t], index.documents) if t in dfs else 0 for t in range(len(bank.terms))], np.int64)
        leading = _ranked(_leading_blocks(blocks, bank, FIRST), FIRST)
        chosen: dict[str, list[int]] = {}
        for row in leading.collect():  # at most FIRST for each item of the bank
            chosen.setdefault(row.name, []).append(row.item)
        least = np.ones(len(bank.names), np.int64)
        seeds = staged(_ranked(_visit(blocks, bank, k, least, chosen, inside=True), k), "search-seeds")
        for row in seeds.where(F.col("rank") == k).collect():  # at most one for each item of the bank
            least[row.item] = row.value
        rest = _visit(blocks, bank, k, least, chosen, inside=False)
        best = _ranked(seeds.drop("rank").unionByName(rest), k)
        names = spark.createDataFrame(list(enumerate(bank.names)), f"item bigint, _name {kinds[0]}")
        answer = best.join(F.broadcast(names), "item").select("_name", "rank", "name", "value")
        out = answer if out is None else out.unionByName(answer)
    if out is None:
        out = spark.createDataFrame([], f"_name {kinds[0]}, rank int, name {kinds[1]}, value bigint")
    return out.select(F.col("_name").alias(id_col), "rank", F.col("name").alias(doc_col), F.col("value").alias("score"))
