"""Near duplicates: a Jaccard join of word shingles by chosen paths, and classes of what it links."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caskline.llm.common import row_key, slices, spread, staged, text_bytes, word_hashes

SHINGLE, SIMILARITY = 5, 0.8
#: Buckets up to this size are compared at once; larger ones are split on another shared token.
SMALL = 128
#: Texts on one side of a comparison, when a bucket that splitting doesn't shrink is compared in tiles.
TILE = 512
#: Tokens a path can have, and the recall that the runs are repeated for.
DEPTH, RECALL = 12, 0.9999
_PIECE = 2 << 20

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def shingle_sets(column: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word k-grams of each text, and where each text's begin (one entry more).

    A text of 1 to k - 1 words has one shingle of all its words, a text without words none.
    """
    data, bounds = text_bytes(column)
    words, first = word_hashes(data, bounds, _IS_WORD)
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    starts = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(first[:-1] - starts[:-1], count) + np.arange(starts[-1])
    end = np.repeat(first[1:], count)
    out = np.full(len(at), 0x2545F4914F6CDD1D, np.uint64)
    for j in range(k):
        inside = at + j < end
        out[inside] = spread(out[inside] ^ words[(at + j)[inside]])
    return out, starts


def runs_for(recall: float, similarity: float) -> int:
    """Runs until a pair of this similarity is met with probability ``recall``.

    A run starts with one token and takes two more whenever it must split, so a pair stays together with
    the root's chance times the fixed point of 1 - (1 - similarity * x) ** 2.
    """
    stays = 1.0
    for _ in range(200):
        stays = 1 - (1 - similarity * stays) ** 2
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity * stays)))


def _sketches(docs: DataFrame, coordinates: int, k: int) -> DataFrame:
    """(_id, _name, n, s1, s2, mins) of rows (_id, _name, _t): set size, set hash, sampled tokens."""
    kind = docs.schema["_id"].dataType.simpleString()
    odd = spread(np.arange(1, coordinates + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_t", _PIECE):
            tokens, starts = shingle_sets(batch.column("_t"), k)
            rows = len(starts) - 1
            n, s1, s2 = np.zeros(rows, np.int64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            for r in range(rows):
                own = np.unique(tokens[starts[r] : starts[r + 1]])
                n[r] = len(own)
                s1[r] = own.sum(dtype=np.uint64)
                s2[r] = spread(own).sum(dtype=np.uint64)
            full = np.flatnonzero(n)
            mins = np.zeros((len(full), coordinates), np.uint64)
            if len(full):
                for j in range(coordinates):
                    mins[:, j] = np.minimum.reduceat(tokens * odd[j], starts[:-1][full])
            ends = np.zeros(rows + 1, np.int32)
            ends[1:] = np.cumsum(np.where(n > 0, coordinates, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_name"),
                    pa.array(n),
                    pa.array(s1.view(np.int64)),
                    pa.array(s2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(mins.ravel().view(np.int64))),
                ],
                names=["_id", "_name", "n", "s1", "s2", "mins"],
            )

    return docs.mapInArrow(run, f"_id {kind}, _name string, n bigint, s1 bigint, s2 bigint, mins array<bigint>")


def chosen_paths(sets: DataFrame, runs: int, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """Buckets (bucket, rep, size) of rows (rep, mins): sets that share all tokens of a sampled path.

    Every run begins with one sampled token of each set (its minimum under a random order, so two sets
    share it with a chance equal to their similarity). A bucket of over ``small`` sets is split on two
    further tokens. Where a part keeps at least half of its bucket, its sets are alike and splitting
    ends; so it does at ``depth`` tokens. Sizes are counted before anything is gathered.
    """
    pool = 2 * (depth - 1)
    front = sets.select(
        "rep",
        F.explode(F.array(*[F.struct(F.lit(r).alias("run"), F.xxhash64(F.lit(r), F.get("mins", F.lit(r))).alias("bucket")) for r in range(runs)])).alias("p"),
        F.lit(None).cast("long").alias("parent_size"),
    ).select("rep", "p.run", "p.bucket", "parent_size")
    done: list[DataFrame] = []
    for level in range(1, depth + 1):
        sizes = front.groupBy("bucket").agg(F.count("*").alias("size"), F.max("parent_size").alias("whole")).where("size > 1")
        sizes = staged(sizes, "paths-sizes")
        split = (F.col("size") > small) & (F.col("whole").isNull() | (2 * F.col("size") < F.col("whole")))
        if level == depth:
            split = F.lit(False)
        sized = staged(front.join(sizes.withColumn("split", split), "bucket").select("rep", "run", "bucket", "size", "split"), "paths-level")
        done.append(sized.where(~F.col("split")).select("bucket", "rep", "size"))
        open_rows = sized.where("split")
        if open_rows.isEmpty():
            break
        step = 2 * (level - 1)
        children = F.array(
            *[
                F.xxhash64(F.col("bucket"), F.lit(j), F.get("mins", F.lit(runs) + F.pmod(F.lit(step + j) + 5 * F.col("run"), F.lit(pool)).cast("int")))
                for j in (0, 1)
            ]
        )
        front = open_rows.join(sets, "rep").select("rep", "run", F.explode(children).alias("bucket"), F.col("size").alias("parent_size"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    # Buckets with the same members would compare the same pairs: the one with the smallest number stays.
    marks = out.groupBy("bucket", "size").agg(F.sum(F.shiftright(F.xxhash64("rep"), 16)).alias("m1"), F.sum(F.shiftright(F.xxhash64("rep", F.lit(1)), 16)).alias("m2"))
    kept = marks.groupBy("size", "m1", "m2").agg(F.min("bucket").alias("bucket")).select("bucket")
    return out.join(kept, "bucket", "left_semi")


def _common_counts(sets: list[np.ndarray], left: int) -> np.ndarray:
    """Sizes of all intersections of the first ``left`` sets with all sets."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1
    number, owner = number[shared], owner[shared]
    common = np.zeros((left, m), np.float32)
    if len(number):
        number = np.cumsum(np.concatenate([[0], number[1:] != number[:-1]]))
        wide = max(64, (4 << 20) // m)
        for begin in range(0, int(number[-1]) + 1, wide):
            lo, hi = np.searchsorted(number, [begin, begin + wide])
            block = np.zeros((m, min(wide, int(number[-1]) + 1 - begin)), np.float32)
            block[owner[lo:hi], number[lo:hi] - begin] = 1
            common += block[:left] @ block.T
    return common


def _met_before(lists: list[np.ndarray], bucket: int, left: int) -> np.ndarray:
    """Which pairs share a bucket of a smaller number, where they are counted."""
    keys = np.unique(np.concatenate(lists))
    keys = keys[keys < bucket]
    if not len(keys):
        return np.zeros((left, len(lists)), bool)
    member = np.zeros((len(lists), len(keys)), np.float32)
    for r, own in enumerate(lists):
        own = own[own < bucket]
        member[r, np.searchsorted(keys, own)] = 1
    return member[:left] @ member.T > 0


def _compare(similarity: float, k: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        bucket, a, b = key
        group = group.drop_duplicates("rep").sort_values(["side", "rep"], kind="stable")
        left = int((group["side"] == a).sum()) if a != b else len(group)
        reps = group["rep"].to_numpy(object)
        tokens, starts = shingle_sets(pa.array(group["_t"], pa.string()), k)
        sets = [np.unique(tokens[starts[r] : starts[r + 1]]) for r in range(len(group))]
        n = np.array([len(s) for s in sets], float)
        common = _common_counts(sets, left)
        linked = common >= similarity * (n[:left, None] + n[None, :] - common) - 1e-6
        rows = np.arange(left)[:, None]
        linked &= (np.arange(len(group))[None, :] > rows) if a == b else (np.arange(len(group))[None, :] >= left)
        linked &= ~_met_before([np.asarray(x, np.int64) for x in group["buckets"]], bucket, left)
        links = np.zeros(len(group), np.int64)
        links[:left] += linked.sum(1)
        links += linked.sum(0)
        root = np.arange(len(group))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        # The first partner of a row joins it; so do all of a row's partners, and each once at most.
        for r in np.flatnonzero(linked.any(1)):
            for c in np.flatnonzero(linked[r]):
                if root[c] == c or top(c) != top(r):
                    p, q = top(r), top(c)
                    root[max(p, q)] = min(p, q)
        tops = np.array([top(x) for x in range(len(group))], int)
        hit = links > 0
        return pd.DataFrame({"rep": reps[hit], "links": links[hit], "to": reps[tops[hit]]})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (rep, to): the smallest node that edges lead to.

    Labels go to neighbours and then along labels, until none changes; every round is written to the
    shared folder. Only joins on nodes and minima by node: a node with very many edges is split.
    """
    both = edges.where("rep <> to").select(F.col("rep").alias("u"), F.col("to").alias("v")).distinct()
    both = staged(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))), "components-edges")
    labels = staged(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root")), "components-0")
    while True:
        heard = both.join(labels, "u").groupBy(F.col("v").alias("u")).agg(F.min("root").alias("heard"))
        lower = labels.join(heard, "u", "left").select("u", F.least("root", "heard").alias("mid"), F.col("root").alias("old"))
        ahead = labels.select(F.col("u").alias("mid"), F.col("root").alias("next"))
        step = staged(
            lower.join(ahead, "mid", "left").select("u", F.least("mid", F.coalesce("next", "mid")).alias("root"), "old"), "components-round"
        )
        changed = not step.where("root <> old").isEmpty()
        labels = step.select("u", "root")
        if not changed:
            return labels.select(F.col("u").alias("node"), "root")


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    small: int = SMALL,
    tile: int = TILE,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Join texts whose sets of word shingles have a Jaccard similarity of ``similarity`` or more.

    Returns id, copies_id, n_copies, n_links, class_id, row_key and class_key for every row. ``copies_id`` is the smallest id
    among the rows of the same shingle set, ``n_copies`` their number, ``n_links`` the number of
    different sets that are similar, ``class_id`` the smallest id of all rows that links lead to,
    through others too. ``row_key`` names a row by id and text, ``class_key`` the row its class is named by. Sets are taken once, whatever the number of their copies. Candidates come from
    chosen paths; each pair of a bucket is compared on its full sets, and counted in one bucket only.
    A pair at the threshold is missed with probability 1 - ``recall`` at most.

    Null, empty and blank texts have no shingles: no copies, no links, a class of their own (class_id is
    their id). Texts of fewer words than a shingle count as one shingle. Rows that repeat an id and text
    are copies. Null ids stay null and count after all others. An empty table gives an empty result.
    """
    runs = runs_for(recall, similarity)
    rows = docs.select(F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_name"), F.col(text_col).alias("_t"))
    sketched = staged(_sketches(rows, runs + 2 * (DEPTH - 1), shingle), "jaccard-sketches")
    sets = staged(
        sketched.where("n > 0")
        .groupBy("s1", "s2")
        .agg(F.min("_name").alias("rep"), F.min("_id").alias("least"), F.count("*").alias("copies"), F.first("mins").alias("mins")),
        "jaccard-sets",
    )
    buckets = staged(chosen_paths(sets.select("rep", "mins"), runs, small), "jaccard-buckets")
    homes = buckets.groupBy("rep").agg(F.collect_list(F.struct("bucket", "size")).alias("homes"))
    texts = rows.select(F.col("_name").alias("rep"), "_t")
    if not sketched.where("n > 0").groupBy("_name").agg(F.count("*").alias("times")).where("times > 1").isEmpty():
        # Rows that repeat id and text: each task folds its own before any text is sent.
        texts = texts.groupBy("rep").agg(F.first("_t").alias("_t"))
    texts = texts.join(homes, "rep")
    tiles = F.ceil(F.col("home.size") / tile).cast("int")
    side = F.pmod(F.xxhash64("rep"), F.when(tiles > 1, tiles).otherwise(1)).cast("int")
    placed = (
        texts.select("rep", "_t", F.col("homes.bucket").alias("buckets"), F.explode("homes").alias("home"))
        .select("rep", "_t", "buckets", F.col("home.bucket").alias("bucket"), tiles.alias("tiles"), side.alias("side"))
        .select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("tiles") - 1, F.lit(0)))).alias("other"))
        .select("rep", "_t", "buckets", "bucket", "side", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"))
    )
    found = staged(placed.groupBy("bucket", "a", "b").applyInPandas(_compare(similarity, shingle), "rep string, links long, to string"), "jaccard-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found)
    known = staged(
        sets.select("s1", "s2", "rep", "least", "copies")
        .join(links, "rep", "left")
        .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .withColumn("root", F.coalesce("root", "rep")),
        "jaccard-known",
    )
    classes = known.where("links > 0").groupBy("root").agg(F.min("least").alias("class"))
    known = known.join(classes, "root", "left").select(
        "s1", "s2", "root", "least", "copies", "links", F.coalesce("class", "least").alias("class")
    )
    result = sketched.drop("mins").join(known, ["s1", "s2"], "left")
    return result.select(
        F.col("_id").alias(id_col),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("_id")).alias("copies_id"),
        F.when(F.col("n") > 0, F.col("copies")).otherwise(1).alias("n_copies"),
        F.when(F.col("n") > 0, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("n") > 0, F.col("class")).otherwise(F.col("_id")).alias("class_id"),
        F.col("_name").alias("row_key"),
        F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("_name")).alias("class_key"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each class of ``near_duplicates`` stays: the one of the smallest id."""
    found = staged(near_duplicates(docs, id_col=id_col, text_col=text_col, **how).select("row_key", "class_key"), "jaccard-classes")
    key = "_jaccard_row_key"
    stay = found.where("row_key = class_key").select(F.col("row_key").alias(key)).distinct()
    named = docs.withColumn(key, row_key(id_col, text_col))
    if not found.groupBy("row_key").agg(F.count("*").alias("times")).where("times > 1").isEmpty():
        named = named.dropDuplicates([key])  # rows that repeat id and text, folded before the join sends them
    kept = named.join(stay, key, "left_semi")
    return kept.drop(key)
