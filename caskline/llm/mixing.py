"""Mix sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from caskline.llm.common import WORD, staged

#: Rows of a flight block. A block leaves at most two rows undecided, so each level keeps 1/256 or less.
BLOCK_ROWS = 512
_SPAN = 1 << 53
#: Rows of one id, source and size that one task numbers.
_CHUNK = 4096


def word_count(text: Column) -> Column:
    """Words of a text, null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = 1.0, repeat: float = 3.0) -> list[float]:
    """Words to take of each source: ``share`` of all words by weight, at most ``repeat`` times its own.

    What a source cannot give goes to the others by weight until none is above its limit. If no
    source can take more, the rest is not given out.
    """
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while free:
        unit = left / math.fsum(weights[i] for i in sorted(free))
        full = [i for i in sorted(free) if unit * weights[i] > repeat * sizes[i]]
        if not full:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = repeat * sizes[i]
            left -= out[i]
            free.discard(i)
    return out


def _fly(chance: np.ndarray, size: np.ndarray, dice: np.ndarray) -> np.ndarray:
    """Flight phase: move the chances along directions that keep their sum and their sum of sizes.

    Three undecided rows and two totals leave one direction. Each step goes as far as the first
    chance at 0 or 1, forwards or backwards by a throw that keeps every expected value. At most two
    chances stay between 0 and 1.
    """
    p, x = chance.tolist(), size.tolist()
    tiny, hand, throw = 1e-9, [], iter(dice.tolist())
    for k in range(len(p)):
        if not tiny < p[k] < 1 - tiny:
            p[k] = round(p[k])
            continue
        hand.append(k)
        while len(hand) == 3:
            a, b, c = hand
            u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            ahead = min(((1 - p[i]) / d if d > 0 else -p[i] / d) for i, d in zip(hand, u, strict=True) if d)
            back = min((p[i] / d if d > 0 else (p[i] - 1) / d) for i, d in zip(hand, u, strict=True) if d)
            step = ahead if next(throw) * (ahead + back) < back else -back
            for i, d in zip(hand, u, strict=True):
                p[i] += step * d
                if not tiny < p[i] < 1 - tiny:
                    p[i] = float(round(p[i]))
            hand = [i for i in hand if tiny < p[i] < 1 - tiny]
    return np.array(p)


def _land(chance: np.ndarray, size: np.ndarray, dice: np.ndarray) -> np.ndarray:
    """Landing phase: decide the rows still open (two at most), then repair what that costs.

    An open row may be the longest one, since a step moves a row by the size difference of the other
    two. So the words missed are made up by the decided rows of this block: as long as it brings the
    words nearer to their total, the best of all exchanges of a taken row for another, or else of all
    rows put in or left out, is made. Only rows that had a chance between 0 and 1 are exchanged.
    """
    p = _fly(chance, size, dice)
    open_rows = np.flatnonzero((p > 0) & (p < 1))
    wanted = float((p[open_rows] * size[open_rows]).sum())
    best = min(
        range(1 << len(open_rows)),
        key=lambda bits: (abs(sum(size[r] for j, r in enumerate(open_rows) if bits >> j & 1) - wanted), bits),
        default=0,
    )
    for j, row in enumerate(open_rows):
        p[row] = best >> j & 1
    free = (chance > 0) & (chance < 1)
    total = float((chance * size).sum())
    while abs(miss := total - float((p * size).sum())) >= 1:
        out, inside = np.flatnonzero(free & (p == 0)), np.flatnonzero(free & (p == 1))
        # A row that stays as it is stands for the one side of a mere addition or removal.
        gain = np.append(size[out], 0.0)[:, None] - np.append(size[inside], 0.0)[None, :]
        left = np.abs(miss - gain)
        left[-1, -1] = np.inf
        # Exchanges keep the number of documents; of equally good ones they come first.
        i, j = np.unravel_index(int(np.argmin(left)), left.shape)
        if not left[i, j] < abs(miss) - 1e-6:
            break
        if i < len(out):
            p[out[i]] = 1
        if j < len(inside):
            p[inside[j]] = 0
    return p


def _decide(last: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        # By size, so that the three rows of a step differ little.
        group = group.sort_values(["_size", "_order", "_row"], ascending=[False, True, True], kind="stable")
        seed = int(group["_order"].iloc[0]) % _SPAN
        dice = np.random.default_rng(seed).random(2 * len(group) + 8)
        move = _land if last else _fly
        group["_chance"] = move(group["_chance"].to_numpy(float), group["_size"].to_numpy(float), dice)
        return group

    return run


def _numbered(base: DataFrame) -> DataFrame:
    """Rows (_id, _source, _size) with a number ``_copy`` from 0 among those alike in all three.

    Rows that are alike are interchangeable, so they are counted and written out again in chunks.
    """
    alike = ["_id", "_source", "_size"]
    counted = base.groupBy(*alike).agg(F.count("*").alias("_n"))
    if counted.where("_n > 1").isEmpty():
        return base.withColumn("_copy", F.lit(0).cast("long"))
    chunks = counted.select(*alike, "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {_CHUNK}"))).alias("_c"))
    last = F.least(F.col("_n"), (F.col("_c") + 1) * _CHUNK) - 1
    return chunks.repartition(*alike, "_c").select(*alike, F.explode(F.sequence(F.col("_c") * _CHUNK, last)).alias("_copy"))


def balanced_mix(
    docs: DataFrame,
    weights: Sequence[float] = (1.0, 2.0, 3.0),
    share: float = 1.0,
    repeat: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Choose how often each document enters the mix.

    Sources in code-point order, null last, take ``weights`` in turn. A document of a source whose
    target is ``r`` times its words enters ``floor(r)`` times for sure, and once more with the chance
    that is left. The cube method draws these: blocks of ``block_rows`` rows of a source fly until
    two rows each are open, the open rows of a source form the blocks of the next level, and when one
    block is left it lands. Documents and words of every source are balanced; landing exchanges rows
    of the last block until the words of the source are as near to its target as any exchange
    brings them, within a few words where there are a few dozen documents of mixed sizes.

    Returns id, size, source_size, target, taken, copies. Null or empty text: size 0, taken 0. A null
    source is a source. Repeated rows are drawn one by one, and dealt over the blocks as others are. An empty table gives an empty result.
    The draw depends on ids and sizes alone, so reruns agree. Sources are the mix's configuration:
    one number for each goes through the driver.
    """
    spark = docs.sparkSession
    base = staged(
        docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size")),
        "mix-sizes",
    )
    rows = base.groupBy("_source").agg(F.count("*").alias("n"), F.sum("_size").alias("words")).collect()
    rows.sort(key=lambda r: (r["_source"] is None, (r["_source"] or "").encode("utf-32-be")))
    wanted = targets([r["words"] for r in rows], [weights[k % len(weights)] for k in range(len(rows))], share, repeat)
    plan = spark.createDataFrame(
        [
            (k, r["_source"], r["words"], t, max(1, -(-r["n"] // block_rows)))
            for k, (r, t) in enumerate(zip(rows, wanted, strict=True))
        ],
        T.StructType(
            [
                T.StructField("_k", T.LongType()),
                T.StructField("_name", T.StringType()),
                T.StructField("_words", T.LongType()),
                T.StructField("_target", T.DoubleType()),
                T.StructField("_blocks", T.LongType()),
            ]
        ),
    )
    if len(rows) <= 10_000:
        plan = F.broadcast(plan)
    rate = F.when(F.col("_words") > 0, F.col("_target") / F.col("_words")).otherwise(0.0)
    units = (
        _numbered(base).join(plan, F.col("_source").eqNullSafe(F.col("_name")))
        .withColumn("_rate", rate)
        .withColumn("_whole", F.floor("_rate").cast("long"))
        .withColumn("_chance", F.when(F.col("_size") > 0, F.col("_rate") - F.col("_whole")).otherwise(0.0))
        .withColumn("_order", F.xxhash64("_id", "_size", "_copy"))
        .withColumn("_block", F.pmod(F.xxhash64("_id", "_size", "_copy", F.lit(1)), F.col("_blocks")))
        .withColumn("_row", F.col("_id"))
        .select("_k", "_block", "_order", "_row", "_size", "_words", "_target", "_whole", "_chance")
    )
    most = max((-(-r["n"] // block_rows) for r in rows), default=1)
    done: list[DataFrame] = []
    while True:
        last = most <= 1
        units = staged(units.groupBy("_k", "_block").applyInPandas(_decide(last), units.schema), "mix-flight")
        still = (F.col("_chance") > 0) & (F.col("_chance") < 1)
        if last:
            done.append(units)
            break
        done.append(units.where(~still))
        # A block of the next level takes the two rows that each of block_rows / 4 blocks may have left.
        merge = max(2, block_rows // 4)
        units = units.where(still).withColumn("_block", F.floor(F.col("_block") / merge))
        most = -(-most // merge)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = F.col("_whole") + F.col("_chance").cast("long")
    return out.select(
        F.col("_row").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * copies).alias("taken"),
        copies.alias("copies"),
    )
