"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from caskline.llm.common import slices, staged

#: Length of the n-grams, and how many of a text or a language are ranked.
LONGEST, RANKS = 3, 300
#: Text bytes handled at a time inside a task.
PIECE = 1 << 20
_GAP = 1


def _letters() -> np.ndarray:
    """For each code point below 2 ** 17: its lower-case letter, or the gap. Rarer planes: see ``_folded``."""
    out = np.full(1 << 17, _GAP, np.uint32)
    for code in range(len(out)):
        char = chr(code)
        if char.isalpha():
            small = char.lower()
            out[code] = ord(small) if len(small) == 1 else code
    return out


_TABLE: list[np.ndarray] = []


def _folded(text: str) -> np.ndarray:
    """Lower-case letters of a text as code points, every run of anything else as one gap, gaps around."""
    if not _TABLE:
        _TABLE.append(_letters())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _TABLE[0][np.minimum(codes, (1 << 17) - 1)]
    for k in np.flatnonzero(codes >= 1 << 17):
        low[k] = codes[k] if chr(codes[k]).isalpha() else _GAP
    codes = np.concatenate([[_GAP], low, [_GAP]]).astype(np.int64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _GAP) | (codes[:-1] != _GAP)
    return codes[keep]


def grams_of(text: str | None) -> np.ndarray:
    """All n-grams of a text as numbers (21 bits a character), unsorted; a lone gap is none."""
    codes = _folded(text or "")
    if len(codes) <= 1:
        return np.empty(0, np.int64)
    parts = [codes[codes != _GAP]]
    for n in range(2, LONGEST + 1):
        value = codes[: max(0, len(codes) - n + 1)]
        for k in range(1, n):
            value = (value << 21) | codes[k : len(codes) - n + 1 + k]
        # A gap inside would join two words.
        inside = np.ones(len(value), bool)
        for k in range(1, n - 1):
            inside &= codes[k : k + len(value)] != _GAP
        parts.append(value[inside])
    return np.concatenate(parts)


def ranked(grams: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams, the most frequent first, equally frequent ones by their number."""
    if not len(grams):
        return grams
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    counts = np.diff(np.append(first, len(grams)))
    values = grams[first]
    if len(counts) > ranks:
        least = np.partition(counts, len(counts) - ranks)[len(counts) - ranks]
        keep = counts >= least
        values, counts = values[keep], counts[keep]
    return values[np.argsort(-counts, kind="stable")[:ranks]]


def train_profiles(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", ranks: int = RANKS) -> DataFrame:
    """Count every n-gram of every text by language; the ``ranks`` most frequent make its profile.

    Returns lang, rank (from 0), gram. Counts are summed inside the tasks, then by Spark. Of a language's
    distinct n-grams each task sends its ``ranks`` most frequent on to the window.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(grams), pa.string()), "gram": grams, "n": n.astype(np.int64)}
                )
            held.clear()

        size = 0
        for batch in slices(batches, text_col, PIECE):
            for lang, text in zip(batch.column(lang_col).to_pylist(), batch.column(text_col).to_pylist(), strict=True):
                held.setdefault(lang, []).append(part := grams_of(text))
                size += len(part)
                if size > 4 * PIECE:
                    yield from flush()
                    size = 0
        yield from flush()

    totals = (
        labelled.select(lang_col, text_col)
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    # The limit stands on the row number itself, so every task keeps its first rows only before they meet.
    first = totals.withColumn("_place", order).where(F.col("_place") <= ranks)
    return first.select("lang", (F.col("_place") - 1).alias("rank"), "gram")


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: int = RANKS) -> DataFrame:
    """Name the language whose profile is nearest to the text's by out-of-place distance.

    Each of the text's n-grams costs the difference of its ranks, or ``ranks`` if the profile lacks
    it. Returns id, lang_pred, score: how much nearer the nearest profile is than the next (0 to 1; with
    a single profile, how near it is). Ties go to the language first by name. Texts that are null or
    without a letter, and all texts when nothing was learned, are ``und`` with score 0.
    A profile is ``ranks`` numbers, so what each task gets is bounded by the number of languages.
    """
    learned: dict[str, np.ndarray] = {}
    for row in profiles.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("p")).collect():
        learned[row["lang"]] = np.array([x["gram"] for x in row["p"]], np.int64)
    names = sorted(learned)
    order = [np.argsort(learned[x]) for x in names]
    lists = [learned[x][o] for x, o in zip(names, order, strict=True)]

    def judge(text: str | None) -> tuple[str, float]:
        own = ranked(grams_of(text), ranks)
        if not len(own) or not names:
            return "und", 0.0
        place, far = np.arange(len(own)), []
        for grams, at in zip(lists, order, strict=True):
            k = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            far.append(int(np.where(grams[k] == own, np.abs(at[k] - place), ranks).sum()))
        best = int(np.argmin(far))
        rest = min((d for k, d in enumerate(far) if k != best), default=ranks * len(own))
        return names[best], (rest - far[best]) / rest if rest else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, PIECE):
            found = [judge(text) for text in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[id_col, "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, lang_pred string, score double")


def language_predictions(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Learn from the documents outside fold 0 that have a language, and predict for all.

    A document's fold is the CRC-32 of its id as text, modulo ``folds``; a null id is held out.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    held = F.coalesce(fold == 0, F.lit(True))
    train = docs.where(~held & F.col("lang").isNotNull())
    profiles = staged(train_profiles(train), "language-profiles")
    return identify(docs, profiles).select("doc_id", held.alias("held_out"), "lang_pred", "score")
