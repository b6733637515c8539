"""Keep-latest deduplication and row rejection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Packed text: columns are joined by _END. _MARK stands before an escaped _END or _MARK of a value's own, and
# alone for the empty text, so that NULL can be nothing at all.
_END, _MARK = "\x00", "\x01"
_OWN_END, _OWN_MARK = "\x01\x01", "\x01\x02"
PACKED = "_packed"


def pack_text(columns: Sequence[str]) -> Column:
    """Text columns as one text, whose order is that of the columns one after the other, NULL first.

    In a shuffle a row's column costs eight bytes and its text is padded to eight; a packed row has neither.
    """

    def part(name: str) -> Column:
        value = F.col(f"`{name}`")
        escaped = F.replace(F.replace(value, F.lit(_MARK), F.lit(_OWN_MARK)), F.lit(_END), F.lit(_OWN_END))
        return F.coalesce(F.when(value == "", F.lit(_MARK)).otherwise(escaped), F.lit(""))

    return F.concat_ws(_END, *[part(name) for name in columns])


def unpack_text(packed: str, position: int) -> Column:
    """Column number ``position``, from 0, of those packed."""
    part = F.split_part(F.col(packed), F.lit(_END), F.lit(position + 1))
    own = F.replace(F.replace(part, F.lit(_OWN_END), F.lit(_END)), F.lit(_OWN_MARK), F.lit(_MARK))
    return F.when(part == _MARK, F.lit("")).when(part != "", own)


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: str,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest ``latest_by``.

    Rows loaded at the same moment are told apart by ``tiebreak`` (default: every other column, in
    order), so the choice is the same on every run. Spark applies the limit of one row per key on
    the map side too, so a key that holds most of the rows sends one row per input partition
    through the shuffle. A tiebreak of text columns is shuffled and sorted as one packed text.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c != latest_by and c not in keys]
    columns, fields = df.columns, {field.name: field for field in df.schema}
    packs = _packs([fields[c] for c in tiebreak], [*keys, latest_by])
    if packs:
        df = df.withColumn(PACKED, pack_text(tiebreak)).drop(*tiebreak)
    order = [F.col(latest_by).desc_nulls_last()]
    order += [F.col(c).asc_nulls_first() for c in ([PACKED] if packs else tiebreak)]
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    newest = (
        df.withColumn("_newest", F.row_number().over(newest_first))
        .filter(F.col("_newest") == 1)
        .drop("_newest")
    )
    if not packs:
        return newest
    # Texts are taken apart once: a filter to come could move below a mere projection and do so for each column it reads.
    texts = F.struct(*[unpack_text(PACKED, i).alias(c) for i, c in enumerate(tiebreak)])
    whole = newest.withColumn(PACKED, texts)
    apart = whole.select(*[f"`{c}`" for c in whole.columns if c != PACKED], F.inline(F.array(PACKED)))
    return apart.select(*[F.col(f"`{c}`").alias(c, metadata=fields[c].metadata) for c in columns])


def _packs(fields: Sequence[T.StructField], others: Sequence[str]) -> bool:
    """Whether a tiebreak can be packed: several different columns, all text compared byte by byte."""
    names = [field.name for field in fields]
    return len(set(names) - set(others)) == len(names) > 1 and all(f.dataType == T.StringType() for f in fields)


def split_rejects(
    df: DataFrame, rules: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Split rows into (accepted, rejected with a ``reject_reason``).

    Each rule is a condition a good row fulfils; a condition that is false or NULL rejects the row
    under the rule's name. The first rule that fails gives the reason.
    """
    reason = F.lit(None).cast("string")
    for name, condition in reversed(rules.items()):
        failed = ~F.coalesce(condition, F.lit(False))
        reason = F.when(failed, F.lit(name)).otherwise(reason)
    judged = df.withColumn("reject_reason", reason)
    accepted = judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, judged.filter(F.col("reject_reason").isNotNull())
