"""Quality rules: decision lists learned from labelled text statistics, applied as Spark conditionals."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from caskline.llm.common import WORD

#: Statistics the rules may test; every one is a number for every text.
FEATURES = (
    "n_words",
    "mean_word_chars",
    "symbols_per_word",
    "dup_line_share",
    "repeat_word_share",
    "stops_per_word",
    "digits_per_word",
    "words_per_line",
)
#: Labelled rows a list is learned from, at most; those with the smallest hashes of their id.
TRAIN_ROWS = 20_000


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Count words, word characters, symbols, repeated lines and words in repeated 3-word windows.

    Null or empty texts count 0 everywhere. Windows are told apart by 64-bit hashes within a text.
    Time is n log n in the words of a text. Every row of ``docs`` gives one row, in any number of copies;
    ``_row`` holds all its columns.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    count = lambda pattern: F.regexp_count("_t", F.lit(pattern)).cast("long")
    lines = F.filter(F.split("_t", "\n"), lambda line: line.rlike(WORD))
    w = F.regexp_extract_all("_t", F.lit(WORD), F.lit(0))
    words = (
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), text.alias("_t"))
        .withColumns({"_w": w, "_lines": lines})
        .select(
            "_row",
            "_w",
            F.size("_w").cast("long").alias("n_words"),
            (F.length("_t") - count(r"[\x20\x09-\x0D]")).cast("long").alias("word_chars"),
            count(r"[#*$%&|<>]").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size("_lines").cast("long").alias("_n_lines"),
            count(r"[.!?,;:]").alias("_stops"),
            count(r"[0-9]").alias("_digits"),
        )
    )
    window = F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3),
        lambda i: F.struct(
            F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i")
        ),
    )
    sorted_windows = F.when(F.size("_w") > 3, F.sort_array(window))
    seen_twice = F.filter(
        "_s",
        lambda x, k: (F.get("_s", k - 1)["h"] == x["h"]) | (F.get("_s", k + 1)["h"] == x["h"]),
    )
    covered = F.aggregate(
        F.sort_array(F.transform(seen_twice, lambda x: x["i"])),
        F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n")),
        lambda a: a["n"],
    )
    # A filter on a result is not moved below a row number. Below this one it would sort the windows anew
    # for each of them.
    return words.withColumns({"_s": sorted_windows, "_guard": F.monotonically_increasing_id()}).select(
        "_row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(F.col("_guard") >= 0, F.coalesce(covered, F.lit(0))).cast("long").alias("n_repeat_words"),
        "_n_lines",
        "_stops",
        "_digits",
    )


def features() -> dict[str, Column]:
    """The statistics as sizes that do not grow with the text; 0 for a text without words."""
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "_n_lines"),
        "repeat_word_share": per("n_repeat_words", "n_words"),
        "stops_per_word": per("_stops", "n_words"),
        "digits_per_word": per("_digits", "n_words"),
        "words_per_line": per("n_words", "_n_lines"),
    }


@dataclass(frozen=True)
class Threshold:
    """One threshold: ``feature > value`` or ``feature <= value``."""

    feature: str
    above: bool
    value: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.value if self.above else x[self.feature] <= self.value

    def column(self, by: dict[str, Column]) -> Column:
        return by[self.feature] > self.value if self.above else by[self.feature] <= self.value

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.value:g}"


Rule = tuple[Threshold, ...]


def _all_hold(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for test in rule:
        out &= test.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: int, longest: int) -> Rule:
    """Add the threshold with the largest information gain until no good row is left or none gains."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < longest:
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        if not p0 or not n0:
            break
        best, gain = None, 1e-9
        for name, column in x.items():
            here = column[inside]
            points = np.unique(np.quantile(here, np.linspace(0, 1, cuts + 2)[1:-1], method="lower"))
            order = np.argsort(here, kind="stable")
            ranked, hits = here[order], np.concatenate([[0], np.cumsum(bad[inside][order])])
            upto = np.searchsorted(ranked, points, side="right")
            for above in (False, True):
                p = p0 - hits[upto] if above else hits[upto]
                total = len(here) - upto if above else upto
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(p > 0, p * (np.log2(p / np.maximum(total, 1)) - np.log2(p0 / (p0 + n0))), -1.0)
                k = int(np.argmax(gains)) if len(gains) else 0
                if len(gains) and gains[k] > gain:
                    best, gain = Threshold(name, above, float(points[k])), float(gains[k])
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drop last thresholds as long as held-back rows are told apart no worse: (p - n) / (p + n)."""

    def worth(r: Rule) -> float:
        hit = _all_hold(r, x, len(bad))
        p, n = (bad & hit).sum(), (~bad & hit).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def learn_decision_list(
    x: dict[str, np.ndarray],
    bad: np.ndarray,
    seed: int = 1,
    least_precision: float = 0.9,
    least_hits: int = 5,
    most_rules: int = 12,
    cuts: int = 63,
    longest: int = 4,
) -> list[Rule]:
    """Sequential covering: grow a conjunction on two thirds of the rows, prune it on the rest, keep it
    if ``least_precision`` of the held-back rows it hits are bad, take out what it covers, repeat.
    Without rows of both classes the list is empty."""
    rng = np.random.default_rng(seed)
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    misses = 0
    while len(rules) < most_rules and misses < 3 and bad[left].sum() >= 2 * least_hits and (~bad[left]).any():
        rows = np.flatnonzero(left)
        held = rng.random(len(rows)) < 1 / 3
        part = lambda at: {k: v[at] for k, v in x.items()}
        rule = _prune(_grow(part(rows[~held]), bad[rows[~held]], cuts, longest), part(rows[held]), bad[rows[held]])
        hit = _all_hold(rule, part(rows), len(rows))
        p, n = (bad[rows] & hit & held).sum(), (~bad[rows] & hit & held).sum()
        if not rule or p < least_hits or p < least_precision * (p + n):
            misses += 1
            continue
        rules.append(rule)
        left[rows[hit]] = False
    return rules


def rejected_by(rules: list[Rule], by: dict[str, Column]) -> Column:
    """Number of the first rule that holds (from 1), null if none does: one ordered CASE WHEN."""
    if not rules:
        return F.lit(None).cast("int")
    conditions = []
    for rule in rules:
        condition = rule[0].column(by)
        for test in rule[1:]:
            condition &= test.column(by)
        conditions.append(condition)
    out = F.when(conditions[0], 1)
    for k, condition in enumerate(conditions[1:], 2):
        out = out.when(condition, k)
    return out


def train_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS, **how
) -> list[Rule]:
    """Learn from the statistics of labelled documents, at most ``rows``. Labels other than 0 and 1 don't
    count; a document labelled both ways counts as good."""
    wanted = (
        labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max("quality").alias("_good"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(wanted), "_id")
    sample = (
        text_statistics(texts, "_text")
        .select("_row._id", "_row._good", *[c.alias(f"_{name}") for name, c in features().items()])
        .dropDuplicates(["_id"])
        .collect()
    )
    sample.sort(key=lambda r: r["_id"])
    x = {name: np.array([r[f"_{name}"] for r in sample], float) for name in FEATURES}
    return learn_decision_list(x, np.array([r["_good"] == 0 for r in sample], bool), **how)


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, how: dict) -> DataFrame:
    """Statistics with base_failed, rule and kept."""
    rule = rejected_by(train_rules(docs, labels, id_col, text_col, **how), features())
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        text_statistics(docs, text_col)
        .withColumns({"base_failed": failed, "rule": rule})
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Judge every document: base rules (under 50 words, or over half of the words in repeated 3-word
    windows), then the learned decision list.

    Returns the id, the five counts, base_failed, rule (number of the list's rule, else null) and kept.
    Null and empty texts have no words and fail the base rule. Repeated rows are judged one by one.
    Without usable labels only the base rules hold; an empty table gives an empty result.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return _judged(docs, labels, id_col, text_col, how).select(
        F.col(f"_row.{id_col}").alias(id_col), *counts, "base_failed", "rule", "kept"
    )


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that ``quality_verdicts`` keeps, with their columns."""
    judged = _judged(docs, labels, id_col, text_col, how)
    # As above: the counts are not worked out twice, for the filter and the result.
    return judged.withColumn("_pass", F.monotonically_increasing_id()).where("kept and _pass >= 0").select("_row.*")
