import re
from collections import Counter

import numpy as np
from llm_cases import awkward, awkward_rows, nothing, plan

from caskline.llm.quality import Threshold, keep_quality, learn_decision_list, quality_verdicts, rejected_by

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_equal_brute_force(spark):
    texts = ["a b c a b c", "a a a a a", "x\nx\n \ny\nx", "#1 $2 <b>", "é 𝒳 é 𝒳 é", "a b c d", "to be or not to be or not"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(awkward(spark).select("doc_id", "text"))
    found = Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in quality_verdicts(docs, labels(spark, [])).collect()
    )
    rows = list(enumerate(texts)) + [r[:2] for r in awkward_rows()]
    assert found == Counter((i, *brute(t)) for i, t in rows)


def test_list_finds_thresholds_and_leaves_good_rows():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    bad = (x["a"] > 0.8) | ((x["b"] < 0.2) & (x["a"] < 0.5))
    rules = learn_decision_list(x, bad, most_rules=6)
    hit = np.zeros(3000, bool)
    for rule in rules:
        hit |= np.logical_and.reduce([t.holds(x) for t in rule])
    assert (hit == bad).mean() > 0.97 and (hit & ~bad).mean() < 0.01
    assert learn_decision_list(x, np.zeros(3000, bool)) == []


def test_rules_are_one_ordered_conditional(spark):
    from pyspark.sql import functions as F

    rules = [(Threshold("a", True, 5.0),), (Threshold("a", True, 1.0), Threshold("a", False, 3.0))]
    rows = spark.range(7).select(rejected_by(rules, {"a": F.col("id").cast("double")}).alias("r")).collect()
    assert [r.r for r in rows] == [None, None, 2, 2, None, None, 1]


def test_learned_list_on_the_test_tables(spark, larger_dir):
    docs, marks = (spark.read.parquet(f"{larger_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = quality_verdicts(docs, marks)
    assert not re.search("Python|Pandas|Arrow", plan(found))
    rows = found.join(marks, "doc_id").collect()
    assert sum(r.kept for r in rows if r.quality == 1 and not r.base_failed) >= 0.98 * sum(r.quality == 1 and not r.base_failed for r in rows)
    assert sum(not r.kept for r in rows if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in rows)
    kept = keep_quality(docs, marks)
    assert kept.columns == docs.columns and kept.count() == found.where("kept").count()


def test_empty_table_and_labels(spark):
    assert quality_verdicts(nothing(spark), labels(spark, [(1, 0, 0)])).count() == 0
    rows = quality_verdicts(awkward(spark), labels(spark, [(None, 1, 0), (4, None, 0), (5, 7, 1)])).collect()
    assert all(r.kept == (r.n_words >= 50 and 2 * r.n_repeat_words <= r.n_words) for r in rows)
    kept = keep_quality(awkward(spark), labels(spark, []))
    assert kept.columns == awkward(spark).columns
