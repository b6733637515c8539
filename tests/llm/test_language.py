from collections import Counter

import numpy as np
from llm_cases import awkward, nothing, plan

from caskline.llm import language as g


def brute_grams(text):
    out, gap = Counter(), "\x01"
    words = "".join(c.lower() if len(c.lower()) == 1 else c for c in text) if text else ""
    words = "".join(c if c.isalpha() else " " for c in words).split()
    if not words:
        return out
    out.update(c for w in words for c in w)
    for n in (2, 3):
        for w in words:
            padded = gap + w + gap
            out.update(padded[k : k + n] for k in range(len(padded) - n + 1))
    return out


def number(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def test_grams():
    for text in ("", "12 ..", "a", "Hello, World! hello", "Éa ñ 漢字 𝒳y", "a1b"):
        got = Counter(g.grams_of(text).tolist())
        want = Counter({number(k): n for k, n in brute_grams(text).items()})
        # Gaps are shared by neighbouring words, which no n-gram of a word can tell.
        assert got == want


def test_ranks_follow_counts_then_numbers():
    assert g.ranked(np.array([5, 3, 3, 9, 9, 1]), 3).tolist() == [3, 9, 1]
    assert g.ranked(np.empty(0, np.int64), 3).tolist() == []


def test_out_of_place_distance(spark):
    train = spark.createDataFrame([("x", "aa ab aa"), ("y", "zz zy zz"), ("x", None)], "lang string, text string")
    profiles = g.train_profiles(train, ranks=5)
    ranks = {}
    for r in profiles.collect():
        ranks.setdefault(r.lang, {})[r.gram] = r["rank"]
    assert {k: len(v) for k, v in ranks.items()} == {"x": 5, "y": 5}
    docs = spark.createDataFrame([(1, "ab za"), (2, "zz"), (3, "??"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in g.identify(docs, profiles, ranks=5).collect()}
    for k, text in ((1, "ab za"), (2, "zz")):
        own = g.ranked(g.grams_of(text), 5).tolist()
        far = {lang: sum(abs(p[x] - i) if x in p else 5 for i, x in enumerate(own)) for lang, p in ranks.items()}
        best, rest = sorted(far, key=lambda x: (far[x], x))[:2]
        assert got[k].lang_pred == best and abs(got[k].score - (far[rest] - far[best]) / far[rest]) < 1e-12
    assert got[3].lang_pred == got[4].lang_pred == "und" and got[3].score == 0


def test_held_out_accuracy_on_the_test_tables(spark, larger_dir):
    docs = spark.read.parquet(f"{larger_dir}/documents.parquet")
    rows = g.language_predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward(spark):
    rows = g.language_predictions(awkward(spark)).collect()
    assert len(rows) == 13
    assert all(r.lang_pred == "und" for r in rows if r.doc_id in (1, 2, 3))
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert g.language_predictions(nothing(spark)).count() == 0
    unlabelled = awkward(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in g.language_predictions(unlabelled).collect()} == {"und"}


def test_ranks_are_limited_before_they_meet(spark):
    train = spark.createDataFrame([("x", "aa ab aa"), ("y", "zz zy zz")], "lang string, text string")
    shown = plan(g.train_profiles(train, ranks=5))
    assert "WindowGroupLimit" in shown and "Partial" in shown
