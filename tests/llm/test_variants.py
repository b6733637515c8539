import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from llm_cases import awkward, awkward_rows, nothing, words

from caskline.llm import variants as v
from caskline.llm.queries import SQL, op12_variants
from registry.compare import connect


def brute_words(docs):
    total = Counter()
    for name, text in docs:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in v.RUN.findall(text):
            code = crc32(f"{'null' if name is None else name}:{run}".encode())
            at = code % len(run)
            total[run if code % 97 else run[:at] + run[at + 1 :]] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    for k in range(len(word) + 1):
        yield from (word[:k] + c + word[k:] for c in letters)
        if k < len(word):
            yield word[:k] + word[k + 1 :]
            yield from (word[:k] + c + word[k + 1 :] for c in letters)


def brute(counts):
    letters, out, forms = sorted(set("".join(counts))), [], {}
    for word, n in counts.items():
        near = {x for x in edits(word, letters) if x in counts and x != word}
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        forms[word] = best if best is not None and counts[best] >= 2 * n else None
        out.append((word, n, len(near)))
    rows = []
    for word, n, near in out:
        root = word
        while forms[root] is not None:
            root = forms[root]
        rows.append((word, forms[word], root, n, near, counts.get(forms[word])))
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=repr)


def invented(seed, n, letters="abcdé", low=5, high=9):
    rng = random.Random(seed)
    found = {"".join(rng.choice(letters) for _ in range(rng.randint(low, high))): rng.randint(3, 40) for _ in range(n)}
    return found


def links_of(spark, counts, **limits):
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = v.near_words(frame, **limits).collect()
    return {r.word: (r.links, -r.best.minus, r.best.word) for r in got}


def brute_links(counts):
    letters, out = sorted(set("".join(counts))), {}
    for word in counts:
        near = {x for x in edits(word, letters) if x in counts and x != word}
        if near:
            best = min(near, key=lambda x: (-counts[x], x))
            out[word] = (len(near), counts[best], best)
    return out


@pytest.mark.parametrize(
    "limits",
    [{}, {"shard": 200}, {"shard": 40, "levels": 6, "single": 2}, {"shard": 3, "levels": 4, "single": 1}, {"levels": 1, "single": 0, "shard": 30}],
)
def test_near_words_equal_brute_force(spark, limits):
    """Also where branches are cut at every depth and, at the last, into cells."""
    counts = invented(1, 1500) | invented(2, 300, "ab") | {"abcde" * 40: 5, "abcde" * 39 + "abcd": 50, "ÿ÷×ßé": 3, "ÿ÷×ßéé": 7}
    assert links_of(spark, counts, **limits) == brute_links(counts)


def test_words_of_one_set_of_letters(spark):
    """Anagrams meet in one leaf of the trie whatever its depth."""
    rng = random.Random(3)
    base = list("aabbccddee")
    counts = {"".join(rng.sample(base, len(base))): 3 + k % 5 for k in range(400)}
    counts |= {w[:4] + "x" + w[5:]: 9 for w in list(counts)[:50]}
    assert links_of(spark, counts, shard=25, levels=3, single=2) == brute_links(counts)


def test_one_edit():
    rng = random.Random(4)
    pool = list(invented(5, 400, "ab", 5, 7)) + ["abcde" * 30, "abcde" * 29 + "abcd", "abcde" * 29 + "abcdd"]
    letters = np.array(sorted(map(ord, set("".join(pool)))), np.uint32)
    held = v.Words(pool, letters, np.zeros(len(letters), np.int64), 1)
    x = np.array([rng.randrange(len(pool)) for _ in range(20_000)] + [len(pool) - 3] * 2)
    y = np.array([rng.randrange(len(pool)) for _ in range(20_000)] + [len(pool) - 2, len(pool) - 1])
    near = {w: set(edits(w, "abcde")) - {w} for w in pool}
    want = [pool[b] in near[pool[a]] for a, b in zip(x, y, strict=True)]
    assert v.one_edit(held, x, held, y).tolist() == want and any(want)


def test_the_trie_spends_one_surplus_and_one_deficit():
    rng = np.random.default_rng(6)
    vectors = rng.integers(0, 3, (300, 5))
    trie = v.Trie(vectors)
    for budget in range(4):
        asked, found = trie.search(vectors[:40], budget)
        got = set(zip(asked.tolist(), found.tolist(), strict=True))
        more = np.maximum(vectors[None] - vectors[:40, None], 0).sum(2)
        less = np.maximum(vectors[:40, None] - vectors[None], 0).sum(2)
        able = (more <= (budget & 1)) & (less <= (budget >> 1))
        assert got == set(zip(*(a.tolist() for a in np.nonzero(able)), strict=True)) and len(asked) == len(got)


def test_ways_are_followed_to_their_end(spark):
    chain = [(f"w{k:03}", f"w{k + 1:03}") for k in range(60)] + [("x", "w060"), ("y", "x")]
    got = dict(v.follow(spark.createDataFrame(chain, "word string, form string")).collect())
    assert set(got.values()) == {"w060"} and len(got) == 62
    assert v.follow(spark.createDataFrame([], "word string, form string")).count() == 0


def test_test_tables_equal_sql_and_brute_force(spark, sf_dir):
    got = rows_of(op12_variants(spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert got == brute(brute_words([(r.doc_id, r.text) for r in docs])) and len(got) > 100
    sql = connect(sf_dir).sql(f"SELECT word, form, root, n, n_near, form_n FROM ({SQL['op12_variants']})").fetchall()
    assert sorted(sql, key=repr) == got


def test_small_memory_changes_nothing(spark, monkeypatch):
    docs = [(i, words(60, i % 7, "abc") + " Éclair éclair eclair") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(brute_words(docs))
    assert rows_of(v.spelling_variants(frame)) == want and any(r[1] for r in want)
    monkeypatch.setattr(v, "COUNTED", 5)
    monkeypatch.setattr(v, "SEARCHES", 7)
    monkeypatch.setattr(v, "CELLS", 50)
    monkeypatch.setattr(v, "PIECE", 100)
    assert rows_of(v.spelling_variants(frame)) == want


def test_awkward(spark):
    rows = awkward_rows() * 3
    frame = spark.createDataFrame(rows, awkward(spark).schema).selectExpr("*", "1 as word", "2 as n", "3 as form", "4 as best")
    assert rows_of(v.spelling_variants(frame)) == brute(brute_words([(r[0], r[1]) for r in rows]))
    assert v.spelling_variants(nothing(spark)).count() == 0
    named = frame.select(frame.doc_id.alias("root"), frame.text.alias("links"))
    assert v.spelling_variants(named, "root", "links").count() > 0
