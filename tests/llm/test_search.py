import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward, awkward_rows, nothing, words

from caskline.llm import search as s
from caskline.llm.common import LEAN_WORKERS
from caskline.llm.queries import SQL, op11_search
from registry.compare import connect


def brute(docs, items, k=20):
    """(item's number, rank) -> (id, score), for lists of (id, text); nulls last among equal scores."""
    tfs = [(i, s.terms_of(t)) for i, t in docs if s.terms_of(t)]
    count, total = len(tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        asked, found = s.terms_of(text), []
        for i, c in tfs:
            m = 100 - 25 + 25 * sum(c.values()) * count // total
            score = sum(
                o * math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, o in asked.items()
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r, i, -score) for r, (score, _, i) in enumerate(sorted(found, key=lambda f: f[:2] + (f[2] or 0,))[:k], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def test_terms():
    assert s.terms_of("Ab ab-AB 3x_é É") == {b"ab": 3, b"3x": 1, "é".encode(): 1, "É".encode(): 1}
    assert not s.terms_of(None) and not s.terms_of(" .,")
    long = "ab cd " * (s.PIECE // 4)
    assert s.terms_of(long) == {b"ab": s.PIECE // 4, b"cd": s.PIECE // 4}


def test_term_counts():
    texts = ["Ab ab-AB 3x_é É", None, "", " .,", "a", "b", " c", "d ", "-é漢 x", "a"]
    whole = pa.array(texts, pa.string())
    for part in (whole, whole[1:], whole[4:6], whole[:0], pa.array([None], pa.string())):
        want = [sum(s.terms_of(t).values()) for t in part.to_pylist()]
        assert s.count_terms(part).tolist() == want


def test_a_block_holds_every_posting():
    counts = [Counter({b"a": 2, b"b": 1}), Counter({b"a": 1}), Counter({b"a": 2, b"c": 5})]
    block = s._block(80, "x", None, counts)
    assert block["terms"] == ["a", "b", "c"] and block["dfs"].tolist() == [3, 1, 1] and block["max_tfs"].tolist() == [2, 1, 5]
    assert block["docs"].tolist() == [0, 2, 1, 0, 2]
    assert block["run_tfs"].tolist() == [2, 1, 1, 5] and block["run_docs"].tolist() == [2, 1, 1, 1]


def test_test_tables_equal_sql_and_brute_force(spark, larger_dir):
    got = rows_of(op11_search(spark, larger_dir))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{larger_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{larger_dir}/benchmark.parquet").collect()]
    assert got == brute(docs, items)
    sql = connect(larger_dir).sql(f"SELECT item_id, rank, doc_id, score FROM ({SQL['op11_search']})").fetchall()
    assert sorted(sql, key=repr) == got


@pytest.mark.parametrize("limits", [{}, {"BLOCK_DOCS": 3, "FIRST": 1, "BANK_ITEMS": 2}, {"BLOCK_PAIRS": 5, "BANK_TERMS": 4, "CHUNK": 3}])
def test_small_blocks_and_banks_change_nothing(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(s, name, value)
    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnop")
    docs = [(i, " ".join(rng.choice(letters, rng.integers(1, 12)))) for i in range(150)]
    docs += [(1000 + i, "p o p") for i in range(40)]  # equal scores, one stratum
    items = [(i, " ".join(rng.choice(letters, rng.integers(1, 6)))) for i in range(9)] + [(100, "p p o"), (101, "zz")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    index = s.build_index(frame)
    blocks = index.blocks(spark).collect()
    assert sorted(i for b in blocks for i in b.ids) == sorted(i for i, _ in docs)
    assert len({b.block for b in blocks}) == len(blocks) and all(len(b.ids) <= s.BLOCK_DOCS for b in blocks)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for k in (1, 20):
        assert rows_of(s.search(index, asked, k)) == brute(docs, items, k)


def test_no_visit_below_the_bound(spark):
    """The bound of a block is at least every score in it, and blocks below the threshold give nothing."""
    docs = [(i, words(30, i)) for i in range(60)]
    index = s.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    items = [(0, docs[7][1])]
    bank = s._Bank.of(s.item_terms(spark.createDataFrame(items, "item_id long, text string")).collect())
    bank.weights = np.arange(1, len(bank.terms) + 1)
    reach = {}
    for b in index.blocks(spark).collect():
        found = {c: np.array(b[c]) for c in ("dfs", "max_tfs", "run_tfs", "run_docs", "docs")} | {"n": len(b.ids)}
        bounds, number, place = s._bounds(bank, pa.array(b.terms), found["max_tfs"], b.m)
        scores = s._scores(bank, np.array([0]), number, place, found, b.m)
        assert scores.max() <= bounds[0]
        reach[b.block] = bounds[0]
    least = np.array([sorted(reach.values())[-1]])
    rows = s._visit(index.blocks(spark), bank, 20, least, {}, inside=False).collect()
    assert rows and all(r.value >= least[0] for r in rows)


def test_awkward(spark):
    docs = awkward(spark)
    items = spark.createDataFrame(
        [(1, "short TEXT"), (1, "short TEXT"), (2, None), (3, ""), (None, words(20, 2)), (5, words(40, 3) + " 漢字 𝒳 ñandú"), (6, "zzzzzzzzzz")],
        "item_id long, text string",
    ).selectExpr("*", "'a' as rank", "1 as score", "2 as doc_id", "3 as item")
    got = rows_of(s.search(s.build_index(docs), items))
    want = brute([(r[0], r[1]) for r in awkward_rows()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and any(r[2] is None for r in got)
    assert s.search(s.build_index(nothing(spark)), items).count() == 0
    assert s.search(s.build_index(docs), items.limit(0)).count() == 0
    texts = docs.selectExpr("concat('d', doc_id) as name", "text as body", "1 as ids", "2 as block")
    named = s.search(s.build_index(texts, "name", "body"), items, doc_col="name")
    assert {r.name for r in named.where("item_id = 1").collect()} == {"d7"}


def test_workers_give_freed_memory_back(spark, sf_dir):
    for name in LEAN_WORKERS:
        spark.sparkContext.environment.pop(name, None)
    spark.sparkContext.environment["MALLOC_ARENA_MAX"] = "3"  # a session's own setting stays
    op11_search(spark, sf_dir)
    assert spark.sparkContext.environment.pop("MALLOC_ARENA_MAX") == "3"
    assert LEAN_WORKERS.items() - {("MALLOC_ARENA_MAX", "2")} <= spark.sparkContext.environment.items()
