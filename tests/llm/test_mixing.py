import pytest
from llm_cases import awkward, nothing

from caskline.llm import mixing
from caskline.llm.mixing import balanced_mix, targets


def test_targets_share_what_a_small_source_cannot_give():
    assert targets([100, 100, 100], [1, 2, 3]) == pytest.approx([50, 100, 150])
    assert targets([10, 1000], [5, 1]) == pytest.approx([30, 980])
    assert targets([], [1]) == []
    assert targets([0, 10], [1, 1]) == pytest.approx([0, 10])


def test_words_and_documents_of_each_source_are_balanced(spark):
    docs = spark.range(6000).selectExpr(
        "id as doc_id",
        "repeat('w ', cast(1 + pmod(hash(id), 300) as int)) as text",
        "case when id % 3 = 0 then 'hot' else concat('s', id % 7) end as source",
    )
    rows = balanced_mix(docs, block_rows=64).collect()
    assert len(rows) == 6000
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
        by.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), own in by.items():
        assert sum(r.size for r in own) == size
        assert abs(sum(r.taken for r in own) - target) <= 300
        assert abs(sum(r.copies for r in own) - len(own) * target / size) <= 0.05 * len(own) + 3
    again = {(r.doc_id, r.copies) for r in balanced_mix(docs.repartition(3, "text"), block_rows=64).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}


def near_enough(rows):
    """Every source within 1 % of its target, or within its five shortest rows."""
    by = {}
    for r in rows:
        by.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), own in by.items():
        short = sum(sorted(r.size for r in own if r.size)[:5])
        assert abs(sum(r.taken for r in own) - target) <= max(0.01 * target, short)
        assert all(r.taken <= 3 * r.size for r in own)
    return by


def test_the_test_tables_meet_their_targets(spark, larger_dir):
    rows = balanced_mix(spark.read.parquet(f"{larger_dir}/documents.parquet")).collect()
    assert len(near_enough(rows)) == 20


@pytest.mark.parametrize("seed", range(3))
def test_a_row_of_a_third_of_the_words(spark, seed):
    docs = spark.range(240).selectExpr(
        "id as doc_id",
        f"case when id < 3 then repeat('w ', 3000) else repeat('w ', cast(1 + pmod(hash(id, {seed}), 150) as int)) end as text",
        "concat('s', id % 3) as source",
    )
    rows = balanced_mix(docs).collect()
    assert max(r.size for r in rows) * 3 > min(r.source_size for r in rows)
    for (size, target), own in near_enough(rows).items():
        assert abs(sum(r.copies for r in own) - len(own) * target / size) <= 0.15 * len(own) + 3


def test_landing_decides_every_row_and_leaves_sure_ones():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 10, 200):
        chance = np.where(rng.random(n) < 0.2, rng.integers(0, 2, n), rng.random(n))
        size = rng.integers(1, 500, n).astype(float)
        size[0] = 5000
        p = mixing._land(chance, size, rng.random(2 * n + 8))
        sure = (chance == 0) | (chance == 1)
        assert set(p) <= {0.0, 1.0} and (p[sure] == chance[sure]).all()
        if n == 200:
            assert abs((p * size).sum() - (chance * size).sum()) <= 2


def test_awkward_rows_and_empty_table(spark):
    rows = balanced_mix(awkward(spark)).collect()
    assert len(rows) == 13
    assert [r.taken for r in rows if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    # Sources in code-point order: a, b, é, null, with weights 1, 2, 3, 1.
    total = sum(r.size for r in rows)
    assert sum({r.source_size: r.target for r in rows}.values()) == pytest.approx(total)
    assert balanced_mix(nothing(spark)).count() == 0


def test_rows_of_one_id_are_dealt_over_the_blocks(spark, monkeypatch):
    decide, chunk = mixing._decide, 64

    def strict(last):
        inner = decide(last)

        def run(group):
            assert len(group) <= 3 * 64
            return inner(group)

        return run

    monkeypatch.setattr(mixing, "_decide", strict)
    monkeypatch.setattr(mixing, "_CHUNK", chunk, raising=False)
    docs = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end as doc_id",
        "repeat('w ', cast(case when id % 3 = 1 then 5 else 1 + id % 50 end as int)) as text",
        "'s' as source",
    )
    rows = balanced_mix(docs, share=0.5, block_rows=64).collect()
    assert len(rows) == 3000 and sum(r.doc_id is None for r in rows) == 1000 and sum(r.doc_id == 7 for r in rows) == 1000
    assert abs(sum(r.taken for r in rows) - rows[0].target) <= 50
    again = balanced_mix(docs.repartition(3), share=0.5, block_rows=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
