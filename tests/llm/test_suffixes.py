import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_cases import awkward, awkward_rows, nothing, words

from caskline.llm import suffixes as s


@given(st.lists(st.integers(0, 3), max_size=80))
@settings(max_examples=200, deadline=None)
def test_suffix_array(values):
    text = np.array(values, int)
    assert s.suffix_array(text).tolist() == sorted(range(len(values)), key=lambda k: values[k:])


def test_common_prefixes():
    data = np.frombuffer(b"abcabcabcabcabcabcabcabxabcabcabcabcabcabcabc", np.uint8)
    order = s.suffix_array(data)
    got = s.permuted_prefixes(data, order, 16)
    for a, b in zip(order[:-1], order[1:]):
        common = next((k for k in range(16) if data[a + k : a + k + 1].tolist() != data[b + k : b + k + 1].tolist()), 16)
        assert got[b] == (16 if common >= 16 else common // 8 * 8)


def brute(rows, length):
    """(n_bytes, n_removed, n_spans, kept) of (id, text) rows, in the operator's order."""
    seen, out = {}, {}
    for key, text in sorted(rows):
        data, gone = text.encode(), [False] * len(text.encode())
        own = set()
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen or window in own:
                gone[k : k + length] = [True] * length
            own.add(window)
        seen.update(dict.fromkeys(own))
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[key] = (len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g))
    return out


def corpus():
    passage, line = words(40, 1), words(6, 2)
    rows = []
    for k in range(60):
        parts = [words(20, 100 + k)]
        if k % 2:
            parts.append(passage[k % 7 :])
        if k % 3 == 0:
            parts += [line] * (k % 5 + 3)
        if k % 10 == 4:
            parts = [words(20, 100 + k - 4), "é" * 70, "."]
        rows.append((k, " ".join(parts)))
    rows += [(100, rows[7][1]), (101, rows[7][1]), (102, "ab" * 300), (103, "z" * 500), (104, "z" * 99)]
    return rows


@pytest.mark.parametrize("how", [{}, {"hot": 6}, {"block_bytes": 700, "hot": 30}, {"length": 40, "gram": 9}])
def test_equals_brute_force(spark, how):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in s.remove_repeats(docs, **how).collect()}
    assert got == brute(rows, how.get("length", 100))


def test_awkward(spark):
    rows = awkward_rows()
    got = s.remove_repeats(awkward(spark)).collect()
    assert len(got) == len(rows)
    # 5 stands twice and counts once, 6 repeats it; ids come before the null id.
    assert sorted(r.n_removed for r in got if r.row.doc_id == 5) == [0, 0]
    assert [r.n_removed == r.n_bytes for r in got if r.row.doc_id == 6] == [True]
    assert [r.n_removed for r in got if r.row.doc_id == 9] == [len(words(90, 4))]
    assert all(r.n_bytes == 0 == r.n_removed for r in got if r.row.doc_id in (1, 2))
    assert s.remove_repeats(nothing(spark)).count() == 0
    left = s.without_repeats(awkward(spark))
    assert left.columns == awkward(spark).columns
    assert {r.doc_id for r in left.collect()} == {4, 5, None, 7, 8, 9, 10}
    assert [r.text for r in left.where("doc_id = 9").collect()] == [" more"]
