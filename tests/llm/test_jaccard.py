import random
import re

import pytest
from llm_cases import awkward, nothing, words

from caskline.llm import jaccard as j

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(copies_id, n_copies, n_links, class_id) of each id."""
    by = {}
    for i, text in rows:
        by.setdefault(shingles(text), []).append(i)
    sets = [x for x in by if x]
    links = {x: [y for y in sets if y != x and 5 * len(x & y) >= 4 * len(x | y)] for x in sets}
    out = {}
    for x, ids in by.items():
        if not x:
            out.update({i: (i, 1, 0, i) for i in ids})
            continue
        seen, todo = {x}, [x]
        while todo:
            for y in links[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        low = min(i for y in seen for i in by[y])
        out.update({i: (min(ids), len(ids), len(links[x]), low) for i in ids})
    return out


def corpus():
    rng, rows, passage = random.Random(5), [], words(90, 1)
    for k in range(40):
        rows.append(words(rng.randint(30, 150), 10 + k))
    for k in range(40):  # unlike texts around one long passage
        rows.append(" ".join([words(rng.randint(5, 60), 100 + k), passage, words(rng.randint(5, 60), 200 + k)]))
    base = words(200, 2).split()
    for k in range(50):  # one large group of near copies
        own = base[:]
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(200)] = f"x{k}{rng.random()}"
        rows.append(" ".join(own))
    for k in range(20):  # small groups and copies
        own = words(60, 300 + k).split()
        rows += [" ".join(own), " ".join([*own[:-1], "end"]), " \n".join(own)]
    rows += ["a b c", "a  b c", "a b", "", None, " "]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("how", [{}, {"small": 4, "tile": 7}, {"small": 2, "tile": 1000}])
def test_equals_brute_force(spark, how):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.copies_id, r.n_copies, r.n_links, r.class_id) for r in j.near_duplicates(docs, **how).collect()}
    assert got == brute(rows)


def test_runs_reach_the_recall():
    for recall in (0.9, 0.99, 0.9999):
        runs = j.runs_for(recall, 0.8)
        assert (1 - 0.75) ** runs <= 1 - recall + 1e-9
    assert j.runs_for(0.99, 0.5) > j.runs_for(0.99, 0.9)


def test_components(spark):
    edges = [("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("z", "y"), ("q", "q")] + [(f"h{k}", "hub") for k in range(40)]
    got = {r.node: r.root for r in j.components(spark.createDataFrame(edges, "rep string, to string")).collect()}
    assert got == {**dict.fromkeys("abcde", "a"), "y": "y", "z": "y", **{f"h{k}": "h0" for k in range(40)}, "hub": "h0"}


def test_awkward(spark):
    got = j.near_duplicates(awkward(spark)).collect()
    assert len(got) == 13
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by[6].copies_id, by[6].n_copies, by[6].class_id) == (5, 3, 5)
    assert (by[9].class_id, by[9].n_links, by[8].n_links) == (8, 1, 1)
    assert [(by[k].class_id, by[k].n_copies) for k in (1, 2, 3)] == [(1, 1), (2, 1), (3, 1)]
    assert j.near_duplicates(nothing(spark)).count() == 0
    left = j.keep_one_of_each(awkward(spark))
    assert left.columns == awkward(spark).columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["1", "2", "3", "4", "5", "None", "None", "7", "8", "10"])


def test_rows_that_repeat_id_and_text_are_compared_once(spark, monkeypatch):
    compare = j._compare

    def strict(similarity, k):
        inner = compare(similarity, k)

        def run(key, group):
            assert not group["rep"].duplicated().any()
            return inner(key, group)

        return run

    monkeypatch.setattr(j, "_compare", strict)
    base = words(60, 1).split()
    rows = [(1, " ".join(base))] * 60 + [(2, " ".join([*base[:-1], "end"]))] + [(None, words(50, 2))] * 20 + [(k, words(40, k)) for k in range(10, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = j.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {(r.copies_id, r.n_copies, r.n_links, r.class_id) for r in got if r.doc_id in (1, 2)} == {(1, 60, 1, 1), (2, 1, 1, 1)}
    assert sorted(str(r.doc_id) for r in j.keep_one_of_each(docs).collect()) == sorted(["1", "None", *map(str, range(10, 30))])


def test_no_two_ids_read_alike(spark):
    from caskline.llm.common import row_key

    ids = ["a" * 24 + "-1", "a" * 24 + "-2", "a", "0a", "7", "07", "-7", "null", "", None, "12345678901234567890123"]
    rows = spark.createDataFrame([(i, "same") for i in ids], "doc_id string, text string")
    assert rows.select(row_key("doc_id", "text")).distinct().count() == len(ids)
    numbers = spark.createDataFrame([(i, "t") for i in (10, 9, 0, None, 10**18)], "doc_id long, text string")
    in_order = [r.doc_id for r in numbers.orderBy(row_key("doc_id", "text")).collect()]
    assert in_order == [0, 9, 10, 10**18, None]
