import random

import numpy as np
from llm_cases import awkward, nothing, words

from caskline.llm import decontaminate as d


def test_subsequence_equals_the_table():
    rng = random.Random(0)
    for _ in range(200):
        a = [rng.randint(0, 4) for _ in range(rng.randint(0, 12))]
        b = [rng.randint(0, 4) for _ in range(rng.randint(0, 12))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert d.subsequence(np.array(a), np.array(b)) == t[-1][-1]


def test_vocabulary():
    rng = np.random.default_rng(0)
    known = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    v = d.Vocabulary(known)
    mixed = np.concatenate([known, known + np.uint64(1 << 40)])
    got = v.numbers(mixed)
    assert (v.words[got[:3000]] == known).all() and (got[3000:] == -1).all()


def test_svd_spans_the_rows(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(12, 40)) * (rng.random((12, 40)) < 0.3)
    rows = [{"column": np.flatnonzero(r), "weight": r[np.flatnonzero(r)]} for r in a]
    v = d.randomised_svd(spark, rows, 40, 12)
    assert np.allclose(a @ v @ v.T, a, atol=1e-6)
    best = np.linalg.svd(a)[2][:3]
    few = d.randomised_svd(spark, rows, 40, 3, powers=6)
    assert np.allclose(np.abs(np.diag(best @ few)), 1, atol=1e-2)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long, cosine string")


def test_exact_and_reworded_passages(spark):
    rng = random.Random(3)
    items = [words(rng.randint(15, 150), 50 + k, "abcdefghijklmnop") for k in range(20)]
    docs, expected = [], set()
    for k in range(300):
        parts = [words(rng.randint(20, 120), 1000 + k, "abcdefghijklmnop"), words(rng.randint(0, 60), 3000 + k, "abcdefghijklmnop")]
        if k % 3 == 0:
            text = items[k % 20].split()
            if k % 2:  # one word in eight is another
                text = [w if j % 8 else "zzz" + str(k) for j, w in enumerate(text)]
            parts.insert(1, " ".join(text))
            expected.add((k, k % 20))
        docs.append((k, " ".join(parts).upper() if k % 5 == 0 else " ".join(parts)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = benchmark(spark, [(k, t, 1, "c") for k, t in enumerate(items)])
    for bank in (256, 7):
        assert {(r.doc_id, r.item_id) for r in d.benchmark_leaks(frame, bench, bank=bank).collect()} == expected


def test_answer_decides_between(spark):
    item = " ".join(f"w{k}" for k in range(24)) + " the answer word"
    part = " ".join(f"w{k}" if k % 3 else f"other{k}" for k in range(24))
    docs = spark.createDataFrame([(1, part + " the answer word"), (2, part + " no such thing"), (3, "quite another text here")], "doc_id long, text string")
    assert {r.doc_id for r in d.benchmark_leaks(docs, benchmark(spark, [(1, item, 1, "")])).collect()} == {1}


def test_all_passages_of_the_test_tables(spark, larger_dir):
    docs, bench = (spark.read.parquet(f"{larger_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    expected = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in r.text}
    found = {(r.doc_id, r.item_id) for r in d.benchmark_leaks(docs, bench).collect()}
    assert expected and expected <= found
    assert len(found - expected) <= 0.1 * len(expected)


def test_awkward(spark):
    bench = benchmark(spark, [(1, None, 1, ""), (None, "a b", 1, ""), (2, "", 1, ""), (3, words(120, 2), 1, ""), (3, words(120, 2), 1, "")])
    assert {(r.doc_id, r.item_id) for r in d.benchmark_leaks(awkward(spark), bench).collect()} == {(5, 3), (6, 3)}
    assert d.benchmark_leaks(nothing(spark), bench).count() == 0
    assert d.benchmark_leaks(awkward(spark), bench.limit(0)).count() == 0


def test_a_passage_in_a_third_of_all_documents_is_found(spark):
    items = [words(30, 70 + k, "abcdefghijklmnop") for k in range(12)]
    rows = [(k, " ".join([words(40, 500 + k), *([items[3]] if k % 3 == 0 else [])])) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = benchmark(spark, [(k, t, 1, "") for k, t in enumerate(items)])
    assert {(r.doc_id, r.item_id) for r in d.benchmark_leaks(docs, bench).collect()} == {(k, 3) for k in range(0, 120, 3)}


def test_repeated_and_shared_passages_keep_their_weight(spark):
    items = [words(30, 170 + k, "abcdefghijklmnop") for k in range(12)]
    rows = [(k, " ".join([words(40, 900 + k), *([items[3]] if k % 3 == 0 else [])])) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = set(range(0, 120, 3))
    plain = [(k, t, 1, "") for k, t in enumerate(items)]
    repeated = d.benchmark_leaks(docs, benchmark(spark, plain + [(3, items[3], 1, "")] * 2)).collect()
    assert {(r.doc_id, r.item_id) for r in repeated} == {(k, 3) for k in expected}
    # Three questions on one passage.
    asked = [(20 + k, f"{items[3]} q{k} r{k}", 1, "") for k in range(3)]
    shared = d.benchmark_leaks(docs, benchmark(spark, [x for x in plain if x[0] != 3] + asked)).collect()
    assert {(r.doc_id, r.item_id) for r in shared} == {(k, 20 + j) for k in expected for j in range(3)}


def test_items_of_few_or_common_words(spark):
    fill = lambda k: words(30, 1300 + k, "abcdefghijklmnop")
    common = "what is the name of the first man who was in it"
    items = ["What is the capital of France", "What is the speed of light", "of the man who was", common, *(words(30, 1200 + k, "abcdefghijklmnop") for k in range(8))]
    spread_out = " ".join(f"{w} {x} {y}" for w, x, y in zip("the of is was who it in man".split(), *(words(8, 1400 + k).split() for k in (1, 2)), strict=True))
    docs = [(k, f"{fill(k)} {spread_out} {fill(50 + k)}") for k in range(40)]
    docs += [(100, f"{fill(100)} the capital city lies in northern France {fill(101)}"), (101, f"light has a speed {fill(102)}")]
    docs += [(200 + k, f"{fill(200 + k)} {x}, {fill(300 + k)}") for k, x in enumerate(items)]
    # Five words in the midst of words of another item.
    rare = items[4].split()
    docs += [(300, " ".join(rare[:15] + "zq zr zs zt zu".split() + rare[15:]))]
    bench = [(k, x, 1, "") for k, x in enumerate([*items, "zq zr zs zt zu"])]
    got = d.benchmark_leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark(spark, bench)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(200 + k, k) for k in range(len(items))} | {(300, 4), (300, len(items))}


def test_a_large_benchmark_takes_one_scan(spark, monkeypatch):
    items = [words(12 + k % 30, 5000 + k, "abcdefghijklmnop") for k in range(1000)]
    rows = [(k, " ".join([words(40, 9000 + k), items[7 * k % 1000], words(20, 9500 + k)])) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = benchmark(spark, [(k, t, 1, "") for k, t in enumerate(items)])
    monkeypatch.setattr(d, "_KEEP", 1 << 16)  # most spaces are read again for each piece
    found = d.benchmark_leaks(docs, bench)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(k, 7 * k % 1000) for k in range(200)}


def test_stretches_left_out_have_no_long_subsequence():
    rng = np.random.default_rng(5)
    number = rng.integers(-1, 40, 4000).astype(np.int32)
    index = np.zeros(41, np.int32)
    for size in (9, 20, 60):
        own = d.Item(1, rng.integers(0, 40, size), np.empty(0, int), 0)
        low = rng.integers(0, 3990, 300)
        high = np.minimum(low + rng.integers(1, 80, 300), 4000)
        kept = d._worth_comparing(own, number, low, high, index)
        assert not index.any() and kept.any()
        for a, b, k in zip(low, high, kept, strict=True):
            assert k or d.subsequence(own.words, number[a:b]) < d.LIKELY * size


def test_blocks_leave_out_only_what_the_stretch_itself_does():
    rng = np.random.default_rng(6)
    number = rng.integers(-1, 90, 4000).astype(np.int32)
    blocks, index = d._Blocks(number, 90), np.zeros(91, np.int32)
    for size in (9, 20, 60, 200):
        own = d.Item(1, rng.integers(0, 90, size), np.empty(0, int), 0)
        low = rng.integers(0, 3990, 300)
        high = np.minimum(low + rng.integers(1, 300, 300), 4000)
        kept = blocks.may_hold(own, low, high)
        assert not (d._worth_comparing(own, number, low, high, index) & ~kept).any()
        assert not kept.all() and not blocks.bit.any() and not blocks.asked.any()


def test_windows_near_an_item_equal_those_of_all_sums():
    rng = np.random.default_rng(7)
    size, items = 60, 12
    for known in (size, 25):  # a bank of all words, and one of some
        number = np.where(rng.random(6000) < 0.4, rng.integers(0, size, 6000), -1).astype(np.int32)
        first = np.array([0, 0, 700, 703, 3500, 6000])
        weight = rng.random(size) + 0.5
        words = np.sort(rng.permutation(size)[:known])
        table = np.where(rng.random((known, 2 * items)) < 0.3, rng.random((known, 2 * items)), 0).astype(np.float32)
        bank, halves = d.Bank(np.arange(items), words, table), d._Halves(number, first, weight)
        local = np.full(size, -1, np.int32)
        local[words] = np.arange(known)
        got = {}
        for column, slots in halves.near(bank, local, 0.4):
            c, close = halves.cosines(bank, local, column, slots, 0.4)
            got |= {(column, int(halves.place[k])): x for k, x, near in zip(slots, c, close, strict=True) if near}
        want = {}
        for a, b in zip(first, first[1:], strict=False):
            parts = [number[k : min(k + d.HALF, b)] for k in range(a, b, d.HALF)]
            for k, here in enumerate(parts):
                if (here >= 0).any():
                    window = np.concatenate(parts[k : k + 2])
                    window = window[window >= 0]
                    inside = local[window]
                    near = table[inside[inside >= 0]].sum(axis=0, dtype=float) / np.sqrt((weight[window] ** 2).sum())
                    at = int(a + k * d.HALF)
                    want |= {(i, at): near[i] for i in range(items) if max(near[i], near[i + items]) >= 0.4}
        assert got.keys() == want.keys() and len(got) > 100
        assert all(abs(got[k] - want[k]) < 1e-5 for k in got)


def test_ids_may_be_texts(spark):
    item = words(30, 77, "abcdefghijklmnop")
    docs = spark.createDataFrame([("a-1", f"{words(20, 78)} {item}", 5), ("b", words(40, 79), 6), (None, item, 7)], "name string, body string, item_id int")
    bench = spark.createDataFrame([("x/1", item), ("x/2", words(25, 80, "abcdefghijklmnop"))], "item_id string, text string")
    got = {(r.name, r.item_id) for r in d.benchmark_leaks(docs, bench, id_col="name", text_col="body").collect()}
    assert got == {("a-1", "x/1"), (None, "x/1")}
    number = spark.createDataFrame([(4, item)], "item_id int, text string")
    assert {r.item_id for r in d.benchmark_leaks(docs, number, id_col="name", text_col="body").collect()} == {4}


def test_a_passage_spread_among_words_of_its_topic_is_found(spark):
    """Its words stand too far apart for a window's own cosine, but the latent space knows the topic's words."""
    rng = random.Random(11)
    topic, other = (words(60, seed, "abcdefghijklmnop").split() for seed in (8001, 8002))
    items = [" ".join(rng.sample(pool, 24)) for _ in range(20) for pool in (topic, other)]
    wanted = items[0].split()
    rest = [w for w in topic if w not in wanted]
    spread = " ".join(" ".join([w, *rng.sample(rest, 3)]) for w in wanted)
    docs = [(1, f"{words(40, 8003)} {spread} {words(40, 8004)}"), *((k, words(80, 8100 + k)) for k in range(2, 40))]
    bench = benchmark(spark, [(k, t, 1, "") for k, t in enumerate(items)])
    got = d.benchmark_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert (1, 0) in {(r.doc_id, r.item_id) for r in got}
    assert [r.cosine < d.COSINE for r in got if r.item_id == 0] == [True]
