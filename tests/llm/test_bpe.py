import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from llm_cases import awkward, nothing, plan

from caskline.llm import bpe
from caskline.llm.queries import op13_bpe


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def ranks(request):
    return bpe.load_ranks(public_tokenizers.path(request.param))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(bpe.Transducer(ranks).check(), public_tokenizers.PATTERN)


def trained(seed, letters, merges):
    """A small vocabulary from merges of the pairs that are most frequent in random text."""
    rng = random.Random(seed)
    ranks = {bytes([b]): b for b in range(256)}
    words = [[bytes([rng.choice(letters)]) for _ in range(rng.randint(1, 12))] for _ in range(200)]
    for _ in range(merges):
        pairs = {}
        for word in words:
            for pair in zip(word, word[1:]):
                pairs[pair] = pairs.get(pair, 0) + 1
        pairs = {p: n for p, n in pairs.items() if p[0] + p[1] not in ranks}
        if not pairs:
            break
        left, right = max(pairs, key=lambda p: (pairs[p], p))
        ranks[left + right] = len(ranks)
        words = [bpe.merged(b"".join(word), ranks)[0] for word in words]
    return ranks


def test_random_tokens_equal_the_library(ranks, library, encoder):
    rng, tokens = random.Random(5), list(ranks)
    for _ in range(4000):
        text = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))).decode("utf-8", "ignore")
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_small_alphabets_equal_the_library(library, encoder):
    rng = random.Random(6)
    for letters in ("ab", " a", "aeinorst ", "01 9", "\n \t", "-=* ", "éàñ漢字ßЖ ", "'stremvd "):
        for _ in range(200):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 150)))
            assert encoder.encode(text) == library.encode_ordinary(text)


def test_every_code_point_equals_the_library(library, encoder):
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    assert encoder.encode(text) == library.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(text):
    ranks = _first()
    assert _ENCODER[0].encode(text) == _ENCODER[1].encode_ordinary(text) and ranks


_ENCODER = []


def _first():
    if not _ENCODER:
        ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _ENCODER.extend([bpe.Encoder(bpe.Transducer(ranks), public_tokenizers.PATTERN), library])
    return True


@pytest.mark.parametrize("seed", range(6))
def test_other_vocabularies_equal_the_definition(seed):
    ranks = trained(seed, b"abc" if seed % 2 else b"ab", 40)
    transducer = bpe.Transducer(ranks).check()
    tight = bpe.Transducer(ranks, transducer.unmade, arcs=7)
    rng = random.Random(seed)
    for _ in range(400):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40)))
        want = [ranks[piece]] if piece in ranks else [ranks[p] for p in bpe.merged(piece, ranks)[0]]
        # Forgetting all states again and again changes nothing.
        assert transducer.encode(piece) == tight.encode(piece) == want


def test_arcs_that_keep_coming_are_not_made_anew(ranks, monkeypatch):
    transducer = bpe.Transducer(ranks, arcs=2000)
    rng, made = random.Random(3), []
    state = transducer._state
    monkeypatch.setattr(transducer, "_state", lambda branches: made.append(branches) or state(branches))
    common = [bytes(rng.choice(b"etaoinshr") for _ in range(12)) for _ in range(10)]
    want = [transducer.encode(piece) for piece in common]
    before, again = {repr(x) for x in made}, 0
    for _ in range(200):
        transducer.encode(bytes(rng.choice(b"bcdfgjklmpquvwxyz") for _ in range(12)))
        made.clear()
        assert [transducer.encode(piece) for piece in common] == want
        again += len(made)
    assert before and not again


def test_chunks_of_rows_and_rows_of_chunks():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, "漢".encode()[:2]: 301, "漢".encode(): 70_000}
    texts = ["", "ab漢", None, "é" * 40, "x", "漢字" * 9, "abab", ""]
    encoder = bpe.Encoder(bpe.Transducer(ranks), r"\w+|\W+")
    column = pa.array([None if t is None else encoder.encode(t) for t in texts], pa.list_(pa.int32()))
    tokens = bpe.TokenBytes({rank: token for token, rank in ranks.items()})
    for chunk in (1, 3, 8, 1000):
        assert tokens.texts(column, chunk) == [t or "" for t in texts]
        assert tokens.texts(column.slice(3, 3), chunk) == texts[3:6]
    for wrong in (299, -1, 70_001):
        with pytest.raises(KeyError):
            tokens.of(np.array([65, wrong], np.int32))


def test_a_token_that_its_merges_do_not_make():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bcd": 257}
    transducer = bpe.Transducer(ranks).check()
    assert transducer.unmade == {b"bcd"}
    assert transducer.encode(b"bcd") == [257] and transducer.encode(b"abcd") == [256, 99, 100]


def test_a_vocabulary_out_of_order_is_refused():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257}
    with pytest.raises(ValueError, match="in order"):
        bpe.Transducer(ranks).check()
    with pytest.raises(ValueError, match="no token"):
        bpe.Transducer({b"a": 0}).check()


def test_ids_are_written_long_before_the_end(ranks):
    transducer = bpe.Transducer(ranks)
    state, written, held = 0, 0, 0
    for n, byte in enumerate(b"a" * 5000, 1):
        arc = transducer.arcs.get(state << 8 | byte) or transducer._arc(state, byte)
        state, written = arc[0], written + len(arc[1])
        held = max(held, max(len(read) for read, _, _ in transducer.states[state]))
    assert written > 500 and held <= max(map(len, ranks)) and len(transducer.states) < 600


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(1, 5), max_size=40))
def test_streamed_bytes_equal_bytes_at_once(data, steps):
    stream, out, at = bpe.Utf8Stream(), "", 0
    for step in steps:
        out += stream.feed(data[at : at + step])
        at += step
    out += stream.feed(data[at:]) + stream.end()
    assert out == data.decode("utf-8", "replace")


def test_characters_split_between_chunks():
    text = "aé漢𝒳߿ࠀ￿\U0010ffff" * 3
    data = text.encode()
    for step in (1, 2, 3, 5):
        stream = bpe.Utf8Stream()
        parts = [stream.feed(data[at : at + step]) for at in range(0, len(data), step)]
        assert "".join(parts) + stream.end() == text
        assert all("�" not in part for part in parts)


def test_test_tables_equal_the_library(spark, larger_dir):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in op13_bpe(spark, larger_dir).collect()}
    docs = spark.read.parquet(f"{larger_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode_ordinary(doc.text or "")
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()


def test_awkward(spark):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = awkward(spark)
    encoded = bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN)
    rows = bpe.decode_ids(encoded, ranks).collect()
    assert len(rows) == 13
    want = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == want
    assert all(r.n_tokens == 0 for r in rows if not r.text)
    assert bpe.round_trip(nothing(spark), ranks, public_tokenizers.PATTERN).count() == 0
    named = docs.selectExpr("doc_id as ids", "text as n_tokens", "source as text")
    assert bpe.round_trip(named, ranks, public_tokenizers.PATTERN, "ids", "n_tokens").count() == 13
    assert "Exchange" not in plan(encoded)


def test_unknown_ids_and_lone_bytes(spark):
    ranks = {bytes([b]): b for b in range(256)}
    frame = spark.createDataFrame([(1, [0xE6, 0xBC]), (2, []), (3, None), (4, [0xE6, 0xBC, 0xA2])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode_ids(frame, ranks).collect()}
    assert got == {1: "�", 2: "", 3: "", 4: "漢"}
    with pytest.raises(Exception, match="KeyError|999"):
        bpe.decode_ids(spark.createDataFrame([(1, [999])], "doc_id long, ids array<int>"), ranks).collect()
