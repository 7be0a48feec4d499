import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brezza.llm import queries
from brezza.llm.tokenize import Encoder, count_tokens, encode_texts, encoder, read_vocabulary, round_trips, vocabulary_path
from brezza.llm.transducer import Transducer, Utf8, decode_stream

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary_path()
DATA = read_vocabulary(PATH)


@pytest.fixture(scope="module")
def reference():
    own = tokenizers.Tokenizer.from_file(PATH.replace(".tiktoken", ".json"))
    own.encode_special_tokens = True
    return lambda text: own.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def own():
    return encoder(DATA)


ODD = ["", " ", "  ", "\n", " \n ", "a  b", "a \n b", " a", "a ", "\ta", "a  b", "a  b", "a\x1c b", "a\x85 b", "　 a", "<|endoftext|>", "don't'll we've", "é" * 50, "x" * 500, "1" * 99,
       "日本語テキスト", "🙂🙃 👩‍⚖️", "​ a", "ﬁled Ⅳ № 7", "﻿Order", "½ p.a. 3/2/2019", "á b", "\x00\x01", "''s", " 's", "İstanbul ß ẞ"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(own, reference, text):
    assert own.encode(text) == (reference(text) if text else [])
    assert own.decode(own.encode(text)) == text


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'aeinrst.,1é")), max_size=80))
def test_any_text(text):
    own = encoder(DATA)
    rust = tokenizers.Tokenizer.from_file(PATH.replace(".tiktoken", ".json")) if not hasattr(test_any_text, "rust") else test_any_text.rust
    rust.encode_special_tokens = True
    test_any_text.rust = rust
    ids = own.encode(text)
    assert ids == rust.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == text
    assert own.count(text) == len(ids)


def test_every_token_encodes_to_itself(own):
    chance = random.Random(1)
    for token in chance.sample(sorted(own.tokens), 3000):
        assert own._transducer.merged(own.tokens[token]) == [token]


def test_transducer_against_the_merges(own):
    """Pieces of random letters take many merges; small memories change nothing."""
    chance = random.Random(2)
    small = Transducer(own.ranks, limit=500)
    for _ in range(400):
        piece = "".join(chance.choice("aeionrstlchédg") for _ in range(chance.randrange(1, 40))).encode()
        wanted = own._transducer.merged(piece)
        assert list(own._transducer.encode_piece(piece)) == wanted == list(small.encode_piece(piece))


def test_states_are_met_lazily_and_shared(own):
    fresh = Transducer(own.ranks)
    assert len(fresh._keys) == 1
    fresh.encode_piece(b"unbelievablyoverwrought")
    first = len(fresh._keys)
    fresh.encode_piece(b"unbelievablyoverwrought")
    assert len(fresh._keys) == first
    # The lookahead is bounded: what is pending never grows with the piece.
    fresh.encode_piece(b"ab" * 5000)
    assert max(len(pending) for _, pending in fresh._keys) <= 2 * fresh._longest


def test_forgetting_words_changes_nothing(reference):
    tiny = Encoder(DATA, remembered=3)
    text = "the quick brown fox jumps over the lazy dog and the quick brown cat " * 5
    assert tiny.encode(text) == reference(text)


def test_streaming_decoder():
    machine = Utf8()
    data = "aé€🙂".encode()
    assert [machine.feed(bytes([b])) for b in data] == ["a", "", "é", "", "", "€", "", "", "", "🙂"]
    for raw in [b"\xc3", b"\xe2\x82", b"\xff\xfea", b"\xc3\xc3\xa9", b"\xed\xa0\x80", b"\xf0\x9f\x99", b"\xc0\xaf", b"\xf4\x90\x80\x80", b"\xe0\x80\x80"]:
        machine = Utf8()
        assert machine.feed(raw) + machine.end() == raw.decode("utf-8", "replace")
    assert list(decode_stream([0, 1], {0: b"\xe2\x82", 1: b"\xac!"})) == ["€!"]
    with pytest.raises(KeyError):
        list(decode_stream([7], {}))


def test_tables(spark, reference):
    data = [(1, "Hello  world", "x"), (2, None, "x"), (3, "", "x"), (None, "a b", "x"), (1, "Hello  world", "x"), (4, "long " * 50_000, "x")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, ids string")
    got = sorted(((r.doc_id, list(r.ids)) for r in encode_texts(df, "doc_id", "text", PATH).collect()), key=str)
    assert got == sorted(((k, reference(t) if t else []) for k, t, _ in data), key=str)
    assert encode_texts(df.limit(0), "doc_id", "text", PATH).dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    counts = {(r.doc_id, r.tokens) for r in count_tokens(df, ["doc_id"], "text", PATH).collect()}
    assert counts == {(k, len(i)) for k, i in got}
    assert all(r.exact for r in round_trips(df, "doc_id", "text", PATH).collect())


def test_corpus(spark, small, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.p7_ids(spark, small)
    assert got.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    ids = {r.doc_id: list(r.ids) for r in got.collect()}
    assert ids == {k: reference(t) if t else [] for k, t in texts.items()}


def test_memory_is_bounded_within_a_piece(own):
    """One long unbroken piece of random letters, by a transducer that may keep few steps."""
    chance = random.Random(8)
    piece = "".join(chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)).encode()
    small = Transducer(own.ranks, limit=300)
    most = 0
    step = small._step

    def counted(state, byte):
        nonlocal most
        most = max(most, len(small._steps))
        return step(state, byte)

    small._step = counted
    assert small.encode_piece(piece) == own._transducer.encode_piece(piece)
    assert most <= 300


def test_executors_need_no_file(spark, tmp_path):
    """The vocabulary is shipped: its file may go once the query is made."""
    import shutil

    copy = tmp_path / "v.tiktoken"
    shutil.copy(PATH, copy)
    encoded = encode_texts(spark.createDataFrame([(1, "the court")], "doc_id bigint, text string"), "doc_id", "text", str(copy))
    copy.unlink()
    assert encoded.first().ids == encoder(DATA).encode("the court")
