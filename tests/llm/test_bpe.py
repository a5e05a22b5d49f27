import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import op01_bpe as bpe

RANKS = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
ENCODER = bpe.Encoder(RANKS, P.PATTERN)
DECODER = bpe.Decoder(RANKS)
KNOWN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text_encodes_as_the_reference_tokenizer(text):
    ids = ENCODER.encode(text)
    assert ids == KNOWN.encode_ordinary(text)
    assert DECODER.decode(ids) == text


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 900, " " * 700, "é" * 1300, "\n" * 50 + "x", "1" * 2500,
                                  "don't we'll I'd", "漢字かな交じり文" * 90, "😀" * 300, "x  y\x1cz"])
def test_long_runs_and_white_space(text):
    assert ENCODER.encode(text) == KNOWN.encode_ordinary(text)


def test_transducer_equals_merging_by_definition():
    rng = random.Random(3)
    for _ in range(2000):
        data = bytes(rng.choice(b"aeinrst \xc3\xa9\xe2\x82\xac") for _ in range(rng.randrange(1, 25)))
        assert ENCODER.transduce(data) == bpe.merge_bytes(RANKS, data)


def test_small_tables_give_the_same_ids(monkeypatch):
    for name, value in (("PIECES_KEPT", 3), ("STATES_KEPT", 4), ("PAIRS_KEPT", 5), ("LOOKAHEAD", 8)):
        monkeypatch.setattr(bpe, name, value)
    small = bpe.Encoder(RANKS, P.PATTERN)
    text = "internationalisation of unbelievably longwordswithoutblanks " * 3 + "zzz" * 40
    assert small.encode(text) == KNOWN.encode_ordinary(text)


def test_every_character_is_split_like_the_reference_tokenizer():
    for start in range(0, 0x3000, 7):
        c = chr(start)
        text = f"a{c} 1{c} .{c}"
        assert ENCODER.encode(text) == KNOWN.encode_ordinary(text), hex(start)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50255), max_size=40))
def test_streaming_decoder_replaces_what_is_ill_formed(ids):
    data = b"".join(ENCODER.bytes_of[i] for i in ids)
    assert DECODER.decode(ids) == data.decode("utf-8", "replace")
    fed = bpe.Decoder(RANKS)
    assert "".join(fed.feed([i]) for i in ids) + fed.finish() == data.decode("utf-8", "replace")


def test_query_over_odd_rows(spark, make_docs):
    rows = [(1, "Hello wörld"), (2, None), (3, ""), (None, "no id"), (1, "Hello wörld"), (5, "word " * 40000)]
    got = bpe.round_trip(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for (doc, text), row in zip(rows, got, strict=True):
        ids = KNOWN.encode_ordinary(text or "")
        want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (row.doc_id, row.n_tokens, row.ids_sha256) == (doc, len(ids), want)
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(make_docs([])).count() == 0
    coded = bpe.token_rows(make_docs(rows[:4]))
    assert [r.text for r in bpe.decode_ids(coded).collect()] == ["Hello wörld", "", "", "no id"]


def test_pairs_part_as_merging_by_definition():
    """Vocabularies in any order of ranks, with tokens that no merging reaches."""
    rng = random.Random(1)
    for _ in range(60):
        words = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(rng.randrange(3, 40))}
        tokens = [b"a", b"b", b"c", *sorted(words)]
        rng.shuffle(tokens)
        ranks = {t: i for i, t in enumerate(tokens)}
        coder = bpe.Encoder(ranks, r"\S+")
        for _ in range(100):
            left, right = rng.randrange(len(tokens)), rng.randrange(len(tokens))
            if all(coder.compatible(-1, t) for t in (left, right)):
                assert coder.compatible(left, right) == (bpe.merge_bytes(ranks, tokens[left] + tokens[right]) == [left, right])
            data = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 16)))
            assert coder.transduce(data) == bpe.merge_bytes(ranks, data)


def test_the_last_byte_of_a_piece_makes_no_state():
    coder = bpe.Encoder(RANKS, P.PATTERN)
    assert coder.transduce(b"") == [] and len(coder.states) == 1
    data = b"zqxjkvzq"
    assert coder.transduce(data) == bpe.merge_bytes(RANKS, data)
    assert len(coder.states) <= len(data)
