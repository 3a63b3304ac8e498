import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from amberline.llm import bpe
from amberline.llm.common import table
from tests.llm.helpers import ODD, clashing, docs

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")]


def known(path):
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=PATHS)
def pair(request):
    return bpe.Encoder(bpe.load_ranks(request.param), public_tokenizers.PATTERN), known(request.param)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("  \n\tabeéñ'st1\x1c\x85 ")), max_size=60))
def test_any_text(pair, text):
    encoder, want = pair
    assert list(encoder.encode([text])) == [want.encode_ordinary(text)]


def test_long_pieces(pair):
    encoder, want = pair
    for text in ("a" * 3000, "ab" * 500, "ñ" * 400, "  " * 300 + "x", "=" * 777, "thethethe" * 90):
        assert list(encoder.encode([text])) == [want.encode_ordinary(text)]


def test_state_reset(pair, monkeypatch):
    monkeypatch.setattr(bpe, "STATES", 50)
    monkeypatch.setattr(bpe, "PIECES", 10)
    encoder = bpe.Encoder(pair[0].machine.ranks, public_tokenizers.PATTERN)
    text = "Many different words make many different states, internationalisation too."
    assert list(encoder.encode([text] * 2)) + list(encoder.encode([text])) == [pair[1].encode_ordinary(text)] * 3


@given(st.binary(max_size=30), st.integers(1, 5))
def test_stream_ends_between_characters(data, step):
    stream = bpe.Utf8Stream()
    parts = [stream.feed(data[i : i + step]) for i in range(0, len(data), step)] + [stream.close()]
    assert b"".join(parts) == data


@given(st.text(max_size=30), st.integers(1, 3))
def test_stream_parts_decode(text, step):
    data, stream = text.encode("utf-8", "ignore"), bpe.Utf8Stream()
    parts = [stream.feed(data[i : i + step]).decode() for i in range(0, len(data), step)]
    assert "".join(parts) + stream.close().decode() == data.decode()


def test_documents(spark, data):
    want = known(PATHS[0])
    rows = [(r.doc_id, r.text) for r in table(spark, data, "documents").collect()] + [(i and i + 10_000, t) for i, t in ODD]
    out = bpe.encode_documents(clashing(docs(spark, rows)), PATHS[0], public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        if r.doc_id is not None:
            text = texts[r.doc_id] or ""
            ids = want.encode_ordinary(text)
            assert r.ids == ids and r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_documents(docs(spark, []), PATHS[0], public_tokenizers.PATTERN).count() == 0


def test_tasks_of_a_worker_share_one_encoder():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoder = bpe.encoder_of(path, public_tokenizers.PATTERN)
    first = list(encoder.encode(["unheard-of wordings"]))
    steps = len(encoder.machine.steps)
    assert list(bpe.encoder_of(path, public_tokenizers.PATTERN).encode(["unheard-of wordings"])) == first
    assert len(encoder.machine.steps) == steps > 0
