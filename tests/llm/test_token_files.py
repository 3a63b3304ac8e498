import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from amberline.llm import token_files
from amberline.llm.common import scratch_path, table
from tests.llm.helpers import ODD, clashing, docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def known():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return token_files.WordEncoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("  \n\t\x0b\x0cabEÉs'st1́\x1c\x85 ΣİK")), max_size=50))
def test_words_give_the_ids_of_the_text(encoder, known, text):
    assert np.frombuffer(encoder.encode([text])[0], encoder.kind).tolist() == known(text)


def test_special_strings_and_cache(encoder, known, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 1)
    for text in ("<|endoftext|> x<|startoftext|>", "It's we'll THEY'RE 3.14 — ok", ""):
        assert np.frombuffer(encoder.encode([text])[0], encoder.kind).tolist() == known(text)


def test_documents_of_the_table(spark, data, known):
    rows = sorted((r.doc_id, r.text) for r in table(spark, data, "documents").collect())
    got = {r.doc_id: r for r in token_files.token_round_trip(spark, table(spark, data, "documents"), PATH).collect()}
    at = 0
    for doc_id, text in rows:
        ids = np.array([*known(text), 2], "<u4")
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_odd_rows_and_random_access(spark, known):
    folder = scratch_path(spark, "tokens")
    files = token_files.write_tokens(clashing(docs(spark, ODD)), folder, PATH, length=64)
    out = token_files.read_documents(files).orderBy("start").collect()
    assert len(out) == len(ODD) and [r.doc_id for r in out][:2] == [None, None]
    assert [r.start for r in out] == [0, *np.cumsum([r.n_tokens for r in out])[:-1].tolist()]
    want = [x for _, t in sorted(ODD, key=lambda r: (r[0] or -1, r[1] or "")) for x in [*known(t), 2]]
    stream = []
    for f in sorted(files.collect(), key=lambda f: f.part):
        reader = token_files.SequenceReader(f.path)
        parts = []
        for i in reversed(range(-(-f.n_tokens // 64))):
            ids, mask = reader.sequence(i)
            assert len(ids) == len(mask) == 64
            parts.append([x for x, m in zip(ids.tolist(), mask.to_pylist(), strict=True) if m])
        stream += [x for part in reversed(parts) for x in part]
    assert stream == want
    with pa.memory_map(files.first().path.removeprefix("file:")) as source:
        schema = pa.ipc.open_file(source).schema
    assert schema.field("ids").type == pa.list_(pa.uint16(), 64) and schema.field("mask").type == pa.list_(pa.bool_(), 64)


def test_added_tokens_get_the_ids_of_the_library_call(spark):
    plain = Tokenizer.from_file(PATH)
    rows = [(i, t) for i, t in enumerate(["x <|endoftext|> y", "a<|startoftext|>b c", "plain words", "<|ENDOFTEXT|> <|endof text|>", "<|endoftext|>" * 3, "more words"])]
    assert plain.encode(rows[0][1], add_special_tokens=False).ids == [343, 49407, 344]
    got = {r.doc_id: r for r in token_files.token_round_trip(spark, docs(spark, rows), PATH).collect()}
    at = 0
    for doc_id, text in rows:
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_empty(spark):
    assert token_files.token_round_trip(spark, docs(spark, []), PATH).count() == 0


def test_files_are_read_back_in_several_tasks(spark):
    texts = [(i, f"Words of text {i}. " * 40) for i in range(400)]
    files = token_files.write_tokens(docs(spark, texts), scratch_path(spark, "tokens"), PATH, length=8)
    many = files.unionByName(files).unionByName(files).unionByName(files)  # the same files, with paths of their own hash
    read = token_files.read_documents(many.withColumn("path", many.path))
    assert read.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert read.count() == 4 * 400


@pytest.mark.parametrize("length", [1, 5, 64])
def test_batches_are_of_one_size(tmp_path, length):
    path, n = str(tmp_path / "x.arrow"), 3 * token_files.SEQUENCES * length + 7
    ids = np.arange(n, dtype=np.uint16)
    with open(path, "wb") as sink:
        writer = token_files.SequenceWriter(sink, "<u2", length)
        for low in range(0, n, 10_001):
            writer.add(ids[low : low + 10_001].tobytes())
        writer.close()
    reader = token_files.SequenceReader(path)
    sizes = [reader.file.get_batch(i).num_rows for i in range(reader.file.num_record_batches)]
    assert sizes[:-1] == [token_files.SEQUENCES] * 3 and sizes[-1] == -(-7 // length)
    for start, size in ((0, n), (n - 3, 3), (token_files.SEQUENCES * length - 2, 5)):
        assert np.concatenate(list(reader.tokens(start, size))).tolist() == ids[start : start + size].tolist()
    assert reader.sequence(1)[0].tolist() == ids[length : 2 * length].tolist()


def test_tasks_of_a_worker_share_one_encoder(known):
    text = "Words, not met\u00a0before ß Σς \x1c x"
    encoder = token_files.encoder_of(PATH, True)
    assert np.frombuffer(encoder.encode([text])[0], encoder.kind).tolist() == known(text)
    assert token_files.encoder_of(PATH, True) is encoder and set(text.split(" ")) & set(encoder.known)


def test_marks_behind_words_and_ascii_case_make_no_new_words():
    plain = Tokenizer.from_file(PATH)
    encoder = token_files.WordEncoder(PATH, True)
    learned = []
    learn = encoder.learn
    encoder.learn = lambda words: learned.extend(words) or learn(words)
    texts = ["Qulbrend qulbrend, QULBREND. qulbrend?! été été, Été.", "it's, IT'S 3.5. a.b, x́, ẞ. H̱, 's. ...a. <|ENDOFTEXT|>, İ. a b,"]
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert learned.count("qulbrend") == 1
    assert not [word for word in learned if word.lower().startswith("qulbrend") and word != "qulbrend"]
    assert "été," not in learned


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("aZéÉßİΣς'’.,;:!? 1٣̧̱́<|>-_字ª")))
def test_cut_words_give_the_ids_of_the_text(encoder, known, text):
    assert np.frombuffer(encoder.encode([text])[0], encoder.kind).tolist() == known(text)
