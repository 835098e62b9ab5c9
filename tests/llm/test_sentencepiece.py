from __future__ import annotations

import random
import struct

import pytest
import sentencepiece
from larder.llm import sentencepiece_tokens as st
from pyspark.sql import functions as F

TEXTS = [
    "", " ", "   ", "a", "  two  blanks   here ", "tab\tand\n\nlines\r\n", "emoji 😀 漢字 \x00 ​ é é", "<s> </s> <unk> <0x0A>",
    "a" * 700, "▁mark ▁▁ x", "퟿\U0010ffff", "ß nbsp", "x" * 50 + " " * 40 + "y",
]


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model():
    """A small unigram model with byte fallback, written field by field."""
    pieces = [("<unk>", 0.0, st.UNKNOWN), ("<s>", 0.0, st.CONTROL), ("</s>", 0.0, st.CONTROL)]
    pieces += [(f"<0x{b:02X}>", 0.0, st.BYTE) for b in range(256)]
    pieces += [(p, s, st.NORMAL) for p, s in (
        ("▁", -2.0), ("▁the", -2.5), ("▁th", -4.0), ("e", -3.0), ("t", -3.2), ("h", -3.4), ("he", -3.3), ("▁t", -3.9),
        ("r", -4.1), ("er", -3.5), ("▁▁", -6.0), ("here", -5.5), ("re", -3.75))]
    out = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    out += field(2, field(3, st.UNIGRAM) + field(4, len(pieces)) + field(35, 1) + field(40, 0) + field(41, 1) + field(42, 2))
    return out + field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))


@pytest.fixture(scope="module")
def model():
    return st.read_model()


def test_parity_of_whole_texts_with_the_other_library(model, folder, spark):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect()]
    reference = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = st.Codec(model)
    found = codec.encode(texts)
    ids = found.lists()
    assert codec.by_segment and all(found.parity)
    assert found.round_trip.tolist() == [codec.decode(i) == t for i, t in zip(ids, texts)]
    assert found.unknown.tolist() == [i.count(codec.model.unknown) for i in ids]
    assert ids == reference.encode(texts)
    whole = st.build_tokenizer(codec.model)
    assert [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)] == ids
    for row, text in zip(ids, texts):
        assert codec.decode(row) == reference.decode(row) == whole.decode(row, skip_special_tokens=False)
        assert codec.decode(row) == text.replace("▁", " ")


def test_a_unigram_model_with_byte_fallback():
    data = unigram_model()
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = st.Codec(data)
    rng = random.Random(6)
    texts = TEXTS[:7] + ["".join(rng.choices("there  é", k=rng.randint(1, 30))) for _ in range(200)]
    found = codec.encode(texts)
    ids = found.lists()
    assert ids == reference.encode(texts) and all(found.parity) and all(found.round_trip)
    assert [codec.decode(i) for i in ids] == texts


def test_unknown_files_are_refused():
    with pytest.raises(ValueError):
        st.parse_model(b"\x0b\x01")


def test_query_columns_nulls_repeats_and_clashes(spark, model):
    rows = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(None, None, "n"), (3, "a", "c"), (3, "a", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = st.encode(docs).collect()
    assert len(got) == len(rows)
    null = next(r for r in got if r.doc_id is None)
    assert (null.ids, null.n_tokens, null.round_trip, null.parity) == ([], 0, True, True)
    assert all(r.parity for r in got)
    assert [r.doc_id for r in got if not r.round_trip] == [TEXTS.index("▁mark ▁▁ x")]
    assert all(len(r.ids) == r.n_tokens for r in got)
    back = st.encode(docs).select("doc_id", st.decoded(F.col("ids")).alias("back")).collect()
    assert {r.back for r in back if r.doc_id == 4} == {TEXTS[4]}
    assert st.encode(docs.limit(0)).collect() == []


def test_known_segments_stay_bounded(model, monkeypatch):
    monkeypatch.setattr(st, "CACHED", 50)
    codec = st.Codec(model)
    reference = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(5):
        texts = [f"word{i}x{j} and " + "long" * 30 for j in range(30)]
        assert codec.encode(texts).lists() == reference.encode(texts)
        assert len(codec.known) <= 50


def test_the_more_used_half_of_the_segments_is_kept(model, monkeypatch):
    monkeypatch.setattr(st, "CACHED", 20)
    codec = st.Codec(model)
    reference = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(12):
        text = "often " * 9 + " ".join(f"rare{i}x{j}" for j in range(7))
        assert codec.encode([text]).lists() == [reference.encode(text)]
        assert "often" in codec.known.index and len(codec.known) <= 20


def test_checks_by_segment_equal_those_of_whole_texts(model):
    """A segment that the libraries differ in, or that does not decode to itself, shows in its texts alone."""
    codec = st.Codec(model)
    codec.encode(["one two three"])
    at = codec.known.index["two"]
    codec.known.unequal[at], codec.known.ids[codec.known.offsets[at]] = 1, codec.model.unknown
    codec.known.unlike[at] = codec.known.unknown[at] = 1
    found = codec.encode(["one three", "three two", "two", "", "one ▁ three"])
    assert found.parity.tolist() == [True, False, False, True, True]
    assert found.round_trip.tolist() == [True, False, False, True, False]
    assert found.unknown.tolist() == [0, 1, 1, 0, 0]
