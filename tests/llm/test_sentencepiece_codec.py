"""Encoding and decoding against the sentencepiece library."""

import hashlib
import struct

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adspend.llm import sentencepiece_codec as codec

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
SP = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
OWN = codec.codec(MODEL)
HARD = ["", " ", "  x", "x  ", "▁", "a▁▁b", "\n", "a\n\n b", "\x00", "</s> <0x41> <unk>", "é😀𠀀中文", "aaaaaaaaaaaaaa",
        "the " * 3000, "x" * 5000, "\tif x:\n\t\treturn 'ｈ'"]


def unpacked(b):
    return list(struct.unpack(f"<{len(b) // 4}I", b))


def check(text):
    ids = SP.encode(text, add_bos=True, add_eos=True)
    assert unpacked(OWN.encode(text)) == ids
    assert OWN.decode(struct.pack(f"<{len(ids)}I", *ids)) == SP.decode(ids)


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    check(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab eThin.,0\n▁é😀"), st.characters(exclude_categories=("Cs",))),
               max_size=60))
def test_any_text(text):
    check(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 262)), max_size=14))
def test_any_ids(ids):
    assert OWN.decode(struct.pack(f"<{len(ids)}I", *ids)) == SP.decode(ids)


def test_pair_test_agrees_with_merging():
    ids = [i for p, i in OWN.ids.items() if len(p) <= 4][:3000:7]
    for a in ids[:60]:
        for b in ids[::9]:
            pieces = [OWN.pieces[a], OWN.pieces[b]]
            if all(len(OWN.merged(p)) == 1 for p in pieces):
                assert OWN.compatible(a, b) == (OWN.merged("".join(pieces)) == pieces)


def test_without_cuts_the_result_is_the_same():
    whole = codec.Codec(MODEL)
    whole.cuts = False
    for text in HARD[:12]:
        assert whole.encode(text) == OWN.encode(text)


def test_frames(spark, docs):
    rows = [(1, "Hello world"), (2, None), (3, ""), (None, "x"), (1, "Hello world"), (4, "word " * 40000)]
    d = docs(rows).withColumn("ids", F.lit("clash"))
    out = codec.decode(codec.encode(d, MODEL), MODEL).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in out) == sorted((i or 0, t or "") for i, t in rows)
    for r in out:
        ids = SP.encode(r.text or "", add_bos=True, add_eos=True)
        assert hashlib.sha256(r.ids).digest() == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).digest()
    both = codec.round_trip(d, MODEL)
    assert both.columns == ["doc_id", "lang", "source", "n_chars", "ids", "decoded"]
    assert sorted((r.doc_id or 0, bytes(r.ids), r.decoded) for r in both.collect()) == sorted(
        (r.doc_id or 0, bytes(r.ids), r.decoded) for r in out)
    assert codec.encode(docs([]), MODEL).collect() == []
    assert [r.decoded for r in codec.decode(spark.createDataFrame([(None,)], "ids binary"), MODEL).collect()] == [""]
