import hashlib
import random

import pyarrow as pa
import pytest
import sentencepiece as spm
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import no_docs, odd_docs, odd_rows
from sentencepiece import sentencepiece_model_pb2 as pb

from meteomart.llm import piece_codec
from meteomart.llm.piece_codec import MODEL

SF = "/root/testdata/sf0.001"
LIBRARY = spm.SentencePieceProcessor(model_file=MODEL)
MINE = piece_codec.Codec(MODEL)
ALPHABET = st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("ab e  ▁\n\t<0x>é中日あ😀́\0")), st.sampled_from("the ing tion <s> </s> <0x0A> ".split(" ")))


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


def pieces(texts, path=MODEL):
    """ids and byte spans per text, its blocks put together."""
    out = [([], []) for _ in texts]
    for b in piece_codec.encoded(iter([batch(texts)]), path):
        for r in b.to_pylist():
            out[r["doc_id"]][0].extend(r["ids"])
            out[r["doc_id"]][1].extend(zip(r["begins"], r["ends"], strict=True))
    return out


def library_spans(text, library=LIBRARY):
    return [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=40).map("".join), max_size=4))
def test_equals_the_library(texts):
    for text, (ids, spans) in zip(texts, pieces(texts), strict=True):
        assert ids == LIBRARY.encode(text)
        assert spans == library_spans(text)
        assert MINE.decode(ids).decode("utf-8", "each_byte") == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 260)), max_size=12))
def test_any_ids_are_decoded_as_the_library_does(ids):
    assert MINE.decode(ids).decode("utf-8", "each_byte") == LIBRARY.decode(ids)


@pytest.mark.parametrize("size", [1, 7, 64])
def test_blocks_of_any_size(monkeypatch, size):
    monkeypatch.setattr(piece_codec, "CHUNK", size)
    rng = random.Random(size)
    texts = ["".join(rng.choice("the quick  brown ▁é中😀<\n") for _ in range(rng.randrange(200))) for _ in range(20)] + ["a" * 300, " " * 90]
    for text, (ids, spans) in zip(texts, pieces(texts), strict=True):
        assert ids == LIBRARY.encode(text) and spans == library_spans(text)
    blocks = list(piece_codec.encoded(iter([batch(texts)]), MODEL))
    rows = [r for b in piece_codec.digested(iter(blocks), MODEL) for r in b.to_pylist()]
    assert [r["ids_sha256"] for r in rows] == [hashlib.sha256(",".join(map(str, LIBRARY.encode(t))).encode()).hexdigest() for t in texts]
    assert [r["n_source_bytes"] for r in rows] == [len(t.encode()) for t in texts]


def mapped(tmp_path, **spec):
    """The model with a character map, and the library's processor of the same file."""
    model = pb.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    rules = spm.SentencePieceNormalizer(rule_name="nmt_nfkc_cf").serialized_model_proto()
    model.normalizer_spec.precompiled_charsmap = pb.ModelProto.FromString(rules).normalizer_spec.precompiled_charsmap
    for k, v in spec.items():
        setattr(model.normalizer_spec, k, v)
    path = str(tmp_path / "mapped.model")
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    return path, spm.SentencePieceProcessor(model_file=path)


@pytest.mark.parametrize("spec", [{}, {"remove_extra_whitespaces": True}, {"add_dummy_prefix": False}])
def test_character_map_equals_the_library(tmp_path, spec):
    path, library = mapped(tmp_path, **spec)
    rng = random.Random(1)
    letters = list("aé é ｆｏ  ﬁ①㌔　\t\r\n​ＡİßΣ中がが각각😀x\xa0­") + [" ", "  "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(300)] + ["", " ", "​", "  a  b  "]
    for text, (ids, spans) in zip(texts, pieces(texts, path), strict=True):
        assert ids == library.encode(text), repr(text)
        assert spans == library_spans(text, library), repr(text)
        assert piece_codec.codec(path).decode(ids).decode("utf-8", "each_byte") == library.decode(ids)


def expected(rows):
    out = []
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "")
        out.append((str(doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in df.collect())


def test_query_against_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(piece_codec.digests(docs)) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(spark):
    assert found(piece_codec.digests(odd_docs(spark))) == expected([r[:2] for r in odd_rows()])
    assert piece_codec.digests(no_docs(spark)).count() == 0
    assert piece_codec.encode(no_docs(spark)).count() == 0


def test_decode_of_encode(spark):
    docs = odd_docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in piece_codec.decode(piece_codec.encode(docs)).collect()}
    assert texts == {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def test_other_models_are_refused(tmp_path):
    model = pb.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.pieces[500].type = 4
    path = tmp_path / "own.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        piece_codec.Codec(str(path))
