import zlib

import pytest
from llm_data import docs_of, no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from meteomart.llm import language_zstd as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.predict(docs, L.dictionaries(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert r["n"] > 200 and r["a"] > 0.97


def test_folds_and_odd_rows(spark):
    docs = odd_docs(spark)
    rows = L.predict(docs, L.dictionaries(docs)).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (3, 4, 5, 8):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in ("en", "fr", "es", "und")
    assert L.predict(no_docs(spark), {}).count() == 0
    assert L.dictionaries(no_docs(spark)) == {}


def test_held_out_rows_are_not_learned_from(spark):
    texts = ["aaa bbb ccc ddd " * 20] * 40
    docs = docs_of(spark, texts).withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "xx").otherwise("en"))
    assert set(L.dictionaries(docs)) == {"en"}


def test_letters():
    assert L.letters("Ab1-Çd__e!\n") == "ab çd e".encode()
    assert L.letters(None) == b""


def test_the_smallest_size_wins():
    sizes = L.Sizes({"a": b"the cat sat on the mat and the dog " * 50, "b": b"el gato se sienta en la mesa y el perro " * 50})
    assert L.predict_one(sizes, "The dog and the cat sat on the mat")[0] == "a"
    assert L.predict_one(sizes, "el perro y el gato se sienta en la mesa")[0] == "b"
    lang, score, rejected = L.predict_one(sizes, "qq")
    assert lang == "a" and rejected and score == pytest.approx(0.5)


def test_only_letters_make_a_language():
    for text in ("²", "½ ¼", "Ⅷ", "12 ٣", "...", "\u0301", "_"):
        assert L.letters(text) == b""
    assert L.letters("Ça va? 3²x") == "ça va x".encode()


def test_every_language_has_a_dictionary(spark, monkeypatch):
    """Many languages get smaller dictionaries; none is left out, however short its texts."""
    from llm_data import SCHEMA
    rows = [(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26)} " * 5 if i else "ab", f"l{i}", "s", 10) for i in range(260)]
    kept = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    found = L.dictionaries(spark.createDataFrame(rows, SCHEMA))
    assert set(found) == {r[2] for r in kept}
    monkeypatch.setattr(L, "ALL_BYTES", 260 * 16)
    assert max(map(len, L.dictionaries(spark.createDataFrame(rows, SCHEMA)).values())) <= 21
    monkeypatch.setattr(L, "MOST_IDS", 100)
    with pytest.raises(ValueError):
        L.dictionaries(spark.createDataFrame(rows, SCHEMA))
