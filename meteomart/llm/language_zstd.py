"""Language identification by compression.

For every language a raw-content dictionary is made of labelled texts: at most
``DICTIONARY_BYTES`` of them, and ``ALL_BYTES`` over all languages, so that many
languages get smaller dictionaries but each has one.  A text, lower-cased and cut
to letters and single spaces, is compressed whole with each dictionary by
zstandard; the language of the smallest output is chosen.  The score comes
from the margin between the smallest and the next size, per character; below
``NARROW`` the row is marked ``rejected`` (the chosen language stays).

Defined results.  Null or empty text, or one without letters: ``und``, score 0,
rejected.  Ties of size: the language first in order.  Null id: predicted,
``held_out`` false, never learned from.  Null lang: never learned from.
Repeated rows: one result each.  No labelled text at all, so also an empty
training table: ``und`` for all.  A language whose labelled texts have no letter has no
dictionary and is never predicted.  More than ``MOST_IDS`` languages are an error.
Letters are the characters of Unicode's category L.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteomart.llm.tables import bounded_sample, fold

DICTIONARY_BYTES = 96 * 1024
SAMPLE_DOCS = 300             # a language
LEVEL = 5
NARROW = 0.02                 # of the smallest size
ALL_BYTES = 200 * DICTIONARY_BYTES
MOST_IDS = 60_000             # ids of the sample, over all languages
SHARPNESS = 60.0

_OTHERS = regex.compile(r"\P{L}+")


def letters(text: str | None) -> bytes:
    """Lower-case letters, everything between them one space."""
    return _OTHERS.sub(" ", (text or "").lower()).strip().encode("utf-8", "replace")


def dictionaries(docs: DataFrame, size: int = DICTIONARY_BYTES, sample: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """A raw-content dictionary for each language, from documents whose crc32 fold of 4 is not 2."""
    known = (docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
             .where(fold(F.col("doc_id"), 4) != 2).select("lang", "doc_id"))
    n_langs = max(1, known.select("lang").distinct().count())
    if n_langs > MOST_IDS:
        raise ValueError(f"{n_langs} languages are more than {MOST_IDS}")
    size = min(size, ALL_BYTES // n_langs)
    sample = max(1, min(sample, MOST_IDS // n_langs, size // 64))
    # At most MOST_IDS ids: a proven bound for the broadcast.
    picked = F.broadcast(bounded_sample(known, "lang", F.col("doc_id"), sample).select("doc_id"))
    texts = docs.where("lang IS NOT NULL").select("doc_id", "lang", "text").join(picked, "doc_id").select("doc_id", "lang", "text")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A text gives at most its share of a dictionary, from its middle.
        most = 4 * size // sample
        for b in batches:
            clean = [letters(v.as_py()) for v in b.column(2)]
            clean = [c[max(0, (len(c) - most) // 2):][:most] for c in clean]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(clean, pa.binary())], ["doc_id", "lang", "part"])
    by_lang: dict[str, list[tuple[int, bytes]]] = defaultdict(list)
    for r in texts.mapInArrow(parts, "doc_id long, lang string, part binary").collect():
        by_lang[r["lang"]].append((r["doc_id"], bytes(r["part"])))
    out = {}
    for lang, found in sorted(by_lang.items()):
        content = b" ".join(p for _, p in sorted(found))[:size]
        if content.strip():
            out[lang] = content.ljust(8)        # the least that makes a dictionary
    return out


class Sizes:
    """Compressed sizes of a text under each dictionary."""

    def __init__(self, contents: dict[str, bytes]):
        self.langs = list(contents)
        self.coders = []
        for c in contents.values():
            d = zstandard.ZstdCompressionDict(c, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def of(self, clean: bytes) -> list[int]:
        return [len(c.compress(clean)) for c in self.coders]


def predict_one(sizes: Sizes, text: str | None) -> tuple[str, float, bool]:
    clean = letters(text)
    if not clean or not sizes.langs:
        return "und", 0.0, True
    found = sizes.of(clean)
    best = int(np.argmin(found))
    margins = np.array(found, float) / found[best] - 1
    score = float(1 / np.exp(-SHARPNESS * margins).sum())
    narrow = len(found) > 1 and float(np.partition(margins, 1)[1]) < NARROW
    return sizes.langs[best], score, narrow


def predict(docs: DataFrame, contents: dict[str, bytes]) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(contents)
        for b in batches:
            found = [predict_one(sizes, v.as_py()) for v in b.column(2)]
            langs, scores, narrow = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(narrow, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
