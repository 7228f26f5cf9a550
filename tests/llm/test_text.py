import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from meteomart.llm import text as X

MASK = (1 << 64) - 1


def mix(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & MASK
    return h ^ (h >> 31)


def word_hash(word):
    return mix((sum(b * pow(X._P, i, 1 << 64) for i, b in enumerate(word)) + len(word) * X._SHINGLE) & MASK)


def shingle_hashes(words, k):
    def one(part):
        h = 0 if len(part) == k else len(part)      # a short text's shingle begins with its length
        for w in part:
            h = (h * X._SHINGLE + w) & MASK
        return mix(h)
    return [one(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []


@pytest.mark.parametrize("window", [1, 5, 64, 1 << 16])
def test_any_window_gives_the_same_hashes(monkeypatch, window):
    monkeypatch.setattr(X, "WINDOW", window)
    rng = random.Random(window)
    texts = [None, "", " ", *("".join(rng.choice("ab é\n ") for _ in range(rng.randrange(120))) for _ in range(12)), "x" * 300 + " y"]
    for chunk in X.chunks(pa.array(texts, pa.string())):
        words = [[word_hash(w) for w in (t or "").encode().split()] for t in texts]
        got, off = X.word_hashes(chunk)
        assert [got[i:j].tolist() for i, j in zip(off[:-1], off[1:], strict=True)] == words
        for k in (1, 3, 5):
            h, o = X.shingles(got, off, k)
            assert [h[i:j].tolist() for i, j in zip(o[:-1], o[1:], strict=True)] == [shingle_hashes(w, k) for w in words]
        flat = [w for ws in words for w in ws]
        spans = X.span_hashes(got, np.arange(len(flat) - 3), 4)
        assert spans.tolist() == [mix((sum(v * pow(X._P, i, 1 << 64) for i, v in enumerate(flat[s:s + 4])) + 4) & MASK) for s in range(len(flat) - 3)]
        kinds = X.kind_counts(chunk, np.arange(256, dtype=np.uint8) % 7, 7)
        assert kinds.tolist() == [np.bincount(np.frombuffer((t or "").encode(), np.uint8) % 7, minlength=7).tolist() for t in texts]


def test_a_long_text_needs_a_few_times_its_size():
    code = """
import resource, pyarrow as pa
from meteomart.llm import quality_qda
text = pa.array(["word and text " * (40_000_000 // 14)])
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10
before = peak()
quality_qda.batch_features(text)
print(peak() - before)
"""
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=root)
    assert int(out.stdout) < 500
