import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece as spm
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import no_docs, odd_docs, odd_rows
from tokenizers import Tokenizer

from meteomart.llm import token_alignment as ta

SF = "/root/testdata/sf0.001"
A = Tokenizer.from_file(ta.A_MODEL)
A.encode_special_tokens = True
B = spm.SentencePieceProcessor(model_file=ta.B_MODEL)
BYTES_OF = ta.ByteTokenizer(ta.A_MODEL).bytes
ALPHABET = st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("ab e  ▁\n\té'sé中😀\xa0×0")),
                     st.sampled_from([" the", " don't", "<|endoftext|>", "<s>", " wörld", "  ", " 's", "ing "]))


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def tokens(text):
    """Token lists of both with their ends, or None."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    sides = [[(i, BYTES_OF[i]) for i in a], [(i, b_bytes(i)) for i in b]]
    if any(b"".join(x for _, x in s) != (" " + text).encode() for s in sides):
        return None
    out = []
    for s in sides:
        end, ends = 0, []
        for i, x in s:
            end += len(x)
            ends.append((i, end))
        out.append(ends)
    return out


def by_hand(rows):
    """The contract, token by token."""
    read = [(doc_id, tokens(text)) for doc_id, text in rows]
    links, count = [], Counter()
    for _, both in read:
        mine = [(x, y) for x, e in both[0] for y, f in both[1] if e == f] if both else []
        links.append(mine)
        count.update(mine)
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for (doc_id, both), mine in zip(read, links, strict=True):
        if both is None:
            out.append((str(doc_id), 0, 0, 0, 0, 0, 0, ""))
            continue
        shared = sorted({e for _, e in both[0]} & {e for _, e in both[1]})
        groups = [tuple([i for i, e in side if low < e <= high] for side in both) for low, high in zip([0, *shared], shared, strict=False)]
        text = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        out.append((str(doc_id), len(both[0]), len(both[1]), len(groups), len(mine), sum(count[x] == best[x[1]] for x in mine),
                    sum(count[x] for x in mine), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r["doc_id"]), *[r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")])
                  for r in df.collect())


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


@settings(max_examples=250, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=40).map("".join), max_size=4))
def test_tokens_equal_the_libraries(texts):
    for b in ta.aligned(iter([batch(texts)]), ta.A_MODEL, ta.B_MODEL):
        for r in b.to_pylist():
            both = tokens(texts[r["doc_id"]])
            assert r["a_ids"] == ([i for i, _ in both[0]] if both else [])
            assert r["b_ids"] == ([i for i, _ in both[1]] if both else [])
            if both:
                assert [both[0][i][1] for i in r["a_linked"]] == [both[1][i][1] for i in r["b_linked"]]
                assert r["a_groups"][-1] == len(both[0]) and r["b_groups"][-1] == len(both[1])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), min_size=1, max_size=25))
def test_coalesced_groups_are_the_connected_intervals(spans):
    import numpy as np
    starts = np.array([s for s, _ in spans])
    ends = starts + np.array([n for _, n in spans])
    group = ta.coalesce(starts, ends).tolist()
    covered = sorted({x for s, e in zip(starts, ends, strict=True) for x in range(s, e)})
    inside = {x for s, e in zip(starts, ends, strict=True) for x in range(s + 1, e)}      # borders that some interval crosses
    for i, (s, g) in enumerate(zip(starts, group, strict=True)):
        for t, h in zip(starts[i:], group[i:], strict=True):
            low, high = sorted((int(s), int(t)))
            assert (g == h) == all(x in inside for x in range(low + 1, high + 1)), covered


def test_overlaps_against_all_pairs():
    import numpy as np
    rng = random.Random(2)
    for _ in range(50):
        n = rng.randrange(1, 40)
        sides = []
        for _ in range(2):
            ends = np.array(sorted({n, *(rng.randrange(1, n + 1) for _ in range(rng.randrange(12)))}))
            sides += [np.concatenate([[0], ends[:-1]]), ends]
        got = list(zip(*(x.tolist() for x in ta.overlaps(*sides)), strict=True))
        assert got == [(i, j) for i in range(len(sides[0])) for j in range(len(sides[2]))
                       if sides[0][i] < sides[3][j] and sides[2][j] < sides[1][i]]


@pytest.mark.parametrize("hot", [0, 3, 1 << 18])
def test_query_against_brute_force(spark, hot):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("n_chars").limit(120)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(ta.digests(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot)) == by_hand(rows)


def test_odd_rows(spark):
    short = [r for r in odd_rows() if len(r[1] or "") < 5000] + [(20, "a ▁ b", None, None, 5), (21, " lead", None, None, 5), (21, "\x85 \xa0x", None, None, 4)]
    docs = odd_docs(spark)
    df = spark.createDataFrame([r[:2] for r in short], "doc_id long, text string").selectExpr("*", "'c' AS row", "'c' AS pairs", "1 AS n", "2 AS pair")
    assert found(ta.digests(df)) == by_hand([r[:2] for r in short])
    assert ta.digests(docs).count() == len(odd_rows())
    assert ta.digests(no_docs(spark)).count() == 0


@pytest.mark.parametrize("size", [1, 30, 400])
def test_parts_of_any_size(spark, monkeypatch, size):
    rng = random.Random(size)
    texts = [" ".join(rng.choice(["the", "wörld", "it's", "a,b", "x\ny", "中文", "", "12"]) for _ in range(rng.randrange(90))) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate([*texts, "▁ at the end " + texts[0], texts[1] + " and ▁"])]
    whole = list(ta._summaries(ta.aligned(iter([batch([t for _, t in rows])]), ta.A_MODEL, ta.B_MODEL), ta.A_MODEL, ta.B_MODEL))
    monkeypatch.setattr(ta, "CHUNK", size)
    cut = list(ta._summaries(ta.aligned(iter([batch([t for _, t in rows])]), ta.A_MODEL, ta.B_MODEL), ta.A_MODEL, ta.B_MODEL))
    assert [r for b in cut for r in b.to_pylist()] == [r for b in whole for r in b.to_pylist()]
    assert [r["n_a"] for b in whole for r in b.to_pylist()] == [len(x[0]) if x else 0 for x in (tokens(t) for _, t in rows)]
