"""Alignment of two tokenizers' tokens over the bytes of each text.

A text is read as a space and the text.  Tokenizer A is a byte-level one,
tokenizer B a SentencePiece model (``piece_codec``); both give every token the
bytes [start, end) that it covers.  Interval coalescing: the tokens of A and B are
lexsorted by start, the ends accumulated to their running maximum, and a group
ends where the next start reaches that maximum, that is where tokens of both end.
Overlaps are expanded within the groups, from each token of A to all tokens of B
that share a byte with it; those that end together are links.

Lines are cut, at single spaces which neither tokenizer crosses, into segments
that are encoded once a worker, and long texts into parts of about ``CHUNK``
characters, so memory is bounded by a part and the different links of a text.

Corpus-wide counts of linked id pairs are grouped sums.  The ``HOT`` most
frequent pairs (a fixed number) are looked up in the tasks; all other pairs go
through a shuffle join, in which no pair is frequent.

Defined results.  Null and empty texts, and texts whose joined token bytes differ
from space and text (U+2581 becomes a space in B), have no tokens: zeros and an
empty digest.  Repeated rows and null ids are texts of their own, counted each.
Empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meteomart.llm import piece_codec
from meteomart.llm.segments import Memo, slices
from meteomart.llm.tables import cut
from meteomart.llm.text import lists

A_MODEL = public_tokenizers.path("byte_bpe_50k.json")
B_MODEL = piece_codec.MODEL
CHUNK = 1 << 20
HOT = 1 << 18
ALIGNED = ("doc_id long, part long, last boolean, valid boolean, a_ids array<int>, b_ids array<int>, "
           "a_groups array<int>, b_groups array<int>, a_linked array<int>, b_linked array<int>")


class ByteTokenizer:
    """A byte-level tokenizer file: ids of lines, bytes of ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")       # Spark runs the tasks side by side
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        self.splits = spec["normalizer"] is None and pre.get("use_regex", True)
        # Byte-level alphabet: visible latin-1 characters stand for themselves, the other bytes for 256, 257, ...
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(visible)))}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            self.bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.lossless = True
        self.memo = Memo(self._learn, 1)

    def _learn(self, new: list[str]) -> list[tuple[list[int]]]:
        found = [(e.ids,) for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        self.lossless &= all(b"".join(map(self.bytes.__getitem__, ids)) == x.encode() for (ids,), x in zip(found, new, strict=True))
        return found

    def encode(self, lines: list[str], edges: np.ndarray, whole: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments between ``edges``, and how many each has."""
        (ids,), many = self.memo.gather(slices(whole, edges)) if self.splits else self.memo.gather(lines)
        return ids, many


# Kinds of characters, by code point up to U+024F: 1 letters, 2 marks that are no letter, number, apostrophe or white space.
_KINDS = np.zeros(0x250, np.uint8)
_KINDS[[c for c in range(0x250) if chr(c).isalpha() and (c < 0x80 or c >= 0xC0)]] = 1
_KINDS[[ord(c) for c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = 2
_DIGITS = np.zeros(0x250, bool)
_DIGITS[ord("0"):ord("9") + 1] = True


def _kinds(points: np.ndarray) -> np.ndarray:
    return np.where(points < 0x250, _KINDS[np.minimum(points, 0x24F)], 0)


def lone_spaces(points: np.ndarray) -> np.ndarray:
    """Whether each character is a space between two characters that are known not to be white.

    The byte-level pattern has a token begin at such a space and no look behind.
    """
    kinds = _kinds(points)
    plain = (kinds > 0) | (points == ord("'")) | ((points < 0x250) & _DIGITS[np.minimum(points, 0x24F)])
    out = np.zeros(len(points), bool)
    out[1:-1] = (points[1:-1] == 0x20) & plain[:-2] & plain[2:]
    return out


def segment_starts(points: np.ndarray) -> np.ndarray:
    """Places at which the byte-level pattern always begins a token: lone spaces, and marks after a letter."""
    out = lone_spaces(points)
    kinds = _kinds(points)
    out[1:] |= (kinds[1:] == 2) & (kinds[:-1] == 1)
    return out


class Pair(NamedTuple):
    a: ByteTokenizer
    b: piece_codec.Codec
    sizes: tuple[np.ndarray, np.ndarray]    # bytes of each id of A and of B


@lru_cache(maxsize=2)
def pair(a_path: str, b_path: str) -> Pair:
    a, b = ByteTokenizer(a_path), piece_codec.Codec(b_path)
    return Pair(a, b, (np.array([len(x) for x in a.bytes], np.int64), np.array([len(x) for x in b.surfaces], np.int64)))


def _puts_a_space(codec: piece_codec.Codec) -> bool:
    """Whether the model puts a space before a text and changes nothing else."""
    return codec.plain and codec.spec.add_dummy_prefix


def parts(text: str, codec: piece_codec.Codec) -> Iterator[str]:
    """Space and text, in parts of about ``CHUNK`` characters cut where both tokenizers end."""
    line, begin = " " + text, 0
    while len(line) - begin > CHUNK and _puts_a_space(codec):
        size, cuts = CHUNK, np.zeros(0, np.int64)
        while not len(cuts) and begin + size < len(line):
            piece = line[begin:begin + size]
            lone = np.flatnonzero(lone_spaces(np.frombuffer(piece.encode("utf-32-le"), np.uint32)))
            cuts = np.intersect1d(lone, codec.cuts(piece), assume_unique=True)
            size *= 2
        if not len(cuts):
            break
        yield line[begin:begin + int(cuts[-1])]
        begin += int(cuts[-1])
    yield line[begin:] if begin else line


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Group number of every interval: groups break where a start reaches the running maximum of the ends."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(breaks)
    return out


def overlaps(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in A, place in B) of tokens that share a byte; each side ascends and has no gaps."""
    first = np.searchsorted(b_end, a_start, "right")
    many = np.searchsorted(b_start, a_end, "left") - first
    left = np.repeat(np.arange(len(a_start)), many)
    off = np.cumsum(many) - many
    return left, np.arange(len(left)) - np.repeat(off, many) + np.repeat(first, many)


def _chunks(batch: pa.RecordBatch, codec: piece_codec.Codec):
    keys, lines, size = [], [], 0
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
        text = text.as_py() or ""
        left = len(text) + 1
        for number, part in enumerate(parts(text, codec)):
            left -= len(part)
            keys.append((doc_id, number, left == 0))
            lines.append(part if text else "")
            size += len(part)
            if size >= CHUNK:
                yield keys, lines
                keys, lines, size = [], [], 0
    if keys:
        yield keys, lines


def _tokens(lines: list[str], p: Pair):
    """Ids of both tokenizers for all lines in a row, and each line's first id (one more at the end)."""
    whole = "".join(lines)
    firsts = np.concatenate([[0], np.cumsum([len(t) for t in lines], dtype=np.int64)])
    edge = segment_starts(np.frombuffer(whole.encode("utf-32-le"), np.uint32))
    edge = np.append(edge, True)
    edge[firsts] = True
    edges = np.flatnonzero(edge)
    a, many = p.a.encode(lines, edges, whole)
    a_off = np.concatenate([[0], np.cumsum(many)])
    a_off = a_off[np.searchsorted(edges, firsts)] if p.a.splits else a_off
    norms = [t.replace(" ", p.b.space) if _puts_a_space(p.b) else p.b.normalize(t[1:])[0] for t in lines]
    b, _, b_off = p.b.encode(norms)
    return a, a_off, b, b_off


def _valid(lines: list[str], p: Pair, a, a_off, b, b_off) -> np.ndarray:
    """Whether the bytes of both tokenizers' tokens join to the line."""
    if p.a.lossless and p.a.splits and _puts_a_space(p.b):
        # Every segment of A was compared when it was learned; B's pieces join to their segment.
        return np.array([p.b.space not in t for t in lines], bool)
    return np.array([
        b"".join(map(p.a.bytes.__getitem__, a[a_off[i]:a_off[i + 1]].tolist())) == data
        and b"".join(map(p.b.surfaces.__getitem__, b[b_off[i]:b_off[i + 1]].tolist())) == data
        for i, data in enumerate(t.encode() for t in lines)], bool)


def aligned(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) batches -> parts of texts with their tokens, groups and links; runs inside a task.

    ``a_groups`` and ``b_groups`` hold the place after each group's last token,
    ``a_linked`` and ``b_linked`` the places of linked tokens, within the part.
    """
    p = pair(a_path, b_path)
    for batch in batches:
        for keys, lines in _chunks(batch, p.b):
            a, a_off, b, b_off = _tokens(lines, p)
            valid = _valid(lines, p, a, a_off, b, b_off)
            sides = []
            for ids, off, sizes in ((a, a_off, p.sizes[0]), (b, b_off, p.sizes[1])):
                line = np.repeat(np.arange(len(lines)), np.diff(off))
                keep = valid[line]
                ids, line = ids[keep], line[keep]
                end = np.cumsum(sizes[ids])
                sides.append((ids, line, end - sizes[ids], end))
            (a, a_line, a_start, a_end), (b, b_line, b_start, b_end) = sides
            group = coalesce(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]))
            left, right = overlaps(a_start, a_end, b_start, b_end)
            together = a_end[left] == b_end[right]
            left, right = left[together], right[together]
            n = len(lines)
            a_first, b_first = (np.searchsorted(line, np.arange(n + 1)) for line in (a_line, b_line))
            columns = []
            for ids, first in ((a, a_first), (b, b_first)):
                columns.append(lists(ids, first, pa.int32()))
            for g, line, first in ((group[:len(a)], a_line, a_first), (group[len(a):], b_line, b_first)):
                stops = np.flatnonzero(np.append(g[1:] != g[:-1], True)) + 1 if len(g) else np.zeros(0, np.int64)
                of = line[stops - 1]
                columns.append(lists(stops - first[of], np.searchsorted(of, np.arange(n + 1)), pa.int32()))
            link_first = np.searchsorted(a_line[left], np.arange(n + 1))
            for places, line, first in ((left, a_line, a_first), (right, b_line, b_first)):
                columns.append(lists(places - first[line[places]], link_first, pa.int32()))
            doc_id, number, last = zip(*keys, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id, pa.int64()), pa.array(number, pa.int64()), pa.array(last, pa.bool_()), pa.array(valid), *columns],
                names=["doc_id", "part", "last", "valid", "a_ids", "b_ids", "a_groups", "b_groups", "a_linked", "b_linked"])


def align(docs: DataFrame, a_path: str = A_MODEL, b_path: str = B_MODEL) -> DataFrame:
    """Tokens of both tokenizers, groups and links of every text, a row a part of it."""
    return docs.select("doc_id", "text").mapInArrow(lambda batches: aligned(batches, a_path, b_path), ALIGNED)


class _Text:
    """What is gathered of one text over its parts."""

    def __init__(self):
        self.valid, self.n_a, self.n_b, self.n_groups, self.n_links = True, 0, 0, 0, 0
        self.digest = hashlib.sha256()
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.links:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, place = np.unique(np.concatenate([c for c, _ in self.links]), return_inverse=True)
        return codes, np.bincount(place, np.concatenate([n for _, n in self.links])).astype(np.int64)


def _group_text(a, b, a_groups, b_groups, comma: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3;``: the ids of each group, A's then B's."""
    a_size, b_size = (np.diff(g, prepend=0) for g in (a_groups, b_groups))
    g = np.arange(len(a_groups))
    a_group, b_group = np.repeat(g, a_size), np.repeat(g, b_size)
    codes = np.empty(len(a) + len(b), np.int64)
    kind = np.zeros(len(codes), np.int64)
    codes[np.arange(len(a)) + (b_groups - b_size)[a_group]] = a
    codes[np.arange(len(b)) + a_groups[b_group]] = b
    kind[a_groups + b_groups - b_size - 1] = 1
    kind[a_groups + b_groups - 1] = 2
    return "".join(map(comma.__getitem__, (codes * 3 + kind).tolist()))


def _summaries(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """Parts, those of a text in a row -> one row a text with its different linked pairs; runs inside a task."""
    p = pair(a_path, b_path)
    signs = [f"{i}{s}" for i in range(max(map(len, p.sizes))) for s in ",|;"]
    text = _Text()
    for batch in batches:
        flat = {c: (batch.column(c).offsets.to_numpy(), batch.column(c).flatten().to_numpy())
                for c in ("a_ids", "b_ids", "a_groups", "b_groups", "a_linked", "b_linked")}
        rows, pairs = [], []
        for i, (doc_id, last, valid) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "last", "valid")), strict=True)):
            a, b, a_groups, b_groups, left, right = (v[off[i]:off[i + 1]] for off, v in flat.values())
            if not valid:
                text.valid = False
            elif len(a) and text.valid:
                text.digest.update(((";" if text.n_groups else "") + _group_text(a, b, a_groups, b_groups, signs)[:-1]).encode())
                text.n_a, text.n_b = text.n_a + len(a), text.n_b + len(b)
                text.n_groups, text.n_links = text.n_groups + len(a_groups), text.n_links + len(left)
                text.links.append(np.unique(a[left].astype(np.int64) << 32 | b[right], return_counts=True))
            if last:
                some = text.valid and text.n_a > 0
                rows.append((doc_id, text.n_a, text.n_b, text.n_groups, text.n_links, text.digest.hexdigest()) if some
                            else (doc_id, 0, 0, 0, 0, ""))
                pairs.append(text.pairs() if some else _Text().pairs())
                text = _Text()
        kinds = [pa.int64()] * 5 + [pa.string()]
        columns = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 6, kinds, strict=True)]
        off = np.concatenate([[0], np.cumsum([len(c) for c, _ in pairs], dtype=np.int64)])
        for k in (0, 1):
            columns.append(lists(np.concatenate([x[k] for x in pairs] or [np.zeros(0, np.int64)]), off, pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def pair_counts(texts: DataFrame) -> DataFrame:
    """Every linked id pair (A's id times 2**32 plus B's), its count and whether that is the highest of its B id."""
    counts = cut(texts.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
                 .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    # One row an id of B's vocabulary.
    most = F.broadcast(counts.groupBy(b.alias("b")).agg(F.max("n").alias("most")))
    return cut(counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _looked_up(hot: pa.Table):
    """A task that sums what is known of the hot pairs of each text and leaves it the other pairs."""
    keys, n, best = (hot.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(keys)
    keys, n, best = keys[order], n[order], best[order]

    def run(batches):
        for batch in batches:
            off = batch.column("pairs").offsets.to_numpy().astype(np.int64)
            off, base = off - off[0], off[0]
            pairs, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[off])
            sums = [np.zeros(len(pairs), np.int64) for _ in range(2)]
            sums[0][known] = times[known] * best[at[known]]
            sums[1][known] = times[known] * n[at[known]]
            rest = np.concatenate([[0], np.cumsum(~known)])[off]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(total(sums[0]), pa.int64()), pa.array(total(sums[1]), pa.int64()),
                 lists(pairs[~known], rest, pa.int64()), lists(times[~known], rest, pa.int64())],
                names=["row", "n_best", "count_sum", "pairs", "times"])
    return run


def digests(docs: DataFrame, a_path: str = A_MODEL, b_path: str = B_MODEL, hot: int = HOT) -> DataFrame:
    """Per text: tokens, groups, links, and what the corpus-wide counts say of its links."""
    texts = cut(docs.select("doc_id", "text").mapInArrow(
        lambda batches: _summaries(aligned(batches, a_path, b_path), a_path, b_path),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")
        .withColumn("row", F.monotonically_increasing_id()))
    counts = pair_counts(texts)
    hottest = counts.orderBy(F.desc("n"), "pair").limit(hot).toArrow()
    # What else goes through the join: (row, pair, times) of pairs that are not among the hottest.
    found = cut(texts.select("row", "pairs", "times").mapInArrow(
        _looked_up(hottest), "row long, n_best long, count_sum long, pairs array<long>, times array<long>"))
    rare = (found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), "x.times")
            .join(counts, "pair").select("row", (F.col("times") * F.col("best").cast("long")).alias("n_best"),
                                         (F.col("times") * F.col("n")).alias("count_sum")))
    sums = (found.select("row", "n_best", "count_sum").unionByName(rare)
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return texts.drop("pairs", "times").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
