"""SentencePiece encoding with source offsets, and decoding.

A text is normalised first: at every place the longest prefix that the model's
compiled character map knows is replaced, and each character of the result keeps
the byte of the text at which its source begins.  White space becomes U+2581.
The result is cut wherever no piece of the vocabulary holds the two characters
beside each other; no merge can cross such a place, so each segment is merged by
itself (best score first, then leftmost) and equal segments are merged once.
Every piece is then projected to the bytes of the text that its characters came
from.  A character without a piece becomes its UTF-8 bytes: the last of them
spans the character, those before it nothing.

``encode`` gives one row a block: a text of more than ``CHUNK`` characters is
several blocks, in order, so neither a text nor its pieces is ever held whole.
Only models with a character map (``normalize`` needs the whole text) get one block.

Models: byte-pair models with byte pieces, without user-defined or unused ones; others are refused.

Defined results.  Null and empty texts: one block without pieces, decoded empty.
Repeated rows and null ids are texts of their own.  Empty table: no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as pb

from meteomart.llm.segments import Memo, slices
from meteomart.llm.text import lists

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
CHUNK = 1 << 20          # characters handled at once
SHORT = 32               # segments up to this long are merged together, in rounds
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BLOCKS = "doc_id long, block long, last boolean, ids array<int>, begins array<long>, ends array<long>"

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class CharMap:
    """Longest-prefix replacement by a compiled map: a double-array trie over UTF-8 bytes, then its strings."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, np.uint32, size // 4, 4).tolist()
        self.strings = blob[4 + size:]
        self.known: dict[tuple[str, str], bool] = {}

    def _walk(self, data: bytes) -> tuple[bool, int, int]:
        """Whether some key begins with ``data``; length and value of the longest key that begins it."""
        child = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        at, length, value = child(self.units[0]), 0, -1
        for i, b in enumerate(data):
            at ^= b
            if at >= len(self.units) or self.units[at] & 0x800000FF != b:
                return False, length, value
            unit = self.units[at]
            at ^= child(unit)
            if unit & 0x100:
                length, value = i + 1, self.units[at] & 0x7FFFFFFF
        return True, length, value

    def acts(self, a: str, b: str) -> bool:
        """Whether a key may match where ``a`` is followed by ``b``."""
        if (a, b) not in self.known:
            if len(self.known) > 1 << 18:
                self.known.clear()
            on, length, _ = self._walk(a.encode())
            self.known[a, b] = length > 0 or (on and self._walk((a + b).encode())[0])
        return self.known[a, b]

    def apply(self, text: str) -> tuple[str, np.ndarray]:
        """The replaced text, and the byte of ``text`` at which each character's source begins."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        place = np.concatenate([[0], np.cumsum(_utf8_size(points))])
        pairs = points.astype(np.uint64) << np.uint64(21)
        pairs[:-1] |= points[1:].astype(np.uint64)
        different, inverse = np.unique(pairs, return_inverse=True)
        acts = np.array([self.acts(chr(int(p) >> 21), chr(int(p) & 0x1FFFFF)) for p in different], bool)
        parts, sources, done = [], [], 0
        for i in np.flatnonzero(acts[inverse]).tolist():
            if i < done:
                continue
            begin = int(place[i])
            _, length, value = self._walk(text[i:i + 64].encode())
            if not length:
                continue
            parts.append(text[done:i])
            sources.append(place[done:i])
            new = self.strings[value:self.strings.index(b"\0", value)].decode()
            parts.append(new)
            sources.append(np.full(len(new), begin))
            done = int(np.searchsorted(place, begin + length))
        parts.append(text[done:])
        sources.append(place[done:-1])
        return "".join(parts), np.concatenate([*sources, place[-1:]])


def _utf8_size(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


class Codec:
    """One model: its pieces, the character pairs inside them, and segments already merged."""

    def __init__(self, path: str):
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or kinds != {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path} is not a byte-pair model of plain pieces with byte pieces")
        self.spec, self.pieces = model.normalizer_spec, model.pieces
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        self.space = SPACE if self.spec.escape_whitespaces else " "
        self.char_map = CharMap(self.spec.precompiled_charsmap) if self.spec.precompiled_charsmap else None
        self.plain = self.char_map is None and not self.spec.remove_extra_whitespaces and not self.suffix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.rank = {p: -model.pieces[i].score for p, i in self.ids.items() if len(p) > 1}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        # Characters that stand beside another one in some piece, numbered from 1.
        letters = sorted({c for p in self.rank for c in p})
        self.letter = np.zeros(0x110000, np.uint16)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        if self.spec.escape_whitespaces:
            self.letter[0x20] = self.letter[ord(SPACE)]
        self.width = len(letters) + 1
        self.beside = np.zeros(self.width * self.width, bool)
        for p in self.rank:
            n = self.letter[[ord(c) for c in p]].astype(np.int64)
            self.beside[n[:-1] * self.width + n[1:]] = True
        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        self.lengths = np.array([len(p.piece) for p in model.pieces], np.int64)
        # Places in the order of scores; equal scores share one.
        self.score_order = np.unique([-p.score for p in model.pieces], return_inverse=True)[1].astype(np.int64)
        self.joins, self.joined = self._join_table()
        self.memo = Memo(self._learn, 2)
        self.numbers = [str(i) for i in range(len(model.pieces))]
        self.surfaces = [self._surface(i) for i in range(len(model.pieces))]

    # -- encoding ------------------------------------------------------------
    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and the source byte of each of its characters and of its end."""
        if not text:
            return "", np.zeros(1, np.int64)
        if self.char_map:
            out, source = self.char_map.apply(text)
        else:
            out, source = text, np.concatenate([[0], np.cumsum(_utf8_size(np.frombuffer(text.encode("utf-32-le"), np.uint32)))])
        if self.spec.remove_extra_whitespaces:
            blank = np.frombuffer(out.encode("utf-32-le"), np.uint32) == 0x20
            keep = ~blank
            keep[1:] |= ~blank[:-1]
            keep[:1] = ~blank[:1]
            kept = np.flatnonzero(keep)
            if len(kept) and blank[kept[-1]]:
                kept = kept[:-1]
            if not len(kept):
                return "", np.zeros(1, np.int64)
            out, source = "".join(map(out.__getitem__, kept.tolist())), source[np.append(kept, kept[-1] + 1)]
        if self.spec.add_dummy_prefix:
            out = out + " " if self.suffix else " " + out
            source = np.concatenate([source, source[-1:]] if self.suffix else [source[:1], source])
        return out.replace(" ", self.space), source

    def cuts(self, text: str) -> np.ndarray:
        """Places before which no piece can reach back (0 left out)."""
        n = self.letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int64)
        return np.flatnonzero(~self.beside[n[:-1] * self.width + n[1:]]) + 1

    def parts(self, text: str) -> Iterator[str]:
        """The text in slices of about ``CHUNK`` characters that can be merged apart."""
        begin = 0
        while self.plain and len(text) - begin > CHUNK:
            size, cuts = CHUNK, ()
            while not len(cuts) and begin + size < len(text):
                cuts = self.cuts(text[begin:begin + size])
                size *= 2
            if not len(cuts):
                break
            yield text[begin:begin + int(cuts[-1])]
            begin += int(cuts[-1])
        yield text[begin:] if begin else text

    def merge(self, segment: str) -> list[str]:
        """The segment's pieces: neighbours are joined, best score first, then leftmost."""
        n, rank = len(segment), self.rank
        if n < 2:
            return [segment] if n else []
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            score = rank.get(segment[i:i + 2])
            if score is not None:
                heap.append((score, i, i + 1, i + 2))
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, a, b, stop = heapq.heappop(heap)
            if not alive[a] or end[a] != b or not alive[b] or end[b] != stop:
                continue
            end[a], alive[b] = stop, False
            if stop < n:
                before[stop] = a
                score = rank.get(segment[a:end[stop]])
                if score is not None:
                    heapq.heappush(heap, (score, a, stop, end[stop]))
            left = before[a]
            if left >= 0:
                score = rank.get(segment[left:stop])
                if score is not None:
                    heapq.heappush(heap, (score, left, a, stop))
        out, i = [], 0
        while i < n:
            out.append(segment[i:end[i]])
            i = end[i]
        return out

    def _join_table(self) -> tuple[pd.Index, np.ndarray]:
        """Pairs of pieces that join to one (left id times the vocabulary plus right id), and that one."""
        joins = {}
        for p in self.rank:
            for i in range(1, len(p)):
                left, right = self.ids.get(p[:i]), self.ids.get(p[i:])
                if left is not None and right is not None:
                    joins[left * len(self.pieces) + right] = self.ids[p]
        # One more at the end, for pairs that join to nothing.
        return pd.Index(np.array(list(joins), np.int64)), np.array([*joins.values(), -1], np.int64)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair joins to, or -1."""
        return self.joined[self.joins.get_indexer(left * len(self.pieces) + right)]

    def _rounds(self, segments: list[str], ids: np.ndarray, firsts: np.ndarray) -> list[tuple[list[int], list[int]]]:
        """Merge many segments of known characters at once: each round joins the first best pair of every segment.

        A row is a piece; ``pair`` is what it and the next piece join to.  Only the
        pairs beside a join are looked up again.
        """
        segment = np.repeat(np.arange(len(segments)), np.diff(firsts))
        done_ids, done_segments = [], []
        pair = np.full(len(ids), -1)
        inner = np.flatnonzero(segment[:-1] == segment[1:])
        pair[inner] = self._joined(ids[inner], ids[inner + 1])
        while len(ids):
            where = np.flatnonzero(pair >= 0)
            # Score order first, then place: one number a pair.
            order = self.score_order[pair[where]] * np.int64(len(ids)) + where
            begins = np.flatnonzero(np.diff(segment[where], prepend=-1))
            best = np.minimum.reduceat(order, begins) % len(ids) if len(begins) else where
            more = np.zeros(len(segments), bool)
            more[segment[best]] = True
            ids[best] = pair[best]
            stay = np.ones(len(ids), bool)
            stay[best + 1] = False
            active = stay & more[segment]
            done_ids.append(ids[stay & ~active])
            done_segments.append(segment[stay & ~active])
            at = (np.cumsum(active) - 1)[best]
            ids, segment, pair = ids[active], segment[active], pair[active]
            for left in (at, at[at > 0] - 1):      # the joined piece with the next one, and the one before with it
                right = np.minimum(left + 1, len(ids) - 1)
                inside = (segment[left] == segment[right]) & (left < right)
                pair[left] = -1
                pair[left[inside]] = self._joined(ids[left[inside]], ids[right[inside]])
        ids, segment = np.concatenate([np.zeros(0, np.int64), *done_ids]), np.concatenate([np.zeros(0, np.int64), *done_segments])
        order = np.argsort(segment, kind="stable")
        ids, edges = ids[order], np.searchsorted(segment[order], np.arange(len(segments) + 1)).tolist()
        steps = self.lengths[ids].tolist()
        ids = ids.tolist()
        return [(ids[i:j], steps[i:j]) for i, j in zip(edges[:-1], edges[1:], strict=True)]

    def _learn(self, segments: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of each segment's pieces and the characters that each of them spans."""
        whole = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        firsts = np.concatenate([[0], np.cumsum([len(s) for s in segments], dtype=np.int64)])
        ids = self.char_ids[whole].astype(np.int64)
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        sizes = np.diff(firsts)
        easy = (unknown[firsts[1:]] == unknown[firsts[:-1]]) & (sizes <= SHORT) & (sizes > 0)
        kept = np.flatnonzero(easy).tolist()
        quick = self._rounds([segments[i] for i in kept], ids[np.repeat(easy, sizes)],
                             np.concatenate([[0], np.cumsum(sizes[easy])]))
        out = dict(zip(kept, quick, strict=True))
        return [out[i] if easy[i] else self._one(s) for i, s in enumerate(segments)]

    def _one(self, segment: str) -> tuple[list[int], list[int]]:
        ids, steps = [], []
        for piece in self.merge(segment):
            known = self.ids.get(piece)
            new = [known] if known is not None else [self.bytes[b] for b in piece.encode()]
            ids += new
            steps += [0] * (len(new) - 1) + [len(piece)]
        return ids, steps

    def encode(self, norms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and spanned characters of all the normalised texts, and each text's first id."""
        whole = "".join(norms)
        firsts = np.concatenate([[0], np.cumsum([len(t) for t in norms], dtype=np.int64)])
        edge = np.zeros(len(whole) + 1, bool)
        edge[firsts] = True
        if len(whole) > 1:
            edge[self.cuts(whole)] = True
        edges = np.flatnonzero(edge)
        (ids, steps), many = self.memo.gather(slices(whole, edges))
        off = np.concatenate([[0], np.cumsum(many)])
        return ids, steps, off[np.searchsorted(edges, firsts)]

    # -- decoding ------------------------------------------------------------
    def _surface(self, i: int) -> bytes:
        piece = self.pieces[i]
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        if piece.type == CONTROL:
            return b""
        return " ⁇ ".encode() if piece.type == UNKNOWN else piece.piece.replace(SPACE, " ").encode()

    def decode(self, ids: list[int], begins: bool = True) -> bytes:
        """UTF-8 (perhaps cut or false inside bytes) of the ids; the space put before a text is taken off."""
        out = b"".join(map(self.surfaces.__getitem__, ids))
        if begins and (self.spec.add_dummy_prefix or self.spec.remove_extra_whitespaces):
            skip = 0
            first = next((i for i in ids if self.pieces[i].type != CONTROL), None)
            if first is not None and self.pieces[first].type == NORMAL and out.startswith(b" "):
                skip = 1
            if skip and self.spec.remove_extra_whitespaces:
                skip = len(out) - len(out.lstrip(b" "))
            out = out[skip:]
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _blocks(batch: pa.RecordBatch, model: Codec) -> Iterator[tuple[list, list[str], list[np.ndarray]]]:
    """Groups of about ``CHUNK`` characters: (doc_id, block, last), normalised texts, source bytes."""
    keys, norms, sources, size = [], [], [], 0
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
        text, byte = text.as_py() or "", 0
        left = len(text)
        for number, part in enumerate(model.parts(text)):
            left -= len(part)
            if number:
                norm = part.replace(" ", model.space)
                source = np.concatenate([[0], np.cumsum(_utf8_size(np.frombuffer(part.encode("utf-32-le"), np.uint32)))])
            else:
                norm, source = model.normalize(part)
            keys.append((doc_id, number, left == 0))
            norms.append(norm)
            sources.append(source + byte)
            byte += int(source[-1])
            size += len(norm)
            if size >= CHUNK:
                yield keys, norms, sources
                keys, norms, sources, size = [], [], [], 0
    if keys:
        yield keys, norms, sources


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) batches -> blocks of ids with the bytes that each spans; runs inside a task."""
    model = codec(path)
    for batch in batches:
        for keys, norms, sources in _blocks(batch, model):
            ids, steps, off = model.encode(norms)
            # A text has one source more than characters: its end.
            texts = np.repeat(np.arange(len(norms)), np.diff(off))
            source = np.concatenate(sources)
            stop = np.cumsum(steps, dtype=np.int64) + texts
            doc_id, number, last = zip(*keys, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id, pa.int64()), pa.array(number, pa.int64()), pa.array(last, pa.bool_()),
                 lists(ids, off, pa.int32()), lists(source[stop - steps], off, pa.int64()), lists(source[stop], off, pa.int64())],
                names=["doc_id", "block", "last", "ids", "begins", "ends"])


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """Blocks of every text: piece ids and the bytes [begin, end) of the text that each spans."""
    return docs.select("doc_id", "text").mapInArrow(lambda batches: encoded(batches, path), BLOCKS)


def decode(blocks: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, block, ids) -> doc_id, block, text; block 0 begins a text."""
    def run(batches):
        model = codec(path)
        for batch in batches:
            text = [None if ids is None else model.decode(ids, number == 0).decode("utf-8", "each_byte") for number, ids in
                    zip(batch.column("block").to_pylist(), batch.column("ids").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("block"), pa.array(text, pa.string())],
                                             names=["doc_id", "block", "text"])
    return blocks.select("doc_id", "block", "ids").mapInArrow(run, "doc_id long, block long, text string")


def digested(blocks: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Blocks, those of a text in a row, -> one digest row a text; runs inside a task."""
    model = codec(path)
    begun = False
    for batch in blocks:
        rows = []
        off = batch.column("ids").offsets.to_numpy()
        flat = [batch.column(c).flatten().to_numpy() for c in ("ids", "begins", "ends")]
        for i, (doc_id, number, last) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "block", "last")), strict=True)):
            if number == 0:
                n, covered, ids_hash, text_hash, begun = 0, 0, hashlib.sha256(), hashlib.sha256(), False
            ids, begins, ends = (a[off[i]:off[i + 1]] for a in flat)
            ids = ids.tolist()
            if ids:
                ids_hash.update((b"," if begun else b"") + ",".join(map(model.numbers.__getitem__, ids)).encode())
                begun = True
            text_hash.update(model.decode(ids, number == 0).decode("utf-8", "each_byte").encode())
            n += len(ids)
            covered += int((ends - begins).sum())
            if last:
                rows.append((doc_id, n, ids_hash.hexdigest(), text_hash.hexdigest(), covered))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_source_bytes"])


def digests(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """Per text: pieces, digests of their ids and of the decoded text, bytes of the text under all spans."""
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: digested(encoded(batches, path), path),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_source_bytes long")
