"""Arrow batches of texts as byte arrays: words, shingles and per-document counts.

The helpers run inside ``mapInArrow`` tasks.  A batch is cut into chunks of
about ``CHUNK_BYTES`` (a longer text is a chunk of its own, never cut), and
each chunk is handled with a few array operations instead of a Python loop
over words.  A word is a run of bytes other than ASCII white space.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

# Odd multipliers of the rolling hashes (any odd 64-bit values do).
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_SHINGLE = 0xD6E8FEB86659FD93

# Arrays are handled in windows of this many elements, so no table grows with a text.
WINDOW = 1 << 16


def _power_table(base: int) -> np.ndarray:
    out = np.full(WINDOW + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS, _INVERSE_POWERS = _power_table(_P), _power_table(_P_INV)


class Chunk(NamedTuple):
    first: int            # row of the batch at which the chunk begins
    data: np.ndarray      # uint8, the texts one after the other
    offsets: np.ndarray   # int64, n + 1 places in data


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a batch (null: empty) as consecutive byte chunks."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, ends, data = texts.buffers()
    off = np.frombuffer(ends, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(off, off[row] + limit, "right")) - 1)
        yield Chunk(row, raw[off[row]:off[stop]], off[row:stop + 1] - off[row])
        row = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def runs(chunk: Chunk, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-document offsets of the maximal runs without separators."""
    data, off = chunk.data, chunk.offsets
    starts, ends, before = [], [], False
    for w in range(0, len(data), WINDOW):
        inside = ~separator[data[w:w + WINDOW]]
        n = len(inside)
        first, last = np.searchsorted(off, (w, w + n))
        joined = np.empty(n, bool)            # the element belongs to the run of the one before
        joined[0], joined[1:] = before, inside[:-1]
        joined[off[first:last] - w] = False
        starts.append(np.flatnonzero(inside & ~joined) + w)
        # A run ends where the next element, perhaps of the next window, does not go on with it.
        after = np.empty(n, bool)
        after[:-1] = (inside & joined)[1:]
        end = w + n
        after[-1] = end < len(data) and not separator[data[end]] and off[np.searchsorted(off, end)] != end
        ends.append(np.flatnonzero(inside & ~after) + w + 1)
        before = bool(inside[-1])
    none = np.zeros(0, np.int64)
    starts, ends = np.concatenate([none, *starts]), np.concatenate([none, *ends])
    return starts, ends, np.searchsorted(starts, off)


def _rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values[i] * P**(i - start) over each span; starts ascend, and so do ends."""
    out = np.zeros(len(starts), np.uint64)
    for w in range(0, len(values), WINDOW):
        part = values[w:w + WINDOW].astype(np.uint64)
        stop = w + len(part)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _POWERS[:len(part)], out=total[1:])
        i, j = np.searchsorted(starts, (w, stop))
        s, e = starts[i:j] - w, np.minimum(ends[i:j], stop) - w
        out[i:j] += (total[e] - total[s]) * _INVERSE_POWERS[s]
        # Spans that began in an earlier window; a distance beyond the table is one very long word.
        k = int(np.searchsorted(ends[:i], w, "right"))
        if k < i:
            far = w - starts[k:i]
            scale = np.array([pow(_P, int(d), 1 << 64) for d in far], np.uint64)
            out[k:i] += total[np.minimum(ends[k:i], stop) - w] * scale
    return out


def run_hashes(chunk: Chunk, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run."""
    return mix(_rolled(chunk.data, starts, ends) + (ends - starts).astype(np.uint64) * np.uint64(_SHINGLE))


def word_hashes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the per-document offsets into them."""
    starts, ends, off = runs(chunk, WHITE)
    return run_hashes(chunk, starts, ends), off


def shingles(words: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words of a document, and their offsets.

    A document of 1 to k-1 words has one shingle, all its words; one without
    words has none.
    """
    size, n = np.diff(off), len(words)
    count = np.where(size >= k, size - k + 1, np.minimum(size, 1))
    # Places that begin no shingle: the last k - 1 words of a document, or all but the first of a short one.
    begins = np.ones(n, bool)
    stops, short = off[1:][size >= k], np.flatnonzero((size > 0) & (size < k))
    v = size[short].astype(np.uint64)
    for j in range(k - 1):
        begins[stops - j - 1] = False
        more = np.flatnonzero(size[short] > j)
        at = off[short[more]] + j
        v[more] = v[more] * np.uint64(_SHINGLE) + words[at]
        if j:
            begins[at] = False
    out = [np.zeros(0, np.uint64)]
    for w in range(0, n, WINDOW):
        stop = min(w + WINDOW, n)
        h = np.zeros(stop - w, np.uint64)
        for j in range(k):
            h *= np.uint64(_SHINGLE)
            part = words[w + j:stop + j]
            h[:len(part)] += part
        i, j = np.searchsorted(off[short], (w, stop))
        h[off[short[i:j]] - w] = v[i:j]
        out.append(mix(h[begins[w:stop]]))
    return np.concatenate(out), np.concatenate([[0], np.cumsum(count)])


def span_hashes(words: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each start (ascending); the caller keeps spans inside documents."""
    return mix(_rolled(words, starts, starts + k) + np.uint64(k))


def lists(values: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Consecutive slices of ``values`` as an Arrow list column."""
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values, kind))


def per_document(counts_at: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of a per-element array over each document's slice."""
    total = np.concatenate([[0], np.cumsum(counts_at)])
    return total[off[1:]] - total[off[:-1]]


def distinct_per_document(hashes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of different values in each document's slice."""
    if len(off) == 2:          # one document, perhaps a very long one
        return np.array([len(np.unique(hashes))])
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=len(off) - 1)


def kind_counts(chunk: Chunk, kind: np.ndarray, kinds: int) -> np.ndarray:
    """How many bytes of each kind (a table of 256) every document has."""
    n = len(chunk.offsets) - 1
    out = np.zeros(n * kinds, np.int64)
    for w in range(0, len(chunk.data), WINDOW):
        part = chunk.data[w:w + WINDOW]
        doc = np.searchsorted(chunk.offsets, np.arange(w, w + len(part)), "right") - 1
        first = int(doc[0])
        found = np.bincount((doc - first) * kinds + kind[part])
        out[first * kinds:first * kinds + len(found)] += found
    return out.reshape(n, kinds)
