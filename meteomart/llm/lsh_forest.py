"""N-gram Jaccard join with a MinHash LSH forest.

Each document's shingles (five consecutive words) give ``TREES`` labels of
``DEPTH`` minimum hashes.  A tree is the trie of its labels: they are sorted, and
what a label shares with its neighbours in that order is its longest matched
prefix.  Labels that share nothing leave; they are most of all.  From whole
labels, the trees' prefixes are shortened one by one until pairs at the threshold
meet in some tree with probability ``RECALL``: no document meets others by a longer prefix.
A matched prefix is shortened further, by each document, as far as at most
``SMALL`` classes share it, so the recall is higher where that is cheap.
Every meeting is then verified on the exact shingle sets.

Documents with equal shingle sets are one class from the start.  Where a
prefix has at most ``SMALL`` classes, all of them are compared as rows.  A prefix
with more is expanded into rows only as far as its components need.  Its members
are compared with one hub, the
member that meets most others over all trees; members similar to the same hub
are linked through it.  The members that neither the hub nor the links found so
far join to the hub's component are joined exactly with all members of such prefixes: two sets at the threshold must share
one of their rarest shingles, at places that leave room for the overlap, so
only the rarest fifth of each set is joined, by shingle.

These links settle the components, but they are not all links.  For the link
table and ``n_links`` every two members of a large prefix are compared, too: the
members are dealt into blocks, and a task compares two blocks by a product of
their incidence matrices.  A pair belongs to the least large prefix it shares.
``n_links`` sums counts of the blocks, so a family of m different texts makes
m * m / BLOCK_ROWS rows a tree, not m * m / 2 pairs.

Defined results.  Null or empty texts and texts of white space have no
shingles: each is a class of its own, without links.  A text of 1 to 4 words has
one shingle.  Null id: class null, no links.  Repeated rows: one result each,
same class.  Classes are made from the texts: rows that repeat an id with another
text are as far apart as other rows.  Empty table: no rows.  Ties: the least id
names a class; where several classes have the same least id (it repeats with other
texts), one is named by it and the others by numbers from 2**62 on.  Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from meteomart.llm import text as X
from meteomart.llm.components import components
from meteomart.llm.tables import cut
from meteomart.plans.joins import bounded_broadcast

WORDS = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 6
RECALL = 0.999
SMALL = 24
BLOCK_ROWS = 1024             # sets in a block
BLOCK_SHINGLES = 1 << 19      # shingles in a block, on average
ID_BROADCAST = 2_000_000      # rows of 8 bytes
SEED = 20_011
CONTENT = ["f1", "f2", "size"]
CLASHING = 1 << 62            # names of classes whose least id names another one


class Source(NamedTuple):
    """The documents, and what tells apart texts with the same id, if there are any."""
    docs: DataFrame
    classes: DataFrame | None = None      # id, least (an id of its documents), f1, f2, size


def longest(trees: int, depth: int, threshold: float, recall: float) -> list[int]:
    """Each tree's longest prefix at which pairs at the threshold meet somewhere with probability ``recall``.

    Whole labels are shortened by one hash, a tree after the other, until the recall is
    reached (or no prefix can be shortened).  The order does not depend on the documents, so
    a pair's chance to meet does not, either.
    """
    out = [depth] * trees
    missed = lambda: math.prod(1 - threshold ** p for p in out)
    for step in range(trees * (depth - 1)):
        if 1 - missed() >= recall:
            break
        out[step % trees] -= 1
    return out


def sorted_shingles(chunk: X.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's set of shingle hashes, ascending, and the offsets."""
    h, off = X.shingles(*X.word_hashes(chunk), k)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h = h[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=len(off) - 1))])


def _labels(h: np.ndarray, multipliers: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a shingle set, in blocks that fit the cache."""
    low = (h >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(multipliers), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 2048):
        v = multipliers[:, None] * low[None, i:i + 2048] + offsets[:, None]
        np.minimum(out, v.min(axis=1), out=out)
    return out


def _content(h: np.ndarray, off: np.ndarray) -> list[pa.Array]:
    """f1, f2 and size of each shingle set: equal for equal sets."""
    f1, f2 = (X.per_document(v, off).astype(np.uint64) for v in (h.view(np.int64), X.mix(h).view(np.int64)))
    return [pa.array(f1.view(np.int64)), pa.array(X.mix(f2).view(np.int64)), pa.array(np.diff(off).astype(np.int64))]


def signatures(docs: DataFrame, words: int, depth: int, prefixes: list[int], shortest: int) -> DataFrame:
    """doc_id, two hashes and the size of the shingle set, and the keys of each tree's prefixes.

    A key is the hash of the tree's number and a prefix of its label; a tree has one for each
    length from ``shortest`` to its longest prefix, ascending.
    """
    trees = len(prefixes)
    rng = np.random.default_rng(SEED)
    mult = (rng.integers(0, 1 << 31, trees * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1))
    add = rng.integers(0, 1 << 32, trees * depth, dtype=np.uint32)
    wanted = np.arange(shortest, max(prefixes) + 1)[None, :] <= np.array(prefixes)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in X.chunks(b.column(1)):
                h, off = sorted_shingles(c, words)
                n = len(off) - 1
                labels = np.zeros((n, trees * depth), np.uint32)
                for d in range(n):
                    if off[d + 1] > off[d]:
                        labels[d] = _labels(h[off[d]:off[d + 1]], mult, add)
                by_tree = labels.reshape(n, trees, depth).astype(np.uint64)
                keys = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), (n, trees)).copy()
                levels = []
                for j in range(max(prefixes)):
                    keys = X.mix(keys * np.uint64(0x100000001B3) + by_tree[:, :, j])
                    if j + 1 >= shortest:
                        levels.append(keys)
                flat = np.stack(levels, axis=2)[:, wanted]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(c.first, n), *_content(h, off),
                     X.lists(flat.ravel().view(np.int64), np.arange(n + 1) * flat.shape[1], pa.int64())],
                    ["doc_id", "f1", "f2", "size", "keys"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, f1 long, f2 long, size long, keys array<long>")


def _labels_of(classes: DataFrame, prefixes: list[int], shortest: int) -> DataFrame:
    """id, size and k0, k1, ...: the keys of one tree's prefixes, ascending in length (null beyond its longest)."""
    width, rows, at = max(prefixes) - shortest + 1, [], 1
    for p in prefixes:
        own = p - shortest + 1
        key = lambda j: F.element_at("keys", at + j) if j < own else F.lit(None).cast("long")  # noqa: B023, E731
        rows.append(F.struct(*[key(j).alias(f"k{j}") for j in range(width)]))
        at += own
    return classes.select("id", "size", F.explode(F.array(*rows)).alias("label")).select("id", "size", "label.*")


def _matched(labels: DataFrame) -> DataFrame:
    """The labels that share a prefix with a neighbour in the sorted trie; ``matched``: how many keys.

    The first and last label of a partition count as matched, as their neighbours are elsewhere.
    """
    keys = [c for c in labels.columns if c not in ("id", "size")]
    width = len(keys)

    def shared(t: pa.RecordBatch, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
        own = sum(t.column(c).is_valid().to_numpy(zero_copy_only=False).astype(np.int32) for c in keys)
        matched = np.minimum(np.maximum(left, right), own).astype(np.int32)
        some = pa.array(np.flatnonzero(matched > 0))
        return pa.RecordBatch.from_arrays([*[c.take(some) for c in t.columns], pa.array(matched).take(some)],
                                          [*t.schema.names, "matched"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, width                 # the last label so far, and what it shares with the one before it
        for b in batches:
            if not b.num_rows:
                continue
            t = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            table = np.stack([t.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in keys], axis=1)
            alike = np.logical_and.accumulate(table[1:] == table[:-1], axis=1).sum(axis=1)
            left = np.concatenate([[before], alike])
            yield shared(t.slice(0, t.num_rows - 1), left[:-1], alike)
            held, before = t.slice(t.num_rows - 1), int(left[-1])
        if held is not None:
            yield shared(held, np.array([width]), np.array([width]))
    order = [*keys, "id"]
    schema = StructType([*labels.schema.fields, StructField("matched", IntegerType())])
    return labels.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def _meetings(labels: DataFrame) -> DataFrame:
    """id, size, key and n (> 1) of the prefixes by which classes meet.

    A label's matched prefix is the shortest that at most SMALL classes share, or
    its tree's longest.
    """
    keys = [c for c in labels.columns if c not in ("id", "size")]
    path = F.array_compact(F.array(*keys))
    trie = cut(_matched(labels).select("id", "size", "matched", path.alias("path")))
    each = trie.select("id", "size", "path", F.posexplode(F.slice("path", 1, F.col("matched"))).alias("at", "key"))
    parent = F.when(F.col("at") > 0, F.get("path", F.col("at") - 1)).otherwise(F.col("key"))
    nodes = cut(each.groupBy("key").agg(F.first(parent).alias("parent"), F.first("at").alias("at"),
                                        F.first(F.col("at") + 1 == F.size("path")).alias("last"), F.count("*").alias("n")).where("n > 1"))
    above = nodes.select(F.col("key").alias("parent"), F.col("n").alias("above"))
    ends = (nodes.join(above, "parent").where((F.col("n") <= SMALL) | F.col("last"))
            .where((F.col("at") == 0) | (F.col("above") > SMALL)).select("key", "n"))
    return cut(each.select("id", "size", "key").join(ends, "key"))


def _sets(source: Source | DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """The shingle sets of the classes in ``ids`` (id)."""
    source = source if isinstance(source, Source) else Source(source)
    told = [] if source.classes is None else CONTENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in X.chunks(b.column(1)):
                h, off = sorted_shingles(c, words)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(c.first, len(off) - 1), *(_content(h, off) if told else []),
                     X.lists(h.view(np.int64), off, pa.int64())], ["id", *told, "shingles"])
    texts = source.docs.select("doc_id", "text")
    if source.classes is None:        # a class is named by an id that has one text only
        wanted = texts.join(bounded_broadcast(ids.withColumnRenamed("id", "doc_id"), ID_BROADCAST), "doc_id", "left_semi")
        # Rows that repeat an id carry the same text; one of them is enough.
        return wanted.mapInArrow(run, "id long, shingles array<long>").dropDuplicates(["id"])
    asked = cut(ids.join(source.classes, "id"))
    near = cut(asked.select(F.col("least").alias("doc_id")).distinct())
    found = (texts.join(bounded_broadcast(near, ID_BROADCAST), "doc_id", "left_semi")
             .mapInArrow(run, "id long, f1 long, f2 long, size long, shingles array<long>").dropDuplicates(CONTENT))
    return found.drop("id").join(asked, CONTENT).select("id", "shingles")


def _verified(pairs: DataFrame, docs: Source, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact Jaccard similarity reaches the threshold."""
    pairs = cut(pairs.distinct())
    ids = cut(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
    sets = cut(_sets(docs, ids, words))
    left, right = (sets.select(F.col("id").alias(s), F.col("shingles").alias(f"s{s}")) for s in "ab")
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    return cut(pairs.join(left, "a").join(right, "b")
               .select("a", "b", shared.alias("shared"), (F.size("sa") + F.size("sb") - shared).alias("union"))
               .where(F.col("shared") >= F.lit(threshold) * F.col("union"))
               .select("a", "b", (F.col("shared") / F.col("union")).alias("similarity")))


def _pairs_of_small(members: DataFrame) -> DataFrame:
    """All pairs inside the prefixes that have at most SMALL members."""
    lists = members.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return (lists.select("ids", F.posexplode("ids").alias("at", "a"))
            .select("a", F.explode(F.expr("slice(ids, at + 2, size(ids))")).alias("b")))


def _named(classes: DataFrame) -> tuple[DataFrame, bool]:
    """Adds a unique id: the least of the class's documents, unless it names another class; whether any such is left."""
    shared = cut(classes.groupBy("least").agg(F.max("same").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    if not shared.count():
        return classes.withColumn("id", F.col("least")), False
    other = F.lit(CLASHING) + F.pmod(F.xxhash64("least", "same"), F.lit(CLASHING))
    named = classes.join(bounded_broadcast(shared, ID_BROADCAST), "least", "left")
    return cut(named.withColumn("id", F.when(F.col("first").isNull() | (F.col("first") == F.col("same")), F.col("least"))
                                .otherwise(other)).drop("first")), True


def _met(docs: DataFrame, threshold: float, words: int, trees: int, depth: int,
         recall: float) -> tuple[DataFrame, DataFrame, Source]:
    """(members, meet, source): class of every row; id, size, key and n of the prefixes by which classes meet."""
    prefixes = longest(trees, depth, threshold, recall)
    shortest = max(1, min(prefixes) - 1)
    rows = cut(signatures(docs.where("doc_id IS NOT NULL"), words, depth, prefixes, shortest))
    # A text without shingles is a class with all rows of its id that have none, either.
    same = F.struct(F.col("size"), F.when(F.col("size") > 0, F.col("f1")).otherwise(F.col("doc_id")).alias("f1"), F.col("f2"))
    rows = rows.withColumn("same", same)
    classes = cut(rows.groupBy("same").agg(F.min("doc_id").alias("least"), F.first(F.when(F.col("size") > 0, F.col("keys"))).alias("keys")))
    classes, clashing = _named(classes)
    members = rows.select("doc_id", "same").join(classes.select("same", "id"), "same").select("doc_id", F.col("id").alias("representative"))
    labels = _labels_of(classes.where("keys IS NOT NULL").select("id", F.col("same.size").alias("size"), "keys"), prefixes, shortest)
    contents = classes.select("id", "least", "same.f1", "same.f2", "same.size") if clashing else None
    return members, _meetings(labels), Source(docs, contents)


def _connecting(meet: DataFrame, docs: Source, words: int, threshold: float) -> DataFrame:
    """Links (a, b, similarity) with the components of all links: all in small prefixes, enough in large ones."""
    links = _verified(_pairs_of_small(meet.where(F.col("n") <= SMALL)), docs, words, threshold)
    large = cut(meet.where(F.col("n") > SMALL).select("key", "id"))
    central = meet.groupBy("id").agg(F.sum("n").alias("met"))
    hubs = (large.join(central, "id").groupBy("key")
            .agg(F.max_by("id", F.struct("met", -F.col("id"))).alias("hub")))
    tried = large.join(hubs, "key").withColumns({"a": F.least("id", "hub"), "b": F.greatest("id", "hub")})
    tried = cut(tried)
    starred = _verified(tried.where("id <> hub").select("a", "b"), docs, words, threshold)
    links = cut(links.unionByName(starred).dropDuplicates(["a", "b"]))
    # A member that some links join to its hub's component is explained too.
    named = components(links)
    mine, theirs = (named.select(F.col("id").alias(c), F.col("component").alias(f"{c}_name")) for c in ("id", "hub"))
    unexplained = cut(tried.join(mine, "id", "left").join(theirs, "hub", "left")
                      .where(F.coalesce("id_name", "id") != F.coalesce("hub_name", "hub")).select("id").distinct())
    exact = _verified(_rare_pairs(unexplained, cut(large.select("id").distinct()), docs, words, threshold), docs, words, threshold)
    return cut(links.unionByName(exact).dropDuplicates(["a", "b"]))


def _large_keys(meet: DataFrame) -> DataFrame:
    """id and the large prefixes it is in."""
    return meet.where(F.col("n") > SMALL).groupBy("id").agg(F.collect_list("key").alias("large"))


def _apart(links: DataFrame, keys: DataFrame) -> DataFrame:
    """The links whose ends share no large prefix."""
    left, right = (keys.select(F.col("id").alias(s), F.col("large").alias(f"l{s}")) for s in "ab")
    together = F.coalesce(F.arrays_overlap("la", "lb"), F.lit(False))
    return links.join(left, "a", "left").join(right, "b", "left").where(~together).select(*links.columns)


def _overlaps(rows: np.ndarray, values: np.ndarray, n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many values each row of ``left`` and each of ``right`` have in common; a row has a value once."""
    _, at, often = np.unique(values, return_inverse=True, return_counts=True)
    kept = often[at] > 1
    number = np.cumsum(often > 1) - 1
    rows, at = rows[kept], number[at[kept]]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    step = 2048
    for first in range(0, int(at[-1]) + 1 if len(at) else 0, step):
        i, j = np.searchsorted(at, (first, first + step))
        table = np.zeros((n, step), np.float32)
        table[rows[i:j], at[i:j] - first] = 1
        out += table[left] @ table[right].T
    return out


def _linked(meet: DataFrame, keys: DataFrame, docs: Source, words: int, threshold: float, counted: bool) -> DataFrame:
    """All links of two members of a large prefix: (id, n) to be summed, or (a, b, similarity), each link once."""
    large = meet.where(F.col("n") > SMALL).select("key", "id", "size")
    blocks = large.groupBy("key").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    sets = cut(_sets(docs, cut(large.select("id").distinct()), words).join(keys, "id"))
    dealt = (large.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
             .select("key", "id", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id")
             .join(sets, "id"))

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        key, low, high = (t.column(c)[0].as_py() for c in ("key", "low", "high"))
        n = t.num_rows
        ids, block = t.column("id").to_numpy(), t.column("block").to_numpy()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)

        def flat(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            lists = t.column(name).chunk(0)
            size = np.diff(lists.offsets.to_numpy())
            return np.repeat(np.arange(n), size), lists.flatten().to_numpy(), size
        rows, values, size = flat("shingles")
        shared = _overlaps(rows, values, n, left, right).astype(np.float64)
        union = size[left][:, None] + size[right][None, :] - shared
        found = shared >= threshold * union
        rows, values, _ = flat("large")
        earlier = values < key
        found &= _overlaps(rows[earlier], values[earlier], n, left, right) == 0
        if low == high:
            found = np.triu(found, 1)
        i, j = np.nonzero(found)
        if counted:
            often = np.bincount(left[i], minlength=n) + np.bincount(right[j], minlength=n)
            some = often > 0
            return pa.table({"id": ids[some], "n": often[some].astype(np.int64)})
        x, y = ids[left[i]], ids[right[j]]
        return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y), "similarity": shared[i, j] / union[i, j]})
    return dealt.groupBy("key", "low", "high").applyInArrow(run, "id long, n long" if counted else "a long, b long, similarity double")


def join(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, trees: int = TREES,
         depth: int = DEPTH, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(members, links): class representatives of all rows, and all links between them.

    members: doc_id, representative; links: a < b (representatives), similarity.
    """
    members, meet, source = _met(docs, threshold, words, trees, depth, recall)
    links, keys = _connecting(meet, source, words, threshold), cut(_large_keys(meet))
    return members, cut(_apart(links, keys).unionByName(_linked(meet, keys, source, words, threshold, False)))


def _rare_pairs(asking: DataFrame, among: DataFrame, docs: Source | DataFrame, words: int, threshold: float) -> DataFrame:
    """Every pair of an id in ``asking`` and one in ``among`` (which has them all) that may reach the threshold.

    The shingles of a set are ordered from rare to common.  If two sets reach
    the threshold, the first shingle they share leaves at least the needed
    overlap on both sides, and lies among the first size - threshold * size + 1.
    """
    sets = _sets(docs, among, words).select("id", F.size("shingles").alias("size"), F.explode("shingles").alias("s"))
    sets = cut(sets)
    counts = sets.groupBy("s").agg(F.count("*").alias("n"))
    order = Window.partitionBy("id").orderBy("n", "s")
    first = (sets.join(counts, "s").withColumn("left", F.col("size") - F.row_number().over(order) + 1)
             .where(F.col("left") >= F.ceil(F.lit(threshold) * F.col("size") - 1e-6)).select("id", "size", "left", "s"))
    first = cut(first)
    asks = asking.select("id", F.lit(True).alias("asks"))
    first = first.join(asks, "id", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    mine = first.where("asks").select("s", F.col("id").alias("i"), F.col("size").alias("i_size"), F.col("left").alias("i_left"))
    theirs = first.select("s", F.col("id").alias("j"), F.col("size").alias("j_size"), F.col("left").alias("j_left"), "asks")
    needed = F.lit(threshold / (1 + threshold)) * (F.col("i_size") + F.col("j_size")) - 1e-6
    once = (F.col("i") < F.col("j")) | (~F.col("asks") & (F.col("i") != F.col("j")))
    met = mine.join(theirs, "s").where(once & (F.least("i_left", "j_left") >= needed))
    return met.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))


def classes(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, trees: int = TREES,
            depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (least id of its component), n_links and n_copies of every row.

    n_links: verified links of the row's shingle set to other sets; n_copies: rows
    with the same shingle set, itself included.
    """
    members, meet, source = _met(docs, threshold, words, trees, depth, recall)
    members, links, keys = cut(members), _connecting(meet, source, words, threshold), cut(_large_keys(meet))
    named = components(links)
    apart = _apart(links, keys)
    one = F.lit(1).cast("long").alias("n")
    ends = (apart.select(F.col("a").alias("id"), one).unionByName(apart.select(F.col("b").alias("id"), one))
            .unionByName(_linked(meet, keys, source, words, threshold, True)))
    degree = ends.groupBy(F.col("id").alias("representative")).agg(F.sum("n").alias("n_links"))
    copies = members.groupBy("representative").agg(F.count("*").alias("n_copies"))
    found = (copies.join(degree, "representative", "left")
             .join(named.withColumnRenamed("id", "representative"), "representative", "left")
             .select("representative", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                     F.coalesce("component", "representative").alias("class_id")))
    nulls = docs.where("doc_id IS NULL").select(
        "doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"))
    return members.join(found, "representative").select("doc_id", "class_id", "n_links", "n_copies").unionByName(nulls)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, trees: int = TREES,
             depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """One document of each class, with all its columns; rows without an id stay."""
    members, meet, source = _met(docs, threshold, words, trees, depth, recall)
    # The least name of a component is the least of its classes' names.
    named = components(_connecting(meet, source, words, threshold)).withColumnRenamed("id", "representative")
    left = (members.join(named, "representative", "left")
            .where(F.col("representative") == F.coalesce("component", "representative")))
    columns = [f"`{c}`" for c in docs.columns]
    nulls = docs.where("doc_id IS NULL")
    if source.classes is None:
        ids = cut(left.where("doc_id = representative").select("doc_id").distinct())
        kept = docs.join(bounded_broadcast(ids, ID_BROADCAST), "doc_id", "left_semi").select(*columns)
        repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count()
        return (kept.dropDuplicates(["doc_id"]) if repeated else kept).unionByName(nulls)
    # Ids repeat with other texts: the rows to keep are told by id and content.
    chosen = cut(left.select(F.col("representative").alias("id")).distinct().join(source.classes, "id").drop("id"))
    at = docs.columns.index("text")
    extra = [f"_{c}" for c in CONTENT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in X.chunks(b.column(at)):
                h, off = sorted_shingles(c, words)
                rows = b.slice(c.first, len(off) - 1)
                yield pa.RecordBatch.from_arrays([*rows.columns, *_content(h, off)], [*b.schema.names, *extra])
    schema = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in extra]])
    rows = docs.where("doc_id IS NOT NULL").mapInArrow(run, schema)
    content = F.when(F.col("_size") > 0, F.col("_f1")).otherwise(F.col("doc_id"))
    renamed = chosen.select(*[F.col(c).alias(f"__{c}") for c in chosen.columns])
    match = ((F.col("doc_id") == F.col("__least")) & (content == F.col("__f1"))
             & (F.col("_f2") == F.col("__f2")) & (F.col("_size") == F.col("__size")))
    return (rows.join(bounded_broadcast(renamed, ID_BROADCAST // 4), match, "left_semi").dropDuplicates(["doc_id", *extra])
            .select(*columns).unionByName(nulls))
