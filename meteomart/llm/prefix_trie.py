"""Conversation prefix trie: shared turn prefixes, rolled up in depth bands.

Conversations are rebuilt (the first turns of one in five replace those of its
neighbours), and every distinct sequence of first turns is a node.  A node's key
is the exclusive or of 128-bit hashes of its (depth, turn) pairs, so keys come
from running sums that are cut into blocks; no task needs a whole conversation.

Rollup.  Depths are dealt into bands of ``BAND``.  A node sends its figures to
its ancestors within its band only.  The band roots then form a trie of their
own, a ``BAND``-th as deep, which is rolled up the same way, and so on: there
are log(depth) rounds and at most ``BAND`` rows sent a node and round.  Completed
totals of the band roots then go back down, to the nodes of the band above each.

Hot keys.  Turns are numbered over range partitions, so a conversation of any
length is spread; sums are pre-aggregated; parents with many children (at most
``HEAVY`` of them, by count) are looked up by broadcast, all others by a shuffle
join; ids that end at one node are hashed as a stream of sorted chunks.

Defined results.  Null role or text: empty.  Null turns come first.  Equal turns
are ordered by role, then by the SHA-256 of the text; repeated rows are turns of
their own.  Rows without conv_id take no part.  Conversations left without turns
are members of the root alone.  Empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meteomart.llm.tables import cut

GROUP = 5          # conversations that share the first turns of the first of them
LONGEST_HEAD = 8   # crc32 % 9
BAND = 16
BLOCK = 512        # depths a running sum covers in one task; a multiple of BAND
HEAVY = 1000
CHUNK = 4096       # ids a chunk of an end list covers
KEY = ["k1", "k2"]


def head_length(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first of its group."""
    return F.crc32(conv_id.cast("string")) % (LONGEST_HEAD + 1)


def numbered(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, part, place, role digest and text bytes), sorted over range partitions.

    ``place`` ascends with the order inside a part, and parts ascend too.
    """
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", role.alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", "digest", "row"]     # row: equal turns may lie in several parts
    return cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
        "role", "digest", "bytes"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, role, digest, bytes) of the rebuilt turns, and (conv_id, n_turns)."""
    turns = numbered(conversations)
    parts = cut(turns.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")))
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), head_length(F.col("conv_id")).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = cut(convs.join(bases, "base", "left").select(
        "conv_id", "n", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("m")))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (parts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1)
              .join(convs.select("conv_id", "h", "m"), "conv_id").select("conv_id", "part", "shift", "h", "m"))
    placed = cut(turns.join(shifts, ["conv_id", "part"]).withColumn("pos", F.col("place") + F.col("shift"))
                 .select("conv_id", "pos", "h", "m", "role", "digest", "bytes"))
    own = placed.where("pos > h").select("conv_id", (F.col("m") + F.col("pos") - F.col("h")).alias("depth"), "role", "digest", "bytes")
    heads = placed.where((F.col("pos") <= LONGEST_HEAD) & (F.col("conv_id") % GROUP == 0)).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("depth"), "role", "digest", "bytes")
    heads = heads.join(convs.select("conv_id", "base", "m"), "base").where("depth <= m").drop("base", "m")
    sizes = convs.select("conv_id", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    return own.unionByName(heads.select(own.columns)), sizes


def prefixes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every prefix of every conversation: its key, its ancestors in the band, its last text's bytes.

    ``path`` holds the keys of the ancestors at the depths from a band's first on;
    for a band's first depth, those of the whole band above.
    """
    tag = lambda seed: F.xxhash64(F.lit(seed), F.col("depth"), F.col("role"), F.col("digest"))
    rows = turns.select("conv_id", "depth", F.floor((F.col("depth") - 1) / BLOCK).alias("block"), "bytes",
                        tag(1).alias("e1"), tag(2).alias("e2"))
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (rows.groupBy("conv_id", "block").agg(F.bit_xor("e1").alias("e1"), F.bit_xor("e2").alias("e2"))
             .select("conv_id", "block", F.bit_xor("e1").over(earlier).alias("c1"), F.bit_xor("e2").over(earlier).alias("c2"))
             .where("c1 IS NOT NULL"))
    rows = rows.select("*", *[F.bit_xor(f"e{i}").over(so_far).alias(f"r{i}") for i in (1, 2)])
    rows = rows.join(carry, ["conv_id", "block"], "left")
    rows = rows.select("conv_id", "depth", "block", "bytes", "e1", "e2", *[
        F.col(f"r{i}").bitwiseXOR(F.coalesce(F.col(f"c{i}"), F.lit(0))).alias(f"k{i}") for i in (1, 2)])
    above = F.struct(*[F.col(f"k{i}").bitwiseXOR(F.col(f"e{i}")).alias(f"k{i}") for i in (1, 2)])
    band = Window.partitionBy("conv_id", "block", F.floor((F.col("depth") - 1) / BAND)).orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0)
    rows = rows.select("conv_id", "depth", "bytes", *KEY, F.collect_list(above).over(band).alias("path"))
    none = F.array().cast("array<struct<k1:bigint,k2:bigint>>")
    roots = sizes.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"),
                         F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), none.alias("path"))
    ends = sizes.select("conv_id", F.col("n_turns").alias("depth"), F.lit(True).alias("last"))
    return rows.unionByName(roots).join(ends, ["conv_id", "depth"], "left").withColumn("last", F.coalesce("last", F.lit(False)))


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])


def _sent(rows: DataFrame, children: bool) -> DataFrame:
    """The figures of each row, for every node on its path; the last of the path is its parent."""
    at = rows.select(F.posexplode("path").alias("at", "to"), F.size("path").alias("n"), "n_leaves", "saved_tokens")
    child = (F.col("at") == F.col("n") - 1).cast("long") if children else F.lit(0).cast("long")
    return at.select("to.k1", "to.k2", child.alias("n_children"), "n_leaves", "saved_tokens")


def _levels(paths: DataFrame, deepest: int) -> list[DataFrame]:
    """Per level: the nodes at every BAND**level-th depth with their paths among them."""
    levels, step = [paths.select(*KEY, "depth", "path")], 1
    rows = paths
    while step * BAND <= deepest:
        step *= BAND
        group = Window.partitionBy("conv_id", F.floor((F.col("depth") / step - 1) / BAND)).orderBy("depth").rowsBetween(
            Window.unboundedPreceding, 0)
        # The first of a band root's path is the band root above it.
        rows = cut(rows.where(F.col("depth") % step == 0).select(
            "conv_id", "depth", *KEY, F.collect_list(F.get("path", F.lit(0))).over(group).alias("path")))
        levels.append(cut(rows.groupBy(*KEY).agg(F.max("depth").alias("depth"), F.first("path").alias("path"))))
    return levels


def rollup(nodes: DataFrame, paths: DataFrame, deepest: int) -> DataFrame:
    """n_children, n_leaves and saved_tokens over the subtree of every node, by key.

    ``nodes`` have key, depth, path and their own figures; ``paths`` are the prefixes
    of all conversations, which give the band roots their paths at the upper levels.
    """
    levels = _levels(paths.select("conv_id", "depth", *KEY, "path"), deepest)
    levels[0] = nodes.select(*KEY, "depth", "path")
    weights = nodes.select(*KEY, F.lit(0).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
    within = []
    for i, level in enumerate(levels):      # up: totals inside the bands
        band = BAND ** (i + 1)
        own = nodes if i == 0 else level.join(weights, KEY)
        inner = own.where(F.col("depth") % band != 0)
        within.append(cut(_totals(weights.unionByName(_sent(inner, i == 0)) if i == 0 else
                                  own.select(weights.columns).unionByName(_sent(inner, False)))))
        weights = within[-1].withColumn("n_children", F.lit(0).cast("long"))
    done = within[-1]
    for i in range(len(levels) - 2, -1, -1):   # down: completed band roots reach the band above
        roots = levels[i].where((F.col("depth") % BAND ** (i + 1) == 0) & (F.col("depth") > 0))
        full = roots.join(done.select(*KEY, "n_leaves", "saved_tokens"), KEY)
        done = cut(_totals(within[i].unionByName(_sent(full, i == 0))))
    return done


def _hash_streams(batches):
    """Sorted (k1, k2, chunk, ids) -> the SHA-256 of each key's ids, one key at a time."""
    key = state = None
    for batch in batches:
        done = []
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids")), strict=True):
            if (k1, k2) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _ends_batch(done)
    if key is not None:
        yield _ends_batch([(*key, state.hexdigest())])


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, c = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())],
                                      names=["k1", "k2", "ends_sha256"])


def end_digests(paths: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of the conversations that end at a node, by key."""
    chunks = (paths.where("last").groupBy(*KEY, F.expr(f"conv_id div {CHUNK}").alias("chunk"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    return (chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids")
            .mapInArrow(_hash_streams, "k1 long, k2 long, ends_sha256 string"))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Adds parent_conv_id; parents of a HEAVY-th of all nodes or more are at most HEAVY rows."""
    many = nodes.count() // HEAVY + 1
    ids = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    parent = F.get("path", F.size("path") - 1)
    rows = nodes.select("*", parent["k1"].alias("p1"), parent["k2"].alias("p2"))
    heavy = F.broadcast(ids.where(F.col("n_children") >= many).drop("n_children"))
    light = ids.where((F.col("n_children") < many) & (F.col("n_children") > 0)).drop("n_children")
    return (rows.join(heavy, ["p1", "p2"])
            .unionByName(rows.join(heavy, ["p1", "p2"], "left_anti").join(light, ["p1", "p2"], "left")))


def trie(conversations: DataFrame) -> DataFrame:
    """Every node with its members, children, leaves and savings; one row a node."""
    paths = cut(prefixes(*rebuilt(conversations)))
    nodes = cut(paths.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        F.count_if("last").alias("n_ends"), F.max("bytes").alias("bytes"), F.first("path").alias("path"))
        .withColumn("n_leaves", (F.col("n_ends") == F.col("n_convs")).cast("long"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes")))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = rollup(nodes, paths, deepest)
    full = cut(nodes.drop("n_leaves", "saved_tokens").join(totals, KEY).join(end_digests(paths), KEY, "left"))
    return _with_parents(full)


def nodes(conversations: DataFrame) -> DataFrame:
    """The digest columns of the trie's nodes."""
    return trie(conversations).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


# A node is an md5 over the lengths and contents of its turns; its figures go to every ancestor.
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % {GROUP} AS base, conv_id::VARCHAR AS s FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, base, xor(list_reduce(
    [4294967295::BIGINT] || flatten(list_transform(range(1, length(s) + 1), lambda i: [ord(s[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda crc, bits: CASE WHEN xor(crc, bits) & 1 = 1 THEN xor(xor(crc, bits) >> 1, 3988292384::BIGINT) ELSE xor(crc, bits) >> 1 END),
    4294967295::BIGINT) % {LONGEST_HEAD + 1} AS h FROM convs),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM heads c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
lists AS (
  SELECT c.conv_id, coalesce(list(md5(length(role) || ':' || role || text) ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS digests,
         coalesce(list(strlen(text) ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS sizes
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
keyed AS (
  SELECT conv_id, sizes, list_transform(range(0, len(digests) + 1), lambda d: md5(d || ':' || array_to_string(digests[1:d], ''))) AS keys
  FROM lists),
prefixes AS (
  SELECT conv_id, unnest(range(1, len(keys) + 1)) AS i, keys, sizes FROM keyed),
nodes AS (
  SELECT keys[i] AS k, i - 1 AS depth, min(conv_id) AS conv_id, any_value(keys[1:i]) AS path, count(*) AS n_convs,
         count(*) FILTER (i = len(keys)) AS n_ends, any_value(CASE WHEN i > 1 THEN sizes[i - 1] ELSE 0 END) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (i = len(keys)), '')) AS ends_sha256
  FROM prefixes GROUP BY ALL),
sent AS (
  SELECT unnest(path) AS k, unnest(range(1, len(path) + 1)) AS i, depth, n_ends = n_convs AS leaf, (n_convs - 1) * bytes AS saved FROM nodes),
totals AS (
  SELECT k, count(*) FILTER (depth = i) AS n_children, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved_tokens FROM sent GROUP BY k)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.k = n.k LEFT JOIN nodes p ON p.k = n.path[n.depth]"""
