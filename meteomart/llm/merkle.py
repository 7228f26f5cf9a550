"""Document fingerprints: a Merkle tree over sections, paragraphs and clauses.

A text is cut into sections (after blank lines), those into paragraphs (after
line ends), those into clauses (after a run of marks).  The cuts drop no
character.  A clause's digest is the SHA-256 of its text; a node's is the
SHA-256 of its children's digests; the root is the fingerprint, so equal texts
have equal roots and an edit changes exactly the nodes above it.  ``changed``
descends two trees and lists the paragraphs whose branches differ.

Everything is DataFrame functions.  The SQL twin is ``ORACLE``.

Defined results.  Null text: as empty; its tree has no node, its root is the
SHA-256 of nothing, and its likeness is 1 to another empty text, else 0.  Null
ids come first in the order.  Repeated rows are documents of their own,
neighbours in the order (ties by text).  A single row is its own next.  Empty
table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

# The same three patterns serve Spark and the SQL twin.
SECTION = r"(?s).+?(?:\n{2,}|\z)"
PARAGRAPH = r"[^\n]+\n*|\n+"
CLAUSE = r"[^.!?|;]*[.!?|;]+ *|[^.!?|;]+"
ROWS_A_GROUP = 1000
MOST_GROUPS = 20_000


def _cut(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def tree(text: Column) -> Column:
    """array<array<array<string>>>: the clause digests by section and paragraph."""
    return F.transform(_cut(text, SECTION), lambda s: F.transform(
        _cut(s, PARAGRAPH), lambda p: F.transform(_cut(p, CLAUSE), lambda c: F.sha2(c, 256))))


def section_digests(tree_: Column) -> Column:
    return F.transform(tree_, lambda s: F.sha2(F.array_join(
        F.transform(s, lambda p: F.sha2(F.array_join(p, ""), 256)), ""), 256))


def root(tree_: Column) -> Column:
    return F.sha2(F.array_join(section_digests(tree_), ""), 256)


def leaves(tree_: Column) -> Column:
    """The different clause digests of a tree, by their first 64 bits."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(tree_)), lambda c: F.substring(c, 1, 16)))


def likeness(a: Column, b: Column) -> Column:
    """Shared share of two arrays of different digests (Dice), 1 for two empty ones."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def paragraph_digests(tree_: Column) -> Column:
    """The digests of all paragraphs, in order."""
    return F.flatten(F.transform(tree_, lambda s: F.transform(s, lambda p: F.sha2(F.array_join(p, ""), 256))))


def n_changed(mine: Column, theirs: Column) -> Column:
    """How many of the digests ``mine`` are not among ``theirs``, by one pass over both, sorted.

    Equal digests stand side by side, theirs first, so the state is theirs that came last.
    """
    entry = lambda side: lambda d: F.struct(d.alias("digest"), F.lit(side).alias("side"))
    both = F.array_sort(F.concat(F.transform(F.array_distinct(theirs), entry(0)), F.transform(mine, entry(1))))
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("n"))
    return F.aggregate(both, start, lambda s, x: F.struct(
        F.when(x["side"] == 0, x["digest"]).otherwise(s["last"]).alias("last"),
        (s["n"] + F.when((x["side"] == 1) & (x["digest"] != s["last"]), 1).otherwise(0)).alias("n")), lambda s: s["n"])


def changed(a: Column, b: Column) -> Column:
    """Paragraphs of tree ``a`` that tree ``b`` has not: array of (section, paragraph), from 0.

    Digests that b has not are found by hashing; a section whose digest is among b's is skipped whole.
    """
    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))
    gone = let(F.struct(F.array_except(paragraph_digests(a), paragraph_digests(b)).alias("paragraphs"),
                        F.array_except(section_digests(a), section_digests(b)).alias("sections")),
               lambda g: F.flatten(F.transform(
                   F.filter(F.zip_with(F.transform(a, lambda s, i: F.struct(s.alias("s"), i.alias("i"))), section_digests(a),
                                       lambda s, d: F.struct(s["s"].alias("s"), s["i"].alias("i"), d.alias("d"))),
                            lambda x: F.array_contains(g["sections"], x["d"])),
                   lambda x: F.transform(F.filter(
                       F.transform(x["s"], lambda p, j: F.struct(F.sha2(F.array_join(p, ""), 256).alias("d"), j.alias("j"))),
                       lambda p: F.array_contains(g["paragraphs"], p["d"])),
                       lambda p: F.struct(x["i"].alias("section"), p["j"].alias("paragraph"))))))
    return gone


def with_next(docs: DataFrame, rows_a_group: int = ROWS_A_GROUP,
              most_groups: int = MOST_GROUPS) -> tuple[DataFrame, WindowSpec]:
    """doc_id, text (null: empty), group, halo and next_text: that of the next row by id.

    The last row's next is the first.  The ids are dealt into ranges whose first
    ids are known on the driver (at most ``most_groups`` numbers); the first row
    of a range is also given, as a halo, to the range before, so one exchange of
    the texts is enough.  The window that orders a range comes back too.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n, nulls, low = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull()), F.min("doc_id")).first()
    groups = min(most_groups, max(1, n // rows_a_group))
    # percentile_approx gives ids of the table, so each range begins with a row of its own.
    shares = [i / groups for i in range(1, groups)] or [0.0]
    firsts = docs.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0] or []
    firsts = sorted({f for f in firsts if f > low})
    known = F.split(F.lit(",".join(map(str, firsts))), ",").cast("array<bigint>") if firsts else F.lit(None).cast("array<bigint>")
    own = F.coalesce(_rank(F.col("doc_id"), known, len(firsts)), F.lit(0))
    very_first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(low)
    begins = F.col("doc_id") == F.get(known, F.col("own") - 1)
    place = lambda group, halo: F.struct(group.alias("group"), F.lit(halo).alias("halo"))
    places = F.array_compact(F.array(
        place(F.col("own"), 0), F.when(begins, place(F.col("own") - 1, 1)),
        F.when(very_first, place(F.lit(len(firsts)), 2))))
    dealt = (rows.withColumn("own", own).withColumn("at", F.explode(places))
             .select("doc_id", "text", "at.group", "at.halo"))
    order = Window.partitionBy("group").orderBy("halo", F.asc_nulls_first("doc_id"), "text")
    return dealt.withColumn("next_text", F.lead("text").over(order)), order


def _rank(value: Column, known: Column, many: int) -> Column:
    """How many of the ascending numbers ``known`` are at most ``value``, in two steps."""
    step = max(1, int(many ** 0.5))
    every = F.transform(F.sequence(F.lit(0), F.lit(max(0, (many - 1) // step))), lambda i: F.get(known, i * step))
    block = F.size(F.filter(every, lambda x: x <= value)) - 1
    inside = F.size(F.filter(F.slice(known, F.greatest(block, F.lit(0)) * step + 1, step), lambda x: x <= value))
    return F.when(F.lit(many) > 0, F.greatest(block, F.lit(0)) * step + inside).otherwise(0)


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the next text's first."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (F.length(text) - half).cast("int")), F.substring(next_text, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit, their likenesses, and what the edit changed."""
    rows, order = with_next(docs)
    rows = (rows.withColumn("edit", edited(F.col("text"), F.col("next_text"))).drop("next_text")
            .withColumns({"tree": tree(F.col("text")), "edit_tree": tree(F.col("edit"))})
            .withColumns({"paragraphs": paragraph_digests(F.col("tree")), "edit_paragraphs": paragraph_digests(F.col("edit_tree"))})
            .select("group", "halo", "doc_id", "text", F.length("text").cast("long").alias("n_chars"),
                    F.sha2("edit", 256).alias("edited_sha256"), root(F.col("tree")).alias("fingerprint"),
                    root(F.col("edit_tree")).alias("edited_fingerprint"), leaves(F.col("tree")).alias("leaves"),
                    leaves(F.col("edit_tree")).alias("edit_leaves"),
                    n_changed(F.col("paragraphs"), F.col("edit_paragraphs")).alias("n_changed_paragraphs")))
    rows = rows.withColumn("next_leaves", F.lead("leaves").over(order))
    return rows.where("halo = 0").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("leaves"), F.col("edit_leaves")).alias("near_edited"),
        likeness(F.col("leaves"), F.col("next_leaves")).alias("near_next"), "n_changed_paragraphs")


def _sql_list(pattern: str, of: str) -> str:
    return f"regexp_extract_all({of}, '{pattern}')"


_SQL_TREE = (f"list_transform({_sql_list(SECTION, '{0}')}, lambda s: list_transform({_sql_list(PARAGRAPH, 's')}, "
             f"lambda p: list_transform({_sql_list(CLAUSE, 'p')}, lambda c: sha256(c))))").replace("{2,}", "{{2,}}")
_SQL_SECTIONS = ("list_transform({0}, lambda s: sha256(array_to_string(list_transform(s, "
                 "lambda p: sha256(array_to_string(p, ''))), '')))")
_SQL_LEAVES = "list_distinct(list_transform(flatten(flatten({0})), lambda c: c[1:16]))"
_SQL_LIKE = ("CASE WHEN len({0}) + len({1}) = 0 THEN 1.0::DOUBLE "
             "ELSE 2.0::DOUBLE * len(list_intersect({0}, {1})) / (len({0}) + len({1})) END")

ORACLE = f"""
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS next_text
  FROM documents WINDOW o AS (ORDER BY doc_id NULLS FIRST, text)),
edits AS (
  SELECT doc_id, text, length(text) AS n_chars,
         substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) AS edit
  FROM rows),
trees AS (
  SELECT doc_id, text, n_chars, edit, {_SQL_TREE.format('text')} AS t, {_SQL_TREE.format('edit')} AS e FROM edits),
digests AS (
  SELECT doc_id, text, n_chars, edit, t, {_SQL_SECTIONS.format('t')} AS ts, {_SQL_SECTIONS.format('e')} AS es,
         {_SQL_LEAVES.format('t')} AS tl, {_SQL_LEAVES.format('e')} AS el,
         list_transform(flatten(e), lambda p: array_to_string(p, '')) AS ep FROM trees),
nexts AS (
  SELECT *, coalesce(lead(tl) OVER o, first_value(tl) OVER o) AS nl
  FROM digests WINDOW o AS (ORDER BY doc_id NULLS FIRST, text))
SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(edit) AS edited_sha256,
       sha256(array_to_string(ts, '')) AS fingerprint, sha256(array_to_string(es, '')) AS edited_fingerprint,
       {_SQL_LIKE.format('tl', 'el')} AS near_edited, {_SQL_LIKE.format('tl', 'nl')} AS near_next,
       len(flatten(list_transform(t, lambda s, i: CASE WHEN list_contains(es, ts[i]) THEN []
           ELSE list_filter(list_transform(s, lambda p: array_to_string(p, '')), lambda p: NOT list_contains(ep, p)) END)))::INTEGER
         AS n_changed_paragraphs
FROM nexts"""
