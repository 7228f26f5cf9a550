"""Mixing sources to target weights by iterative proportional fitting.

One pass over the documents counts the tokens of every (source, language,
topic) cell.  The cells are raked: their weights are scaled to each marginal
in turn until all marginals hold.  A cell's documents then share one
probability: the token budget times the cell's share over the cell's tokens,
at most 1, with what a full cell cannot take given to the others.  A document
stays when a uniform number made from its id is below its cell's probability.

The number of cells that reach the driver is bounded: every level that a target names,
and where none is given the ``max_levels`` largest of a dimension, have one of their
own; all others share the level ``OTHER`` and its target (that of the name
``OTHER``, if targets are given; none: their documents leave).  Nothing depends on the number of documents.
Targets that name more than ``max_levels`` levels raise an error; marginals that do
not settle (empty cells may rule them out) are reported by a warning.

Defined results.  Null source, language or topic: the level ``NULL_LEVEL``.  Null
or empty text: one token (its end).  Null id: the uniform number of the text
"null".  Repeated rows: the same decision each.  Empty table: no rows.  Extra
columns are ignored by ``decide`` and kept by ``mix``; those whose names clash
with the columns made here are never read.
"""

from __future__ import annotations

import itertools
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteomart.llm.tables import cut

NULL_LEVEL, OTHER = "(none)", "(other)"
DIMENSIONS = ("source", "lang", "topic")
MAX_LEVELS = 200
TEMPERATURE = 0.5
BUDGET_SHARE = 0.6
ROUNDS = 200
SETTLED = 1e-6                # the largest difference to a target marginal
CELL = "source string, lang string, topic string, tokens double, share double, probability double"


def n_tokens(text: Column) -> Column:
    """Words (runs without ASCII white space) and one end."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def topic(text: Column) -> Column:
    """The topic of a document by its form, as the corpus has no topic column.

    ``list``: bars between words; ``poem``: lines of under 60 characters on the
    average; ``note``: under 600 characters; ``story``: over 5,000; else ``essay``.
    """
    t = F.coalesce(text, F.lit(""))
    size, lines = F.length(t), F.regexp_count(t, F.lit("\n")) + 1
    return (F.when(F.instr(t, " | ") > 0, "list").when(size / lines < 60, "poem").when(size < 600, "note")
            .when(size > 5000, "story").otherwise("essay"))


def uniform(doc_id: Column) -> Column:
    """From 0 to 1, by the first 52 bits of the id's md5."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 13), 16, 10).cast("double") / float(16 ** 13)


def _levels(docs: DataFrame) -> DataFrame:
    """The row's columns in one struct, so that extra names cannot clash, and what is derived."""
    level = {"source": F.coalesce(F.col("source").cast("string"), F.lit(NULL_LEVEL)),
             "lang": F.coalesce(F.col("lang").cast("string"), F.lit(NULL_LEVEL)),
             "topic": F.when(F.col("text").isNull(), NULL_LEVEL).otherwise(topic(F.col("text")))}
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[c.alias(k) for k, c in level.items()],
                       n_tokens(F.col("text")).alias("n_tokens"), uniform(F.col("doc_id")).alias("u"))


def tempered(tokens: dict[str, float], temperature: float = TEMPERATURE) -> dict[str, float]:
    """Target shares in proportion to tokens ** temperature."""
    powers = {k: v ** temperature for k, v in tokens.items()}
    total = sum(powers.values()) or 1.0
    return {k: v / total for k, v in powers.items()}


def rake(cells: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS, close: float = 1e-12) -> np.ndarray:
    """Scale a table of weights to its target marginals; empty cells stay empty.

    Targets of levels without weight are given to the others in proportion.
    """
    w = cells / max(cells.sum(), 1e-300)
    axes = range(w.ndim)
    wanted = []
    for a, t in zip(axes, targets, strict=True):
        t = np.where(w.sum(axis=tuple(x for x in axes if x != a)) > 0, t, 0.0)
        wanted.append(t / max(t.sum(), 1e-300))
    for _ in range(rounds):
        worst = 0.0
        for a in axes:
            have = w.sum(axis=tuple(x for x in axes if x != a))
            worst = max(worst, float(np.abs(have - wanted[a]).max()))
            factor = np.divide(wanted[a], have, out=np.zeros_like(have), where=have > 0)
            w = w * factor.reshape([-1 if x == a else 1 for x in axes])
        if worst < close:
            break
    else:
        if worst > SETTLED:
            warnings.warn(f"marginals differ by {worst:.2g} from their targets after {rounds} rounds", stacklevel=2)
    return w


def probabilities(tokens: np.ndarray, shares: np.ndarray, budget: float) -> np.ndarray:
    """Per-cell probabilities whose expected tokens are the budget, at most 1 each."""
    p = np.zeros_like(tokens, dtype=float)
    full = np.zeros(tokens.shape, bool)
    some = tokens > 0
    for _ in range(tokens.size + 1):
        open_ = some & ~full
        left, share = budget - tokens[full].sum(), shares[open_].sum()
        if left <= 0 or share <= 0:
            break
        p[open_] = left * shares[open_] / share / tokens[open_]
        over = open_ & (p >= 1)
        if not over.any():
            break
        full |= over
    p[full] = 1.0
    return np.clip(p, 0, 1)


def calibrate(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None,
              budget_share: float = BUDGET_SHARE, max_levels: int = MAX_LEVELS) -> DataFrame:
    """One row a cell: its levels, tokens, raked weight and probability."""
    return docs.sparkSession.createDataFrame(_cells(_levels(docs), targets, budget_share, max_levels), CELL)


def _cells(rows: DataFrame, targets, budget_share, max_levels) -> list[tuple]:
    # Written once: the texts are counted in one pass, the cells read several times.
    cells = cut(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")))
    kept = {}
    for d in DIMENSIONS:
        if targets and d in targets:
            if len(targets[d]) > max_levels:
                raise ValueError(f"targets name {len(targets[d])} levels of {d}; max_levels is {max_levels}")
            kept[d] = sorted(set(targets[d]) - {OTHER})
        else:
            # The largest max_levels levels by tokens: a bounded list.
            top = cells.groupBy(d).agg(F.sum("tokens").alias("t")).orderBy(F.desc("t"), d).limit(max_levels).collect()
            kept[d] = sorted(r[d] for r in top)
    folded = cells.groupBy(*[F.when(F.col(d).isin(kept[d]), F.col(d)).otherwise(OTHER).alias(d) for d in DIMENSIONS]) \
        .agg(F.sum("tokens").alias("tokens")).collect()
    names = [[*kept[d], OTHER] for d in DIMENSIONS]
    at = [{n: i for i, n in enumerate(ns)} for ns in names]
    tokens = np.zeros([len(n) for n in names])
    for r in folded:
        tokens[tuple(a[r[d]] for a, d in zip(at, DIMENSIONS, strict=True))] += r["tokens"]
    wanted = []
    for a, d in enumerate(DIMENSIONS):
        marginal = dict(zip(names[a], tokens.sum(axis=tuple(x for x in range(3) if x != a)), strict=True))
        chosen = (targets or {}).get(d) or tempered(marginal)
        wanted.append(np.array([chosen.get(n, 0.0) for n in names[a]]))
    shares = rake(tokens, wanted)
    p = probabilities(tokens, shares, budget_share * tokens.sum())
    return [(*(names[a][i] for a, i in enumerate(ix)), float(tokens[ix]), float(shares[ix]), float(p[ix]))
            for ix in itertools.product(*map(range, tokens.shape)) if tokens[ix] > 0]


def _decided(docs: DataFrame, targets, budget_share, max_levels) -> DataFrame:
    rows = _levels(docs)
    found = _cells(rows, targets, budget_share, max_levels)
    cells = docs.sparkSession.createDataFrame(found, CELL)
    kept = {d: sorted({c[a] for c in found} - {OTHER}) for a, d in enumerate(DIMENSIONS)}
    folded = [F.when(F.col(d).isin(kept[d]), F.col(d)).otherwise(OTHER) for d in DIMENSIONS]
    weight = F.col("share") / F.col("tokens")
    small = F.broadcast(cells.select(F.struct(*DIMENSIONS).alias("cell"), weight.alias("weight"), "probability"))
    return (rows.withColumn("cell", F.struct(*[c.alias(d) for c, d in zip(folded, DIMENSIONS, strict=True)]))
            .join(small, "cell").withColumn("keep", F.col("u") < F.col("probability")))


def decide(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None,
           budget_share: float = BUDGET_SHARE, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Every document's levels, tokens, token weight, probability and decision."""
    return _decided(docs, targets, budget_share, max_levels).select(
        "row.doc_id", *DIMENSIONS, "n_tokens", "weight", "probability", "keep")


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None,
        budget_share: float = BUDGET_SHARE, max_levels: int = MAX_LEVELS) -> DataFrame:
    """The documents that stay, with all their columns."""
    return _decided(docs, targets, budget_share, max_levels).where("keep").select("row.*")
