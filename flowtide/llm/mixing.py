"""Operator 6, mixing sources to target weights.

Token counts are summed over cells of source, language and topic. Iterative proportional fitting rakes the
cells until their sums match the target marginals; each document is then sampled with a probability that is
in proportion to its cell's weight, calibrated so that the expected number of tokens kept is `budget` times
all tokens, with no probability over 1 (what a full cell can't give is asked of the others). As full cells move the mix off its
target, the share of the expected tokens that each level really gets is reported beside the target.

`tokens` is any column of weights: a word count, or the counts of operator 1. Levels that a marginal doesn't name share one level, OTHER,
and what the named ones leave of the mass; so the cells number at most the product of the marginals' lengths plus one each, which
bounds what the driver rakes. Levels without tokens are left out and the others scaled up.

The table is written once with its levels and tokens, so that costly expressions are computed once, and read back to be
sampled; columns in `without` are left out of it.

Defined cases: a null level is OTHER. A text without tokens (null too) has weight like its cell and is
sampled like the rest; in a cell without any token the probability is the budget. Sampling hashes the seed,
doc_id and text, so repeated rows share their fate. An empty table gives an empty result. Columns are kept, but one called like the
output is replaced; those that begin with "__mx_" are taken.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

OTHER = "(other)"
ROUNDS, CLOSE = 500, 1e-10


@dataclass(frozen=True)
class Marginal:
    """A column (or expression) and the target share of each level."""

    name: str
    column: Column
    shares: dict[str, float]

    def level(self) -> Column:
        text = self.column.cast("string")
        return F.when(text.isin(list(self.shares)), text).otherwise(F.lit(OTHER))

    def target(self, level: str) -> float:
        return self.shares[level] if level != OTHER else max(0.0, 1 - sum(self.shares.values()))


def rake(cells: dict[tuple, int], marginals: list[Marginal]) -> dict[tuple, float]:
    """Cell tokens to the factor each is raised by, so that factor times tokens has the target marginals and the same sum."""
    full = {k: float(n) for k, n in cells.items() if n > 0}
    if not full:
        return {}
    keys = sorted(full)
    tokens = np.array([full[k] for k in keys])
    total, factor = tokens.sum(), np.ones(len(keys))
    index, want = [], []
    for d, m in enumerate(marginals):
        levels = sorted({k[d] for k in keys})
        t = np.array([m.target(x) for x in levels])
        want.append(t / t.sum() * total if t.sum() else np.full(len(t), total / len(t)))
        index.append(np.array([levels.index(k[d]) for k in keys]))
    for _ in range(ROUNDS):
        off = 0.0
        for i, t in zip(index, want):
            now = np.bincount(i, factor * tokens, len(t))
            ratio = np.divide(t, now, out=np.zeros_like(t), where=now > 0)
            off = max(off, np.abs(now - t).max() / total)
            factor = factor * ratio[i]
        if off < CLOSE:
            break
    return dict(zip(keys, factor.tolist()))


def calibrate(cells: dict[tuple, int], factor: dict[tuple, float], budget: float) -> dict[tuple, float]:
    """Sampling probabilities in proportion to the factors, at most 1, whose expected tokens are the budget's share of all."""
    total = sum(cells.values())
    full: set[tuple] = set()
    p = {k: budget for k in cells}
    while factor:
        free = {k: f for k, f in factor.items() if k not in full and f > 0}
        left = budget * total - sum(cells[k] for k in full)
        mass = sum(f * cells[k] for k, f in free.items())
        scale = left / mass if mass else 0.0
        over = {k for k, f in free.items() if f * scale > 1}
        p |= {k: 1.0 for k in full} | {k: f * scale for k, f in factor.items() if k not in full}
        if not over:
            break
        full |= over
    return p


def reached(cells: dict[tuple, int], p: dict[tuple, float], dim: int) -> dict[str, float]:
    """The share of the expected tokens that each level of one marginal gets."""
    total = sum(p[k] * n for k, n in cells.items())
    out: dict[str, float] = {}
    for k, n in cells.items():
        out[k[dim]] = out.get(k[dim], 0.0) + (p[k] * n / total if total else 0.0)
    return out


def mix(docs: DataFrame, marginals: list[Marginal], budget: float, tokens: Column, seed: int = 0, doc_id: str = "doc_id", text: str = "text", out: str = "mixing", without: tuple[str, ...] = ()) -> DataFrame:
    """docs with the struct `out` added: for each marginal its level, and the level's reached share as reached_<name>; n_tokens, weight, p, kept."""
    spark = docs.sparkSession
    names = [f"__mx_{i}" for i in range(len(marginals))]
    u = (F.shiftright(F.xxhash64(F.lit(seed), doc_id, text), 11) + F.lit(2.0**52)) / F.lit(2.0**53)
    added = {n: m.level() for n, m in zip(names, marginals)} | {"__mx_n": F.coalesce(tokens.cast("long"), F.lit(0).cast("long")), "__mx_u": u}
    d = stash(docs.withColumns(added).drop(*without), "weighed")
    cells = {tuple(r)[:-1]: r[-1] or 0 for r in d.groupBy(*names).agg(F.sum("__mx_n")).collect()}  # at most the product of the marginals' lengths plus one
    factor = rake(cells, marginals)
    p = calibrate(cells, factor, budget)
    shares = [reached(cells, p, i) for i in range(len(marginals))]
    rows = [(*k, factor.get(k, 1.0), p[k], *(s[x] for s, x in zip(shares, k))) for k in sorted(cells)]
    got = [f"__mx_r{i}" for i in range(len(marginals))]
    schema = ", ".join([f"{n} string" for n in names] + ["__mx_w double", "__mx_p double"] + [f"{g} double" for g in got])
    d = d.join(F.broadcast(spark.createDataFrame(rows, schema)), names, "left")  # a row a cell
    fields = [F.col(n).alias(m.name) for n, m in zip(names, marginals)] + [F.col(g).alias(f"reached_{m.name}") for g, m in zip(got, marginals)]
    result = F.struct(*fields, F.col("__mx_n").alias("n_tokens"), F.col("__mx_w").alias("weight"), F.col("__mx_p").alias("p"), (F.col("__mx_u") < F.col("__mx_p")).alias("kept"))
    return d.withColumn(out, result).drop(*names, *got, "__mx_n", "__mx_u", "__mx_w", "__mx_p")
