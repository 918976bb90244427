"""Many logistic regressions at once: one pass over the rows per Newton step.

A stepwise selection compares sets of features that differ in one, on several folds. Instead of a fit
for each, every task adds up the gradient and Hessian of all (set, fold) pairs over its batches, one
aggregate puts the tasks together, and the driver solves the small systems. The model is that of
`models.fit_logistic`: standardised features, class weights n / (2 n_class), penalty 1 / (C n) per row
on the coefficients alone. Features must be known; fill missing values first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

c = F.col
# Newton steps at most, the step that counts as none, and rows that are held as a matrix at a time.
STEPS = 30
TOLERANCE = 1e-9
BLOCK = 2_048
MODEL_SUMS = "model int, place int, total double"
# Rows of a score range that is ranked alone, rows that tell the ranges' cuts, and scores a task holds at a time.
RANGE_ROWS = 200_000
DRAWN = 4_096
HELD = 4_000_000


@dataclass
class Fold:
    """Statistics of the rows outside a fold."""

    n: float
    bads: float
    mean: np.ndarray
    scale: np.ndarray

    def weights(self, y: np.ndarray) -> np.ndarray:
        return np.where(y == 1, self.n / (2 * self.bads), self.n / (2 * (self.n - self.bads)))


@dataclass
class Fit:
    """One model: columns of its features, the fold it hasn't seen, coefficients and intercept."""

    columns: list[int]
    fold: int
    beta: np.ndarray

    def linear(self, x: np.ndarray, fold: Fold) -> np.ndarray:
        return ((x - fold.mean) / fold.scale)[:, self.columns] @ self.beta[:-1] + self.beta[-1]


def fold_statistics(df: DataFrame, features: list[str], target: str, folds: list[int]) -> dict[int, Fold]:
    """Statistics outside each fold, from one aggregate by fold."""
    number = lambda f: c(f).cast("double")
    rows = df.groupBy("fold").agg(
        F.count("*").alias("n"),
        F.sum(c(target).cast("double")).alias("bads"),
        F.array(*[F.avg(number(f)) for f in features]).alias("mean"),
        F.array(*[F.var_pop(number(f)) for f in features]).alias("variance"),
    ).collect()
    out = {}
    for k in folds:
        kept = [r for r in rows if r["fold"] != k]
        n = float(sum(r["n"] for r in kept))
        mean = sum(r["n"] * np.array(r["mean"], float) for r in kept) / n
        spread = sum(r["n"] * (np.array(r["variance"], float) + (np.array(r["mean"], float) - mean) ** 2) for r in kept)
        scale = np.sqrt(spread / max(n - 1, 1))
        out[k] = Fold(n, float(sum(r["bads"] for r in kept)), mean, np.where(scale > 0, scale, 1.0))
    return out


def _matrices(batches, features: int):
    """(x, target, fold) of blocks of rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            some = batch.slice(at, BLOCK)
            values = [v.to_numpy(zero_copy_only=False) for v in some.columns]
            yield np.column_stack(values[:features]), values[features], values[features + 1]


def _columns(df: DataFrame, features: list[str], target: str) -> DataFrame:
    return df.select(*[c(f).cast("double") for f in features], c(target).cast("double"), c("fold").cast("int"))


def _sums(df: DataFrame, features: list[str], target: str, fits: list[Fit], folds: dict[int, Fold]) -> list[np.ndarray]:
    """Loss, gradient and Hessian of each model at its coefficients, one after another."""

    def added(batches):
        totals = [np.zeros(1 + len(m.beta) + len(m.beta) ** 2) for m in fits]
        for x, y, fold in _matrices(batches, len(features)):
            for k in {m.fold for m in fits}:
                inside = fold != k
                if not inside.any():
                    continue
                own, rows = folds[k], y[inside]
                # a feature is a row of this matrix, so that a model's are taken in whole stretches
                scaled = np.vstack([((x[inside] - own.mean) / own.scale).T, np.ones(len(rows))])
                w = own.weights(rows)
                for total, m in zip(totals, fits):
                    if m.fold != k:
                        continue
                    part = scaled[[*m.columns, -1]]
                    z = m.beta @ part
                    e = np.exp(-np.abs(z))
                    p = np.where(z >= 0, 1.0, e) / (1 + e)
                    size = len(m.beta)
                    total[0] += w @ (np.maximum(z, 0) + np.log1p(e) - rows * z)
                    total[1 : 1 + size] += part @ (w * (p - rows))
                    total[1 + size :] += ((part * (w * p * (1 - p))) @ part.T).ravel()
        model = np.repeat(np.arange(len(fits), dtype=np.int32), [len(t) for t in totals])
        place = np.concatenate([np.arange(len(t), dtype=np.int32) for t in totals])
        yield pa.RecordBatch.from_arrays([pa.array(model), pa.array(place), pa.array(np.concatenate(totals))], ["model", "place", "total"])

    rows = _columns(df, features, target).mapInArrow(added, MODEL_SUMS)
    found = rows.groupBy("model", "place").agg(F.sum("total").alias("total")).toArrow()
    model, place, total = (found.column(k).to_numpy() for k in ("model", "place", "total"))
    order = np.lexsort((place, model))
    return np.split(total[order], np.cumsum(np.bincount(model[order], minlength=len(fits)))[:-1])


def fit_many(
    df: DataFrame,
    features: list[str],
    sets: list[list[str]],
    target: str = "target",
    folds: list[int] = (-1,),
    inverse_penalty: float = 1.0,
    known: dict[int, Fold] | None = None,
    start: dict[str, float] | None = None,
) -> tuple[list[Fit], dict[int, Fold]]:
    """A fit for every set of features and fold left out (-1 leaves out none); df has `fold`.

    As many jobs as Newton steps, whatever the number of models. A step that makes the loss larger
    is halved. start: coefficients to begin with by feature, and the intercept's under "".
    """
    known = known or fold_statistics(df, features, target, list(folds))
    at = {f: k for k, f in enumerate(features)}
    begin = start or {}
    fits = [Fit([at[f] for f in s], k, np.array([begin.get(f, 0.0) for f in [*s, ""]])) for s in sets for k in folds]
    last = [np.inf] * len(fits)
    steps = [np.zeros(len(m.beta)) for m in fits]
    open_ = list(range(len(fits)))
    for _ in range(STEPS):
        if not open_:
            break
        sums = _sums(df, features, target, [fits[i] for i in open_], known)
        still = []
        for i, total in zip(open_, sums):
            m, size, n = fits[i], len(fits[i].beta), known[fits[i].fold].n
            penalty = np.append(np.full(size - 1, 1.0 / inverse_penalty), 0.0)  # n times 1 / (C n)
            loss = total[0] + (penalty * m.beta**2).sum() / 2
            if loss > last[i] + 1e-12 * n:
                steps[i] = steps[i] / 2
                m.beta = m.beta - steps[i]
            else:
                last[i] = loss
                gradient = total[1 : 1 + size] + penalty * m.beta
                hessian = total[1 + size :].reshape(size, size) + np.diag(penalty)
                steps[i] = -np.linalg.lstsq(hessian, gradient, rcond=None)[0]
                m.beta = m.beta + steps[i]
            if np.abs(steps[i]).max() > TOLERANCE:
                still.append(i)
        open_ = still
    return fits, known


def held_out_scores(
    df: DataFrame, features: list[str], fits: list[Fit], folds: dict[int, Fold], sets: list[int], target: str = "target"
) -> DataFrame:
    """set, fold, target, score: every row's probability under the models that haven't seen its fold.

    sets: the number of each fit's set. A fit of fold -1 scores all rows, as fold -1.
    """

    def scored(batches):
        for x, y, fold in _matrices(batches, len(features)):
            for number, m in zip(sets, fits):
                inside = np.ones(len(y), bool) if m.fold < 0 else fold == m.fold
                if inside.any():
                    p = 1 / (1 + np.exp(-np.clip(m.linear(x[inside], folds[m.fold]), -700, 700)))
                    whole = np.full(inside.sum(), 1, np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(whole * number), pa.array(whole * m.fold), pa.array(y[inside]), pa.array(p)],
                        ["set", "fold", target, "score"],
                    )

    return _columns(df, features, target).mapInArrow(scored, f"set int, fold int, {target} double, score double")


def _levels(scores: np.ndarray, n: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct scores in ascending order with their numbers of rows and of bads."""
    order = np.argsort(scores, kind="stable")
    scores = scores[order]
    first = np.flatnonzero(np.append(True, scores[1:] != scores[:-1]))
    return scores[first], np.add.reduceat(n[order], first), np.add.reduceat(bad[order], first)


def held_out_aucs(
    df: DataFrame, features: list[str], fits: list[Fit], folds: dict[int, Fold], sets: list[int], drawn: np.ndarray,
    rows: float, target: str = "target", range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """set, fold, auc: the exact AUC of what `held_out_scores` gives, NULL for a single class.

    A task sends its distinct scores with their counts as one array for each model and range of scores; a
    range is ranked alone, and range totals put the ranges together. `drawn` (rows of `draw`) tells the cuts
    of the about `rows` / `range_rows` ranges; the result is the same for any cuts.
    """
    share = np.arange(1, int(np.ceil(rows / range_rows))) / np.ceil(rows / range_rows)
    probability = lambda z: 1 / (1 + np.exp(-np.clip(z, -700, 700)))
    cuts = [
        np.unique(np.quantile(probability(m.linear(drawn, folds[m.fold])), share)) if len(drawn) else np.zeros(0) for m in fits
    ]
    lists = ["scores", "ns", "bads"]

    def sent(held):
        """A row for each model and range of the blocks held."""
        for number, m, cut, blocks in zip(sets, fits, cuts, held):
            if not blocks:
                continue
            scores, y = (np.concatenate(v) for v in zip(*blocks))
            scores, n, bad = _levels(scores, np.ones(len(y), np.int64), y.astype(np.int64))
            ends = np.append(np.searchsorted(scores, cut, side="right"), len(scores))
            offsets = pa.array(np.append(0, ends), pa.int32())
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (scores, n, bad)]
            k = len(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, number, np.int32)), pa.array(np.full(k, m.fold, np.int32)), pa.array(np.arange(k, dtype=np.int32)), *arrays],
                ["set", "fold", "part", *lists],
            )

    def collapsed(batches):
        held, size = [[] for _ in fits], 0
        for x, y, fold in _matrices(batches, len(features)):
            for blocks, m in zip(held, fits):
                inside = slice(None) if m.fold < 0 else fold == m.fold
                scores = probability(m.linear(x[inside], folds[m.fold]))
                if len(scores):
                    blocks.append((scores, y[inside]))
                    size += len(scores)
            if size > HELD:
                yield from sent(held)
                held, size = [[] for _ in fits], 0
        yield from sent(held)

    def one_range(group: pa.Table) -> pa.Table:
        scores, n, bad = _levels(*(group.column(v).combine_chunks().flatten().to_numpy() for v in lists))
        good = (n - bad).astype(float)
        won = bad @ (np.cumsum(good) - good / 2)
        sums = {"won": [float(won)], "bad": [float(bad.sum())], "good": [good.sum()]}
        return pa.table({**{k: group.column(k).slice(0, 1) for k in ("set", "fold", "part")}, **sums})

    known = df.where(c(target).isNotNull())
    made = _columns(known, features, target).mapInArrow(
        collapsed, "set int, fold int, part int, scores array<double>, ns array<bigint>, bads array<bigint>"
    )
    made = made.where(F.size("scores") > 0)
    ranges = made.groupBy("set", "fold", "part").applyInArrow(one_range, "set int, fold int, part int, won double, bad double, good double")
    below = Window.partitionBy("set", "fold").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    pairs = ranges.withColumn("won", c("won") + c("bad") * F.coalesce(F.sum("good").over(below), F.lit(0.0)))
    totals = pairs.groupBy("set", "fold").agg(*[F.sum(x).alias(x) for x in ("won", "bad", "good")])
    both = (c("bad") > 0) & (c("good") > 0)
    return totals.select("set", "fold", F.when(both, c("won") / (c("bad") * c("good"))).alias("auc"))


def draw(df: DataFrame, features: list[str], rows: float) -> np.ndarray:
    """About DRAWN rows' features, or 16 for each range if these are more."""
    wanted = max(DRAWN, 16 * rows / RANGE_ROWS)
    some = df.sample(min(1.0, wanted / max(rows, 1)), seed=42).select(*[c(f).cast("double") for f in features])
    found = some.toArrow()
    return np.column_stack([v.to_numpy() for v in found.columns])
