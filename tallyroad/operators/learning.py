"""Learning operators: functional mixture clustering, forests, inclusion and attribute models.

The mixture is fitted by EM on distributed moments: each pass over the rows returns, for
each cluster, the weight, the weighted sum and the weighted cross products of the vectors,
whose size does not depend on the number of rows; the small steps run on those. One pass
serves all starts, models and seeds that are being fitted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import product
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroad.sources.scratch import materialize

#: Spline functions and weights of the profile blocks (day, week, year), and the weight of spectral features.
BASES = {"day": (24, 12, 1.25), "week": (168, 18, 2.5), "year": (52, 6, 1.5)}
SPECTRAL_WEIGHT = 0.75
#: Rows that a partial sum covers, most partial sums of a pass, and rows (of least hash) that starts are chosen from.
BLOCK_ROWS, MOST_BLOCKS, START_ROWS = 4096, 4096, 2000
#: Starts of each fit; the likeliest end counts.
STARTS = 3
MODELS = ("DkBk", "DkB", "DBk", "DB", "AkjBk", "AkjB", "AkBk", "AkB", "AjBk", "AjB", "ABk", "AB")


# ---- splines


def spline_values(x: np.ndarray, n_basis: int, degree: int = 3) -> np.ndarray:
    """(len(x), n_basis) values of the clamped uniform B-splines on [0, 1]."""
    inner = np.linspace(0, 1, n_basis - degree + 1)
    knots = np.concatenate([np.zeros(degree), inner, np.ones(degree)])
    x = np.clip(np.asarray(x, float), 0, 1)
    # the last span is closed on the right
    span = np.clip(np.searchsorted(knots, x, "right") - 1, degree, n_basis - 1)
    out = np.zeros((len(x), len(knots) - 1))
    out[np.arange(len(x)), span] = 1.0
    for d in range(1, degree + 1):
        new = np.zeros_like(out)
        for i in range(len(knots) - 1 - d):
            left, right = knots[i + d] - knots[i], knots[i + d + 1] - knots[i + 1]
            if left > 0:
                new[:, i] += (x - knots[i]) / left * out[:, i]
            if right > 0:
                new[:, i] += (knots[i + d + 1] - x) / right * out[:, i + 1]
        out = new
    return out[:, :n_basis]


def smoother(n_points: int, n_basis: int) -> np.ndarray:
    """(n_basis, n_points) least-squares projection of equally spaced samples."""
    return np.linalg.pinv(spline_values(np.linspace(0, 1, n_points), n_basis))


def gram(n_basis: int, degree: int = 3) -> np.ndarray:
    """Inner products of the basis, exact by Gauss-Legendre nodes in every knot span."""
    nodes, weights = np.polynomial.legendre.leggauss(degree + 1)
    edges = np.linspace(0, 1, n_basis - degree + 1)
    out = np.zeros((n_basis, n_basis))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        v = spline_values((b - a) / 2 * nodes + (a + b) / 2, n_basis)
        out += (v * (weights * (b - a) / 2)[:, None]).T @ v
    return out


def representation(profiles: DataFrame, blocks: tuple[str, ...] = ("day", "week", "year", "spectral")) -> tuple[DataFrame, np.ndarray]:
    """(site, coefs) with unit-norm blocks smoothed by splines, weighted and standardised over the batch, and the metric of the blocks."""
    parts, metric = [], []
    for b in blocks:
        if b == "spectral":
            parts.append((b, np.eye(5), SPECTRAL_WEIGHT))
            metric.append(np.eye(5))
        else:
            n, k, weight = BASES[b]
            parts.append((b, smoother(n, k), weight / np.sqrt(k)))
            metric.append(gram(k))
    width = sum(m.shape[0] for m in metric)
    w = np.zeros((width, width))
    at = 0
    for m in metric:
        w[at : at + len(m), at : at + len(m)] = m
        at += len(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = []
            for i, (b, m, weight) in enumerate(parts):
                x = np.array(batch.column(i + 1).to_pylist(), float)
                if b != "spectral":
                    norm = np.linalg.norm(x, axis=1, keepdims=True)
                    x = x / np.where(norm > 1e-12, norm, 1.0)
                cols.append(x @ m.T * weight)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.hstack(cols).tolist(), pa.list_(pa.float64()))], names=["site", "coefs"])

    raw = profiles.select("site", *blocks).mapInArrow(run, "site long, coefs array<double>")
    stats = raw.select(F.posexplode("coefs").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("i").collect()  # a row a coefficient
    mean, dev = F.array(*[F.lit(float(r["m"])) for r in stats]), F.array(*[F.lit(float(r["s"]) if r["s"] and r["s"] > 1e-12 else 1.0) for r in stats])
    return raw.select("site", F.zip_with(F.zip_with("coefs", mean, lambda x, m: x - m), dev, lambda x, s: x / s).alias("coefs")), w


# ---- functional mixture


@dataclass
class Mixture:
    """Fitted mixture: means, proportions, discriminant basis and covariances, with its criteria."""

    model: str
    means: np.ndarray
    shares: np.ndarray
    basis: np.ndarray
    inner: list[np.ndarray]
    noise: np.ndarray
    loglik: float = float("-inf")
    bic: float = float("-inf")
    aic: float = float("-inf")
    icl: float = float("-inf")

    def log_densities(self, y: np.ndarray) -> np.ndarray:
        p, d = y.shape[1], self.basis.shape[1]
        out = np.empty((len(y), len(self.means)))
        for k, mean in enumerate(self.means):
            c = y - mean
            z = c @ self.basis
            rest = c - z @ self.basis.T
            b = max(self.noise[k], 1e-12)
            # a covariance of few rows may be singular, or not quite positive by rounding
            values, vectors = np.linalg.eigh((self.inner[k] + self.inner[k].T) / 2)
            values = np.maximum(values, 1e-9 * max(1.0, float(values.max())))
            quad = ((z @ vectors) ** 2 / values).sum(axis=1)
            out[:, k] = -0.5 * (quad + (rest**2).sum(axis=1) / b + (p - d) * np.log(b) + np.log(values).sum() - 2 * np.log(max(self.shares[k], 1e-12)) + p * np.log(2 * np.pi))
        return out


def n_parameters(model: str, k: int, p: int) -> float:
    """Free parameters: proportions, means, orientation, inner covariances and noise."""
    common = (k - 1) + k * (k - 1) + (k - 1) * (p - k / 2)
    inner = {"Dk": k * k * (k - 1) // 2, "D": k * (k - 1) // 2, "Akj": k * (k - 1), "Ak": k, "Aj": k - 1, "A": 1}
    head, noise = model[: model.index("B")], k if model.endswith("Bk") else 1
    # the common isotropic model with own noise counts k for its inner part
    return common + (k if model == "ABk" else inner[head]) + (1 if model == "ABk" else noise)


def _blocks(rows: DataFrame) -> DataFrame:
    """(block, site, coefs) written in blocks of about BLOCK_ROWS by a hash of the site, in order of site: sums never depend on the machine's cores."""
    flat = materialize(rows.select("site", "coefs"), "mixture-rows")
    blocks = max(1, min(MOST_BLOCKS, -(-flat.count() // BLOCK_ROWS)))
    placed = flat.select(F.pmod(F.xxhash64("site"), F.lit(blocks)).cast("int").alias("block"), "site", "coefs")
    return materialize(placed.repartition(blocks, "block").sortWithinPartitions("block", "site"), "mixture-blocks")


def _moments(table: DataFrame, weighers: list, sizes: list[int], p: int) -> list[tuple]:
    """(weights, sums, cross products, log-likelihood, entropy) over all rows for each weigher; a row of numbers for each block, added in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            block, site, y = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), np.array(batch.column(2).to_pylist(), float)
            cuts = np.flatnonzero(np.diff(block, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(block)], strict=True):
                part, values = y[a:b], []
                for weigh in weighers:
                    t, loglik = weigh(part)
                    values += [t.sum(axis=0), (t.T @ part).ravel(), np.einsum("nk,ni,nj->kij", t, part, part).ravel(), [loglik, -float((t * np.log(np.clip(t, 1e-6, None))).sum())]]
                yield pa.RecordBatch.from_pydict({"block": pa.array([block[a]], pa.int32()), "first": pa.array([int(site[a])], pa.int64()), "v": pa.array([np.concatenate(values).tolist()], pa.list_(pa.float64()))})

    flat = np.zeros(sum(k + k * p + k * p * p + 2 for k in sizes))
    for r in table.mapInArrow(run, "block int, first long, v array<double>").orderBy("block", "first").toLocalIterator():
        flat += np.array(r["v"])
    out, at = [], 0
    for k in sizes:
        n, s1, s2, rest = np.split(flat[at : at + k + k * p + k * p * p + 2], np.cumsum([k, k * p, k * p * p]))
        out.append((n, s1.reshape(k, p), s2.reshape(k, p, p), float(rest[0]), float(rest[1])))
        at += k + k * p + k * p * p + 2
    return out


def start_centres(y: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """k centres: spread first choices (each by its squared distance to those before) and Lloyd rounds; a cluster that empties moves to the farthest row."""
    rng = np.random.default_rng(seed)
    centres = y[[rng.integers(len(y))]]
    while len(centres) < k:
        gap = ((y[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1)
        total = gap.sum()
        centres = np.vstack([centres, y[min(int(np.searchsorted(np.cumsum(gap), rng.random() * total, "right")), len(y) - 1) if total > 0 else rng.integers(len(y))]])
    for _ in range(rounds):
        gap = ((y[:, None] - centres[None]) ** 2).sum(axis=2)
        own = gap.argmin(axis=1)
        for c in range(k):
            if not (own == c).any():
                own[gap.min(axis=1).argmax()] = c
        centres = np.stack([y[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(k)])
    return centres


def _steps(n: np.ndarray, s1: np.ndarray, s2: np.ndarray, metric: np.ndarray, model: str) -> Mixture:
    """Discriminant subspace and parameters from moments."""
    if n.min() <= 1:
        raise ValueError("a cluster is almost empty")
    k, p = s1.shape
    d, total = k - 1, n.sum()
    yy = s2.sum(axis=0)
    between = (s1 / np.sqrt(n)[:, None]).T @ (s1 / np.sqrt(n)[:, None])
    try:
        m = np.linalg.solve(yy @ metric, between @ metric)
    except np.linalg.LinAlgError:
        m = np.linalg.pinv(yy @ metric) @ between @ metric
    basis = np.linalg.svd(m)[0][:, :d]
    turned = metric @ basis
    mean = s1.sum(axis=0) / total
    overall = (yy - total * np.outer(mean, mean)) / (total - 1)
    inner, noise = [], np.zeros(k)
    for c in range(k):
        mu = s1[c] / n[c]
        own = (s2[c] - n[c] * np.outer(mu, mu)) / max(n[c] - 1, 1)
        used = own if model[:2] in ("Dk", "Ak") else overall
        inside = turned.T @ used @ turned
        head = model[: model.index("B")]
        if head in ("Akj", "Aj"):
            inside = np.diag(np.diag(inside))
        elif head in ("Ak", "A"):
            inside = np.eye(d) * np.trace(inside) / d
        spread = own if model.endswith("Bk") else overall
        b = (np.trace(spread) - np.trace(turned.T @ spread @ turned)) / (p - d)
        inner.append(inside)
        noise[c] = b if b > 0 else 0.001
    return Mixture(model, s1 / n[:, None], n / total, basis, inner, noise)


def _posterior(mixture: Mixture, y: np.ndarray) -> tuple[np.ndarray, float]:
    a = mixture.log_densities(y)
    top = a.max(axis=1, keepdims=True)
    e = np.exp(a - top)
    return e / e.sum(axis=1, keepdims=True), float((np.log(e.sum(axis=1)) + top[:, 0]).sum())


def _nearest(centres: np.ndarray):
    def weigh(y: np.ndarray) -> tuple[np.ndarray, float]:
        t = np.zeros((len(y), len(centres)))
        t[np.arange(len(y)), ((y[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)] = 1.0
        return t, 0.0

    return weigh


def _filled(n: np.ndarray, s1: np.ndarray, s2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moments of a first partition, mixed with the even one as far as a cluster of less than two rows needs it."""
    k, total = len(n), n.sum()
    lack = max(0.0, 2.0 - n.min())
    e = min(1.0, lack / max(total / k - n.min(), 1e-9)) if lack else 0.0
    return (1 - e) * n + e * total / k, (1 - e) * s1 + e * s1.sum(axis=0) / k, (1 - e) * s2 + e * s2.sum(axis=0) / k


def fit_mixtures(rows: DataFrame, metric: np.ndarray, wanted: list[tuple[int, str, int]], maxit: int = 50, eps: float = 1e-6, starts: int = STARTS) -> list[Mixture]:
    """EM for each (k, model, seed), all in the same passes over the rows; of a fit's starts the likeliest.

    A start is a partition by the nearest of k centres that are chosen from START_ROWS rows. A step that would
    leave a cluster almost empty (a weight of one row or less) ends its start at the step before. Fewer than
    two rows a cluster are an error.
    """
    if any(model not in MODELS or k < 2 for k, model, _ in wanted):
        raise ValueError(f"model must be one of {MODELS} and k at least 2")
    table, p = _blocks(rows), len(metric)
    y = np.array([r["coefs"] for r in table.orderBy(F.xxhash64("site", F.lit(0)), "site").limit(START_ROWS).collect()], float)
    if len(y) < 2 * max(k for k, _, _ in wanted):
        raise ValueError("fewer than two rows a cluster")
    tries = [(w, *one, start) for w, one in enumerate(wanted) for start in range(starts)]
    # models of one k and seed begin alike
    begun = {(k, seed, start): _nearest(start_centres(y, k, 1000 * seed + start)) for _, k, _, seed, start in tries}
    first = dict(zip(begun, _moments(table, list(begun.values()), [k for k, _, _ in begun], p), strict=True))
    fits = [_steps(*_filled(*first[k, seed, start][:3]), metric, model) for _, k, model, seed, start in tries]
    entropy, before, live = [0.0] * len(tries), [float("-inf")] * len(tries), list(range(len(tries)))
    for turn in range(maxit):
        found = _moments(table, [partial(_posterior, fits[i]) for i in live], [tries[i][1] for i in live], p)
        more = []
        for i, (n, s1, s2, loglik, spread) in zip(live, found, strict=True):
            if not np.isfinite(loglik):
                continue
            fits[i].loglik, entropy[i] = loglik, spread
            if n.min() <= 1 or turn + 1 == maxit or abs(loglik - before[i]) < eps * abs(loglik):
                continue
            new = _steps(n, s1, s2, metric, tries[i][2])
            new.loglik = loglik
            fits[i], before[i] = new, loglik
            more.append(i)
        live = more
        if not live:
            break
    total = table.count()
    for (_, k, model, _, _), m, e in zip(tries, fits, entropy, strict=True):
        q = n_parameters(model, k, p)
        m.aic, m.bic = m.loglik - q, m.loglik - 0.5 * q * np.log(total)
        m.icl = m.bic - e
    return [max((m for t, m in zip(tries, fits, strict=True) if t[0] == w), key=lambda m: m.loglik) for w in range(len(wanted))]


def fit_mixture(rows: DataFrame, metric: np.ndarray, k: int, model: str = "AkBk", seed: int = 42, maxit: int = 50, eps: float = 1e-6, starts: int = STARTS) -> Mixture:
    return fit_mixtures(rows, metric, [(k, model, seed)], maxit, eps, starts)[0]


def assign(rows: DataFrame, mixture: Mixture) -> DataFrame:
    """(site, cluster, probability) of the likeliest cluster."""
    shared = rows.sparkSession.sparkContext.broadcast(mixture)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                t, _ = _posterior(shared.value, np.array(batch.column(1).to_pylist(), float))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(t.argmax(axis=1).astype(np.int32)), pa.array(t.max(axis=1))], names=["site", "cluster", "probability"])

    return rows.select("site", "coefs").mapInArrow(run, "site long, cluster int, probability double")


def search(rows: DataFrame, metric: np.ndarray, ks: tuple[int, ...], models: tuple[str, ...], seeds: tuple[int, ...], criterion: str = "bic", maxit: int = 20, refit: int = 0, refit_maxit: int = 50) -> list[dict]:
    """Every (k, model, seed) with its criteria, best first; the best ``refit`` are fitted again with more steps before the last ranking."""
    plain = lambda one, m: dict(zip(("k", "model", "seed"), one, strict=True)) | {c: float(getattr(m, c)) for c in ("loglik", "bic", "aic", "icl")}
    rank = lambda found: sorted(found, key=lambda x: (-x[criterion], x["k"], x["model"], x["seed"]))
    wanted = [(k, model, seed) for k in ks for model in models for seed in seeds]
    found = rank([plain(one, m) for one, m in zip(wanted, fit_mixtures(rows, metric, wanted, maxit), strict=True)])
    if refit:
        best = [(x["k"], x["model"], x["seed"]) for x in found[:refit]]
        found = rank([plain(one, m) for one, m in zip(best, fit_mixtures(rows, metric, best, refit_maxit), strict=True)] + found[refit:])
    return found


# ---- forests


def one_hot(df: DataFrame, column: str, values: list[str]) -> tuple[DataFrame, list[str]]:
    """Fixed columns for known values; unseen ones are zero everywhere."""
    names = [f"{column}_{i}" for i in range(len(values))]
    return df.select("*", *[F.coalesce((F.col(column) == v).cast("double"), F.lit(0.0)).alias(n) for n, v in zip(names, values, strict=True)]), names


def balanced_weight(label: str, weight: Column) -> Column:
    """Weight times n / (classes * rows of the class)."""
    w = Window.partitionBy(label)
    return weight * F.lit(1.0) / F.count(F.lit(1)).over(w)


def group_folds(df: DataFrame, group: str, folds: int = 5) -> DataFrame:
    """Fold by group, so that a group is never in two folds."""
    return df.withColumn("fold", F.pmod(F.xxhash64(group), F.lit(folds)).cast("int"))


def fit_forest(df: DataFrame, features: list[str], label: str, weight: str, trees: int = 60, leaf: int = 8, seed: int = 42, depth: int = 8):
    """Weighted random forest with a label index; classes that are rare are the caller's to drop."""
    stages = [StringIndexer(inputCol=label, outputCol="__label", handleInvalid="skip", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=features, outputCol="__x", handleInvalid="skip"), RandomForestClassifier(labelCol="__label", featuresCol="__x", weightCol=weight, numTrees=trees, minInstancesPerNode=leaf, maxDepth=depth, seed=seed)]
    return Pipeline(stages=stages).fit(df)


#: The space that random searches draw from.
FOREST_SPACE = {"maxDepth": (5, 7, 10, 12, 15), "minInstancesPerNode": (5, 8, 12, 18, 25), "featureSubsetStrategy": ("sqrt", "log2", "0.5")}
SEARCH_DRAWS, SEARCH_FOLDS = 40, 5


class BalancedAccuracy(Evaluator):
    """Mean over the classes of the share of a class's rows that are predicted right."""

    def __init__(self, label: str):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        right = dataset.groupBy(self.label).agg(F.avg((F.col("prediction") == F.col(self.label)).cast("double")).alias("right"))
        return float(right.agg(F.avg("right")).first()[0] or 0.0)


def drawn_parameters(draws: int = SEARCH_DRAWS, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Distinct parameter sets drawn from a space, all of them if it has no more."""
    space = space or FOREST_SPACE
    every = [dict(zip(space, values, strict=True)) for values in product(*space.values())]
    return [every[i] for i in np.random.default_rng(seed).permutation(len(every))[:draws]]


def tuned_forest(df: DataFrame, features: list[str], label: str, weight: str, tried: list[dict], folds: int = SEARCH_FOLDS, trees: int = 20, parallelism: int = 4):
    """Cross-validated balanced accuracy of every parameter set in ``tried`` under grouped folds given by a column ``fold``."""
    index = StringIndexer(inputCol=label, outputCol="__label", handleInvalid="skip", stringOrderType="alphabetAsc").fit(df)
    ready = VectorAssembler(inputCols=features, outputCol="__x", handleInvalid="skip").transform(index.transform(df)).withColumn("__fold", F.col("fold") % folds)
    ready = materialize(ready.select("__label", "__x", "__fold", weight), "forest-search")
    forest = RandomForestClassifier(labelCol="__label", featuresCol="__x", weightCol=weight, numTrees=trees, seed=42)
    maps = [{forest.getParam(k): v for k, v in one.items()} for one in tried]
    return CrossValidator(estimator=forest, estimatorParamMaps=maps, evaluator=BalancedAccuracy("__label"), numFolds=folds, foldCol="__fold", parallelism=parallelism).fit(ready)


def predict_classes(model, df: DataFrame, keys: list[str], observed: Column) -> DataFrame:
    """Class, probability of each class and whether the row had no observation of its own."""
    labels = model.stages[0].labels
    out = model.transform(df).withColumn("__p", vector_to_array("probability"))
    return out.select(*keys, F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int") + 1).alias("predicted"), *[F.col("__p")[i].alias(f"probability_{x}") for i, x in enumerate(labels)], F.when(observed, 0).otherwise(1).alias("extrapolated"))


def fit_inclusion(df: DataFrame, features: list[str], label: str, keep_negatives: float = 0.25, rounds: int = 10, seed: int = 42):
    """Boosted trees on all positives and a hashed share of negatives, which are weighted back up."""
    kept = df.where((F.col(label) == 1) | (F.pmod(F.xxhash64(*features), F.lit(1000)) < int(1000 * keep_negatives))).withColumn("__w", F.when(F.col(label) == 1, 1.0).otherwise(1.0 / keep_negatives))
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="__x", handleInvalid="skip"), GBTClassifier(labelCol=label, featuresCol="__x", weightCol="__w", maxIter=rounds, maxDepth=4, seed=seed)]).fit(kept)


def best_threshold(scored: DataFrame, label: str, score: str, digits: int = 3) -> DataFrame:
    """Threshold of the best F1: scores are grouped at ``digits`` digits first, so the running sums pass over a bounded table."""
    groups = scored.groupBy(F.round(score, digits).alias("threshold")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("threshold"))
    everywhere = Window.partitionBy(F.lit(0))
    run = groups.select("threshold", F.sum("p").over(w).alias("tp"), F.sum("n").over(w).alias("guessed"), F.sum("p").over(everywhere).alias("positives"))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("guessed") + F.col("positives")), F.lit(0.0))
    return run.select("threshold", "tp", "guessed", "positives", f1.alias("f1")).orderBy(F.desc("f1"), F.desc("threshold")).limit(1)


def score_attributes(models: dict, df: DataFrame, keys: list[str]) -> DataFrame:
    """Predicted value and confidence of every target in one table."""
    out = df
    for name, model in models.items():
        labels = model.stages[0].labels
        out = model.transform(out).withColumn("__p", vector_to_array("probability"))
        out = out.withColumn(f"pred_{name}", F.element_at(F.array(*[F.lit(x) for x in labels]), F.array_position("__p", F.array_max("__p")).cast("int"))).withColumn(f"conf_{name}", F.array_max("__p")).drop("__p", "__x", "__label", "rawPrediction", "probability", "prediction")
    return out.select(*keys, *[c for n in models for c in (f"pred_{n}", f"conf_{n}")])


def fit_attributes(df: DataFrame, features: list[str], targets: list[str], tuned: list[str], tried: list[dict], weight: str, trees: int = 20) -> tuple[dict, dict]:
    """A model for each target, fitted on folds 2 and more: the targets in ``tuned`` try every parameter set and keep the one of least
    log loss on fold 1, the others take the set of the first of them. Returns the models and their parameters."""
    train, validation = df.where("fold >= 2"), df.where("fold = 1")
    models, chosen, shared = {}, {}, None
    for target in targets:
        options = tried if target in tuned or shared is None else [shared]
        fitted = []
        for one in options:
            model = fit_forest(train, features, target, weight, trees, one.get("minInstancesPerNode", 8), depth=one.get("maxDepth", 8))
            loss = 0.0
            if len(options) > 1:
                loss = MulticlassClassificationEvaluator(labelCol="__label", metricName="logLoss").evaluate(model.transform(validation))
            fitted.append((loss, len(fitted), model, one))
        _, _, models[target], chosen[target] = min(fitted, key=lambda f: f[:2])
        shared = shared or chosen[target]
    return models, chosen


def attribute_report(scored: DataFrame, lookups: dict[str, list[str]]) -> list[dict]:
    """Quality of every target on fold 0, beside the most frequent value and the most frequent value of a key in the training folds.

    ``scored`` has each target, pred_<target>, fold and the key columns of ``lookups``. What is collected has a row for each pair of a target's values.
    """
    out = []
    for target, keys in lookups.items():
        test, train = scored.where("fold = 0"), scored.where("fold >= 2")
        pairs = test.groupBy(F.col(target).alias("real"), F.col(f"pred_{target}").alias("guess")).count().collect()
        counts = train.groupBy(target).count().orderBy(F.desc("count"), target).limit(1).collect()
        majority = counts[0][target] if counts else None
        mode = train.groupBy(*keys, F.col(target).alias("v")).count().groupBy(*keys).agg(F.min_by("v", F.struct(-F.col("count"), F.col("v"))).alias("lookup"))
        hits = test.join(mode, keys, "left").agg(F.avg((F.coalesce("lookup", F.lit(majority)) == F.col(target)).cast("double"))).first()[0]
        classes = sorted({r["real"] for r in pairs} | {r["guess"] for r in pairs}, key=str)
        table = np.zeros((len(classes), len(classes)))
        for r in pairs:
            table[classes.index(r["real"]), classes.index(r["guess"])] += r["count"]
        n, real, guess, right = table.sum(), table.sum(axis=1), table.sum(axis=0), np.diag(table)
        recall, precision = right / np.maximum(real, 1), right / np.maximum(guess, 1)
        f1 = np.where(recall + precision > 0, 2 * recall * precision / np.maximum(recall + precision, 1e-300), 0.0)
        chance = float((real * guess).sum() / max(n, 1) ** 2)
        accuracy = float(right.sum() / max(n, 1))
        out.append({
            "target": target, "n_holdout": int(n), "n_train": train.count(), "n_classes": len(classes), "accuracy": accuracy, "balanced_accuracy": float(recall[real > 0].mean()) if n else 0.0,
            "macro_f1": float(f1.mean()) if len(f1) else 0.0, "weighted_f1": float((f1 * real).sum() / max(n, 1)), "cohen_kappa": (accuracy - chance) / (1 - chance) if chance < 1 else 0.0,
            "baseline_majority": float(real[classes.index(majority)] / n) if n and majority in classes else 0.0, "baseline_lookup": float(hits or 0.0),
        })
    return out


# ---- persistence


def save_mixture(mixture: Mixture, folder: str, name: str) -> Path:
    """Parameters and criteria as one JSON file in a directory of its own."""
    path = Path(folder, name)
    path.mkdir(parents=True, exist_ok=True)
    plain = {k: v.tolist() if isinstance(v, np.ndarray) else [x.tolist() for x in v] if isinstance(v, list) else v if isinstance(v, str) else float(v) for k, v in vars(mixture).items()}
    (path / "model.json").write_text(json.dumps(plain), encoding="utf-8")
    return path


def load_mixture(path: str | Path) -> Mixture:
    raw = json.loads(Path(path, "model.json").read_text(encoding="utf-8"))
    return Mixture(raw["model"], np.array(raw["means"]), np.array(raw["shares"]), np.array(raw["basis"]), [np.array(x) for x in raw["inner"]], np.array(raw["noise"]), raw["loglik"], raw["bic"], raw["aic"], raw["icl"])


def latest_model(folder: str, prefix: str = "01_") -> Path:
    """The last model directory by name."""
    found = sorted(p for p in Path(folder).iterdir() if p.is_dir() and p.name.startswith(prefix))
    if not found:
        raise FileNotFoundError(f"no model {prefix}* in {folder}")
    return found[-1]
