"""Models on features: elastic nets with and without groups, hierarchical and density clustering."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators.selection import best_row, first_n
from seqloom.session import cut


#: Cells of the matrix of one category that a task may hold, samples of one category a model is fitted on, folds, and penalties of a path.
MAX_CELLS, MAX_SAMPLES, FOLDS, PENALTIES = 50_000_000, 20_000, 5, 20
#: The least penalty of a path as a share of the largest, and rounds of descent per penalty.
LEAST_PENALTY, ROUNDS = 0.01, 500


def penalty_path(x: np.ndarray, y: np.ndarray, groups: Sequence[np.ndarray], mixing: float, n: int = PENALTIES) -> np.ndarray:
    """Penalties from the one that leaves only intercepts, down by a constant factor."""
    gradient = x.T @ (y - y.mean(axis=0)) / len(y)
    largest = max((np.linalg.norm(gradient[g]) / np.sqrt(len(g)) for g in groups), default=0.0) / max(mixing, 1e-3)
    return largest * np.geomspace(1.0, LEAST_PENALTY, n)


def net_path(x: np.ndarray, y: np.ndarray, groups: Sequence[np.ndarray], penalties: Sequence[float], mixing: float, family: str, rounds: int = ROUNDS, tolerance: float = 1e-7) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(coefficients, intercept)`` for every penalty, by accelerated proximal descent with warm starts.

    y has a column per response: one number, or an indicator per class. A group's penalty is the square root of its
    number of features times ``mixing`` of its norm over all responses and the rest of half its square.
    """
    n, responses = len(x), y.shape[1]
    smooth = np.linalg.norm(np.column_stack([np.ones(n), x]), 2) ** 2 / n * (0.5 if family == "multinomial" else 1.0)
    step = 1.0 / max(smooth, 1e-12)
    label = np.zeros(x.shape[1], dtype=int)
    for i, g in enumerate(groups):
        label[g] = i
    weight = np.sqrt(np.bincount(label, minlength=len(groups)))

    def fitted(beta: np.ndarray, start: np.ndarray) -> np.ndarray:
        raw = x @ beta + start
        if family != "multinomial":
            return raw
        raw = np.exp(raw - raw.max(axis=1, keepdims=True))
        return raw / raw.sum(axis=1, keepdims=True)

    beta, start, out = np.zeros((x.shape[1], responses)), np.zeros(responses), []
    for penalty in penalties:
        ahead, ahead_start, turn = beta, start, 1.0
        for _ in range(rounds):
            error = (fitted(ahead, ahead_start) - y) / n
            moved = ahead - step * (x.T @ error)
            size = np.sqrt(np.bincount(label, (moved**2).sum(axis=1), minlength=len(groups)))
            shrunk = np.maximum(0.0, 1 - step * penalty * mixing * weight / np.maximum(size, 1e-300)) / (1 + step * penalty * (1 - mixing) * weight)
            new, new_start = moved * shrunk[label][:, None], ahead_start - step * error.sum(axis=0)
            change = max(np.abs(new - beta).max(initial=0.0), np.abs(new_start - start).max())
            # The momentum starts anew where it points uphill.
            turned = np.sum((ahead - new) * (new - beta)) > 0
            onward = 1.0 if turned else (1 + np.sqrt(1 + 4 * turn * turn)) / 2
            pace = 0.0 if turned else (turn - 1) / onward
            ahead, ahead_start = new + pace * (new - beta), new_start + pace * (new_start - start)
            beta, start, turn = new, new_start, onward
            if change < tolerance:
                break
        out.append((beta.copy(), start.copy()))
    return out


def grouped_net(
    long: DataFrame, category: str, key: str, group: str, feature: str, value: str, target: str, family: str,
    mixing: float = 0.5, folds: int = FOLDS, most: int = MAX_SAMPLES, grouped_below: int = 4,
) -> DataFrame:
    """``(category, class, group, feature, coefficient, penalty, score)`` that are not zero, of a cross-validated elastic net.

    long: one row per sample and feature with the category's target; samples without a feature have 0 there.
    family: ``gaussian`` (the target is a number, class is null) or ``multinomial``. Groups of features share a
    penalty for numbers and for fewer than ``grouped_below`` classes; else every feature is its own group. The
    penalty is the one of the path with the best mean score over the folds: squared error, or negative log likelihood.

    Categories and folds are fitted side by side, each in a task that holds one matrix, of at most ``MAX_CELLS`` cells.
    A category with more than ``most`` samples is fitted on that many, taken by a hash of their keys. Categories
    without two samples or two classes, and constant targets, give no rows. Null targets take no part.
    """
    kinds = dict(long.dtypes)
    rows = long.select(category, key, group, feature, F.col(value).cast("double").alias("__x"), F.col(target).cast("double" if family == "gaussian" else "string").alias("__y")).filter("__y is not null")
    samples = rows.select(category, key).distinct().withColumn("__hash", F.xxhash64(key, F.lit(42)))
    taken = first_n(samples, [category], ["__hash", key], most).withColumn("__fold", F.pmod(F.xxhash64(key, F.lit(7)), F.lit(folds)).cast("int")).drop("__hash")
    rows = rows.join(taken, [category, key])
    spread = rows.withColumn("__fit", F.explode(F.sequence(F.lit(0), F.lit(folds))))
    schema = f"{category} {kinds[category]}, step int, penalty double, score double, class string, {group} {kinds[group]}, {feature} {kinds[feature]}, coefficient double"

    def fit(keys: tuple, part: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame([], columns=[category, "step", "penalty", "score", "class", group, feature, "coefficient"])
        number = keys[1]
        names = part[[group, feature]].drop_duplicates().sort_values([group, feature])
        people = part[[key, "__y", "__fold"]].drop_duplicates(key).sort_values(key)
        if len(names) * len(people) > MAX_CELLS:
            raise ValueError(f"{len(people)} samples x {len(names)} features of a category; at most {MAX_CELLS} cells make one matrix")
        at = pd.MultiIndex.from_frame(names)
        x = np.zeros((len(people), len(names)))
        x[pd.Index(people[key]).get_indexer(part[key]), at.get_indexer(pd.MultiIndex.from_frame(part[[group, feature]]))] = part["__x"]
        classes = [None] if family == "gaussian" else sorted(people["__y"].unique())
        y = people[["__y"]].to_numpy(float) if family == "gaussian" else (people["__y"].to_numpy()[:, None] == np.array(classes, dtype=object)[None, :]).astype(float)
        if len(people) < 2 or (family != "gaussian" and len(classes) < 2) or not y.std(axis=0).any():
            return none
        scale = x.std(axis=0)
        x = (x - x.mean(axis=0)) / np.where(scale > 0, scale, 1.0)
        together = family == "gaussian" or len(classes) < grouped_below
        codes = pd.factorize(names[group])[0] if together else np.arange(len(names))
        groups = [np.flatnonzero(codes == c) for c in range(codes.max() + 1)]
        penalties = penalty_path(x, y, groups, mixing)
        held = (people["__fold"] == number).to_numpy()
        if number == folds:
            found = []
            for step, (beta, _) in enumerate(net_path(x, y, groups, penalties, mixing, family)):
                beta = beta / np.where(scale > 0, scale, np.inf)[:, None]
                for i, j in zip(*np.nonzero(beta), strict=True):
                    found.append((keys[0], step, penalties[step], None, classes[j], names[group].iloc[i], names[feature].iloc[i], beta[i, j]))
            return pd.DataFrame(found, columns=none.columns)
        if not held.any() or held.all():
            return none
        scores = []
        for step, (beta, start) in enumerate(net_path(x[~held], y[~held], groups, penalties, mixing, family)):
            raw = x[held] @ beta + start
            if family == "gaussian":
                loss = float(((raw - y[held]) ** 2).sum())
            else:
                raw = raw - raw.max(axis=1, keepdims=True)
                loss = float((np.log(np.exp(raw).sum(axis=1)) - (raw * y[held]).sum(axis=1)).sum())
            scores.append((keys[0], step, penalties[step], loss, None, None, None, None))
        return pd.DataFrame(scores, columns=none.columns)

    fits = cut(spread.groupBy(category, "__fit").applyInPandas(fit, schema))
    total = fits.filter("score is not null").groupBy(category, "step").agg(F.sum("score").alias("score"))
    best = best_row(total, [category], ["score", "step"])
    chosen = fits.filter("score is null").drop("score").join(best, [category, "step"])
    return chosen.select(category, "class", group, feature, "coefficient", "penalty", "score")


def principal_components(frame: DataFrame, vector: str, components: int) -> DataFrame:
    """``components`` of all rows' vectors as one matrix, computed from a distributed Gram matrix."""
    data = frame.withColumn("__x", array_to_vector(F.col(vector).cast("array<double>")))
    fitted = PCA(k=components, inputCol="__x", outputCol="__c").fit(data)
    return fitted.transform(data).withColumn("components", vector_to_array("__c")).drop("__x", "__c")


def average_linkage(distances: np.ndarray) -> list[tuple[int, int, float, int]]:
    """Merges ``(a, b, height, size)`` of hierarchical clustering by mean distance; new clusters are numbered from n."""
    n = len(distances)
    d = distances.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    label, size, out = list(range(n)), [1] * n, []
    live = np.ones(n, dtype=bool)
    for step in range(n - 1):
        masked = np.where(live[:, None] & live[None, :], d, np.inf)
        i, j = divmod(int(masked.argmin()), n)
        i, j = min(i, j), max(i, j)
        out.append((min(label[i], label[j]), max(label[i], label[j]), float(d[i, j]), size[i] + size[j]))
        mean = (d[i] * size[i] + d[j] * size[j]) / (size[i] + size[j])
        d[i], d[:, i] = mean, mean
        d[i, i] = np.inf
        live[j] = False
        size[i] += size[j]
        label[i] = n + step
    return out


def cut_tree(merges: Sequence[tuple[int, int, float, int]], n: int, height: float) -> list[int]:
    """Cluster from 1 of every leaf when merges up to ``height`` are made; numbered by first leaf."""
    parent = list(range(2 * n))

    def find(a: int) -> int:
        while parent[a] != a:
            a = parent[a]
        return a

    for step, (a, b, h, _) in enumerate(merges):
        if h <= height:
            parent[find(a)] = parent[find(b)] = n + step
    roots = [find(i) for i in range(n)]
    return list(pd.factorize(np.array(roots))[0] + 1)


def leaf_order(merges: Sequence[tuple[int, int, float, int]], n: int) -> list[int]:
    """Leaves in the order of the tree, for the rows of a plot."""
    held: dict[int, list[int]] = {i: [i] for i in range(n)}
    for step, (a, b, _, _) in enumerate(merges):
        held[n + step] = held.pop(a) + held.pop(b)
    return next(iter(held.values())) if n else []


def density_clusters(distances: np.ndarray, least: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Labels (noise -1) and membership of density clustering on a distance matrix: HDBSCAN with excess of mass.

    Mutual reachability, minimum spanning tree, condensed tree, stable clusters. For a matrix of representatives.
    """
    n = len(distances)
    labels, chance = np.full(n, -1), np.zeros(n)
    if n < least:
        return labels, chance
    core = np.sort(distances, axis=1)[:, min(least, n) - 1]
    reach = np.maximum(distances, np.maximum(core[:, None], core[None, :]))
    seen, best, link = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)
    at, tree = 0, []
    for _ in range(n - 1):
        seen[at] = True
        closer = ~seen & (reach[at] < best)
        best[closer], link[closer] = reach[at][closer], at
        nxt = int(np.where(seen, np.inf, best).argmin())
        tree.append((float(best[nxt]), int(link[nxt]), nxt))
        at = nxt
    tree.sort()
    parent, node, size = list(range(n)), list(range(n)), [1] * n
    children: list[tuple[int, int, float]] = []

    def find(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    sizes = {i: 1 for i in range(n)}
    for w, a, b in tree:
        a, b = find(a), find(b)
        new = n + len(children)
        children.append((node[a], node[b], w))
        sizes[new] = size[a] + size[b]
        parent[b], node[a] = a, new
        size[a] += size[b]

    def leaves(k: int) -> list[int]:
        todo, out = [k], []
        while todo:
            x = todo.pop()
            if x < n:
                out.append(x)
            else:
                todo += list(children[x - n][:2])
        return out

    points: dict[int, list[tuple[int, float]]] = {0: []}
    born, split, sons = {0: 0.0}, {}, {}
    todo = [(2 * n - 2, 0)]
    while todo:
        k, cluster = todo.pop()
        while k >= n:
            a, b, w = children[k - n]
            lam = 1 / w if w > 0 else 1e12
            if sizes[a] >= least and sizes[b] >= least:
                split[cluster] = lam
                sons[cluster] = [len(points), len(points) + 1]
                for part, c in zip((a, b), sons[cluster], strict=True):
                    points[c], born[c] = [], lam
                    todo.append((part, c))
                break
            small, k = (a, b) if sizes[a] < least else (b, a)
            points[cluster] += [(x, lam) for x in leaves(small)]
            if sizes[k] < least:
                points[cluster] += [(x, lam) for x in leaves(k)]
                break
        else:
            points[cluster].append((k, 1e12))
    held = {c: sum(l - born[c] for _, l in p) for c, p in points.items()}
    for c, s in split.items():
        held[c] += (s - born[c]) * sum(_under(d, points, sons) for d in sons[c])
    chosen, value = {}, {}
    for c in sorted(points, reverse=True):
        below = sum(value[d] for d in sons.get(c, []))
        chosen[c] = c != 0 and (not sons.get(c) or held[c] >= below)
        value[c] = held[c] if chosen[c] else below
    number = 0
    stack = [0]
    while stack:
        c = stack.pop()
        if chosen[c]:
            inside = _inside(c, points, sons)
            most = max(l for _, l in inside)
            for x, l in inside:
                labels[x], chance[x] = number, min(1.0, l / most)
            number += 1
        else:
            stack += sons.get(c, [])[::-1]
    return labels, chance


def _under(c: int, points: dict, sons: dict) -> int:
    return len(points[c]) + sum(_under(d, points, sons) for d in sons.get(c, []))


def _inside(c: int, points: dict, sons: dict) -> list:
    out = list(points[c])
    for d in sons.get(c, []):
        out += _inside(d, points, sons)
    return out


#: Representatives of one matrix of distances.
MOST_REPRESENTATIVES = 5_000


def _checked(n: int, most: int) -> None:
    if n > most:
        raise ValueError(f"{n} representatives; at most {most} make one matrix")


def tree_clusters(pairs: DataFrame, a: str, b: str, distance: str, heights: Sequence[float] = (0.01, 0.02, 0.05, 0.1), most: int = MOST_REPRESENTATIVES) -> DataFrame:
    """``(sample, coarse_t<height> ...)``: clusters from 1 of representatives by mean linkage, cut at several heights.

    pairs: their distances, each pair once or more; missing ones count as 0. A hierarchical clustering needs the
    whole matrix, so the number of representatives is checked before it is made, in one task.
    """
    kind = dict(pairs.dtypes)[a]
    names = pairs.select(F.col(a).alias("x")).union(pairs.select(b)).distinct().limit(most + 1).count()
    _checked(names, most)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(part[a]) | set(part[b]))
        at = {x: i for i, x in enumerate(names)}
        d = np.zeros((len(names), len(names)))
        i, j = part[a].map(at).to_numpy(), part[b].map(at).to_numpy()
        d[i, j] = d[j, i] = part[distance]
        merges = average_linkage(d)
        return pd.DataFrame({"sample": names, **{f"coarse_t{h:g}": cut_tree(merges, len(names), h) for h in heights}})

    schema = f"sample {kind}, " + ", ".join(f"`coarse_t{h:g}` long" for h in heights)
    return pairs.select(a, b, distance).groupBy(F.lit(0).alias("__all")).applyInPandas(fit, schema)


def _distances(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=float)
    squares = (x * x).sum(axis=1)
    return np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * x @ x.T, 0.0))


def vector_clusters(frame: DataFrame, group: str, key: str, vector: str, least: int = 5, most: int = MOST_REPRESENTATIVES) -> DataFrame:
    """``(group, key, cluster, membership)``: density clusters of every group's representatives; noise is -1.

    One group is one matrix of distances, of at most ``most`` representatives.
    """
    kinds = dict(frame.dtypes)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        _checked(len(part), most)
        part = part.sort_values(key)
        labels, chance = density_clusters(_distances(part[vector]), least)
        return pd.DataFrame({group: part[group], key: part[key], "cluster": labels, "membership": chance})

    return frame.select(group, key, vector).groupBy(group).applyInPandas(fit, f"{group} {kinds[group]}, {key} {kinds[key]}, cluster long, membership double")


def tree_order(frame: DataFrame, group: str, key: str, vector: str, most: int = MOST_REPRESENTATIVES) -> DataFrame:
    """``(group, key, place)``: the rows of every group in the order of their tree by mean linkage, from 0."""
    kinds = dict(frame.dtypes)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        _checked(len(part), most)
        part = part.sort_values(key).reset_index(drop=True)
        order = leaf_order(average_linkage(_distances(part[vector])), len(part))
        return pd.DataFrame({group: part[group].iloc[order].to_numpy(), key: part[key].iloc[order].to_numpy(), "place": np.arange(len(part))})

    return frame.select(group, key, vector).groupBy(group).applyInPandas(fit, f"{group} {kinds[group]}, {key} {kinds[key]}, place long")
