"""Random forests of a table of many rows, all targets together (M8 at size).

The forest is MLlib's: up to ``maxBins`` bins a feature with cuts at equal
shares of a sample, Poisson draws of the rows for every tree, a random third of
the features at every node, the cut with the largest fall of the variance,
``maxDepth`` levels. MLlib updates the sums of all trees row by row and reads
the rows once for each level *and* target. Here a row is packed to a byte a
feature, a level is one pass for all targets, and a task takes a block of rows
through one tree after the other, so a tree's sums stay in the processor's
cache. The sums of a tree are added and its cuts chosen in a group of their
own; the driver holds the cuts only.

Draws are a hash of (row key, tree, seed): they depend neither on the layout of
the rows nor on retries, and need no memory. They are other draws than those of
MLlib's generator, so trees differ from MLlib's as those of another seed do;
without draws (``bootstrap=False``, all features) the trees are the same.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteoframe.session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no installed package

#: Rows of a block, rows of a pass's task up to MANY_TASKS tasks, and beyond.
BLOCK_ROWS, TASK_ROWS, MANY_TASKS, MORE_ROWS = 1 << 17, 1 << 18, 96, 1 << 22
#: Most bins a feature and levels: two bins and a node fit one index.
MOST_BINS, MOST_DEPTH = 32, 8
#: A fall of a node's sum of squares below this share of it is rounding.
ROUNDING = 1e-13

_USED = {"numTrees", "maxDepth", "maxBins", "seed", "featureSubsetStrategy", "subsamplingRate", "minInstancesPerNode", "bootstrap", "cacheNodeIds"}
_PACKED = "n bigint, keys binary, bins binary, labels binary"
_SUMS = "target int, tree int, part int, sums binary"
_CUTS = "target int, tree int, node int, feature int, cut int, whole array<double>, lower array<double>"
_NODE = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
         "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")


def can_fit(params: Mapping[str, object]) -> bool:
    """Whether a forest with these hyper-parameters is built here."""
    return (set(params) <= _USED and params["maxBins"] <= MOST_BINS and 1 <= params["maxDepth"] <= MOST_DEPTH
            and params["featureSubsetStrategy"] in ("auto", "all") and (params.get("bootstrap", True) or params["subsamplingRate"] == 1.0))


def pass_tasks(rows: int) -> int:
    """Tasks of a pass, from the rows alone."""
    return max(1, min(MANY_TASKS, -(-rows // TASK_ROWS))) + rows // MORE_ROWS


def features_per_node(features: int, params: Mapping[str, object]) -> int:
    """MLlib's ``auto`` for regression: all features for one tree, a third for more."""
    every = params["featureSubsetStrategy"] == "all" or params["numTrees"] == 1
    return features if every else math.ceil(features / 3)


def cuts_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Ascending cuts of a feature: halfway between neighbours, at equal shares of the values (MLlib's rule)."""
    distinct, counts = np.unique(values + 0.0, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= bins - 1:
        return middles
    stride = len(values) / bins
    found, so_far, wanted = [], float(counts[0]), stride
    for i in range(1, len(distinct)):
        before, so_far = so_far, so_far + counts[i]
        if abs(before - wanted) < abs(so_far - wanted):
            found.append(middles[i - 1])
            wanted += stride
    return np.array(found)


# --------------------------------------------------------------------------- draws

def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def poisson_steps(rate: float) -> np.ndarray:
    """Cumulated Poisson probabilities in units of 2**-32: a uniform 32-bit number passes as many as its draw says."""
    steps, term, total, k = [], math.exp(-rate), 0.0, 0
    while k <= rate or total < 1.0 - 2.0 ** -33:
        total += term
        k += 1
        term *= rate / k
        steps.append(min(int(total * 2.0 ** 32), 2 ** 32 - 1))
    return np.unique(np.array(steps, dtype=np.uint32))


def draws_of_pair(keys: np.ndarray, pair: int, seed: int, steps: np.ndarray) -> list[np.ndarray]:
    """How often each row is drawn for trees 2 * pair and 2 * pair + 1: the halves of one 64-bit hash."""
    start = ((pair + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95) % 2 ** 64
    hashed = _mixed(keys + np.uint64(start))
    out = []
    for half in (hashed >> np.uint64(32), hashed & np.uint64(0xFFFFFFFF)):
        uniform = half.astype(np.uint32)
        drawn = np.zeros(len(keys), np.uint8)
        for step in steps[:3]:
            drawn += uniform >= step
        if len(steps) > 3:
            often = np.flatnonzero(uniform >= steps[3])
            drawn[often] = np.searchsorted(steps, uniform[often], side="right")
        out.append(drawn)
    return out


# --------------------------------------------------------------------------- tasks

def _packer(cuts: Sequence[np.ndarray], centres: np.ndarray):
    """Rows (key, scaled values, labels) to blocks: a byte of bin a feature, centred labels."""
    def block(parts):
        keys, bins, labels = (np.concatenate(p, axis=-1) for p in zip(*parts))
        return pa.RecordBatch.from_arrays([pa.array([len(keys)], pa.int64()), *[pa.array([a.tobytes()], pa.binary()) for a in (keys, bins, labels)]],
                                          names=["n", "keys", "bins", "labels"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
            labels = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]])
            if not np.isfinite(labels).all():
                raise ValueError("a label is null, NaN or infinite")
            bins = np.stack([np.searchsorted(c, values[:, f], side="left").astype(np.uint8) for f, c in enumerate(cuts)])
            parts.append((batch.column(0).to_numpy(zero_copy_only=False), bins, labels - centres[:, None]))
            rows += n
            if rows >= BLOCK_ROWS:
                yield block(parts)
                parts, rows = [], 0
        if parts:
            yield block(parts)
    return pack


def _sums(picked: np.ndarray, base: np.ndarray, nodes: int, values: Sequence[np.ndarray], size: int) -> np.ndarray:
    """Sums of each of ``values`` by node (``base``), picked feature and bin."""
    sums = np.empty((len(values), nodes, len(picked), size))
    for j in range(0, len(picked) - 1, 2):  # two features in one count, then its margins
        pair = picked[j].astype(np.uint16)
        pair *= np.uint16(size)
        pair += picked[j + 1]
        index = base * (size * size)
        index += pair
        for s, value in enumerate(values):
            both = np.bincount(index, value, minlength=nodes * size * size).reshape(nodes, size, size)
            both.sum(axis=2, out=sums[s, :, j])
            both.sum(axis=1, out=sums[s, :, j + 1])
    if len(picked) % 2:
        index = base * size + picked[-1]
        for s, value in enumerate(values):
            sums[s, :, -1] = np.bincount(index, value, minlength=nodes * size).reshape(nodes, size)
    return sums


def _root_sums(bins, weights, wy, wyy, features, size, squares) -> list[np.ndarray]:
    """As :func:`_tree_sums`, of the root, for all targets: their draws and features are the same."""
    found = _sums(bins[features], np.zeros(len(weights), np.int64), 1, [weights, *wy, *(wyy if squares else [])], size)
    of = lambda i: [0, 1 + i, 1 + len(wy) + i] if squares else [0, 1 + i]
    return [np.append(found[of(i)], wyy[i].sum()) for i in range(len(wy))]


def _rows_by_node(bins, feature, cut, depth) -> dict[int, np.ndarray]:
    """Rows of each node of a level; those of leaves above it are left out."""
    rows = {1: np.arange(bins.shape[1])}
    for _ in range(depth):
        below = {}
        for node, held in rows.items():
            if feature[node] >= 0:
                right = bins[feature[node]].take(held) > cut[node]
                below[2 * node], below[2 * node + 1] = held.compress(~right), held.compress(right)
        rows = below
    return rows


def _tree_sums(bins, weights, wy, wyy, feature, cut, subset, live, depth, size, squares) -> np.ndarray:
    """Sums of one tree's live nodes at a level: (draws, labels[, squares]) x node x feature x bin, then the squares of each node."""
    rows, nodes = _rows_by_node(bins, feature, cut, depth), (1 << depth) + np.flatnonzero(live)
    sizes = np.array([len(rows[v]) for v in nodes])
    ends, order = np.cumsum(sizes), np.concatenate([rows[v] for v in nodes])
    spans = [slice(end - n, end) for n, end in zip(sizes, ends)]
    values = [a.take(order) for a in (weights, wy, wyy)]
    picked = np.empty((subset.shape[1], len(order)), np.uint8)
    for v, span in zip(nodes, spans):
        for j, f in enumerate(subset[v]):
            np.take(bins[f], rows[v], out=picked[j, span], mode="clip")
    found = _sums(picked, np.repeat(np.arange(len(nodes)), sizes), len(nodes), values if squares else values[:2], size)
    return np.append(found, [values[2][span].sum() for span in spans])


def _level_pass(feature, cut, subset, live, depth, size, seed, steps, squares):
    """One pass over the blocks: the sums of every target's every tree at a level, a row each."""
    targets, trees = live.shape[:2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                n, (key_bytes, bin_bytes, label_bytes) = batch.column(0)[r].as_py(), (c[r].as_buffer() for c in batch.columns[1:])
                keys = np.frombuffer(key_bytes, np.int64).view(np.uint64)
                bins, labels = np.frombuffer(bin_bytes, np.uint8).reshape(-1, n), np.frombuffer(label_bytes, np.float64).reshape(-1, n)
                drawn: list[np.ndarray] = []
                for tree in range(trees):
                    if steps is not None and tree % 2 == 0:
                        drawn = draws_of_pair(keys, tree // 2, seed, steps)
                    if not live[:, tree].any():
                        continue
                    times = drawn[tree % 2] if steps is not None else np.ones(n, np.uint8)
                    rows = np.flatnonzero(times)
                    if not len(rows):
                        continue
                    weights, own = times.take(rows).astype(np.float64), np.take(bins, rows, axis=1)
                    grown = np.flatnonzero(live[:, tree].any(axis=1))
                    y = [labels[k].take(rows) for k in grown]
                    wy = [weights * a for a in y]
                    wyy = [a * b for a, b in zip(wy, y)]
                    if depth:
                        found = [_tree_sums(own, weights, a, b, feature[k, tree], cut[k, tree], subset[tree], live[k, tree], depth, size, squares)
                                 for k, a, b in zip(grown, wy, wyy)]
                    else:
                        found = _root_sums(own, weights, wy, wyy, subset[tree, 1], size, squares)
                    for k, sums in zip(grown, found):
                        if (k, tree) in held:
                            held[k, tree] += sums
                        else:
                            held[k, tree] = sums
        part = TaskContext.get().partitionId()
        for (k, tree), sums in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([tree], pa.int32()), pa.array([part], pa.int32()),
                                              pa.array([sums.tobytes()], pa.binary())], names=["target", "tree", "part", "sums"])
    return run


def _choice(subset, live, depth, size, cut_counts, least, squares):
    """Of one tree's sums of all tasks: each live node's (draws, labels, squares), its best cut and what lies left of it."""
    def choose(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        k, tree = table["target"][0].as_py(), table["tree"][0].as_py()
        nodes = np.flatnonzero(live[k, tree])
        sums = np.zeros(len(table["sums"][0].as_buffer()) // 8)
        for part in table["sums"]:
            sums += np.frombuffer(part.as_buffer(), np.float64)
        total, chosen = sums[-len(nodes):], subset[tree, (1 << depth) + nodes]
        below = np.cumsum(sums[:-len(nodes)].reshape(3 if squares else 2, len(nodes), -1, size), axis=-1)
        whole, left = below[..., -1:], below[..., :-1]
        right = whole - left
        with np.errstate(divide="ignore", invalid="ignore"):
            fall = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]
        fits = (left[0] >= least) & (right[0] >= least) & (np.arange(size - 1) < cut_counts[chosen][..., None])
        fall = np.where(fits, fall, -np.inf).reshape(len(nodes), -1)
        at = np.argmax(fall, axis=1)
        rows = []
        for i, node in enumerate((1 << depth) + nodes):
            j, c = divmod(int(at[i]), size - 1)
            splits = fall[i, at[i]] > ROUNDING * total[i]
            lower = [*left[:, i, j, c], *([] if squares else [math.nan])]
            rows.append((k, tree, int(node), int(chosen[i, j]) if splits else -1, c, [whole[0, i, 0, 0], whole[1, i, 0, 0], total[i]], lower))
        kinds = [pa.int32()] * 5 + [pa.list_(pa.float64())] * 2
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["target", "tree", "node", "feature", "cut", "whole", "lower"])
    return choose


# --------------------------------------------------------------------------- driver

def _grown(blocks: DataFrame, targets: int, subset: np.ndarray, cuts: Sequence[np.ndarray], params: Mapping[str, object]):
    """(feature, cut, sums) by target, tree and node (1: root, 2v and 2v + 1: below v); feature -1: a leaf. One pass a level."""
    trees, levels = params["numTrees"], params["maxDepth"]
    size, cut_counts = max(2, *(len(c) + 1 for c in cuts)), np.array([len(c) for c in cuts])
    steps = poisson_steps(params["subsamplingRate"]) if params.get("bootstrap", True) else None
    feature, cut = np.full((targets, trees, 1 << levels), -1, np.int16), np.zeros((targets, trees, 1 << levels), np.int16)
    sums = np.zeros((targets, trees, 2 << levels, 3))
    live = np.ones((targets, trees, 1), bool)
    for depth in range(levels):
        if not live.any():
            break
        squares = depth == levels - 1  # leaves of the last level have no pass of their own
        run = _level_pass(feature, cut, subset, live, depth, size, params["seed"], steps, squares)
        choose = _choice(subset, live, depth, size, cut_counts, params["minInstancesPerNode"], squares)
        below = np.zeros((targets, trees, 2 << depth), bool)
        for r in blocks.mapInArrow(run, _SUMS).groupBy("target", "tree").applyInArrow(choose, _CUTS).collect():
            k, t, v = r.target, r.tree, r.node
            sums[k, t, v] = r.whole
            if r.feature >= 0:
                feature[k, t, v], cut[k, t, v] = r.feature, r.cut
                sums[k, t, 2 * v], sums[k, t, 2 * v + 1] = r.lower, np.subtract(r.whole, r.lower)
                below[k, t, 2 * v - (2 << depth):2 * v + 2 - (2 << depth)] = True
        live = below
    return feature, cut, sums


def _tree_rows(tree: int, feature, cut, sums, cuts: Sequence[np.ndarray], centre: float) -> list[tuple]:
    """One tree as rows of MLlib's model table, parents first; two leaves with one prediction are their parent's leaf."""
    def leaf(v):
        return v >= len(feature) or feature[v] < 0

    def prediction(v):
        return float(sums[v, 1] / sums[v, 0] + centre)

    def shut(v):  # leaves below that predict the same
        return leaf(v) or (shut(2 * v) and shut(2 * v + 1) and prediction(2 * v) == prediction(2 * v + 1))

    rows: list[tuple] = []

    def add(v: int) -> int:
        n, s, q = (float(x) for x in sums[v])
        stats = [n, s + n * centre, q + 2 * centre * s + n * centre * centre]
        own, spread = len(rows), max(q / n - (s / n) ** 2, 0.0)
        rows.append(())
        if shut(v):
            rows[own] = (tree, (own, prediction(v), spread, stats, int(n), -1.0, -1, -1, (-1, [], -1)))
            return own
        (nl, sl, _), (nr, sr, _) = sums[2 * v], sums[2 * v + 1]
        gain = float(sl * sl / nl + sr * sr / nr - s * s / n) / n
        left, right = add(2 * v), add(2 * v + 1)
        rows[own] = (tree, (own, prediction(v), spread, stats, int(n), gain, left, right, (int(feature[v]), [float(cuts[feature[v]][cut[v]])], -1)))
        return own

    add(1)
    return rows


def _as_model(spark, regressor, features: int, rows: list[tuple]) -> RandomForestRegressionModel:
    """The rows as MLlib's model: its table of nodes in the place of those of a forest of two rows with the same settings."""
    ends = [(Vectors.dense([float(i)] * features), float(i)) for i in range(2)]
    small = regressor.fit(spark.createDataFrame(ends, [regressor.getFeaturesCol(), regressor.getLabelCol()]).coalesce(1))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    small.write().save(path)
    spark.createDataFrame(rows, _NODE).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    model = RandomForestRegressionModel.load(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return model


def fit_forests(rows: DataFrame, n: int, key_cols: Sequence[str], targets: Sequence[str], vector_col: str,
                params: Mapping[str, object], regressor) -> dict[str, RandomForestRegressionModel]:
    """One forest per target over the ``n`` rows; ``regressor(target)`` names settings and columns.

    ``key_cols`` tell rows apart (equal keys are drawn alike). Cuts come from a
    sample of about ``maxBins`` squared rows, 10,000 at least, as in MLlib. The
    packed rows (a byte a feature, 8 a label and the key) lie on disk and are
    read once a level.
    """
    spark, seed = rows.sparkSession, params["seed"]
    keyed = rows.select(F.xxhash64(*key_cols).alias("_key"), vector_to_array(vector_col).alias("_x"), *[F.col(t).cast("double").alias(t) for t in targets])
    share = min(1.0, max(params["maxBins"] ** 2, 10_000) / n)
    drawn = F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    sample = keyed.filter(drawn).toArrow()  # about 10,000 rows
    values = sample["_x"].combine_chunks().flatten().to_numpy().reshape(sample.num_rows, -1)
    cuts = [cuts_of(values[:, f], min(params["maxBins"], n)) for f in range(values.shape[1])]
    centres = np.array([np.float32(np.nanmean(sample[t].to_numpy())) for t in targets], dtype=np.float64)
    size, trees, levels = values.shape[1], params["numTrees"], params["maxDepth"]
    wanted = features_per_node(size, params)
    subset = np.zeros((trees, 1 << levels, wanted), np.int16)
    for tree in range(trees):
        random = np.random.default_rng([seed % 2 ** 64, tree])
        for node in range(1 << levels):
            subset[tree, node] = np.sort(random.permutation(size)[:wanted])
    tasks = pass_tasks(n)
    blocks = keyed.mapInArrow(_packer(cuts, centres), _PACKED).repartition(tasks).persist(StorageLevel.DISK_ONLY)
    try:
        feature, cut, sums = _grown(blocks, len(targets), subset, cuts, params)
    finally:
        blocks.unpersist()

    def model(k: int):
        nodes = [row for tree in range(trees) for row in _tree_rows(tree, feature[k, tree], cut[k, tree], sums[k, tree], cuts, float(centres[k]))]
        return targets[k], _as_model(spark, regressor(targets[k]), size, nodes)

    with ThreadPoolExecutor(max_workers=len(targets)) as pool:
        return dict(pool.map(model, range(len(targets))))
