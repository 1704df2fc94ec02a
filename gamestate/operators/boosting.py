"""Boosted trees over binned columns, trained in Spark: binary and softmax, nulls kept, several models in one pass.

The rows are binned once into blocks (a byte for each value, 0 for null) and written as a table. A level of all trees of a
round, of all classes and of all models that are being trained, is one pass over that table: each task adds the gradients
of its rows by node, column and bin, and these sums, whose number follows from depth, columns and bins but never from the
rows, are added up and compared in a few tasks; the driver gets one split for each node. Gradients are summed as integers and the edges
of bins come from counts, so trees don't depend on how rows are dealt out, nor do the row samples, which follow from a hash of
the keys.

A null goes left or right at each split, whichever gains more there; no row is dropped, in training or in scoring. After
each round the loss on the valid rows is known without another pass. A model stops when its loss has not improved for
`patience` rounds and keeps the best round; its curve has all rounds.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.operators.running import running

ROWS = 65_536  # rows of a block
BINS = 64
VALUES = 1_000_000  # of all columns that a task runs over at most, about
CLASSES = 256  # different labels that a model takes at most
SCALE = float(1 << 24)  # of the integers that gradients are summed as
TASKS = 32  # that add up sums and pick splits at most
JOINT = 512  # joint codes of a bundle of columns at most; less at levels of more than 8 nodes
CACHED = 256 << 20  # bytes of margins that a worker keeps between passes


@dataclass(frozen=True)
class Params:
    eta: float = 0.3
    depth: int = 4
    min_child_weight: float = 1.0
    max_delta_step: float = 0.0  # 0: no bound
    subsample: float = 1.0
    colsample: float = 1.0  # of the columns, drawn anew for each node
    alpha: float = 0.0
    lam: float = 1.0
    gamma: float = 0.0
    coarse: bool = False  # bins two by two
    rounds: int = 100
    patience: int = 10
    seed: int = 66


@dataclass
class Tree:
    """Nodes in the order of a heap; feature is -1 at leaves. Rows whose bin is at most `bin` go left, nulls where null_left says."""

    feature: np.ndarray
    bin: np.ndarray
    null_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.int16), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    def nodes(self, codes: np.ndarray, steps: int | None = None) -> np.ndarray:
        """The node of each row after some steps; whole columns are compared, node by node, as they lie together in a block."""
        steps = int(math.log2(len(self.feature) + 1)) - 1 if steps is None else steps
        place, ends = np.zeros(len(codes), np.uint16 if steps > 8 else np.uint8), np.zeros(1, np.int64)  # in the level; where that place is or ended
        for level in range(steps):
            right = np.zeros(len(codes), bool)
            for i in range(2**level):
                node = 2**level - 1 + i
                if ends[i] == node and (f := self.feature[node]) >= 0:
                    c = codes[:, f]
                    mine = c > self.bin[node]
                    if not self.null_left[node]:
                        mine |= c == 0
                    right |= mine & (place == i)
            place = 2 * place + right
            below = np.stack([2 * ends + 1, 2 * ends + 2], 1)
            going = (ends >= 2**level - 1) & (self.feature[ends] >= 0)
            ends = np.where(going[:, None], below, ends[:, None]).ravel()
        return ends[place]


@dataclass
class Booster:
    """A trained model: columns and the edges of their bins, classes, start margins, and the trees of each round by class."""

    columns: list[str]
    edges: list[list[float]]
    classes: list
    start: list[float]
    params: Params
    trees: list[list[Tree]] = field(default_factory=list)
    curve: list[tuple[int, float, float, float]] = field(default_factory=list)  # round, loss on train and valid rows, seconds
    best: int = 0  # rounds that score() takes
    state: str = "complete"

    def margins(self, codes: np.ndarray, rounds: int | None = None, since: int = 0, out: np.ndarray | None = None) -> np.ndarray:
        out = np.asfortranarray(np.tile(np.array(self.start), (len(codes), 1))) if out is None else out
        for trees in self.trees[since:rounds]:
            for k, t in enumerate(trees):
                out[:, k] += t.value[t.nodes(codes)]
        return out

    def to_json(self) -> str:
        trees = [[{k: v.tolist() for k, v in vars(t).items()} for t in r] for r in self.trees]
        return json.dumps({**{k: getattr(self, k) for k in ("columns", "edges", "classes", "start", "curve", "best", "state")}, "params": asdict(self.params), "trees": trees})

    @classmethod
    def from_json(cls, text: str) -> Booster:
        x = json.loads(text)
        kinds = {"feature": np.int16, "bin": np.int16, "null_left": bool}
        trees = [[Tree(**{k: np.array(v, kinds.get(k, np.float64)) for k, v in t.items()}) for t in r] for r in x["trees"]]
        return cls(**{**x, "params": Params(**x["params"]), "trees": trees, "curve": [tuple(c) for c in x["curve"]]})


@dataclass
class Binned:
    """Blocks of rows, train before valid ones and no others (codes by column, label as a place in classes, use: 1 train, 2 valid, a hash of the keys)."""

    rows: DataFrame
    columns: list[str]
    edges: list[list[float]]
    classes: list
    counts: list[int]  # of training rows by class
    tasks: int  # that a pass has at most


def to_codes(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """The bins of a matrix of doubles: 0 for NaN, else 1 and the number of edges below."""
    out = np.empty(x.shape, np.uint8, order="F")
    for j, e in enumerate(edges):
        out[:, j] = np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(e, x[:, j], "left"))
    return out


def _doubles(columns: list[str]) -> list:
    return [F.col(f"`{c}`").cast("double").alias(f"_{j}") for j, c in enumerate(columns)]


def exact_edges(df: DataFrame, columns: list[str], rows: int, keep: Callable[[DataFrame], DataFrame]) -> list[list[float]]:
    """Of each column the least values that hold 1, 2, ... BINS - 1 shares of its rows, nulls and NaN aside; `rows` is about df's number.

    Tasks count the values of a batch, the counts are added up and run over by ranges, so the same rows give the same edges
    however they are dealt, and no task has all values of a column. The driver gets the edges.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in range(len(columns)):
                x = b.column(j).to_numpy(zero_copy_only=False).astype(np.float64)
                value, n = np.unique(x[~np.isnan(x)] + 0.0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), j, np.int32)), pa.array(value), pa.array(n.astype(np.int64))], names=["j", "value", "n"])

    if not columns:
        return []
    seen = keep(df.select(_doubles(columns)).mapInArrow(counted, "j int, value double, n long").groupBy("j", "value").agg(F.sum("n").alias("n")))
    up_to = running(seen, ["j", "value"], keep, {"up_to": F.col("n")}, parts=-(-rows * len(columns) // VALUES) or 1)
    whole = {r["j"]: r["n"] for r in seen.groupBy("j").agg(F.sum("n").alias("n")).collect()}
    sizes = [whole.get(j, 0) for j in range(len(columns))]
    size, before = (F.array(*[F.lit(int(x)).cast("long") for x in xs])[F.col("j")] for xs in (sizes, np.cumsum([0, *sizes])))
    shares = up_to.select("j", "value", ((F.col("up_to") - before) * BINS).alias("upper"), ((F.col("up_to") - F.col("n") - before) * BINS).alias("lower"), size.alias("size"))
    found = shares.where(f"least(upper div size, {BINS - 1}) > lower div size").select("j", "value").collect()  # fewer than BINS of a column
    return [sorted(r["value"] for r in found if r["j"] == j) for j in range(len(columns))]


def bin_rows(df: DataFrame, columns: list[str], label: str, keys: list[str], keep: Callable[[DataFrame], DataFrame], train: str = "fold = 'train'", valid: str = "fold = 'valid'") -> Binned:
    """df in blocks, through `keep`, which writes a frame as a table. Rows without a label belong to neither part."""
    named = df.where(F.col(label).isNotNull()).withColumn("_use", F.expr(f"case when {train} then 1 when {valid} then 2 else 0 end"))
    learned = named.where("_use = 1")
    found = learned.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).orderBy("label").limit(CLASSES + 1).collect()
    if not 1 <= len(found) <= CLASSES:
        raise ValueError(f"{label} has {len(found) or 'no'} classes among the training rows, the most are {CLASSES}")
    classes, counts = [r["label"] for r in found], [r["n"] for r in found]
    edges = exact_edges(learned, columns, sum(counts), keep)
    place = F.coalesce(F.expr("case " + " ".join(f"when _label <=> {_sql(c)} then {i}" for i, c in enumerate(classes)) + " end"), F.lit(-1))
    wide = named.select(*_doubles(columns), F.col(label).alias("_label"), "_use", F.xxhash64(*keys).alias("_key"))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-sum(counts) // (4 * ROWS)))  # each sends its sums, so not more than the cores and rows ask for
    wide = wide.select(*[f"_{j}" for j in range(len(columns))], place.alias("y"), "_use", "_key").where("_use > 0 and y >= 0").coalesce(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def block() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            t = t.take(np.argsort(t["_use"].to_numpy(), kind="stable"))
            x = np.stack([t.column(j).to_numpy().astype(np.float64) for j in range(len(columns))], 1) if columns else np.zeros((t.num_rows, 0))
            parts = [np.ascontiguousarray(to_codes(x, edges).T), *(t[c].to_numpy().astype(k) for c, k in (("y", "<i4"), ("_use", "u1"), ("_key", "<i8")))]
            return pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], names=["block", "codes", "y", "use", "key"])

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= ROWS:
                yield block()
                number, held = number + 1, []
        if sum(x.num_rows for x in held):
            yield block()

    rows = keep(wide.mapInArrow(run, "block long, codes binary, y binary, use binary, key binary"))
    return Binned(rows, columns, edges, classes, counts, tasks)


def _sql(value: object) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


_margins: OrderedDict[tuple, tuple[int, np.ndarray]] = OrderedDict()


@dataclass
class _Forest:
    """What a pass tells its tasks of a model: its trees in one array for each property (round, class, node), so that many trees are sent fast."""

    params: Params
    start: list[float]
    rounds: int
    nodes: tuple[np.ndarray, ...]

    @classmethod
    def of(cls, model: Booster) -> _Forest:
        kinds = ("feature", "bin", "null_left", "value")
        return cls(model.params, model.start, len(model.trees), tuple(np.array([[getattr(t, k) for t in trees] for trees in model.trees]) for k in kinds))

    def trees(self, since: int) -> list[list[Tree]]:
        return [[Tree(*(x[r, k] for x in self.nodes), *[np.empty(0)] * 2) for k in range(len(self.start))] for r in range(since, self.rounds)]


def _known(run: str, m: int, block: int, model: _Forest, codes: np.ndarray) -> np.ndarray:
    """Margins of a block, from those this worker remembers of earlier rounds if it does."""
    key = (run, m, block)
    since, out = _margins.pop(key, (0, None))
    out = Booster([], [], [], model.start, model.params, model.trees(since)).margins(codes, out=out)
    _margins[key] = (model.rounds, out)
    while len(_margins) > 1 and sum(x.nbytes for _, x in _margins.values()) > CACHED:
        _margins.popitem(last=False)
    return out


def probabilities(margins: np.ndarray) -> np.ndarray:
    """Of each class: the logistic function of one margin, or softmax of several."""
    if margins.shape[1] == 1:
        p = 1 / (1 + np.exp(-margins[:, 0]))
        return np.stack([1 - p, p]).T
    e = np.exp(margins - margins.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    x = key.view(np.uint64) ^ np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).astype(np.float64) / 2.0**64


@dataclass
class _Bundle:
    """Columns that are counted as one: the joint code of each row and how many there are, and of which cells its counts are sums."""

    code: np.ndarray
    size: int
    cells: np.ndarray
    share: np.ndarray | None  # joint codes by cells, 1 where a code counts; None: the cells are the codes


def _bundles(columns: np.ndarray, starts: np.ndarray, most: int) -> list[_Bundle]:
    """Columns (column, row) of few values joined, up to `most` joint codes, so that one count serves all of a bundle."""
    low, high = columns.min(1).astype(int), columns.max(1).astype(int)
    spans, groups = high - low + 1, []
    for j in np.argsort(spans, kind="stable"):
        if groups and groups[-1][1] * spans[j] <= most:
            groups[-1][0].append(j)
            groups[-1][1] *= int(spans[j])
        else:
            groups.append([[j], int(spans[j])])
    out = []
    for members, size in groups:
        code, step, share = np.zeros(columns.shape[1], np.uint16), 1, []
        for j in members:
            code += (columns[j] - np.uint8(low[j])) * np.uint16(step)
            share.append(np.arange(size)[:, None] // step % spans[j] == np.arange(spans[j]))
            step *= int(spans[j])
        cells = np.concatenate([starts[j] + np.arange(low[j], high[j] + 1) for j in members])
        out.append(_Bundle(code, size, cells, np.concatenate(share, 1).astype(np.float64) if len(members) > 1 else None))
    return out


@dataclass(frozen=True)
class _Best:
    """The split of a node (feature is -1 if none gains), and the sums of gradients and hessians of all its rows and either side."""

    feature: int
    bin: int
    null_left: bool
    gain: float
    whole: tuple[float, float]
    left: tuple[float, float] = (0.0, 0.0)
    right: tuple[float, float] = (0.0, 0.0)


def _pass(binned: Binned, run: str, models: dict[int, Booster], grown: dict[int, list[Tree]], level: int) -> tuple[dict[int, list[dict[int, _Best]]], dict[int, list[float]]]:
    """One pass: for each model and class the best split of each node of the level, and at level 0 the model's losses.

    Each task sends one row of sums for each node. They are added up, and the splits chosen, in at most TASKS tasks, a node
    in one of them; the driver gets a split for each node. A node is numbered by model, class and place in the level; losses
    have negative numbers.
    """
    wide, many = len(binned.columns), 2**level
    bins = [len(e) + 2 for e in binned.edges]
    starts = np.concatenate([[0], np.cumsum(bins)]).astype(int)
    cells = int(starts[-1])
    of = [(m, k) for m, b in models.items() for k in range(len(b.start))]
    place = {x: i * many for i, x in enumerate(of)}
    sent = {m: _Forest.of(b) for m, b in models.items()}
    grows = {m: (b.params, len(b.trees)) for m, b in models.items()}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(of) * many, cells, 2), np.int64)
        losses = {m: np.zeros((2, 2), np.int64) for m in sent}
        for b in batches:
            for i in range(b.num_rows):
                y, use, key = (np.frombuffer(b[c][i].as_py(), t) for c, t in (("y", "<i4"), ("use", "u1"), ("key", "<i8")))
                columns = np.frombuffer(b["codes"][i].as_py(), np.uint8).reshape(wide, len(y))
                learned = int((use == 1).sum())  # the first rows of a block
                bundles = _bundles(columns[:, :learned], starts, min(JOINT, 8 * JOINT // many)) if learned and wide else []
                for m, model in sent.items():
                    p = probabilities(_known(run, m, b["block"][i].as_py(), model, columns.T))
                    if level == 0:
                        loss = np.rint(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-15)) * SCALE)
                        for part, rows in enumerate((slice(None, learned), slice(learned, None))):
                            losses[m][part] += (int(loss[rows].sum()), len(loss[rows]))
                    x = model.params
                    own, p, label, codes = columns[:, :learned], p[:learned], y[:learned], [u.code for u in bundles]
                    if x.subsample < 1:
                        on = _mixed(key[:learned], x.seed * 100_003 + model.rounds) < x.subsample
                        own, p, label, codes = own[:, on], p[on], label[on], [c[on] for c in codes]
                    for k in range(len(model.start)):
                        cls = k if len(model.start) > 1 else 1
                        g = np.rint((p[:, cls] - (label == cls)) * SCALE)
                        h = np.rint(np.maximum(p[:, cls] * (1 - p[:, cls]) * (2 if len(model.start) > 1 else 1), 1e-6) * SCALE)
                        node = grown[m][k].nodes(own.T, level) - (many - 1)
                        node[node < 0] = many  # ended before this level
                        at, first = place[m, k], {n: node * n for n in {u.size for u in bundles}}
                        for u, code in zip(bundles, codes, strict=True):
                            cell = first[u.size] + code
                            for s, v in enumerate((g, h)):
                                # sums of integers below 2^53, so exact
                                found = np.bincount(cell, v, (many + 1) * u.size)[: many * u.size].reshape(many, u.size)
                                total[at : at + many, u.cells, s] += (found if u.share is None else found @ u.share).astype(np.int64)
        nodes = np.flatnonzero(total.any((1, 2))) if cells else []
        number, held = [int(i) for i in nodes], [total[i].tobytes() for i in nodes]
        if level == 0:
            for at, m in enumerate(sent):
                number.append(-1 - at)
                held.append(losses[m].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(held, pa.binary())], names=["node", "sums"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i in range(b.num_rows):
                node, one = b["node"][i].as_py(), np.frombuffer(b["sums"][i].as_py(), np.int64)
                total[node] = total[node] + one if node in total else one
        out = []
        for node, t in total.items():
            if node < 0:
                out.append([float(node), *(float(t[2 * part] / SCALE / t[2 * part + 1]) if t[2 * part + 1] else math.nan for part in (0, 1))])
                continue
            m, k = of[node // many]
            hist = np.zeros((wide, BINS + 2, 2))
            for j, n in enumerate(bins):
                hist[j, :n] = t.reshape(cells, 2)[starts[j] : starts[j + 1]] / SCALE
            params, rounds = grows[m]
            s = _best(hist, params, rounds * 1009 + k, many - 1 + node % many)
            out.append([float(node), s.feature, s.bin, s.null_left, s.gain, *s.whole, *s.left, *s.right])
        yield pa.RecordBatch.from_arrays([pa.array([[float(v) for v in r] for r in out], pa.list_(pa.float64()))], names=["best"])

    tasks = max(1, min(TASKS, len(of) * many, binned.tasks))
    found = binned.rows.mapInArrow(sums, "node long, sums binary").repartition(tasks, "node").mapInArrow(pick, "best array<double>").toArrow()["best"].to_pylist()
    picked: dict[int, list[dict[int, _Best]]] = {m: [{} for _ in b.start] for m, b in models.items()}
    losses, names = {m: [math.nan, math.nan] for m in models}, list(models)
    for r in found:
        if r[0] < 0:
            losses[names[-1 - int(r[0])]] = r[1:]
        else:
            (m, k), i = of[int(r[0]) // many], int(r[0]) % many
            picked[m][k][i] = _Best(int(r[1]), int(r[2]), bool(r[3]), r[4], (r[5], r[6]), (r[7], r[8]), (r[9], r[10]))
    return picked, losses


def _shrunk(g: np.ndarray, p: Params) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - p.alpha, 0)


def _best(s: np.ndarray, p: Params, salt: int, node: int) -> _Best:
    """The best split from the sums (column, bin, 2) of a node's rows; of equal ones nulls right, then the first column and bin."""
    worth = lambda g, h: _shrunk(g, p) ** 2 / (h + p.lam)
    whole = s[0].sum(0)
    missing, known = s[:, 0], np.cumsum(s[:, 1:], 1)
    sides = np.stack([known, known + missing[:, None]])  # nulls right, nulls left
    left_g, left_h = sides[..., 0], sides[..., 1]
    right_g, right_h = whole[0] - left_g, whole[1] - left_h
    gain = 0.5 * (worth(left_g, left_h) + worth(right_g, right_h) - worth(whole[0], whole[1])) - p.gamma
    ok = (left_h >= p.min_child_weight) & (right_h >= p.min_child_weight) & (left_h > 0) & (right_h > 0)
    if p.colsample < 1:
        rng = np.random.default_rng([p.seed, salt, node])
        drawn = rng.choice(len(s), max(1, round(p.colsample * len(s))), replace=False)
        ok[:, np.setdiff1d(np.arange(len(s)), drawn)] = False
    if p.coarse:
        ok[:, :, ::2] = False
    gain = np.where(ok, gain, -np.inf)
    at = int(gain.argmax())
    if not gain.flat[at] > 1e-9:
        return _Best(-1, 0, False, 0.0, (whole[0], whole[1]))
    side, f, b = np.unravel_index(at, gain.shape)
    return _Best(int(f), int(b) + 1, bool(side), gain[side, f, b], (whole[0], whole[1]), (left_g[side, f, b], left_h[side, f, b]), (right_g[side, f, b], right_h[side, f, b]))


def _split(tree: Tree, level: int, best: dict[int, _Best], p: Params) -> bool:
    """Give the nodes of a level their splits, and values to nodes that end; whether one was split."""

    def value(g: float, h: float) -> float:
        v = float(-_shrunk(g, p) / (h + p.lam))
        return p.eta * (max(-p.max_delta_step, min(p.max_delta_step, v)) if p.max_delta_step else v)

    for i, b in best.items():
        node = 2**level - 1 + i
        if b.feature < 0:
            tree.value[node] = value(*b.whole)
            continue
        tree.feature[node], tree.bin[node], tree.null_left[node] = b.feature, b.bin, b.null_left
        tree.gain[node], tree.cover[node] = b.gain, b.whole[1]
        tree.value[2 * node + 1], tree.value[2 * node + 2] = value(*b.left), value(*b.right)
    return any(b.feature >= 0 for b in best.values())


def fit(binned: Binned, every: list[Params], stop: Callable[[int, list[tuple]], bool] | None = None, seconds: float | None = None) -> list[Booster]:
    """A model for each of the parameters, all trained in the same passes.

    stop(m, curve) may end model m after a round (its state is "pruned"); after `seconds` all that are left end ("timeout").
    Without valid rows there is nothing to wait for: a model then takes all its rounds.
    """
    k, n = len(binned.classes), sum(binned.counts)
    prior = [max(c / n, 1e-6) for c in binned.counts]
    start = [math.log(x) for x in prior] if k > 2 else [math.log(prior[1] / prior[0]) if k == 2 else 30.0]
    models = [Booster(binned.columns, binned.edges, binned.classes, start, p) for p in every]
    open_, run, began = dict(enumerate(models)), uuid.uuid4().hex, time.time()
    while open_:
        grown = {m: [Tree.of_depth(b.params.depth) for _ in b.start] for m, b in open_.items()}
        live = open_
        for level in range(max(b.params.depth for b in open_.values())):
            live = {m: b for m, b in live.items() if b.params.depth > level}
            if not live:
                break
            best, losses = _pass(binned, run, live, grown, level)
            if level == 0:
                for m, b in list(live.items()):
                    b.curve.append((len(b.trees), *losses[m], time.time() - began))
                    if _over(m, b, stop, began, seconds):
                        del live[m], open_[m]
                live = dict(live)
            splits = {m: [_split(t, level, best[m][k], b.params) for k, t in enumerate(grown[m])] for m, b in live.items()}
            live = {m: b for m, b in live.items() if any(splits[m])}
        for m, b in open_.items():
            b.trees.append(grown[m])
    return models


def _over(m: int, b: Booster, stop: Callable[[int, list[tuple]], bool] | None, began: float, seconds: float | None) -> bool:
    """Whether a model ends here; best is then its best round, the earliest of equals."""
    losses = [c[2] for c in b.curve]
    blind = any(math.isnan(x) for x in losses)
    b.best = len(b.trees) if blind else int(np.argmin(losses))
    if len(b.trees) >= b.params.rounds or not blind and len(b.trees) - b.best >= b.params.patience:
        return True
    if len(b.classes) < 2:
        return True
    if seconds is not None and time.time() - began > seconds:
        b.state = "timeout"
    elif stop is not None and stop(m, b.curve):
        b.state = "pruned"
    return b.state != "complete"


def predict(model: Booster, df: DataFrame, name: str, rounds: int | None = None) -> DataFrame:
    """df with the column `name`: the probabilities of the model's classes, in their order. Every row gets them."""
    used = model.best if rounds is None else rounds

    def run(x: pd.DataFrame) -> pd.Series:
        codes = to_codes(x.to_numpy(np.float64), model.edges)
        return pd.Series(list(probabilities(model.margins(codes, used))))

    return df.withColumn(name, F.pandas_udf(run, "array<double>")(F.struct(*_doubles(model.columns))))


def importance(spark: SparkSession, model: Booster) -> DataFrame:
    """feature, gain (share of the loss that its splits gained), weight (its splits) and cover (their mean weight of rows)."""
    seen = [(model.columns[f], float(t.gain[i]), float(t.cover[i])) for r in model.trees[: model.best] for t in r for i, f in enumerate(t.feature) if f >= 0]
    whole = sum(g for _, g, _ in seen) or 1.0
    rows = [(c, sum(x[1] for x in own) / whole, len(own), sum(x[2] for x in own) / max(len(own), 1)) for c in model.columns for own in [[x for x in seen if x[0] == c]]]
    return spark.createDataFrame(rows, "feature string, gain double, weight long, cover double")


def curve(spark: SparkSession, models: list[Booster]) -> DataFrame:
    """eta, iteration (trees so far), train_logloss, valid_logloss, seconds and whether it is the best round of its model."""
    rows = [(b.params.eta, i, float(t), float(v), float(s), i == b.best) for b in models for i, t, v, s in b.curve]
    return spark.createDataFrame(rows, "eta double, iteration int, train_logloss double, valid_logloss double, seconds double, best boolean")


def save(spark: SparkSession, model: Booster, path: str) -> None:
    spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> Booster:
    return Booster.from_json(spark.read.text(path).first()[0])
