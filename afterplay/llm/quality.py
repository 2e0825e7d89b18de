"""A quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Statistics are counted with numpy inside the tasks. The trees are fitted on the driver from a
bounded sample of labelled rows (``FIT_ROWS``), of which only the statistics are collected, and
are flattened into arrays: all trees have the same depth, so a batch goes down one level of a
tree in one step.

Defined results: null and empty texts have all statistics 0 and get a score like any text. An
empty table gives no rows. With no label, or labels of one kind, every score is that kind's
share (0.5 with none). Repeated and null ids are scored each; labels are met by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from afterplay.llm.words import SPACE, blocks, hash_rows, text_buffer

FIT_ROWS = 20_000
KINDS = {
    "digit": b"0123456789",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "mark": b".,;:!?'\"()-",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "line": b"\n",
    "shout": b"!",
    "table": b"|",
}
NAMES = (
    "log_bytes", "log_words", "word_bytes", "spaces", "wide", *KINDS,
    "distinct", "top_word", "repeated_next", "repeated_pair", "upper_words",
)
_CLASS = np.zeros((len(KINDS) + 1, 256), np.float32)
for _i, _kind in enumerate(KINDS.values()):
    _CLASS[_i, list(_kind)] = 1
_CLASS[-1, 128:] = 1


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    data, offsets = text_buffer(column)
    out = np.zeros((len(column), len(NAMES)), np.float32)
    for row, end in blocks(offsets):
        a, bounds = data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        size = np.diff(bounds)
        if not len(a):
            continue
        filled = np.flatnonzero(size)
        shares = np.zeros((end - row, len(_CLASS)), np.float64)
        for i, table in enumerate(_CLASS):
            shares[filled, i] = np.add.reduceat(table[a], bounds[:-1][filled])
        upper, space = (a >= 65) & (a <= 90), SPACE[a].astype(np.int64)
        capitals = np.append(upper[:-1] & upper[1:], False).astype(np.int64)
        words, first = hash_rows(a, bounds)
        count, whole = np.diff(first), np.maximum(size, 1)
        spaces = np.zeros(end - row)
        spaces[filled] = np.add.reduceat(space, bounds[:-1][filled])
        block = out[row:end]
        block[:, 0], block[:, 1] = np.log1p(size), np.log1p(count)
        block[:, 2] = (size - spaces) / np.maximum(count, 1)
        block[:, 3], block[:, 4] = spaces / whole, shares[:, -1] / whole
        block[:, 5 : 5 + len(KINDS)] = shares[:, :-1] / whole[:, None]
        block[filled, 17] = np.add.reduceat(capitals, bounds[:-1][filled]) / size[filled]
        for i in np.flatnonzero(count):
            own = words[first[i] : first[i + 1]]
            distinct, times = np.unique(own, return_counts=True)
            block[i, 13] = len(distinct) / len(own)
            block[i, 14] = times.max() / len(own)
            if len(own) > 1:
                block[i, 15] = np.mean(own[1:] == own[:-1])
                pairs = own[1:] * np.uint64(3) + own[:-1]
                block[i, 16] = 1 - len(np.unique(pairs)) / len(pairs)
    return out


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth as arrays; node n has the children 2n + 1 and 2n + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64,
    rate: float = 0.15, ridge: float = 1.0,
) -> Trees:
    """Boost the logistic loss. Splits are sought in one histogram per node and feature."""
    share = float(y.mean()) if len(y) else 0.5
    inner, leaves = 2**depth - 1, 2**depth
    if not len(y) or share in (0.0, 1.0):
        base = 40.0 * (2 * share - 1)
        return Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], 1)
    n, width = x.shape
    slots = binned + np.arange(width) * bins
    raw = np.full(n, np.log(share / (1 - share)))
    base = float(raw[0])
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, curvature = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            key = ((node - first)[:, None] * (width * bins) + slots).ravel()
            shape = (many, width, bins)
            g, h = (
                np.bincount(key, np.repeat(v, width), many * width * bins).reshape(shape).cumsum(2)
                for v in (gradient, curvature)
            )
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            for f, c in enumerate(cuts):
                gain[:, f, len(c) :] = -1
            best = gain.reshape(many, -1).argmax(1)
            for i, at in enumerate(best):
                f, b = divmod(int(at), bins)
                if gain[i, f, b] > 1e-9:
                    feature[first + i], threshold[first + i] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, curvature, leaves) + ridge)
        raw += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and an array of the statistics of ``text``."""
    rows = docs.select(*[docs[k] for k in keep], docs["text"].cast("string").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("statistics", T.ArrayType(T.FloatType()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(batch.num_columns - 1))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES))
            lists = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], schema.names)

    return rows.mapInArrow(count, schema)


def train(counted: DataFrame, labels: DataFrame, usable: Column, fit_rows: int = FIT_ROWS) -> Trees:
    """Fit on at most ``fit_rows`` labelled rows, those with the smallest hash of their id.

    ``counted`` has ``doc_id`` and ``statistics``; null labels teach nothing.
    """
    marked = labels.select(F.col("doc_id").alias("_of"), F.col("quality").cast("int").alias("_mark"))
    rows = (
        counted.filter(usable)
        .join(marked.filter("_mark IN (0, 1)"), F.col("doc_id") == F.col("_of"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_mark", "statistics")
        .limit(fit_rows)
        .select("statistics", "_mark")
        .collect()
    )
    x = np.array([r.statistics for r in rows], np.float32).reshape(-1, len(NAMES))
    return fit(x, np.array([r._mark for r in rows], float))


def score(counted: DataFrame, trees: Trees) -> DataFrame:
    """``counted`` with its ``statistics`` replaced by a ``score`` from 0 to 1."""
    names = [c for c in counted.columns if c != "statistics"]
    rows = counted.select(*names, "statistics")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(trees.score(x))], schema.names)

    return rows.mapInArrow(judge, schema)


def keep_good(docs: DataFrame, trees: Trees, least: float) -> DataFrame:
    """The documents that score ``least`` or more, scored in the pass that filters them."""
    schema, text = docs.schema, docs.columns.index("text")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = trees.score(statistics(batch.column(text).cast(pa.string()))) >= least
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(choose, schema)
