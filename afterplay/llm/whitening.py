"""Whitening of embeddings by singular values of their centred rows.

Vectors become whole numbers, so their sums and deviations are exact. Tasks centre their rows and
reduce them block by block to a triangle by QR; triangles are reduced by QR again, 32 at a time,
until one is left. From that one, ``bidiagonal`` finds values and directions. A last pass measures
how far the covariance of the whitened rows is from the identity. All that moves is one matrix of
``dimensions`` squared a task, and the model is as small.

Defined results: a vector that is null, empty or holds null or non-finite entries takes no part; nor
does one of another length than most (the longer one of equally many). Entries beyond 2^46 count as
2^46. Null and repeated ids are rows of their own. Directions without variance (a singular value of
1e-11 of the largest, or less) cannot be whitened and are not returned, so a single row, equal rows
and an empty table give none. The sign of a direction makes its largest entry positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from afterplay.llm.bidiagonal import right_singular
from afterplay.llm.components import written

SCALE = 64
ORIGIN = 1_000_000
COMPONENTS = 32
BLOCK_ROWS = 1024
FAN_IN = 32
LARGEST = float(1 << 46)
LEAST_SHARE = 1e-11
PARTS = T.StructType(
    [
        T.StructField("part", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("data", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class Whitening:
    """``n`` rows with sums ``sums``; directions as columns, the variance along each, its share of all, and the measured error."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    error: float


def whole_numbers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, origin: int = ORIGIN) -> DataFrame:
    """``id, x`` with ``x`` the whole numbers floor(scale * c) + origin of the usable vectors."""
    doubles = vectors.select(vectors[key].alias("id"), vectors[vector].cast("array<double>").alias("c"))
    finite = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = lambda c: F.least(F.greatest(c * float(scale), F.lit(-LARGEST)), F.lit(LARGEST))
    usable = doubles.filter((F.size("c") > 0) & finite)
    return usable.select("id", F.transform("c", lambda c: F.floor(kept(c)).cast("bigint") + origin).alias("x"))


def _blocks(column: pa.Array) -> Iterator[np.ndarray]:
    """Rows of a list column as matrices, one for each length that occurs."""
    sizes = np.diff(column.offsets.to_numpy())
    for size in np.unique(sizes).tolist():
        rows = column if (sizes == size).all() else column.filter(pa.array(sizes == size))
        yield rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _reduced(rows: DataFrame, fold: Callable, join: Callable, name: str) -> list[tuple[int, int, np.ndarray]]:
    """``size, n, matrix`` per length of vectors: folded row blocks of each task, joined 32 tasks at a time.

    ``fold(held, block)`` takes up a block of rows (``held`` is None at first), ``join(a, b)`` two results.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        waiting: dict[int, list[np.ndarray]] = {}

        def take(size: int) -> None:
            block = np.concatenate(waiting.pop(size))
            n, before = held.get(size, (0, None))
            held[size] = (n + len(block), fold(before, block))

        for batch in batches:
            for block in _blocks(batch.column(0)):
                size = block.shape[1]
                waiting.setdefault(size, []).append(block)
                if sum(map(len, waiting[size])) >= BLOCK_ROWS:
                    take(size)
        for size in list(waiting):
            take(size)
        part = TaskContext.get().partitionId()
        yield _as_parts([(part, size, n, m) for size, (n, m) in sorted(held.items())])

    def of_parts(table: pa.Table) -> pa.Table:
        joined: dict[int, tuple[int, np.ndarray]] = {}
        found = sorted(_from_parts(table), key=lambda p: p[:2])
        for _, size, n, matrix in found:
            before = joined.get(size)
            joined[size] = (n, matrix) if before is None else (before[0] + n, join(before[1], matrix))
        part = found[0][0] // FAN_IN
        return pa.Table.from_batches([_as_parts([(part, size, n, m) for size, (n, m) in sorted(joined.items())])])

    parts = written(rows.select("x").mapInArrow(of_task, PARTS), name)
    most = parts.agg(F.max("part")).first()[0] or 0
    while most >= FAN_IN:
        grouped = parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(of_parts, PARTS)
        parts, most = written(grouped, name), most // FAN_IN
    # one row per length and at most 32 tasks
    last = parts.toArrow()
    return [p[1:] for p in _from_parts(of_parts(last))] if last.num_rows else []


def _as_parts(parts: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
    columns = list(zip(*parts)) or [(), (), (), ()]
    data = [m.tobytes() for m in columns[3]]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*columns[:3], data], kinds)], PARTS.names)


def _from_parts(table: pa.Table) -> list[tuple[int, int, int, np.ndarray]]:
    """Parts as ``part, size, n, matrix``; sums are whole numbers in one row, all else has ``size`` columns."""
    out = []
    for part, size, n, data in zip(*(table.column(c).to_pylist() for c in PARTS.names)):
        out.append((part, size, n, np.frombuffer(data).reshape(-1, size)))
    return out


def _sums(held: np.ndarray | None, block: np.ndarray) -> np.ndarray:
    """Sums in two rows of doubles, of the high and of the low 24 bits, each exact for 2^29 rows a task and 2^53 in all."""
    high = block >> 24
    found = np.stack([high.sum(0), (block - (high << 24)).sum(0)]).astype(float)
    return found if held is None else held + found


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact: as 64-bit numbers where they suffice, else as Python's."""
    if float(np.abs(x).max(initial=0)) * n * 2 < 2**62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``id, x``; None without usable rows."""
    found = _reduced(rows, _sums, np.add, "whitening-sums")
    if not found:
        return None
    size, n, halves = max(found, key=lambda f: (f[1], f[0]))
    sums = np.array([(int(h) << 24) + int(low) for h, low in zip(*halves)], dtype=object)
    rows = rows.filter(F.size("x") == size)

    def triangle(held: np.ndarray | None, block: np.ndarray) -> np.ndarray:
        y = (centred(block, n, sums) / n).astype(float)
        return np.linalg.qr(y if held is None else np.vstack([held, y]), mode="r")

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.vstack([a, b]), mode="r")

    ((_, _, r),) = _reduced(rows, triangle, joined, "whitening-triangles")
    square = np.vstack([r, np.zeros((max(0, size - len(r)), size))])
    values, directions, total = right_singular(square, components)
    kept = values > values.max(initial=0) * LEAST_SHARE**2
    values, directions = values[kept], directions[:, kept]
    largest = np.abs(directions).argmax(axis=0)
    directions = directions * np.sign(directions[largest, np.arange(len(values))])
    model = Whitening(n, sums, directions, values / n, values / total if total else values, 0.0)
    return Whitening(n, sums, directions, model.variances, model.explained, identity_error(rows, model))


def whiten(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whitened rows, and ``n * x - sums`` behind them."""
    far = centred(x, model.n, model.sums)
    return (far / model.n).astype(float) @ model.directions / np.sqrt(model.variances), far


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    k = len(model.variances)
    if not k:
        return 0.0

    def moments(held: np.ndarray | None, block: np.ndarray) -> np.ndarray:
        w, _ = whiten(model, block)
        found = np.zeros((-(-(k * k + k) // block.shape[1]), block.shape[1]))
        found.flat[: k * k + k] = np.concatenate([(w.T @ w).ravel(), w.sum(0)])
        return found if held is None else held + found

    ((_, n, found),) = _reduced(rows, moments, np.add, "whitening-moments")
    mean = found.flat[k * k : k * k + k] / n
    covariance = found.flat[: k * k].reshape(k, k) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` per row and component."""
    rows = rows.filter(F.size("x") == len(model.sums))
    k = len(model.variances)
    fields = T.StructType.fromDDL("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    schema = T.StructType([rows.schema["id"], *fields.fields])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(model.sums))
            w, far = whiten(model, x)
            if far.dtype == object or float(np.abs(far).max(initial=0)) ** 2 * far.shape[1] >= 2**62:
                far = far.astype(object)
            deviation = pa.array((far * far).sum(1).tolist() if far.dtype == object else (far * far).sum(1), pa.decimal128(38, 0) if far.dtype == object else None)
            many = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(many)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(many), model.n)),
                    deviation.cast(pa.decimal128(38, 0)).take(pa.array(many)),
                    pa.array(w.ravel()),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(many), model.error)),
                ],
                schema.names,
            )

    return rows.mapInArrow(project, schema)
