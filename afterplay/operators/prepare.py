"""From feature tables to model input: target, cleaning, selection, scaling, checks.

What is fitted is small (a few numbers per column) and comes from aggregates that combine
map-side, many columns per pass. It is applied as literal expressions, so preparing a
table of any size takes no shuffle and no join.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field, replace
from itertools import combinations
from math import isfinite

from pyspark.sql import Column, DataFrame, functions as F

from afterplay.functions.numbers import finite_or_zero, is_infinite, not_nan
from afterplay.sources.readers import TEXT_COLUMNS, coerce_numeric

# Thresholds of the checks.
COLLINEAR_ABOVE = 0.95
TINY_VARIANCE = 1e-10
ID_DISTINCT_RATIO = 0.8
ID_MEAN_LENGTH = 10
LOW_SCALED_VARIANCE = 1e-6
HIGH_SCALED_CORRELATION = 0.8
MIN_CLASS_ROWS = 10
MIN_CLASS_RATIO = 0.01

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")

# Text that means true or false.
TRUE_TEXT = ("True", "true", "1", "1.0")
FALSE_TEXT = ("False", "false", "0", "0.0")


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind in NUMERIC or kind.startswith("decimal")]


# Target ---------------------------------------------------------------------------------


def target_to_binary(target: Column) -> Column:
    """0/1 of the known texts; any other text that is not empty counts as 1."""
    text = target.cast("string")
    known = F.when(text.isin(*TRUE_TEXT), True).when(text.isin(*FALSE_TEXT), False)
    return F.coalesce(known, text != "").cast("int")


def target_strict(target: Column) -> Column:
    """True or false of the known texts; any other value fails the job."""
    text = target.cast("string")
    return (
        F.when(text.isin(*TRUE_TEXT), True)
        .when(text.isin(*FALSE_TEXT), False)
        .otherwise(F.raise_error(F.concat(F.lit("not a target: "), F.coalesce(text, F.lit("null")))).cast("boolean"))
    )


def drop_null_target(df: DataFrame, target: str = "churned") -> DataFrame:
    return df.dropna(subset=[target])


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


# Columns --------------------------------------------------------------------------------


def id_column_report(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per text column: share of distinct values, mean length, and whether it looks like an id.

    Exact distinct counts shuffle every distinct value once; sketches of a few percent
    error (``exact=False``) shuffle none.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    text = [name for name, kind in df.dtypes if kind == "string"]
    n = F.count(F.lit(1))
    aggregates = [n.alias("n")]
    for i, name in enumerate(text):
        shown = F.coalesce(F.col(name), F.lit("None"))
        aggregates += [distinct(name).alias(f"d{i}"), F.sum(F.length(shown)).alias(f"l{i}")]
    rows = []
    for i, name in enumerate(text):
        ratio = F.col(f"d{i}") / F.col("n")
        length = F.col(f"l{i}") / F.col("n")
        is_id = F.lit(name in TEXT_COLUMNS) | ((ratio > ID_DISTINCT_RATIO) & (length > ID_MEAN_LENGTH))
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                ratio.alias("distinct_ratio"),
                length.alias("mean_length"),
                F.coalesce(is_id, F.lit(False)).alias("is_id"),
            )
        )
    if not rows:
        schema = "column_name string, distinct_ratio double, mean_length double, is_id boolean"
        return df.sparkSession.createDataFrame([], schema)
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def detect_id_columns(df: DataFrame) -> list[str]:
    """Columns that identify rows. The known names need no look at the data."""
    named = [c for c in df.columns if c in TEXT_COLUMNS]
    others = df.drop(*named)
    if not any(kind == "string" for _, kind in others.dtypes):
        return named
    return named + [r.column_name for r in id_column_report(others).collect() if r.is_id]


def clean_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Infinite, NaN and null values of the feature columns become 0."""
    kinds = dict(df.dtypes)
    return df.select(
        *[finite_or_zero(F.col(c)).cast(kinds[c]).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def dirty_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Infinite and missing values per column, all columns in one pass."""
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        aggregates += [
            F.count_if(is_infinite(value)).alias(f"inf_{c}"),
            F.count_if(value.isNull() | F.isnan(value)).alias(f"nan_{c}"),
        ]
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"inf_{c}").alias("infinite"), F.col(f"nan_{c}").alias("missing"))
        for c in columns
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def exact_medians(df: DataFrame, columns: list[str], in_memory: int = 200_000) -> dict[str, float | None]:
    """The median of each column; null for a column without values.

    The built-in exact median keeps every distinct value of a column in one task, so it
    is used for columns with at most ``in_memory`` values. Above that, quantile sketches
    narrow down the range of values that holds the middle ranks, counts confirm it, and
    only the confirmed range is looked at. Each pass handles all columns.
    """
    values = {c: not_nan(F.col(c).cast("double")) for c in columns}
    if not columns:
        return {}
    infinite = F.lit(float("inf"))
    counts = df.agg(
        *[F.struct(F.count(v), F.count_if(v == -infinite), F.count_if(v == infinite)).alias(f"c{i}") for i, v in enumerate(values.values())]
    ).first()
    sizes, negative, positive = ({c: row[k] for c, row in zip(values, counts)} for k in range(3))
    small = [c for c in columns if sizes[c] <= in_memory]
    medians: dict[str, float | None] = {}
    if small:
        medians |= df.agg(*[F.median(values[c]).alias(c) for c in small]).first().asDict()
    # infinite values take part as the largest finite ones, so that every range can be halved
    most = sys.float_info.max
    for c in columns:
        if negative[c] or positive[c]:
            values[c] = F.least(F.greatest(values[c], F.lit(-most)), F.lit(most))
    pending = {
        c: _Bracket(ranks=((sizes[c] - 1) // 2, sizes[c] // 2), inside=sizes[c]) for c in columns if c not in medians
    }
    while pending:
        before = {c: (b.low, b.high, b.inside) for c, b in pending.items()}
        _narrow(df, values, pending, in_memory)
        stuck = [c for c, b in pending.items() if before[c] == (b.low, b.high, b.inside)]
        if stuck:
            raise RuntimeError(f"the range of the median does not shrink for {stuck}")
        done = {c: b for c, b in pending.items() if b.inside <= in_memory or b.low == b.high}
        if done:
            medians |= _medians_inside(df, values, done)
        pending = {c: b for c, b in pending.items() if c not in done}
    for c in columns:
        # a median is infinite if a middle value is, and there is none between both infinities
        low, high = (sizes[c] - 1) // 2 < negative[c], sizes[c] // 2 >= sizes[c] - positive[c]
        if sizes[c] and (low or high):
            medians[c] = float("nan") if low and high else float("-inf") if low else float("inf")
    return medians


@dataclass
class _Bracket:
    """A closed range of values that holds both middle ranks."""

    ranks: tuple[int, int]
    inside: int
    below: int = 0
    low: float = float("-inf")
    high: float = float("inf")

    def holds(self, value: Column) -> Column:
        return value.between(F.lit(self.low), F.lit(self.high))


def _narrow(df: DataFrame, values: dict[str, Column], pending: dict[str, _Bracket], in_memory: int) -> None:
    accuracy = 2_000
    sketches = []
    for c, b in pending.items():
        lower = max((b.ranks[0] - b.below) / b.inside - 2 / accuracy, 0.0)
        upper = min((b.ranks[1] - b.below) / b.inside + 2 / accuracy, 1.0)
        inside = F.when(b.holds(values[c]), values[c])
        sketches.append(F.percentile_approx(inside, [lower, upper], accuracy).alias(c))
    ranges = df.agg(*sketches).first().asDict()
    counts = []
    for c in pending:
        low, high = ranges[c]
        counts += [
            F.count_if(values[c] < low).alias(f"below_{c}"),
            F.count_if(values[c] <= high).alias(f"upto_{c}"),
            F.min(F.when(values[c] > low, values[c])).alias(f"next_{c}"),
        ]
    found = df.agg(*counts).first().asDict()
    for c, b in pending.items():
        low, high = ranges[c]
        below, upto = found[f"below_{c}"], found[f"upto_{c}"]
        before = (b.low, b.high)
        if below <= b.ranks[0] < upto:
            b.low, b.below = low, below
        if below <= b.ranks[1] < upto:
            b.high = high
        if b.high == high and b.low == low:
            b.inside = upto - below
        if (b.low, b.high) == before:  # one value fills most of the range: halve it instead
            _halve(df, values[c], b)


def _halve(df: DataFrame, value: Column, b: _Bracket) -> None:
    if b.low == float("-inf") or b.high == float("inf"):
        ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
        b.low, b.high = max(b.low, ends.low), min(b.high, ends.high)
    middle = b.low / 2 + b.high / 2
    row = df.agg(
        F.count_if(value <= middle).alias("upto"),
        F.max(F.when(b.holds(value) & (value <= middle), value)).alias("left"),
        F.min(F.when(b.holds(value) & (value > middle), value)).alias("right"),
    ).first()
    if row.upto > b.ranks[1]:
        b.high, b.inside = row.left, row.upto - b.below
    elif row.upto <= b.ranks[0]:
        b.low, b.inside, b.below = row.right, b.inside - (row.upto - b.below), row.upto
    else:  # the two middle ranks lie on either side
        b.low, b.high = row.left, row.right
        b.below, b.inside = row.upto - 1, 2
        b.ranks = (b.below, b.below + 1)


def _medians_inside(
    df: DataFrame, values: dict[str, Column], done: dict[str, _Bracket]
) -> dict[str, float | None]:
    picked = []
    for c, b in done.items():
        if b.low == b.high:
            picked.append(F.array(F.lit(b.low), F.lit(b.low)).alias(c))
            continue
        if b.inside == 2 and b.ranks == (b.below, b.below + 1):
            picked.append(F.array(F.lit(b.low), F.lit(b.high)).alias(c))
            continue
        shares = [(r - b.below) / max(b.inside - 1, 1) for r in b.ranks]
        inside = F.when(b.holds(values[c]), values[c])
        picked.append(F.percentile(inside, F.array(*[F.lit(s) for s in shares])).alias(c))
    row = df.agg(F.count(F.lit(1)).alias("_n"), *picked).first()
    middle = {c: (row[c][0], row[c][1]) for c in done}
    # the sum of two very large values has no number
    return {c: (a + b) / 2 if abs(a) + abs(b) < float("inf") else a / 2 + b / 2 for c, (a, b) in middle.items()}


def impute(df: DataFrame, fills: dict[str, float | None]) -> DataFrame:
    """NaN and null to the given value of the column, or to 0 where there is none."""
    columns = []
    for c in df.columns:
        if c in fills:
            fill = 0.0 if fills[c] is None else float(fills[c])
            columns.append(F.coalesce(not_nan(F.col(c).cast("double")), F.lit(fill)).alias(c))
        else:
            columns.append(F.col(c))
    return df.select(*columns)


def constant_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column whether it is constant: at most one value, or two that hardly differ.

    A count of distinct values would shuffle every value of every column. The extremes
    tell whether there are at least two values, and ``between`` whether there is a third.
    """
    values = {c: not_nan(F.col(c).cast("double")) for c in columns}
    extremes = df.agg(
        *[F.min(v).alias(f"lo_{c}") for c, v in values.items()], *[F.max(v).alias(f"hi_{c}") for c, v in values.items()]
    ).first()
    aggregates, rows = [], []
    for c, v in values.items():
        low, high = extremes[f"lo_{c}"], extremes[f"hi_{c}"]
        third = F.lit(False) if low is None else (v > low) & (v < high)
        aggregates += [F.count_if(third).alias(f"third_{c}"), F.var_samp(v).alias(f"var_{c}")]
        kinds = F.lit(0 if low is None else 1 if low == high else 2) + (F.col(f"third_{c}") > 0).cast("int")
        constant = (kinds <= 1) | ((kinds == 2) & (F.col(f"var_{c}") < TINY_VARIANCE))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.least(kinds, F.lit(3)).alias("values_up_to_3"),
                F.coalesce(constant, F.lit(False)).alias("is_constant"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def constant_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [r.column_name for r in constant_report(df, columns).collect() if r.is_constant] if columns else []


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson's r of every pair of columns, all pairs in one pass."""
    pairs = list(combinations(columns, 2))
    values = {c: not_nan(F.col(c).cast("double")) for c in columns}
    aggregates, rows = [], []
    for i, (a, b) in enumerate(pairs):
        aggregates.append(F.corr(values[a], values[b]).alias(f"r{i}"))
        rows.append(F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"r{i}").alias("r")))
    if not rows:
        return df.sparkSession.createDataFrame([], "left string, right string, r double")
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def collinear_drops(pairs: DataFrame, threshold: float = COLLINEAR_ABOVE) -> DataFrame:
    """Of each too similar pair, the name that sorts last."""
    return (
        pairs.filter(F.abs("r") > threshold).select(F.greatest("left", "right").alias("column_name")).distinct()
    )


# Fitting --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Preparation:
    """Everything learned from a training table."""

    features: list[str]
    fills: dict[str, float | None]
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)
    dropped: dict[str, list[str]] = field(default_factory=dict)

    def apply(self, df: DataFrame, scale: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
        """The features, filled and scaled, next to the columns to keep."""
        numbers = coerce_numeric(df, keep=(*TEXT_COLUMNS, *keep))
        filled = impute(numbers, {f: self.fills.get(f) for f in self.features})
        columns = [F.col(c) for c in keep]
        for f in self.features:
            value = F.col(f)
            if scale:
                value = (value - F.lit(self.means[f])) / F.lit(self.deviations[f])
            columns.append(value.alias(f))
        return filled.select(*columns)


def scaling_of(df: DataFrame, columns: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Mean and population deviation; a column that does not vary is divided by 1."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    ).first()
    means = {c: row[f"m_{c}"] or 0.0 for c in columns}
    return means, {c: row[f"s_{c}"] or 1.0 for c in columns}


def with_scaling(train: DataFrame, chosen: Preparation) -> Preparation:
    filled = impute(coerce_numeric(train), chosen.fills)
    means, deviations = scaling_of(filled, chosen.features)
    return replace(chosen, means=means, deviations=deviations)


@dataclass(frozen=True)
class _Extent:
    """Number of values of a column, of gaps, and the range and mean of the values."""

    n: int
    missing: int
    low: float | None
    high: float | None
    mean: float

    @property
    def is_constant(self) -> bool:
        return self.low is None or self.low == self.high

    @property
    def could_hardly_vary(self) -> bool:
        """With this range, two values alone might stay below the smallest variance."""
        return not self.is_constant and (self.high - self.low) ** 2 < 2 * TINY_VARIANCE * (self.n + self.missing)


def _extents(df: DataFrame, columns: list[str]) -> dict[str, _Extent]:
    values = {c: not_nan(F.col(c).cast("double")) for c in columns}
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, v in enumerate(values.values()):
        aggregates += [
            F.count(v).alias(f"n{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
            F.avg(v).alias(f"m{i}"),
        ]
    row = df.agg(*aggregates).first()
    return {
        c: _Extent(row[f"n{i}"], row["rows"] - row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"m{i}"] or 0.0)
        for i, c in enumerate(columns)
    }


@dataclass(frozen=True)
class _Moments:
    means: dict[str, float]
    deviations: dict[str, float]
    correlations: dict[tuple[str, str], float]


def _moments(df: DataFrame, centers: dict[str, float]) -> _Moments:
    """Means, deviations and all correlations of columns without gaps, in one pass.

    Plain sums of products about a known center: one number per pair, and none of the
    cancellation that sums about zero would suffer.
    """
    columns = list(centers)
    shifted = {c: F.col(c).cast("double") - F.lit(centers[c]) for c in columns}
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(shifted[c]).alias(f"s{i}") for i, c in enumerate(columns)],
        *[F.sum(shifted[a] * shifted[b]).alias(f"p{i}") for i, (a, b) in enumerate(pairs)],
    ).first()
    n = row["n"]
    offsets = {c: (row[f"s{i}"] or 0.0) / max(n, 1) for i, c in enumerate(columns)}
    joint = {
        (a, b): (row[f"p{i}"] or 0.0) / max(n, 1) - offsets[a] * offsets[b] for i, (a, b) in enumerate(pairs)
    }
    spread = {c: max(joint[c, c], 0.0) ** 0.5 for c in columns}
    correlations = {
        (a, b): joint[a, b] / (spread[a] * spread[b]) for a, b in pairs if a != b and spread[a] and spread[b]
    }
    means = {c: centers[c] + offsets[c] for c in columns}
    return _Moments(means, {c: spread[c] or 1.0 for c in columns}, correlations)


def fit_preparation(train: DataFrame, target: str = "churned", threshold: float = COLLINEAR_ABOVE) -> Preparation:
    """Drop ids, constants and collinear columns; learn fills and scaling.

    Two passes over the table, and one more for the medians of columns with gaps. A median
    lies within the range of its column, so filling changes no range.
    """
    numbers = coerce_numeric(train)
    ids = detect_id_columns(train)
    candidates = [c for c in train.columns if c != target and c not in ids]
    extents = _extents(numbers, candidates) if candidates else {}
    medians = exact_medians(numbers, [c for c, e in extents.items() if e.missing and e.n])
    fills = {c: medians.get(c) for c in candidates}
    filled = impute(numbers, fills)
    doubtful = [c for c, e in extents.items() if e.could_hardly_vary]
    constants = [c for c, e in extents.items() if e.is_constant] + constant_columns(filled, doubtful)
    varying = [c for c in candidates if c not in constants]
    if not varying:
        raise ValueError("no feature columns remain")
    centers = {c: extents[c].mean if isfinite(extents[c].mean) else 0.0 for c in varying}
    moments = _moments(filled, centers)
    collinear = sorted({max(pair) for pair, r in moments.correlations.items() if abs(r) > threshold})
    kept = [c for c in varying if c not in collinear]
    return Preparation(
        kept,
        {c: fills[c] for c in kept},
        {c: moments.means[c] for c in kept},
        {c: moments.deviations[c] for c in kept},
        {"id": ids, "constant": constants, "collinear": collinear},
    )


def fit_separately(
    train: DataFrame, held_out: DataFrame, target: str = "churned", threshold: float = COLLINEAR_ABOVE
) -> tuple[Preparation, Preparation]:
    """Clean each table by itself, keep the shared features, scale both as the training table."""
    first, second = (fit_preparation(df, target, threshold) for df in (train, held_out))
    shared = [c for c in first.features if c in second.features]
    if not shared:
        raise ValueError("no common features")
    means, deviations = ({c: d[c] for c in shared} for d in (first.means, first.deviations))
    return tuple(
        Preparation(shared, {c: p.fills[c] for c in shared}, means, deviations, p.dropped) for p in (first, second)
    )


# Checks ---------------------------------------------------------------------------------


def scaling_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per scaled column: gaps, infinities, mean, sample deviation and whether they are right."""
    aggregates, rows = [], []
    for c in columns:
        value = F.col(c)
        aggregates += [
            F.count_if(value.isNull() | F.isnan(value)).alias(f"n_{c}"),
            F.count_if(is_infinite(value)).alias(f"i_{c}"),
            F.avg(value).alias(f"m_{c}"),
            F.stddev_samp(value).alias(f"s_{c}"),
        ]
        mean, deviation = F.col(f"m_{c}"), F.col(f"s_{c}")
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                (F.col(f"n_{c}") > 0).alias("has_missing"),
                (F.col(f"i_{c}") > 0).alias("has_infinite"),
                (deviation * deviation < LOW_SCALED_VARIANCE).alias("low_variance"),
                (F.abs(mean) <= 1e-6).alias("centered"),
                (F.abs(deviation - 1) <= 1e-3 + 1e-5).alias("unit_deviation"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def quality_gate(df: DataFrame, columns: list[str], target: str = "churned") -> DataFrame:
    """One row per check: what it found, and whether that fails, warns or passes."""
    infinite = sum((F.count_if(is_infinite(F.col(c).cast("double"))) for c in columns), F.lit(0))
    missing = sum(
        (F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))) for c in columns), F.lit(0)
    )
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        infinite.alias("infinite"),
        missing.alias("missing"),
        F.count_if(F.col(target).isNull()).alias("no_target"),
        F.count_if(F.col(target) == 0).alias("zeros"),
        F.count_if(F.col(target) == 1).alias("ones"),
    )
    few = F.least(F.when(F.col("zeros") > 0, F.col("zeros")), F.when(F.col("ones") > 0, F.col("ones")))
    many = F.greatest("zeros", "ones")
    checks = [
        ("empty", F.col("rows"), F.col("rows") == 0, "fail"),
        ("infinite", F.col("infinite"), F.col("infinite") > 0, "fail"),
        ("missing", F.col("missing"), F.col("missing") > 0, "fail"),
        ("missing_target", F.col("no_target"), F.col("no_target") > 0, "fail"),
        ("small_class", few, few < MIN_CLASS_ROWS, "warn"),
        ("class_balance", few, few / many < MIN_CLASS_RATIO, "warn"),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(found, F.lit(0)).cast("bigint").alias("found"),
            F.when(F.coalesce(hit, F.lit(False)), level).otherwise("pass").alias("outcome"),
        )
        for name, found, hit, level in checks
    ]
    return totals.select(F.inline(F.array(*rows)))


def passes_gate(gate: DataFrame) -> bool:
    return gate.filter("outcome = 'fail'").isEmpty()


@dataclass(frozen=True)
class MatrixCheck:
    """What is wrong with a matrix, and its rows per class."""

    problems: list[str]
    zeros: int = 0
    ones: int = 0

    @property
    def concerns(self) -> list[str]:
        few, many = sorted((self.zeros, self.ones))
        found = []
        if few < MIN_CLASS_ROWS:
            found.append(f"a class has {few} rows")
        if many and few / many < MIN_CLASS_RATIO:
            found.append(f"classes are {few} to {many}")
        return found


def check_matrix(
    df: DataFrame, columns: list[str], target: str | None = None, fitted: list[str] | None = None
) -> MatrixCheck:
    """Reasons not to train on or predict from a table; none for a sound one.

    The schema is checked first, so a table of the wrong shape costs no job.
    """
    problems = []
    if fitted is not None and columns != fitted:
        missing = [c for c in fitted if c not in columns]
        extra = [c for c in columns if c not in fitted]
        problems.append(f"features differ, missing {missing}, extra {extra}")
    text = [c for c in columns if c not in numeric_columns(df)]
    if text:
        problems.append(f"not numeric: {text}")
    if problems:
        return MatrixCheck(problems)
    aggregates, checks = _matrix_checks(columns, target)
    row = df.agg(*aggregates).select("*", F.array(*[c.alias("c") for _, _, c in checks]).alias("failed")).first()
    problems = [f"{name}: {c}" for (name, c, _), failed in zip(checks, row.failed) if failed]
    return MatrixCheck(problems, row.t_zero, row.t_one) if target else MatrixCheck(problems)


def matrix_validation(df: DataFrame, columns: list[str], target: str | None = None) -> DataFrame:
    """All data checks of a matrix in one pass: rows, gaps, infinities, a 0/1 target with both."""
    aggregates, checks = _matrix_checks(columns, target)
    structs = [
        F.struct(F.lit(name).alias("check_name"), F.lit(c).alias("column_name"), failed.alias("failed"))
        for name, c, failed in checks
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*structs)))


def _matrix_checks(columns: list[str], target: str | None) -> tuple[list[Column], list[tuple[str, str, Column]]]:
    aggregates = [F.count(F.lit(1)).alias("rows")]
    checks = [("empty", "*", F.col("rows") == 0)]
    for c in columns:
        value = F.col(c).cast("double")
        aggregates += [
            F.count_if(value.isNull() | F.isnan(value)).alias(f"n_{c}"),
            F.count_if(is_infinite(value)).alias(f"i_{c}"),
        ]
        checks += [("missing", c, F.col(f"n_{c}") > 0), ("infinite", c, F.col(f"i_{c}") > 0)]
    if target is not None:
        label = F.col(target).cast("double")
        aggregates += [
            F.count_if(label.isNull()).alias("t_null"),
            F.count_if(label == 0).alias("t_zero"),
            F.count_if(label == 1).alias("t_one"),
        ]
        only_both = (F.col("t_zero") > 0) & (F.col("t_one") > 0) & (F.col("t_zero") + F.col("t_one") == F.col("rows"))
        checks += [("missing", target, F.col("t_null") > 0), ("not_binary", target, ~only_both)]
    return aggregates, checks


# Weights --------------------------------------------------------------------------------


def class_weights(df: DataFrame, target: str = "churned") -> DataFrame:
    """``n / (classes * n_class)`` per class."""
    counts = {r[target]: r["n"] for r in df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    rows = [(value, n, total / (len(counts) * n)) for value, n in counts.items()]
    kind = dict(df.dtypes)[target]
    return df.sparkSession.createDataFrame(rows, f"{target} {kind}, n bigint, weight double")


def weigh_rows(df: DataFrame, weights: DataFrame, target: str = "churned", column: str = "weight") -> DataFrame:
    """Each row with the weight of its class, as literals."""
    weight = F.lit(None).cast("double")
    for row in weights.collect():
        weight = F.when(F.col(target).eqNullSafe(F.lit(row[target])), row.weight).otherwise(weight)
    return df.withColumn(column, weight)
