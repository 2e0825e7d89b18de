"""N-gram Jaccard join by filtering under several global token orders.

A document is the set of its distinct shingles of five words. If two sets are to overlap by
75%, then under *any* order of all shingles the first ``n - ceil(0.75 n) + l`` of each share
``l`` at least; ``l`` is 1 and 10% of the smaller set. Three orders are used. Under the first, sets
that share a prefix shingle meet in a bucket; a set that does not share enough of its prefix with
others is left out, and so is a pair. What is left is verified only if its prefixes share enough
under the other orders too. In each order shingles that many texts share come last, so that common passages are
seldom in a prefix.

Links are needed only between components, which keeps the work away from all pairs:

* Equal sets are one class from the start.
* How many of the sets that are left share a shingle is then known, and gives the order under
  which they meet in buckets: what few share comes first.
* A bucket compares its members with one pivot. What links becomes one component. This is
  repeated with new pivots for the buckets that still hold several components.
* Last, the buckets that still hold several components are compared in blocks of sets. Blocks
  meet if they share such a bucket, and a set travels once for each block that its own meets, not
  once for each partner. A task filters by size and by the shared prefixes under every order,
  verifies what is left, and gives one link for each two components that it joins. So no link
  between components is missed, with no limit on partners.

Sets are compared by 64-bit hashes of the shingles. What a task holds is bounded: the most
frequent shingles (``COMMON_LIMIT``) and a bitmap of the classes in some bucket
(``bitmap.BITMAP_BITS``). Both only order or prefilter; any value of them gives the same components.

Defined results: null, empty and blank texts have an empty set and link with nothing, not even
with each other. Texts with fewer than five words are one shingle, the whole sequence. Rows with
the same id are one document each; a null id takes part, and a component's id is its least
non-null id. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from afterplay.llm.arrow import gathered, most_frequent, small_batches
from afterplay.llm.bitmap import bitmap_of, in_bitmap
from afterplay.llm.components import discard, merged, written
from afterplay.llm.words import hashed, mixed

WORD = r"[^\x20\x09-\x0D]"
WORDS = 5
PERCENT = 75
SHARED_PERCENT = 10
ORDERS = 3
PIVOT_ROUNDS = 2
BLOCK_SETS = 1024
BLOCK_SHINGLES = 1 << 20
COMMON_LEAST = 48
COMMON_LIMIT = 1 << 20
FLUSH = 1 << 21
KNOWN_CLASSES = 1 << 20


def shingles(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence, if it is shorter."""
    if len(words) < width:
        h = np.full(1, len(words), np.uint64)
        for word in words:
            h = mixed(h ^ word, 77)
        return h if len(words) else np.zeros(0, np.uint64)
    many = len(words) - width + 1
    h = words[:many]
    for i in range(1, width):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[i : i + many]
    return mixed(h, 5)


class Sets:
    """The sets of a block of texts: ``values[bounds[i]:bounds[i + 1]]``, sorted and distinct."""

    def __init__(self, words: np.ndarray, first: np.ndarray):
        run = shingles(words) if len(words) >= WORDS else np.zeros(0, np.uint64)
        parts = []
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            if hi - lo < WORDS:
                parts.append(shingles(words[lo:hi]))
                continue
            own = np.sort(run[lo : hi - WORDS + 1])
            new = own[1:] != own[:-1]
            parts.append(own if new.all() else own[np.append(True, new)])
        sizes = np.array([len(part) for part in parts], np.int64)
        self.values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.sizes = sizes
        # equal sets have equal numbers: two sums over the set, mixed with its size
        self.numbers = np.zeros(len(sizes), np.int64)
        filled = np.flatnonzero(sizes)
        if len(filled):
            begin = self.bounds[:-1][filled]
            one, two = np.add.reduceat(self.values, begin), np.add.reduceat(mixed(self.values, 9), begin)
            self.numbers[filled] = mixed(mixed(one ^ sizes[filled].astype(np.uint64), 1) ^ two, 2).view(np.int64)

    def of(self, row: int) -> np.ndarray:
        return self.values[self.bounds[row] : self.bounds[row + 1]]


def sets(column: pa.Array) -> Iterator[Sets]:
    for _, _, words, bounds in hashed(column, lower=True):
        yield Sets(words, bounds)


def least_shared(n: int) -> int:
    """How many prefix shingles a pair shares, if the smaller set has ``n``."""
    return 1 + n * SHARED_PERCENT // 100


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n // 100) + least_shared(n)


def meeting_size(n: int, percent: int = PERCENT) -> int:
    """Of the prefix, the part in which the first shingle that a pair shares must lie."""
    return n + (-percent * n // 100) + 1


class Orders:
    """Global orders of shingles: by how common they are, then by a hash of their own."""

    def __init__(self, common: np.ndarray, counts: np.ndarray):
        order = np.argsort(common)
        self.common = common[order]
        self.level = (8 * np.log2(np.maximum(counts[order], 1))).astype(np.int64) + 1
        self.maybe = np.zeros(1 << 23, bool)
        self.maybe[(common & np.uint64(len(self.maybe) - 1)).astype(np.int64)] = True

    def levels(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.int64)
        at = np.flatnonzero(self.maybe[(values & np.uint64(len(self.maybe) - 1)).astype(np.int64)])
        if len(at) and len(self.common):
            place = np.minimum(np.searchsorted(self.common, values[at]), len(self.common) - 1)
            out[at] = np.where(self.common[place] == values[at], self.level[place], 0)
        return out

    @staticmethod
    def places(levels: np.ndarray, spread: np.ndarray, size: int) -> np.ndarray:
        """Where the first ``size`` values by level, then by ``spread`` stand, in that order."""
        if levels.any():
            return np.lexsort((spread, levels))[:size]
        if size >= len(spread):
            return np.argsort(spread)
        first = np.argpartition(spread, size - 1)[:size]
        return first[np.argsort(spread[first])]

    @staticmethod
    def prefix(values: np.ndarray, levels: np.ndarray, spread: np.ndarray, size: int) -> np.ndarray:
        """The first ``size`` values by level, then by ``spread``."""
        return values if size >= len(values) else values[Orders.places(levels, spread, size)]


def _classes(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, text_hash, n, class`` per document, and ``class`` as a shingle seen ``n`` times, where common.

    A task reports the shingles that it meets twice within ``FLUSH`` shingles.
    """
    text = docs["text"].cast("string")
    rows = docs.select(docs[key].alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    schema = T.StructType(
        [T.StructField("doc_id", rows.schema["doc_id"].dataType)]
        + [T.StructField(name, T.LongType()) for name in ("text_hash", "n", "class")]
        + [T.StructField("common", T.BooleanType())]
    )

    def repeated(held: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        value, times = np.unique(np.concatenate(held), return_counts=True)
        value, times = value[times > 1], times[times > 1]
        columns = [pa.nulls(len(value), kind), pa.nulls(len(value), pa.int64())]
        columns += [pa.array(times.astype(np.int64)), pa.array(value.view(np.int64))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.ones(len(value), bool))], schema.names)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many, kind = [], 0, None
        for batch in batches:
            kind, n, classes = batch.schema.field(0).type, [], []
            for found in sets(batch.column(1)):
                n.append(found.sizes)
                classes.append(found.numbers)
                held.append(found.values)
                many += len(found.values)
                if many >= FLUSH:
                    yield repeated(held, kind)
                    held, many = [], 0
            if not n:
                continue
            columns = [batch.column(0), batch.column(2), pa.array(np.concatenate(n)), pa.array(np.concatenate(classes))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.zeros(batch.num_rows, bool))], schema.names)
        if many:
            yield repeated(held, kind)

    return rows.mapInArrow(describe, schema)


class _Once:
    """The rows of blocks whose class this task has not met yet; at most ``KNOWN_CLASSES`` are kept.

    With hashed ``ids``, the rows whose class it has not met under that id.
    """

    def __init__(self) -> None:
        self.known: set[int] = set()

    def new(self, found: Sets, ids: np.ndarray | None = None) -> Iterator[int]:
        numbers = found.numbers if ids is None else mixed(found.numbers.view(np.uint64) ^ mixed(ids.view(np.uint64), 3), 4)
        for row, (number, size) in enumerate(zip(numbers.tolist(), found.sizes.tolist())):
            if size and number not in self.known:
                if len(self.known) >= KNOWN_CLASSES:
                    self.known.clear()
                self.known.add(number)
                yield row


def _prefixes(docs: DataFrame, key: str, orders, bitmap=None) -> DataFrame:
    """``token, class, n`` for the prefix of every set, or of those whose hashed id is in the bitmap."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for batch in batches:
            texts = batch.column(1)
            if bitmap is not None:
                texts = texts.filter(pa.array(in_bitmap(batch.column(0), bitmap.value)))
            for found in sets(texts):
                levels, spread = orders.value.levels(found.values), mixed(found.values, 100)
                tokens, early, rows = [], [], list(once.new(found))
                for row in rows:
                    own, size = slice(found.bounds[row], found.bounds[row + 1]), int(found.sizes[row])
                    place = Orders.places(levels[own], spread[own], prefix_size(size))
                    tokens.append(found.values[own][place])
                    early.append(np.arange(len(place)) < meeting_size(size))
                if rows:
                    counts = [len(t) for t in tokens]
                    columns = [np.concatenate(tokens).view(np.int64)]
                    columns += [np.repeat(x[rows], counts) for x in (found.numbers, found.sizes)]
                    columns.append(np.concatenate(early))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "class", "n", "early"])

    rows = docs.select(F.xxhash64(docs[key]).alias("hashed"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(gathered(first), "token bigint, class bigint, n bigint, early boolean")


def _shared(prefixes: DataFrame) -> DataFrame:
    """The rows of ``prefixes`` whose token several classes have, in classes that share enough."""
    by_token, by_class = Window.partitionBy("token"), Window.partitionBy("class")

    def several(rows: DataFrame) -> DataFrame:
        return rows.withColumn("several", F.min("class").over(by_token) != F.max("class").over(by_token)).filter("several").drop("several")

    met = several(prefixes).groupBy("token", "class").agg(F.first("n").alias("n"), F.first("early").alias("early"))
    partner = F.floor((F.col("n") * PERCENT + 99) / 100)
    counted = met.withColumn("shared", F.count(F.lit(1)).over(by_class))
    enough = counted.filter(F.col("shared") >= F.floor(partner * SHARED_PERCENT / 100) + 1).drop("shared")
    # without the sets that share too little, some tokens are left alone
    return several(enough)


def _whole_sets(docs: DataFrame, key: str, bitmap) -> DataFrame:
    """``hashed, class, shingles`` of the documents whose hashed id is in the bitmap.

    A class may come from several ids, as the bitmap lets others through; a task gives an id's set once.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for batch in batches:
            wanted = in_bitmap(batch.column(0), bitmap.value)
            if not wanted.any():
                continue
            ids, at = batch.column(0).filter(pa.array(wanted)), 0
            for found in sets(batch.column(1).filter(pa.array(wanted))):
                rows = list(once.new(found, ids.slice(at, len(found.sizes)).to_numpy()))
                if rows:
                    values = pa.array([found.of(row).tobytes() for row in rows], pa.binary())
                    columns = [ids.slice(at).take(pa.array(rows)), pa.array(found.numbers[rows]), values]
                    yield pa.RecordBatch.from_arrays(columns, ["hashed", "class", "shingles"])
                at += len(found.sizes)

    rows = docs.select(F.xxhash64(docs[key]).alias("hashed"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(gathered(keep), "hashed bigint, class bigint, shingles binary")


class Kept:
    """Whole sets in a table, and the id under which that of each class counts.

    The table may hold a class under further ids. Sets move only to where they are asked for: the
    ids go along with the classes that ask, and a bitmap keeps the other sets where they are.
    """

    def __init__(self, sets: DataFrame, ids: DataFrame):
        self.sets, self.ids = sets, ids

    def beside(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        """``rows`` with the set of the class in ``column`` as ``name``."""
        wanted = bitmap_of(rows.select(F.col(column).alias("id")).distinct())
        bitmap = rows.sparkSession.sparkContext.broadcast(wanted)
        schema = "asked bigint, hashed bigint, class bigint, shingles binary"

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(in_bitmap(batch.column(0), bitmap.value)))

        near = self.sets.select(F.xxhash64("class").alias("asked"), "hashed", "class", "shingles").mapInArrow(gathered(ask), schema)
        own = rows.join(self.ids.select(F.col("class").alias(column), F.col("hashed").alias("_hashed")), column)
        near = near.select(F.col("class").alias(column), F.col("hashed").alias("_hashed"), F.col("shingles").alias(name))
        return own.join(near, [column, "_hashed"]).drop("_hashed")


def _verified(pairs: DataFrame, kept: Kept, orders) -> DataFrame:
    """``a, b, shared, union`` of the pairs that meet under every order; else both are null.

    Only the sets of ``a`` travel with the pairs; ``b`` has few distinct sets.
    """
    pairs = written(pairs.select("a", "b"), "candidates")
    few = kept.beside(pairs.select("b").distinct(), "b", "set_b")
    wide = kept.beside(pairs, "a", "set_a").join(few, "b").select("a", "b", "set_a", "set_b")
    out = ["a", "b", "shared", "union"]

    def prefixes(values: np.ndarray) -> list[np.ndarray]:
        levels, size = orders.value.levels(values), prefix_size(len(values))
        return [np.sort(Orders.prefix(values, levels, mixed(values, 100 + i), size)) for i in range(1, ORDERS)]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, []
        for batch in batches:
            shared, union = [], []
            for b, one, other in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                set_a, set_b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, other))
                if b != last:
                    last, of_last = b, prefixes(set_b)
                least = least_shared(min(len(set_a), len(set_b)))
                meets = all(len(np.intersect1d(x, y, True)) >= least for x, y in zip(prefixes(set_a), of_last))
                both = len(np.intersect1d(set_a, set_b, True)) if meets else None
                shared.append(both)
                union.append(None if both is None else len(set_a) + len(set_b) - both)
            columns = [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(union, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, out)

    return wide.mapInArrow(compare, "a bigint, b bigint, shared bigint, union bigint")


def block_links(
    classes: list[int], labels: np.ndarray, second: np.ndarray, values: list[np.ndarray], orders: Orders
) -> Iterator[tuple[int, int]]:
    """Links that join the labels of two blocks of sets, or of one, if ``second`` is all false."""
    sizes = np.array([len(v) for v in values])
    everything = np.concatenate(values)
    distinct, ids = np.unique(everything, return_inverse=True)
    levels, labels = orders.levels(everything), labels.copy()
    ends = np.cumsum(sizes)
    small = np.array([prefix_size(int(n)) for n in sizes])
    views = []  # ids of each set's prefix under every order, then of all of it
    for i in range(ORDERS):
        spread = mixed(everything, 100 + i)
        parts = []
        for lo, hi, size in zip(ends - sizes, ends, small):
            parts.append(Orders.prefix(ids[lo:hi], levels[lo:hi], spread[lo:hi], int(size)))
        views.append(parts)
    views.append([ids[lo:hi] for lo, hi in zip(ends - sizes, ends)])
    across = bool(second.any())
    left = np.flatnonzero(~second) if across else np.arange(len(sizes))
    right = np.flatnonzero(second) if across else left
    flat = [np.concatenate([parts[y] for y in right]) for parts in views]
    starts = [np.cumsum([0, *(len(parts[y]) for y in right[:-1])]) for parts in views]
    mark = np.zeros(len(distinct), bool)
    n = sizes[right]
    for x in left:
        low, high = np.minimum(n, sizes[x]), np.maximum(n, sizes[x])
        may = (labels[right] != labels[x]) & (low * 100 >= high * PERCENT)
        if not across:
            may &= right > x
        least = 1 + low * SHARED_PERCENT // 100
        for view, (all_ids, first) in enumerate(zip(flat, starts)):
            if not may.any():
                break
            own = views[view][x]
            mark[own] = True
            both = np.add.reduceat(mark[all_ids], first, dtype=np.int64)
            mark[own] = False
            if view < ORDERS:
                may &= both >= least
            else:
                may &= both * 100 >= (n + sizes[x] - both) * PERCENT
        for y in right[may]:
            if labels[y] != labels[x]:
                yield classes[x], classes[y]
                labels[labels == labels[y]] = labels[x]


def _block_links(members: DataFrame, kept: Kept, orders) -> DataFrame:
    """``a, b``: links that join the labels of ``members`` (token, class, n, label, weight, meets), block by block.

    Sets are in one family if they share the least set of some bucket; a family is cut into
    bands of sizes, of which only neighbours can link, and a band into blocks by
    the number and size of its sets. Each pair of blocks that meets is made once, and a set goes
    there if enough of its prefix is found in the other block.
    """
    least = members.groupBy("token").agg(F.min("class").alias("least"))
    families = members.join(least, "token").groupBy("class").agg(
        F.min("least").alias("family"), F.first("n").alias("n"), F.first("label").alias("label")
    )
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / PERCENT))
    families = written(families.withColumn("band", band), "families")
    parts = families.groupBy("family", "band").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).alias("parts")
    )
    block = F.xxhash64("family", "band", F.pmod(F.xxhash64("class"), F.col("parts")))
    placed = families.join(parts, ["family", "band"]).select("class", "n", "label", "band", block.alias("block"))
    inside = written(members.select("token", "weight", "meets", "class").join(placed, "class"), "inside")
    present = inside.groupBy("token", "block", "band").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max("meets").alias("meets")
    )
    present = written(present, "present")
    one = present.select("token", "band", F.col("block").alias("lo"), F.col("low").alias("l1"), F.col("high").alias("h1"), "meets")
    near = F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band")
    two = present.select("token", near, F.col("block").alias("hi"), F.col("low").alias("l2"), F.col("high").alias("h2"))
    meet = one.join(two, ["token", "band"]).filter("lo <= hi AND (l1 <> h1 OR l2 <> h2 OR l1 <> l2)")
    sides = meet.select("token", "meets", "lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("block"))
    # of a block, the sets whose buckets in the other block weigh enough for a partner
    enough = F.sum("weight") >= F.floor(F.floor((F.first("n") * PERCENT + 99) / 100) * SHARED_PERCENT / 100) + 1
    sent = inside.drop("meets").join(sides, ["token", "block"]).groupBy("class", "lo", "hi", "block").agg(
        F.first("label").alias("label"), (enough & F.max("meets")).alias("enough")
    )
    sent = written(sent.filter("enough").drop("enough"), "sent")
    discard(families, inside, present)
    filled = sent.groupBy("lo", "hi").agg(
        F.min("block").alias("b1"), F.max("block").alias("b2"), F.min("label").alias("l1"), F.max("label").alias("l2")
    )
    filled = filled.filter("least(b1, b2) = lo AND greatest(b1, b2) = hi AND l1 <> l2").select("lo", "hi")
    sent = sent.join(filled, ["lo", "hi"], "left_semi")
    wide = kept.beside(written(sent, "sent"), "class", "shingles")
    wide = wide.repartition("lo", "hi").sortWithinPartitions("lo", "hi", "block", "class")
    wide = wide.select("lo", "hi", "block", "class", "label", "shingles")

    def linked(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        one_of_each = {row[3]: row for row in held}
        classes = list(one_of_each)
        labels = np.array([row[4] for row in one_of_each.values()])
        second = np.array([row[2] != row[0] for row in one_of_each.values()])
        values = [np.frombuffer(row[5], np.uint64) for row in one_of_each.values()]
        links = list(block_links(classes, labels, second, values, orders.value))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*links)], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[0][:2] != row[:2]:
                    yield from linked(held)
                    held = []
                held.append(row)
        if held:
            yield from linked(held)

    return wide.mapInArrow(compare, "a bigint, b bigint")


def _pivots(members: DataFrame, number: int) -> DataFrame:
    """For buckets with several labels: the commonest label and one member of it.

    The first pivots are those in the middle of their groups, later ones are any.
    """
    first = F.col("middle") if number == 0 else F.xxhash64("class", F.lit(number)).cast("double")
    by_label = members.groupBy("token", "label").agg(
        F.count(F.lit(1)).alias("size"),
        F.max(F.struct(first.alias("first"), "class", "n")).alias("pick"),
    )
    return (
        by_label.groupBy("token")
        .agg(F.max(F.struct("size", "pick", "label")).alias("top"), F.count(F.lit(1)).alias("labels"))
        .filter("labels > 1")
        .select(
            F.col("token").alias("bucket"), F.col("top.label").alias("main"),
            F.col("top.pick.class").alias("pivot"), F.col("top.pick.n").alias("pivot_n"),
        )
    )


def _close(n: str, m: str) -> F.Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def _links(tested: DataFrame) -> DataFrame:
    return tested.filter(F.col("shared") * 100 >= F.col("union") * PERCENT).select("a", "b")


def linked_classes(docs: DataFrame, key: str, classes: DataFrame, common: DataFrame) -> DataFrame:
    """``node, label`` of the classes that may link; equal labels are one component."""
    spark = docs.sparkSession
    top = most_frequent(common, "n", COMMON_LIMIT, COMMON_LEAST).toArrow()
    orders = spark.sparkContext.broadcast(
        Orders(top.column("class").to_numpy().astype(np.int64).view(np.uint64), top.column("n").to_numpy())
    )
    def bits_of(kept_classes: DataFrame):
        ids = classes.join(kept_classes, "class", "left_semi").select(F.col("least_id").alias("id"))
        return spark.sparkContext.broadcast(bitmap_of(ids))

    met = written(_shared(_prefixes(docs, key, orders)), "met")
    # the counts of the first prefixes order the second ones; what these do not hold comes first
    times = met.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    seen = most_frequent(times, "n", COMMON_LIMIT, 3).toArrow()
    orders = spark.sparkContext.broadcast(
        Orders(seen.column("token").to_numpy().astype(np.int64).view(np.uint64), seen.column("n").to_numpy())
    )
    first = met.select("class").distinct()
    # the bitmap may let others through, which does no harm
    again = written(_shared(_prefixes(docs, key, orders, bits_of(first))), "met")
    discard(met)
    met = again
    # tokens with the same members say the same: one of them stays. The first token that a pair shares is
    # early in both its sets, so a bucket in which none is early for two of them brings nothing together
    same = met.groupBy("token").agg(
        F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("sum"),
        F.count(F.lit(1)).alias("size"),
        (F.sum(F.col("early").cast("int")) > 1).alias("meets"),
    )
    chosen = same.groupBy("sum", "size").agg(
        F.min("token").alias("token"), F.count(F.lit(1)).alias("weight"), F.max("meets").alias("meets")
    )
    chosen = chosen.select("token", "weight", "size", "meets")
    # a member of many crowded buckets is near the middle of its group
    buckets = met.drop("early").join(chosen, "token").withColumn("crowd", F.col("size") * F.col("weight")).drop("size")
    middle = F.sum("crowd").over(Window.partitionBy("class")) / F.col("n")
    buckets = written(buckets.withColumn("middle", middle).drop("crowd"), "buckets")
    discard(met)
    nodes = written(buckets.select("class").distinct(), "nodes")

    # one set of each class: that of its least id
    ids = classes.join(nodes, "class", "left_semi").select("class", F.xxhash64("least_id").alias("hashed"))
    kept = Kept(written(_whole_sets(docs, key, bits_of(nodes)), "sets"), written(ids, "ids"))

    labels = nodes.select(F.col("class").alias("node"), F.col("class").alias("label"))
    tested = None

    def members() -> DataFrame:
        return buckets.join(labels.select(F.col("node").alias("class"), "label"), "class")

    def untested(pairs: DataFrame) -> DataFrame:
        """``a, b`` of the pairs (a, b, n_a, n_b, weight) whose buckets together weigh enough."""
        smaller = F.least(F.min("n_a"), F.min("n_b"))
        enough = F.sum("weight") >= F.floor(smaller * SHARED_PERCENT / 100) + 1
        pairs = pairs.groupBy("a", "b").agg(enough.alias("enough")).filter("enough").select("a", "b")
        if tested is None:
            return pairs
        known = tested.select("a", "b").unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
        return pairs.join(known, ["a", "b"], "left_anti")

    for number in range(PIVOT_ROUNDS):
        found = members()
        pivots = _pivots(found, number)
        met = found.join(pivots, found["token"] == pivots["bucket"]).filter(
            (F.col("label") != F.col("main")) & _close("n", "pivot_n")
        )
        pairs = met.select(
            F.col("class").alias("a"), F.col("pivot").alias("b"), F.col("n").alias("n_a"), F.col("pivot_n").alias("n_b"), "weight"
        )
        new = written(_verified(untested(pairs), kept, orders), "pairs")
        if new.isEmpty():
            break
        tested = new if tested is None else tested.unionByName(new)
        links = _links(new)
        if links.isEmpty() and number:
            break
        labels = merged(labels, links)

    found = written(members().drop("middle"), "members")
    several = found.groupBy("token").agg((F.min("label") != F.max("label")).alias("several")).filter("several")
    still = written(found.join(several.select("token"), "token", "left_semi"), "open")
    discard(found)
    if still.isEmpty():
        return labels
    return merged(labels, written(_block_links(still, kept, orders), "links"))


def _components(docs: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, class`` of every document, and ``class, label, least_id, first`` of every class.

    ``first`` is the row of the class with the least id, null last, by id and hash of the text.
    """
    small_batches(docs.sparkSession)
    described = written(_classes(docs, key), "classes")
    rows = described.filter("NOT common").select("doc_id", "text_hash", "n", "class")
    common = described.filter("common").groupBy("class").agg(F.sum("n").alias("n"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "class", "text_hash")
    filled = rows.filter("n > 0")
    classes = filled.groupBy("class").agg(F.min("doc_id").alias("least_id"), F.min(first).alias("first"))
    classes = written(classes, "least")
    labels = linked_classes(docs, key, classes, common)
    # classes alone in every bucket keep their own number as label
    numbered = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "label", F.coalesce("label", "class")
    )
    return rows, written(numbered, "numbered")


def join(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document."""
    rows, numbered = _components(docs, key)
    least = numbered.groupBy("label").agg(F.min("least_id").alias("component_id"))
    ids = numbered.join(least, "label").select(F.col("class").alias("of"), "component_id")
    joined = rows.join(ids, (F.col("n") > 0) & (F.col("class") == F.col("of")), "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _row_key(one: Column, text_hash: Column) -> list[Column]:
    """Columns that are equal for equal ids, null ones included, and equal texts."""
    shown = F.coalesce(one.cast("string"), F.lit(""))
    return [one.isNull().alias("none"), shown.alias("shown"), text_hash.alias("text_hash")]


def keep_first(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row of each component: the one with the least id, null last; of rows with that id, the least text class.

    Rows without a word link with nothing and all stay. Where the chosen id and text stand on
    several rows, the one whose other columns have the least hash stays.
    """
    _, numbered = _components(docs, key)
    chosen = numbered.groupBy("label").agg(F.min("first").alias("first"))
    chosen = chosen.select(*_row_key(F.col("first.id"), F.col("first.text_hash")))
    names = ["none", "shown", "text_hash"]
    text = docs["text"].cast("string")
    held = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        F.coalesce(text.rlike(WORD), F.lit(False)).alias("filled"),
        *_row_key(docs[key], F.xxhash64(text)),
    )
    found = held.filter("filled").join(chosen, names, "left_semi")
    nth = F.row_number().over(Window.partitionBy(*names).orderBy(F.xxhash64("doc")))
    found = found.withColumn("nth", nth).filter("nth = 1")
    return found.select("doc.*").unionByName(held.filter("NOT filled").select("doc.*"))
