"""Cross-entropy difference: how much better a target model predicts a text than a background.

Both models are bigram models over the ids of one tokenizer, which is their shared vocabulary and
knows every text. The target model counts the texts marked as good, the background model counts all
texts. A bigram's share is mixed with the smoothed share of its last token; contexts are normalised
over all bigrams, so each model sums to one. The score of a document is the mean over its tokens of
target loss minus background loss: lower means closer to the target.

Texts are tokenised once, into a table of 16-bit ids. All counts of bigrams are kept, in a table.
Tasks hold what the vocabulary bounds (the counts of single tokens), the ``HELD_PAIRS`` most frequent
bigrams and a bitmap of the bigrams that repeat. A bigram that is neither held nor in the bitmap was
counted once, in the text that has it; all others are looked up by a join. Any value of
``HELD_PAIRS`` and any false hit of the bitmap gives the same scores.

Defined results: null, empty and blank texts have 0 tokens and null losses. With no target text,
both models still exist (the target one is uniform). An empty table gives no rows. Repeated rows
are counted and scored each; a repeated label marks its document once, a null id has no label.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from afterplay.llm.arrow import gathered, most_frequent, small_batches
from afterplay.llm.bitmap import bitmap_of, in_bitmap
from afterplay.llm.components import discard, written
from afterplay.llm.packing import word_ids
from afterplay.llm.words import mixed

HELD_PAIRS = 1 << 21
BIGRAM_SHARE = 0.7
SMOOTHING = 0.5
FLUSH = 1 << 22
TEXTS = 64


@dataclass(frozen=True)
class Tokens:
    """``row, doc_id, ids`` of every document, the ids as 16-bit numbers, and the size of the vocabulary."""

    rows: DataFrame
    vocabulary: int


def tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id") -> Tokens:
    """Tokenise all texts, into the shared folder."""
    spark = small_batches(docs.sparkSession)
    vocabulary = word_ids(tokenizer).tokenizer.get_vocab_size()
    if vocabulary >= 1 << 16:
        raise ValueError("the ids of this tokenizer do not fit 16 bits with one to spare")
    rows = docs.select(docs[key].alias("doc_id"), docs["text"].cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, TEXTS):
                texts = batch.column(1).slice(at, TEXTS).to_pylist()
                out += [np.frombuffer(ids, "<u4").astype("<u2").tobytes() for ids in words.encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], schema.names)

    # numbered before they are written, so that a row keeps its number
    encoded = rows.mapInArrow(encode, schema).withColumn("row", F.monotonically_increasing_id())
    return Tokens(written(encoded.select("row", "doc_id", "ids"), "token-ids"), vocabulary)


def pairs_of(column: pa.Array, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Every token with the one before it (``start`` at the beginning of a text) as one number, and where each text begins."""
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    ids = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view("<u2") if data else np.zeros(0, np.uint16)
    bounds = (bounds - bounds[0]) // 2
    before = np.full(len(ids), start, np.uint32)
    before[1:] = ids[:-1]
    before[bounds[:-1][bounds[:-1] < len(ids)]] = start
    return before << np.uint32(16) | ids, bounds


def _counted(rows: DataFrame, start: int) -> DataFrame:
    """``pair, n, good`` of the rows (good, ids), combined in the tasks only."""
    names = ["pair", "n", "good"]

    def totals(held: list[np.ndarray], marks: list[np.ndarray]) -> pa.RecordBatch:
        marked = np.concatenate(held) << np.uint64(1) | np.concatenate(marks)
        marked.sort()
        pair = marked >> np.uint64(1)
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        n = np.diff(np.append(first, len(pair)))
        good = np.add.reduceat((marked & np.uint64(1)).astype(np.int64), first)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (pair[first].astype(np.int64), n, good)], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, marks, many = [], [], 0
        for batch in batches:
            pair, bounds = pairs_of(batch.column(1), start)
            held.append(pair.astype(np.uint64))
            marks.append(np.repeat(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64), np.diff(bounds)))
            many += len(pair)
            if many >= FLUSH:
                yield totals(held, marks)
                held, marks, many = [], [], 0
        if many:
            yield totals(held, marks)

    return rows.mapInArrow(count, "pair bigint, n bigint, good bigint")


def _target_ids(rows: DataFrame, good_ids: DataFrame) -> DataFrame:
    ids = good_ids.toDF("id").select(F.col("id").try_cast(rows.schema["doc_id"].dataType).alias("id")).dropna()
    return written(ids.distinct(), "target-ids")


def _marked(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``good, ids`` of the documents that are surely no target, and of all others.

    A bitmap of the target ids lets all targets and few others through; only these move for the
    exact join. The hint keeps to one plan at every size.
    """
    bitmap = rows.sparkSession.sparkContext.broadcast(bitmap_of(ids))
    hashed = rows.select(F.xxhash64("doc_id").alias("hashed"), "doc_id", "ids")

    def only(inside: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(in_bitmap(batch.column(0), bitmap.value) == inside))

        return keep

    others = hashed.mapInArrow(only(False), hashed.schema).select(F.lit(0).alias("good"), "ids")
    likely = hashed.mapInArrow(gathered(only(True)), hashed.schema)
    likely = likely.join(ids.hint("merge"), F.col("doc_id") == F.col("id"), "left")
    return others, likely.select(F.col("id").isNotNull().cast("int").alias("good"), "ids")


class Singles:
    """Counts of single tokens, in good texts (0) and in all (1): seen, and followed by a token."""

    def __init__(self, counts: DataFrame, vocabulary: int):
        self.vocabulary = vocabulary
        self.seen, self.followed = (np.zeros((2, vocabulary + 1), np.int64) for _ in range(2))
        for place, out in ((F.col("pair").bitwiseAND(F.lit(0xFFFF)), self.seen), (F.shiftright("pair", 16), self.followed)):
            # at most one row a token
            rows = counts.groupBy(place.alias("of")).agg(F.sum("good").alias("good"), F.sum("n").alias("n")).toArrow()
            at = rows.column("of").to_numpy()
            out[0][at], out[1][at] = rows.column("good").to_numpy(), rows.column("n").to_numpy()
        self.total = self.seen.sum(axis=1)

    def loss(self, model: int, pair: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Loss of pairs that the target (0) or background (1) model counted ``n`` times."""
        share = (self.seen[model][pair & 0xFFFF] + SMOOTHING) / (self.total[model] + SMOOTHING * self.vocabulary)
        followed = self.followed[model][pair >> 16]
        lower = np.where(followed > 0, 1 - BIGRAM_SHARE, 1) * share
        return -np.log(BIGRAM_SHARE * n / np.maximum(followed, 1) + lower)


class Model:
    """All counts in the table ``repeated`` (pair, n, good) and in what tasks hold; see above."""

    def __init__(self, singles: Singles, bitmap: np.ndarray, repeated: DataFrame, ids: DataFrame):
        self.singles, self.bitmap, self.repeated, self.ids = singles, bitmap, repeated, ids
        top = most_frequent(repeated, "n", HELD_PAIRS).toArrow()
        pairs = top.column("pair").to_numpy().astype(np.uint32)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        counts = [top.column(name).to_numpy().astype(np.int64)[order] for name in ("good", "n")]
        self.held = [singles.loss(i, self.pairs, n) for i, n in enumerate(counts)]


def _hash(pairs: np.ndarray) -> pa.Array:
    return pa.array(mixed(pairs.astype(np.uint64), 11).view(np.int64))


def train(counted: Tokens, good_ids: DataFrame) -> Model:
    """Count all texts. ``good_ids`` has one column with the ids of the target texts."""
    small_batches(counted.rows.sparkSession)
    ids = _target_ids(counted.rows, good_ids)
    others, likely = (_counted(rows, counted.vocabulary) for rows in _marked(counted.rows, ids))
    summed = others.unionByName(likely).groupBy("pair").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    counts = written(summed, "pair-counts")
    singles = Singles(counts, counted.vocabulary)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_hash(batch.column(0).to_numpy())], ["id"])

    bitmap = bitmap_of(counts.filter("n > 1").select("pair").mapInArrow(hashes, "id bigint"), F.col("id"))
    held = counts.sparkSession.sparkContext.broadcast(bitmap)

    def likely_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(_hash(batch.column(0).to_numpy()), held.value)))

    repeated = written(counts.mapInArrow(gathered(likely_repeated), counts.schema), "repeated-pairs")
    discard(counts)
    return Model(singles, bitmap, repeated, ids)


def score(counted: Tokens, model: Model) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, difference`` per document that was counted."""
    spark = small_batches(counted.rows.sparkSession)
    start = counted.vocabulary
    rows = counted.rows
    names = ("as_target", "as_other", "background")
    schema = T.StructType(
        [rows.schema["row"], rows.schema["doc_id"], T.StructField("n_tokens", T.LongType())]
        + [T.StructField(n, T.DoubleType()) for n in names]
        + [T.StructField("pairs", T.ArrayType(T.LongType()))]
    )
    shared = spark.sparkContext.broadcast((model.singles, model.bitmap, model.pairs, model.held))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles, bitmap, known, held = shared.value
        for batch in batches:
            pair, bounds = pairs_of(batch.column(2), start)
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            frequent = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            away = ~frequent
            away[away] = in_bitmap(_hash(pair[away]), bitmap)
            alone = np.flatnonzero(~frequent & ~away)
            sums = []
            for which, once in ((0, 1), (0, 0), (1, 1)):
                line = np.zeros(len(pair) + 1)
                line[1:][frequent] = held[which][at[frequent]]
                line[1:][alone] = singles.loss(which, pair[alone], once)
                line = np.cumsum(line)
                sums.append(line[bounds[1:]] - line[bounds[:-1]])
            ends = np.concatenate([[0], np.cumsum(away)])[bounds]
            sent = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pair[away].astype(np.int64)))
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(bounds)), *[pa.array(s) for s in sums], sent]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles = shared.value[0]
        for batch in batches:
            pair, n, good = (batch.column(i).to_numpy() for i in (1, 2, 3))
            found = [singles.loss(0, pair, good), singles.loss(1, pair, n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found)], ["row", "target", "background"])

    held = written(rows.mapInArrow(judge, schema), "held-losses")
    # a hint for each: one plan at every size
    met = held.select("row", F.explode("pairs").alias("pair")).join(model.repeated.hint("merge"), "pair")
    looked = met.select("row", "pair", "n", "good").mapInArrow(losses, "row bigint, target double, background double")
    looked = looked.groupBy("row").agg(F.sum("target").alias("more"), F.sum("background").alias("more_background"))
    good = held.select("row", "doc_id").join(model.ids, F.col("doc_id") == F.col("id")).select(F.col("row"), F.lit(True).alias("good"))
    wide = held.drop("pairs").join(looked, "row", "left").join(good, "row", "left")
    own = F.when(F.col("good"), F.col("as_target")).otherwise(F.col("as_other"))
    sums = wide.select(
        "doc_id", "n_tokens",
        (own + F.coalesce("more", F.lit(0.0))).alias("t"),
        (F.col("background") + F.coalesce("more_background", F.lit(0.0))).alias("b"),
    )

    def mean(total: Column) -> Column:
        return F.when(F.col("n_tokens") > 0, total / F.col("n_tokens"))

    return sums.select(
        "doc_id", "n_tokens", mean(F.col("t")).alias("target_loss"), mean(F.col("b")).alias("background_loss"),
        mean(F.col("t") - F.col("b")).alias("difference"),
    )
