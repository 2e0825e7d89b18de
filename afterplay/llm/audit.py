"""How filters interact: what each one removes, alone and after others, in every order.

Five filters look at every whole text: A fewer than 200 words, B more than half of the words
repeated, C more than 2% capitals, D special signs, E a copy of a text with a smaller id. A row's
failures are the bits of a mask. E comes from compressed tries: a task inserts its texts into a trie
whose terminals hold the least id, so that a copy in the same task is known at once and only one
text of each group travels; the texts that are left go to ranges cut at adaptive prefixes, where
tries are filled in the order of texts and emptied behind it. Rows then shrink to counts per part,
mask and label, and the counts of all orders follow from at most 32 masks a part.

Defined results: a null text is empty, and empty texts are copies of each other. A row with a null
id is in the counts, but is no copy and no original. Rows with the same id and text are no copies of
each other. A null part is the empty string. A document that has several labels counts as good or
toxic if one of them says so. An empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from afterplay.llm.components import written
from afterplay.llm.tries import TextTrie, range_cuts, range_of

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
TRIE_BYTES = 1 << 25
SPREAD = 1024
_CAPITALS = bytes(range(65, 91))
_SIGNS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))


def failures(text: bytes) -> int:
    """The bits of the filters A to D that the text fails."""
    words = text.split()
    short = len(words) < 200
    repeated = 100 * len(set(words)) < 50 * len(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    loud = 100 * capitals > 2 * len(text.translate(None, _CONTINUED))
    signs = len(text.translate(None, _SIGNS)) < len(text)
    return short | repeated << 1 | loud << 2 | signs << 3


class Originals:
    """A trie whose terminals hold ``[least id, mask, rows of that id by part]``.

    Rows with a larger id are copies, and so are those of an id that a smaller one replaces:
    they come back from ``add`` as (id, mask, part, rows).
    """

    def __init__(self):
        self.trie = TextTrie()

    def add(self, text: bytes, key, mask: int, parts: dict[str, int]) -> list[tuple]:
        node = self.trie.insert(text)
        if node.held is None or key < node.held[0]:
            replaced, node.held = node.held, [key, mask, dict(parts)]
            return [] if replaced is None else [(replaced[0], mask | COPY, p, n) for p, n in replaced[2].items()]
        if key > node.held[0]:
            return [(key, mask | COPY, p, n) for p, n in parts.items()]
        for part, n in parts.items():
            node.held[2][part] = node.held[2].get(part, 0) + n
        return []

    def full(self) -> bool:
        return self.trie.size >= TRIE_BYTES

    def emptied(self) -> Iterator[tuple]:
        """``text, id, mask, parts`` of every terminal, in the order of texts; the trie is new after that."""
        trie, self.trie = self.trie, TextTrie()
        for text, node in trie.terminals():
            yield text, *node.held


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def masks(docs: DataFrame, key: str = "doc_id", part: str = "source") -> DataFrame:
    """``id, part, mask, n``: how many rows of an id and part fail the filters of the mask."""
    rows = docs.select(
        docs[key].alias("id"),
        F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    cuts = range_cuts(rows.select("text"))
    id_field = rows.schema["id"]
    counted = T.StructType([id_field, *T.StructType.fromDDL("mask int, part string, n long").fields])
    sent = T.StructType([*T.StructType.fromDDL("place int, text string").fields, *counted.fields])

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        originals, schema, told = Originals(), None, 0
        for batch in batches:
            if schema is None:
                kinds = [pa.int32(), pa.string(), batch.schema.field("id").type, pa.int32(), pa.string(), pa.int64()]
                schema = pa.schema(list(zip(sent.names, kinds)))
            known = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for one, of, text in zip(batch.column("id").to_pylist(), batch.column("part").to_pylist(), texts):
                mask = failures(text)
                known += [(None, mask, of, 1)] if one is None else originals.add(text, one, mask, {of: 1})
            yield _batch([(len(cuts) + 1 + (told + i) % SPREAD, None, *row) for i, row in enumerate(known)], schema)
            told += len(known)
            if originals.full():
                yield from travelling(originals, schema)
        if schema is not None:
            yield from travelling(originals, schema)

    def travelling(originals: Originals, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        held = []
        for text, one, mask, parts in originals.emptied():
            place = range_of(cuts, text)
            held += [(place, text.decode(), one, mask, p, n) for p, n in parts.items()]
            if len(held) >= 256:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)

    def in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        originals, schema = Originals(), None
        for batch in batches:
            if schema is None:
                schema = pa.schema([batch.schema.field(n) for n in counted.names])
            names = ("text", "id", "mask", "part", "n")
            found = []
            for text, one, mask, of, n in zip(*(batch.column(c).to_pylist() for c in names)):
                if text is None:
                    found.append((one, mask, of, n))
                else:
                    last = text.encode()
                    found += originals.add(last, one, mask, {of: n})
            if originals.full():
                # rows come in the order of texts, so only the last text can come again
                for text, one, mask, parts in originals.emptied():
                    if text == last:
                        originals.add(text, one, mask, parts)
                    else:
                        found += [(one, mask, p, n) for p, n in parts.items()]
            yield _batch(found, schema)
        if schema is not None:
            yield _batch([(one, mask, p, n) for _, one, mask, parts in originals.emptied() for p, n in parts.items()], schema)

    ranged = rows.mapInArrow(in_task, sent).repartition("place").sortWithinPartitions("text")
    return ranged.mapInArrow(in_range, counted)


def orders() -> list[tuple[int, int, str, int]]:
    """``before, own, filter_order, step``: the bits of the filters before a step and its own, in all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, place in enumerate(order, 1):
            out.append((before, 1 << place, "".join(FILTERS[i] for i in order), step))
            before |= 1 << place
    return out


def report(counts: DataFrame) -> DataFrame:
    """The rows of every part, order and step from ``part, mask, good, toxic, n``.

    A filter's share of an order depends only on which filters come before it, 80 cases; the
    120 orders look their cases up. In all orders together, a row that fails k filters is removed
    by each of them in one k-th of the orders.
    """
    plan = orders()
    cases = sorted({(before, own) for before, own, _, _ in plan})
    case = F.explode(F.array(*[F.struct(F.lit(b).alias("before"), F.lit(o).alias("own")) for b, o in cases])).alias("case")
    failed = F.col("mask").bitwiseAND(F.col("own")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0
    here = failed & ~earlier

    def total(condition, amount=F.col("n")):
        return F.sum(F.when(condition, amount).otherwise(0)).cast("bigint")

    summed = (
        counts.select("*", case)
        .select("part", "mask", "good", "toxic", "n", "case.before", "case.own")
        .groupBy("part", "before", "own")
        .agg(
            total(~failed & ~earlier).alias("kept"),
            total(here).alias("removed"),
            total(failed & earlier).alias("redundant"),
            total(F.col("mask") == F.col("own")).alias("unique_fails"),
            total(here & F.col("good")).alias("good_lost"),
            total(here & F.col("toxic")).alias("toxic_lost"),
            total(failed, F.expr(f"n * {len(plan) // len(FILTERS)} div greatest(bit_count(mask), 1)")).alias("shapley"),
        )
    )
    steps = counts.sparkSession.createDataFrame(plan, "before int, own int, filter_order string, step int")
    # 600 rows at any size of the data
    return summed.join(F.broadcast(steps), ["before", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", part: str = "source") -> DataFrame:
    """``report`` of the documents, with the labels ``quality`` and ``toxic`` by the same key."""
    found = masks(docs, key, part).groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.groupBy(labels[key].alias("of")).agg(
        F.max(F.coalesce(labels["quality"] == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(labels["toxic"] == 1, F.lit(False))).alias("toxic"),
    )
    marked = found.join(marks, found["id"] == marks["of"], "left").select(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n"
    )
    return report(written(marked.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")), "mask-counts"))
