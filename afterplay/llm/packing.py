"""Best-fit packing by minimum bin slack.

Documents become token ids with a closing id, longer ones are cut into pieces, and pieces are
packed into sequences. For a sequence, the longest length left is set, and a subset-sum over
the lengths that are left, kept as the bits of one integer, finds the combination that fills it
best. That combination is used as often as its lengths last, so the plan is made from a
histogram of at most ``max_tokens`` lengths and is as short at any number of documents. Spark
tokenises, counts, numbers the pieces of a length, and places each by its number.

Defined results: a null or empty text is the closing id alone. An empty table gives no rows.
Repeated rows are packed each. Columns other than the id and the text do not matter.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from afterplay.llm.ranks import shuffled_key, slot_digits, with_rank
from afterplay.session import scratch_path

MAX_TOKENS = 2048
END_ID = 0
CACHED_WORDS = 600_000


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers spell the letters a-z and those of Latin-1: one sign per byte."""
    signs, others = {}, 0
    for byte in range(256):
        shown = 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174
        signs[byte] = chr(byte if shown else 256 + others)
        others += not shown
    letters = [*range(97, 123), *(c for c in range(0xDF, 0x100) if c != 0xF7)]
    return {c: "".join(signs[b] for b in chr(c).encode()) for c in letters}


class WordIds:
    """Token ids of texts, as little-endian bytes, each distinct word encoded once.

    Exact for tokenizers that drop white space: no token spans a space, so a text's ids are
    those of its words in turn. The first ``CACHED_WORDS`` words are remembered. Plain words,
    small letters with stops behind them, go straight to the tokenizer's model, if that gives
    what the tokenizer gives for the words in ``PROBES``.
    """

    PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,!]*)")
    LETTERS = _byte_letters()
    PROBES = ("the", "éèñöüß", "unfathomable", "ægir.", "straße,", "rivière!", "a.,", "übermäßig!!")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.stops: dict[str, list[int]] = {"": []}
        self.direct = True
        self.direct = all(self._plain(w) == self.tokenizer.encode(w, add_special_tokens=False).ids for w in self.PROBES)
        self.lowers = self._same("ABC", "abc") and self._same("É", "é")

    def _same(self, one: str, other: str) -> bool:
        return self.tokenizer.encode(one).ids == self.tokenizer.encode(other).ids

    def _plain(self, word: str) -> list[int] | None:
        match = self.PLAIN.fullmatch(word)
        if not self.direct or match is None:
            return None
        stops = self.stops.get(match[2])
        if stops is None:
            stops = self.tokenizer.encode(match[2], add_special_tokens=False).ids
            if len(self.stops) < 1000:
                self.stops[match[2]] = stops
        return [t.id for t in self.tokenizer.model.tokenize(match[1].translate(self.LETTERS))] + stops

    def _encoded(self, new: set[bytes]) -> dict[bytes, bytes]:
        found, rest = {}, []
        for word in new:
            ids = self._plain(word.decode())
            if ids is None:
                rest.append(word)
            else:
                found[word] = array("I", ids).tobytes()
        for word, encoding in zip(rest, self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)):
            found[word] = array("I", encoding.ids).tobytes()
        return found

    def _words(self, text: str | None) -> list[bytes]:
        # bytes.split() cuts at the ASCII white space; any other is left to the tokenizer
        data = (text or "").encode()
        # names of special tokens are small, so capitals must not become one
        return (data.lower() if self.lowers and b"<|" not in data else data).split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        words = [self._words(t) for t in texts]
        found = self._encoded(set().union(*words).difference(self.known))
        known = self.known
        if len(known) + len(found) <= CACHED_WORDS:
            known.update(found)
            return [b"".join(map(known.__getitem__, w)) for w in words]
        return [b"".join([known[x] if x in known else found[x] for x in w]) for w in words]


_encoders: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The encoder of this Python process, which keeps its words from task to task."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def pieces(
    docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, ids: bool = False, key: str = "doc_id"
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` per piece; with ``ids``, also the ids as bytes."""
    rows = docs.select(docs[key].alias("doc_id"), docs["text"].cast("string").alias("text"))
    fields = [rows.schema["doc_id"], T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
    fields += [T.StructField("ids", T.BinaryType())] if ids else []
    width, end = 4 * max_tokens, np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                source, out = [], {n: [] for n in ("piece", "start", "length", "ids_crc32", "ids")}
                for i, data in enumerate(words.encode(part.column(1).to_pylist())):
                    data += end
                    for number, begin in enumerate(range(0, len(data), width)):
                        piece = data[begin : begin + width]
                        source.append(i)
                        out["piece"].append(number)
                        out["start"].append(begin // 4)
                        out["length"].append(len(piece) // 4)
                        out["ids_crc32"].append(zlib.crc32(piece))
                        out["ids"].append(piece)
                columns = [part.column(0).take(pa.array(source, pa.int64()))]
                columns += [pa.array(out["piece"], pa.int32())]
                columns += [pa.array(out[n], pa.int64()) for n in ("start", "length", "ids_crc32")]
                columns += [pa.array(out["ids"], pa.binary())] if ids else []
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return rows.mapInArrow(cut, T.StructType(fields))


def fullest(lengths: dict[int, int], space: int) -> dict[int, int]:
    """How many of each length fill ``space`` best; the longest are tried first.

    Bit s of ``sums`` says that s can be reached. Counts go in by powers of two, so the
    number of steps does not depend on them.
    """
    sums, steps, mask = 1, [], (1 << (space + 1)) - 1
    for length in sorted((n for n in lengths if n <= space and lengths[n] > 0), reverse=True):
        left, block = min(lengths[length], space // length), 1
        while left > 0:
            block = min(block, left)
            steps.append((length, block, sums))
            sums |= (sums << (length * block)) & mask
            left -= block
            block *= 2
        if sums >> space & 1:
            break
    used, at = {}, sums.bit_length() - 1
    for length, block, before in reversed(steps):
        if at >= length * block and before >> (at - length * block) & 1:
            used[length] = used.get(length, 0) + block
            at -= length * block
    return used


def plan(counts: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how often each is used, until no piece is left."""
    left, made = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        used = fullest(left, max_tokens - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // c for n, c in used.items())
        for n, c in used.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
        made.append((used, times))
    return made


def place(ranked: DataFrame, made: list[tuple[dict[int, int], int]]) -> DataFrame:
    """Sequence and offset of each piece from its ``rank`` among the pieces of its ``length``."""
    segments, first = [], 0
    next_rank: dict[int, int] = {}
    for used, times in made:
        offset = 0
        for length in sorted(used, reverse=True):
            rank = next_rank.get(length, 0)
            segments.append((length, rank, first, used[length], offset))
            next_rank[length] = rank + used[length] * times
            offset += length * used[length]
        first += times
    table = np.array(sorted(segments) or np.zeros((0, 5)), np.int64).reshape(-1, 5)
    stride = np.int64(1) << 48
    starts = table[:, 0] * stride + table[:, 1]
    schema = T.StructType(
        [*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    names = ranked.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(names.index("rank")).to_numpy(zero_copy_only=False)
            at = table[np.searchsorted(starts, length * stride + rank, side="right") - 1]
            nth = rank - at[:, 1]
            sequence, offset = at[:, 2] + nth // at[:, 3], at[:, 4] + nth % at[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(number, schema).drop("rank")


def pack(
    docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, ids: bool = False, key: str = "doc_id"
) -> DataFrame:
    """Pieces with ``sequence_id`` and gapless ``offset``. Tokenised once, into the shared folder."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    pieces(docs, tokenizer, max_tokens, ids, key).write.parquet(path)
    cut = spark.read.parquet(path)
    digits = slot_digits(cut.count())
    order = shuffled_key(F.col("doc_id"), F.col("piece"))
    keyed = cut.withColumn("place", order).withColumn("slot", F.substring("place", 1, digits))
    counts_path = scratch_path(spark, "piece-counts")
    keyed.groupBy("length", "slot").agg(F.count(F.lit(1)).alias("n")).write.parquet(counts_path)
    counts = spark.read.parquet(counts_path)
    # at most max_tokens rows
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = with_rank(keyed, counts, ["length"], ["slot"], ["place", "doc_id", "piece"])
    return place(ranked.drop("place", "slot"), plan(histogram, max_tokens))
