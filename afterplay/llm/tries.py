"""Compressed radix tries over whole texts, and ranges of texts cut at adaptive prefixes."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from afterplay.llm.components import written

SAMPLED = 64
SAMPLE_TEXTS = 65_536
RANGE_SAMPLES = 8
FIRST_PREFIX = 64


class Node:
    """The bytes that lead here from the node above, what lies below by first byte, and what a text that ends here holds."""

    __slots__ = ("label", "below", "held")

    def __init__(self, label: bytes):
        self.label = label
        self.below: dict[int, Node] = {}
        self.held = None


class TextTrie:
    """Whole texts as paths; texts with a common beginning share it. ``size`` is the bytes of all labels."""

    def __init__(self):
        self.root = Node(b"")
        self.size = 0

    def insert(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made if need be."""
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = Node(text[at:])
                node.below[text[at]] = child
                self.size += len(child.label)
                return child
            if not text.startswith(child.label, at):
                child = _split(node, child, _common(child.label, text, at))
            node, at = child, at + len(child.label)
        return node

    def terminals(self) -> Iterator[tuple[bytes, Node]]:
        """Every text with its node, in the order of bytes."""
        path: list[bytes] = []
        ahead = [(0, self.root)]
        while ahead:
            depth, node = ahead.pop()
            del path[depth:]
            path.append(node.label)
            if node.held is not None:
                yield b"".join(path), node
            ahead += [(depth + 1, node.below[b]) for b in sorted(node.below, reverse=True)]


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many first bytes of ``label`` stand in ``text`` at ``at``."""
    same, most = 0, min(len(label), len(text) - at)
    while same < most:
        middle = (same + most + 1) // 2
        if text.startswith(label[same:middle], at + same):
            same = middle
        else:
            most = middle - 1
    return same


def _split(above: Node, child: Node, place: int) -> Node:
    """A node between ``above`` and ``child``, after ``place`` bytes of the label."""
    middle = Node(child.label[:place])
    child.label = child.label[place:]
    middle.below[child.label[0]] = child
    above.below[middle.label[0]] = middle
    return middle


def range_cuts(texts: DataFrame) -> list[bytes]:
    """Where the ranges of the column ``text`` begin, as short prefixes in the order of bytes.

    The cuts come from a sample of the distinct texts (by hash, one in ``SAMPLED``, about
    ``SAMPLE_TEXTS`` at most), so copies do not count twice. Prefixes of the sample are
    lengthened only where more texts share one than a range should hold. A cut decides which
    task a text goes to and nothing else.
    """
    every = max(SAMPLED, texts.count() // SAMPLE_TEXTS)
    picked = texts.filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).select("text", F.xxhash64("text").alias("of"))
    sample = written(picked.dropDuplicates(["of"]), "sample-texts")
    known = {
        r.of: (r.prefix, r.bytes)
        for r in sample.select("of", F.substring("text", 1, FIRST_PREFIX).alias("prefix"), F.octet_length("text").alias("bytes")).toLocalIterator()
    }
    length = FIRST_PREFIX
    while True:
        shared: dict[str, list[int]] = {}
        for of, (prefix, _) in known.items():
            if len(prefix) == length:
                shared.setdefault(prefix, []).append(of)
        crowded = [of for ids in shared.values() if len(ids) >= RANGE_SAMPLES for of in ids]
        if not crowded:
            break
        ids = texts.sparkSession.createDataFrame([(of,) for of in crowded], "of long")
        more = sample.join(ids, "of").select("of", F.substring("text", length + 1, length).alias("rest"))
        for row in more.toLocalIterator():
            prefix, size = known[row.of]
            known[row.of] = (prefix + row.rest, size)
        length *= 2
    return _cuts(sorted((prefix.encode(), size) for prefix, size in known.values()))


def _cuts(ordered: list[tuple[bytes, int]]) -> list[bytes]:
    """Shortest prefixes that part the sorted texts into runs of about equal bytes."""
    share = sum(size for _, size in ordered) / max(1, len(ordered) // RANGE_SAMPLES)
    cuts, run = [], 0
    for (before, size), (prefix, _) in zip(ordered, ordered[1:]):
        run += size
        if run >= share and prefix != before:
            cuts.append(prefix[: _common(before, prefix, 0) + 1])
            run = 0
    return cuts


def range_of(cuts: list[bytes], text: bytes) -> int:
    return bisect_right(cuts, text)
