"""Secret scans: fixed shapes, and character Markov models of random strings and identifiers.

The fixed shapes are found with patterns. Beyond them, every long run of key characters is
scored with two Markov models of second order, one of random strings and one of ordinary
words and identifiers; a mean log-likelihood ratio per character above a threshold makes it a
secret. Both models learn from labelled samples: values found by the fixed shapes and drawn
strings against the other words of a bounded sample of texts and identifiers put together from
words as people do (cases, separators, numbers, dates, paths, repeated signs). A fifth of both
samples is held out, and sets the threshold.

Defined results: null and empty texts have no spans. An empty table gives no rows, and the
models then know drawn strings and ``USUAL`` words only. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# fixed values: the shapes of secrets
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
SHORTEST_VALUE, SHORTEST_ACCESS, SHORTEST_HEX = 8, 16, 32

RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+")
SHORTEST_RANDOM = 20
SYMBOLS = string.ascii_letters + string.digits + "+/_=-"
_CODE = {c: i for i, c in enumerate(SYMBOLS)}
#: words that identifiers are made of, besides those of the texts
USUAL = (
    "user session manager config max retry count version final backup archive file example path https www com org get set "
    "list index name value key data time date start end size limit default buffer client server request response handler "
    "service factory update create delete insert select table column row query event queue worker thread process memory "
    "cache storage image video audio document page report summary project module package class method function test build "
    "release debug error warning message format parser writer reader stream batch token number string integer boolean array"
).split()
IDENTIFIERS = 8_000
FALSE_ALARMS = 0.001
SAMPLE_TEXTS = 2_000
SAMPLE_CHARS = 20_000

Span = tuple[int, int, int]  # start, index of the kind, end


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST_VALUE]
    for run in RUN.finditer(text):  # every access key and long hex number lies inside a run
        lo, hi = run.span()
        for kind, pattern, least in ((1, ACCESS, SHORTEST_ACCESS), (2, HEX, SHORTEST_HEX)):
            for m in pattern.finditer(text, lo, hi):
                if m.end() - m.start() >= least:
                    found.append((m.start(), kind, m.end()))
    return sorted(found)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


@dataclass(frozen=True)
class Markov:
    """``ratio[a, b, c]``: log-likelihood ratio of c after a, b; ``threshold`` is per character."""

    ratio: np.ndarray
    threshold: float

    def mean(self, run: str) -> float:
        codes = [_CODE[c] for c in run]
        if len(codes) < 3:
            return float("-inf")
        return float(self.ratio[codes[:-2], codes[1:-1], codes[2:]].mean())


def transitions(strings: list[str]) -> np.ndarray:
    """Smoothed log probabilities; a pair seldom seen leans on its last character, then on all."""
    n = len(SYMBOLS)
    counts = np.zeros((n, n, n))
    for s in strings:
        codes = [_CODE[c] for c in s]
        np.add.at(counts, (codes[:-2], codes[1:-1], codes[2:]), 1)
    single = counts.sum((0, 1)) + 0.5
    single /= single.sum()
    last = counts.sum(0) + 10 * single
    last /= last.sum(1, keepdims=True)
    both = counts + 10 * last
    return np.log(both / both.sum(2, keepdims=True))


def drawn_strings(number: int = 3_000) -> list[str]:
    draw = random.Random(7)
    alphabets = (
        "0123456789abcdef",
        string.ascii_uppercase + string.digits,
        string.ascii_letters + string.digits,
        string.ascii_letters + string.digits + "+/",
        string.ascii_letters + string.digits + "_-",
    )
    return ["".join(draw.choices(alphabets[i % 5], k=draw.randint(20, 48))) for i in range(number)]


def ordinary_identifiers(words: list[str], number: int = IDENTIFIERS) -> list[str]:
    """Identifiers, dates, paths and runs of one sign, put together from ``words`` and ``USUAL`` words in equal shares."""
    draw = random.Random(11)
    plain = sorted({w.lower() for w in words if w.isascii() and w.isalpha()}) or USUAL
    joins = ("camel", "pascal", "_", "-", "/", "__", "caps", "=")

    def end() -> str:
        return draw.choice(
            ("", "", str(draw.randint(0, 9)), str(draw.randint(10, 99999)), str(draw.randint(1970, 2040)), f"v{draw.randint(1, 30)}")
        )

    def date() -> str:
        parts = [str(draw.randint(1970, 2040)), f"{draw.randint(1, 12):02d}", f"{draw.randint(1, 28):02d}"]
        return draw.choice(("-", "/", "_", "")).join(parts)

    def one(i: int) -> str:
        if i % 10 == 0:
            return draw.choice(SYMBOLS) * draw.randint(8, 60)
        if i % 10 == 1:
            row, first = draw.choice((string.digits, string.ascii_lowercase, string.ascii_uppercase)), draw.randint(0, 25)
            return "".join(row[(first + k) % len(row)] for k in range(draw.randint(8, 40)))
        parts = [draw.choice(USUAL if draw.random() < 0.5 else plain) for _ in range(draw.randint(2, 6))]
        join = draw.choice(joins)
        if join in ("camel", "pascal"):
            shown = "".join(w.capitalize() for w in parts)
            return (shown if join == "pascal" else parts[0] + shown[len(parts[0]) :]) + end()
        if join == "caps":
            return "_".join([w.upper() for w in parts] + [e for e in [end()] if e])
        parts += [e for e in [end()] if e]
        if draw.random() < 0.25:
            parts.insert(draw.choice((0, len(parts))), date())
        return join.join(parts)

    return [one(i) for i in range(number)]


def learn(secrets: list[str], ordinary: list[str]) -> Markov:
    """Models of four fifths of both samples; the threshold lies between the scores of the held-out fifths.

    It passes all but ``FALSE_ALARMS`` of the ordinary strings, and is in the middle if secrets score higher.
    """
    secrets = [s for s in secrets if len(s) >= 3] + drawn_strings()
    ordinary = [s for s in ordinary if len(s) >= 3 and set(s) <= _CODE.keys()] + ordinary_identifiers(ordinary)
    for sample in (secrets, ordinary):
        random.Random(3).shuffle(sample)
    cuts = len(secrets) // 5, len(ordinary) // 5
    model = Markov(transitions(secrets[cuts[0] :]) - transitions(ordinary[cuts[1] :]), 0.0)
    held = [[model.mean(s) for s in sample[:cut] if len(s) >= SHORTEST_RANDOM] for sample, cut in zip((secrets, ordinary), cuts)]
    random_low, usual_high = float(np.quantile(held[0], 0.01)), float(np.quantile(held[1], 1 - FALSE_ALARMS))
    return Markov(model.ratio, max(usual_high, (random_low + usual_high) / 2))


def train(docs: DataFrame, key: str = "doc_id", texts: int = SAMPLE_TEXTS) -> Markov:
    """Learn from about ``texts`` texts of at most ``SAMPLE_CHARS``, chosen by a hash of their id."""
    rows = max(docs.count(), 1)
    part = F.pmod(F.xxhash64(docs[key]), F.lit(1_000_000)) < int(1_000_000 * min(1.0, texts / rows)) + 1
    short = F.char_length(docs["text"]) <= SAMPLE_CHARS
    # a rerun takes the same texts, also where many share an id
    order = F.xxhash64(docs[key], docs["text"])
    sample = docs.filter(part & short).orderBy(order, docs["text"]).select(docs["text"].cast("string").alias("text")).limit(2 * texts)
    secrets, ordinary = [], []
    for row in sample.collect():
        spans = base_spans(row.text)
        values = [ASSIGN.match(row.text, s)[2] if kind == 0 else row.text[s:e] for s, kind, e in spans]
        secrets += [value.replace(".", "") for value in values]
        rest, at = [], 0
        for start, _, end in spans:
            rest.append(row.text[at:start])
            at = max(at, end)
        rest.append(row.text[at:])
        ordinary += re.findall(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{3,}+", " ".join(rest))
    return learn(secrets, sorted(set(ordinary)))


def find_spans(text: str, model: Markov) -> list[Span]:
    """Base spans, and the random-looking runs that touch none of them, by start and kind."""
    base = base_spans(text)
    starts, reach = [s for s, _, _ in base], [0, *accumulate((e for _, _, e in base), max)]
    found = []
    for run in RUN.finditer(text):
        lo, hi = run.span()
        # no base span that begins before the run's end reaches into it
        if hi - lo >= SHORTEST_RANDOM and reach[bisect_left(starts, hi)] <= lo:
            if model.mean(run[0]) > model.threshold:
                found.append((lo, 3, hi))
    return sorted(base + found)


def scan(docs: DataFrame, model: Markov, key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``found``: an array of (kind, start, end, base) per document."""
    rows = docs.select(docs[key].alias("doc_id"), docs["text"].cast("string").alias("text"))
    span = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(f"found {span}").fields])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
        for batch in batches:
            found = [
                [
                    {"kind": KINDS[k], "start": s, "end": e, "value": text[s:e]}
                    for s, k, e in (find_spans(text, model) if text else [])
                ]
                for text in _each(batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], schema.names)

    return rows.mapInArrow(search, schema)


def _each(column: pa.Array) -> Iterator[str | None]:
    for at in range(0, len(column), 64):
        yield from column.slice(at, 64).to_pylist()


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span, or union of spans that overlap, replaced by ``[SECRET]``."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Markov) -> DataFrame:
    """The documents without their secrets; ``n_chars``, where there is one, follows the text."""
    names, schema = docs.columns, docs.schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            texts = [t and redacted(t, find_spans(t, model)) for t in _each(batch.column(at))]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if "n_chars" in names:
                i = names.index("n_chars")
                lengths = [None if t is None else len(t) for t in texts]
                columns[i] = pa.array(lengths, batch.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(clean, schema)
