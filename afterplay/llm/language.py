"""Language identification with a linear-chain conditional random field over words.

Every word gets a label, so texts that switch between languages are labelled word by word. A
word's features are its affixes (first and last three bytes), its byte trigrams, and its entry
in a lexicon, hashed into one table of weights per language; transitions between the labels of
neighbouring words are learned too. Forward-backward gives each word the probability of every
language. A document's prediction is the language with the greatest mean probability over its
words, and the score is that mean.

Training texts have one language each. Training sequences are made of stretches of several
texts, so that staying and switching are both seen. The sample is bounded by ``FIT_ROWS`` texts
of at most ``FIT_CHARS`` characters; all of a text is used. Prediction goes through whole texts.

Forward-backward runs in numpy over all texts of a block at once: the words are cut into runs of
``RUN`` words, the transition matrices of a run are multiplied for all runs in step, the runs of
a text are chained, and then all runs go forward and backward in step.

Defined results: ``und`` with score 0 for null texts and texts without a letter. With nothing
to learn from, every text is ``und``. With one language, that is predicted with score 1. An empty
table gives no rows. Repeated rows are predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from afterplay.llm.words import BLOCK, SPACE, blocks, mixed, powers, text_buffer

TABLE_BITS = 18
FIT_ROWS = 1_600
FIT_CHARS = 20_000
RUN = 32
EPOCHS = 3
SEQUENCE_WORDS = 400
UNKNOWN = "und"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MASK = np.uint64((1 << TABLE_BITS) - 1)


@dataclass(frozen=True)
class Words:
    """Features of the words of a block: ``grams`` of word i are ``first[i]:first[i + 1]``."""

    grams: np.ndarray
    first: np.ndarray
    single: np.ndarray  # words x (first letters, last letters, lexicon)

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        if not len(self.single):
            return np.zeros((0, weights.shape[1]))
        counts = np.diff(np.append(self.first, len(self.grams)))
        out = np.add.reduceat(weights[self.grams], self.first) / np.sqrt(counts)[:, None]
        for column in self.single.T:
            out += weights[column]
        return out

    def gradient(self, by_word: np.ndarray, size: int) -> np.ndarray:
        """Sum of the words' gradients for every weight."""
        counts = np.diff(np.append(self.first, len(self.grams)))
        spread = np.repeat(by_word / np.sqrt(counts)[:, None], counts, 0)
        out = np.empty((size, by_word.shape[1]))
        for label in range(by_word.shape[1]):
            out[:, label] = np.bincount(self.grams, spread[:, label], size)
            for column in self.single.T:
                out[:, label] += np.bincount(column, by_word[:, label], size)
        return out


def _slot(h: np.ndarray, salt: int) -> np.ndarray:
    return (mixed(h, salt) & _MASK).astype(np.int64)


def words_of(a: np.ndarray, bounds: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words of the texts in ``a`` that begin at ``bounds``, and the first word of each text."""
    space = SPACE[a]
    before = np.ones(len(a), bool)
    before[1:] = space[:-1]
    before[bounds[bounds < len(a)]] = True
    starts = np.flatnonzero(before & ~space)
    if not len(starts):
        nothing = np.zeros(0, np.int64)
        return Words(nothing, nothing, np.zeros((0, 3), np.int64)), np.zeros(len(bounds), np.int64)
    solid = np.flatnonzero(~space)
    first = np.searchsorted(solid, starts)
    lengths = np.diff(np.append(first, len(solid)))
    letters = _LOWER[a[solid]].astype(np.int64) + 1
    place = np.arange(len(solid)) - np.repeat(first, lengths)
    last = place == np.repeat(lengths, lengths) - 1
    left, right = np.roll(letters, 1), np.roll(letters, -1)
    left[place == 0], right[last] = 0, 0
    grams = (left * 257 + letters) * 257 + right
    end = first + lengths - 1

    def near(step: int, edge: np.ndarray) -> np.ndarray:
        """The letter ``step`` from an edge of the word, 0 beyond the word."""
        inside = lengths > abs(step)
        return np.where(inside, letters[np.where(inside, edge + step, 0)], 0)

    prefix = (near(0, first) * 257 + near(1, first)) * 257 + near(2, first)
    suffix = (near(0, end) * 257 + near(-1, end)) * 257 + near(-2, end)
    whole = np.add.reduceat(letters.astype(np.uint64) * powers(int(lengths.max()))[place], first)
    single = np.stack([_slot(prefix.astype(np.uint64), 1), _slot(suffix.astype(np.uint64), 2), _slot(whole, 3)], 1)
    return Words(_slot(grams.astype(np.uint64), 0), first, single), np.searchsorted(starts, bounds)


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def forward_backward(
    emissions: np.ndarray, bounds: np.ndarray, transitions: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised forward and backward messages of every word, and ``exp`` of its emissions.

    Texts are ``bounds[i]:bounds[i + 1]``; the first label of a text is as likely as any other.
    """
    words, labels = emissions.shape
    e = np.exp(emissions - emissions.max(1, keepdims=True))
    m = np.exp(transitions)
    sizes = np.diff(bounds)
    runs = -(-sizes // RUN)
    text = np.repeat(np.arange(len(sizes)), runs)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    begin = bounds[:-1][text] + nth * RUN
    length = np.minimum(RUN, bounds[1:][text] - begin)
    starts_text = nth == 0

    # the product of the steps of each run
    product = np.broadcast_to(np.eye(labels), (len(text), labels, labels)).copy()
    for t in range(RUN):
        on = np.flatnonzero(length > t)
        if not len(on):
            break
        step = product[on] @ m
        if t == 0:
            step[starts_text[on]] = product[on][starts_text[on]]
        step *= e[begin[on] + t][:, None, :]
        product[on] = step / step.max((1, 2), keepdims=True)

    # chain the runs of a text: all texts go on by one run at a time
    enter, leave = np.full((len(text), labels), 1 / labels), np.ones((len(text), labels)) / labels
    first_run = np.cumsum(runs) - runs
    most = int(runs.max()) if len(runs) else 0
    for i in range(1, most):
        on = first_run[runs > i] + i
        enter[on] = _normal(np.einsum("ni,nij->nj", enter[on - 1], product[on - 1]))
    for i in range(most - 2, -1, -1):
        on = first_run[runs > i + 1] + i
        leave[on] = _normal(np.einsum("nij,nj->ni", product[on + 1], leave[on + 1]))

    forward, backward = np.empty((words, labels)), np.empty((words, labels))
    state = enter
    for t in range(RUN):
        on = np.flatnonzero(length > t)
        if not len(on):
            break
        moved = state[on] @ m
        if t == 0:
            moved[starts_text[on]] = state[on][starts_text[on]]
        moved = _normal(moved * e[begin[on] + t])
        state[on] = moved
        forward[begin[on] + t] = moved
    state = leave
    for t in range(RUN - 1, -1, -1):
        on = np.flatnonzero(length > t)
        if not len(on):
            continue
        at = begin[on] + t
        backward[at] = state[on]
        state[on] = _normal((state[on] * e[at]) @ m.T)
    return forward, backward, e


def marginals(emissions: np.ndarray, bounds: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    forward, backward, _ = forward_backward(emissions, bounds, transitions)
    return _normal(forward * backward)


@dataclass
class Field:
    """The labels, the weights of features, and those of transitions."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def word_probabilities(self, text: str) -> np.ndarray:
        """Words x labels, for one text."""
        a = np.frombuffer(text.encode(), np.uint8)
        words, bounds = words_of(a, np.array([0, len(a)]))
        return marginals(words.emissions(self.weights), bounds, self.transitions)


def fit(texts: list[str], langs: list[str], epochs: int = EPOCHS, seed: int = 5) -> Field:
    """Maximise the conditional likelihood by stochastic gradients with a step per weight."""
    labels = sorted(set(langs))
    size, many = 1 << TABLE_BITS, len(labels)
    weights, transitions = np.zeros((size, many), np.float32), np.zeros((many, many))
    if many < 2:
        return Field(labels, weights, transitions)
    rng = np.random.default_rng(seed)
    data = [t.encode().split() for t in texts]
    marks = [labels.index(lang) for lang in langs]
    seen, moved = np.full((size, many), 1e-2), np.full((many, many), 1.0)
    for _ in range(epochs):
        stretches = []
        for words, mark in zip(data, marks):
            at = 0
            while at < len(words):
                step = int(rng.integers(10, 120))
                stretches.append((words[at : at + step], mark))
                at += step
        rng.shuffle(stretches)
        for group in range(0, len(stretches), 256):
            sequences, gold, held = [], [], []
            for words, mark in stretches[group : group + 256]:
                held += words
                gold += [mark] * len(words)
                if len(held) >= SEQUENCE_WORDS:
                    sequences.append(b" ".join(held))
                    held = []
            sequences.append(b" ".join(held))
            a = np.frombuffer(b"".join(sequences), np.uint8)
            words, bounds = words_of(a, np.concatenate([[0], np.cumsum([len(s) for s in sequences])]))
            truth = np.eye(many)[gold]
            forward, backward, e = forward_backward(words.emissions(weights), bounds, transitions)
            by_word = truth - _normal(forward * backward)
            inner = np.ones(len(truth), bool)
            inner[bounds[:-1][bounds[:-1] < len(truth)]] = False
            at = np.flatnonzero(inner)
            joint = forward[at - 1][:, :, None] * np.exp(transitions) * (e[at] * backward[at])[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            step = truth[at - 1].T @ truth[at] - joint.sum(0)
            moved += step**2
            transitions += 0.5 * step / np.sqrt(moved)
            slope = words.gradient(by_word, size)
            seen += slope**2
            weights += (0.3 * slope / np.sqrt(seen)).astype(np.float32)
    return Field(labels, weights, transitions)


def train(docs: DataFrame, usable: Column, key: str = "doc_id", rows: int = FIT_ROWS) -> Field:
    """Fit on about ``rows`` usable texts with a language, in equal parts, chosen by a hash of the id.

    Languages are few; one row for each comes to the driver.
    """
    known = docs.filter(usable & docs["lang"].isNotNull() & (F.char_length(docs["text"]) <= FIT_CHARS))
    known = known.select(docs[key].alias("id"), docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text"))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return fit([], [])
    each = -(-rows // len(counts))
    rate = F.lit(0.0)
    for lang, n in counts.items():
        rate = F.when(F.col("lang") == lang, min(1.0, each / n)).otherwise(rate)
    picked = F.pmod(F.xxhash64("id", F.lit(21)), F.lit(1 << 20)) < rate * (1 << 20)
    # a rerun takes the same rows, also where many share an id
    order = [F.xxhash64("id", F.lit(21)), F.xxhash64("lang", "text"), "lang", "text"]
    sample = known.filter(picked).orderBy(*order).limit(2 * rows + len(counts)).collect()
    sample = sorted((r.id is None, r.id, r.lang, r.text) for r in sample)
    return fit([s[3] for s in sample], [s[2] for s in sample])


def _long_text(a: np.ndarray, model: Field, block: int = BLOCK) -> np.ndarray:
    """Mean label probabilities of one very long text, one chain through parts that end at white space.

    A part begins with a word that stands for all before it, whose emission is the forward message,
    and ends with one that stands for all behind it. The first pass finds the forward messages, the
    second one goes back through the parts, so only one part is held at a time.
    """
    cuts = [0]
    while cuts[-1] < len(a):
        cut = min(cuts[-1] + block, len(a))
        while cut < len(a) and not SPACE[a[cut]]:
            cut += 1
        cuts.append(cut)
    parts = list(zip(cuts, cuts[1:]))

    def messages(part: tuple[int, int], before: np.ndarray | None, behind: np.ndarray | None):
        """Forward and backward messages and ``exp`` of emissions of the words of a part; None without words."""
        words, _ = words_of(a[slice(*part)], np.array([0, part[1] - part[0]]))
        if not len(words.single):
            return None
        ends = [np.log(np.maximum(x, 1e-300))[None] if x is not None else np.zeros((0, len(model.labels))) for x in (before, behind)]
        rows = np.concatenate([ends[0], words.emissions(model.weights), ends[1]])
        own = slice(len(ends[0]), len(rows) - len(ends[1]))
        return [x[own] for x in forward_backward(rows, np.array([0, len(rows)]), model.transitions)]

    entering, before = [], None
    for part in parts:
        entering.append(before)
        found = messages(part, before, None)
        before = before if found is None else found[0][-1]
    total, many, behind = np.zeros(len(model.labels)), 0, None
    for part, before in zip(reversed(parts), reversed(entering)):
        found = messages(part, before, behind)
        if found is not None:
            forward, backward, e = found
            total, many = total + _normal(forward * backward).sum(0), many + len(forward)
            behind = _normal(e[0] * backward[0])
    return total / max(many, 1)


def _means(a: np.ndarray, offsets: np.ndarray, model: Field) -> np.ndarray:
    if len(a) > 4 * BLOCK:
        return _long_text(a, model)[None]
    words, bounds = words_of(a, offsets)
    out = np.zeros((len(offsets) - 1, len(model.labels)))
    if not len(words.single):
        return out
    p = marginals(words.emissions(model.weights), bounds, model.transitions)
    filled = np.flatnonzero(np.diff(bounds))
    out[filled] = np.add.reduceat(p, bounds[:-1][filled]) / np.diff(bounds)[filled][:, None]
    return out


def predict(docs: DataFrame, model: Field, key: str = "doc_id") -> DataFrame:
    """``doc_id, lang_pred, score`` per document."""
    rows = docs.select(docs[key].alias("doc_id"), docs["text"].cast("string").alias("text"))
    schema = T.StructType(
        [rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        names = np.array([*field.labels, UNKNOWN], object)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            best = np.full(batch.num_rows, len(field.labels))
            score = np.zeros(batch.num_rows)
            for row, end in blocks(offsets) if field.labels else ():
                a, bounds = data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
                means = _means(a, bounds, field)
                marks = np.concatenate([[0], np.cumsum(_LETTER[a])])
                lettered = marks[bounds[1:]] > marks[bounds[:-1]]
                for i in np.flatnonzero(~lettered & (np.diff(bounds) > 0)):
                    other = batch.column(1)[row + i].as_py()
                    lettered[i] = any(map(str.isalpha, other))
                top = means.argmax(1)
                best[row:end] = np.where(lettered, top, len(field.labels))
                score[row:end] = np.where(lettered, means[np.arange(len(means)), top], 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(np.clip(score, 0, 1))], schema.names
            )

    return rows.mapInArrow(label, schema)
