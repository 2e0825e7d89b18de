"""Token counts, whitening and the filter audit against brute force, and on awkward rows."""

import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import types as T

from afterplay.llm import audit, token_counts, transducer, tries, whitening
from afterplay.llm.bidiagonal import right_singular
from afterplay.llm.queries import REGISTRY

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, n long, mask int, id long, part string, place int, quality int"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def drawn_texts():
    draw = random.Random(4)
    signs = list("abcdefghijklmnopqrstuvwxyz''''''  \n\t0129!?.,-<|>éÉßİıſK中文字한각ñ½²̣́̇각‘’😀‍\x85　ǅﬁͅΣςक़")
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(draw.choices("aethinos' ", k=draw.randint(0, 400))) for _ in range(200)]
    texts += ["don't we'll they're 'r 've'v 'l <|endoftext|>x<|startoftext|> <|ENDOFTEXT|> <|endoftext", "", "a" * 20_000]
    return texts + ["é" * 5000, "'" * 999, "'r" * 777, "́" * 300 + "a", "the" * 3000, " " * 5000]


@pytest.mark.parametrize("chunk, block, width, states", [(256, 1 << 20, 128, 1 << 18), (5, 97, 128, 300), (64, 4096, 20, 2000)])
def test_compiled_counts_are_the_tokenizers(monkeypatch, library, chunk, block, width, states):
    """Also with chunks cut anywhere, few states kept, and symbols outside the table."""
    for name, value in (("CHUNK", chunk), ("BLOCK", block), ("WIDTH", width), ("MAX_STATES", states)):
        monkeypatch.setattr(transducer, name, value)
    texts = drawn_texts() if states > 1000 else drawn_texts()[:400] + drawn_texts()[-9:]
    assert transducer.TokenCounter(TOKENIZER).count(texts) == library(texts)


def test_single_characters(library):
    texts = [f"{chr(i)} a{chr(i)}b" for i in range(0x20, 0x3400)]
    assert transducer.TokenCounter(TOKENIZER).count(texts) == library(texts)


def test_token_counts_of_rows(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = REGISTRY["op12_token_counts"].run(spark, sf_dir).collect()
    expected = dict(zip(docs, library(list(docs.values()))))
    assert {r.doc_id: r.n_tokens for r in found} == expected
    assert all(r.n_bytes == len(docs[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 2048) for r in found)
    rows = [(None, None), (1, ""), (1, "a b"), (1, "a b"), (2, " \t\n")]
    counted = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER)
    assert sorted(r.n_tokens for r in counted.collect()) == [0, 0, 0, 2, 2]
    assert token_counts.count_tokens(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        transducer.TokenCounter(public_tokenizers.path("byte_bpe_50k.json"))


def test_tries_hold_every_text():
    draw = random.Random(2)
    texts = ["".join(draw.choices("ab", k=draw.randint(0, 12))).encode() for _ in range(2000)]
    trie, last = tries.TextTrie(), {}
    for i, text in enumerate(texts):
        trie.insert(text).held = last[text] = i
    assert [(text, node.held) for text, node in trie.terminals()] == sorted(last.items())


def failing(text):
    words = text.encode().split()
    return (
        (len(words) < 200)
        + 2 * (100 * len(set(words)) < 50 * len(words))
        + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text))
        + 8 * any(c in "#$%&*|" for c in text)
    )


def audited(rows, labels):
    """The report by brute force, one row at a time."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = Counter()
    shapley = Counter()
    for i, text, source in rows:
        text, part = text or "", source or ""
        mask = failing(text) + 16 * (i is not None and i > least[text])
        good, toxic = labels.get(i, (0, 0))
        for order in permutations("ABCDE"):
            name, gone = "".join(order), False
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                key = (part, name, step)
                fails = bool(mask & bit)
                now = fails and not gone
                redundant, gone = fails and gone, gone or fails
                for j, value in enumerate((not gone, now, redundant, mask == bit, now and good, now and toxic)):
                    out[key, j] += value
                shapley[part, letter] += now
    return {(*key, *(out[key, j] for j in range(6)), shapley[key[0], key[1][key[2] - 1]]) for key, _ in out}


@pytest.mark.parametrize("held, sampled", [(1 << 25, 64), (200, 1)])
def test_audit(spark, monkeypatch, held, sampled):
    """Copies within and across tasks, null and repeated ids, long shared beginnings, and tries that are emptied early."""
    monkeypatch.setattr(audit, "TRIE_BYTES", held)
    monkeypatch.setattr(tries, "SAMPLED", sampled)
    monkeypatch.setattr(tries, "FIRST_PREFIX", 4)
    monkeypatch.setattr(tries, "RANGE_SAMPLES", 2)
    draw = random.Random(7)
    texts = ["", None, "A B", "# a", "word " * 250, "The " * 90, " ".join(f"w{i}" for i in range(210)), "é" * 9]
    texts += ["common beginning " * 12 + f"{i:b}" for i in range(40)]
    rows = [(draw.randint(0, 150) if draw.random() < 0.95 else None, draw.choice(texts), draw.choice(["a", "b", "", None])) for _ in range(300)]
    rows += [(3, texts[4], "a")] * 30
    labels = {i: (i % 2, i % 3 == 0) for i in range(0, 150, 2)}
    docs = spark.createDataFrame([(i, t, s, 1, 2, 3, "x", 4, 5) for i, t, s in rows], SCHEMA)
    marks = spark.createDataFrame([(i, q, int(t)) for i, (q, t) in labels.items()] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    found = audit.audit(docs.repartition(5), marks).collect()
    assert {tuple(r) for r in found} == audited(rows, labels) and len(found) == 600 * 3
    assert audit.audit(docs.limit(0), marks).count() == 0


def matrices():
    draw = np.random.default_rng(0)
    turned = np.linalg.qr(draw.normal(size=(64, 64)))[0]
    tall = np.linalg.qr(draw.normal(size=(300, 64)))[0]
    yield "random", draw.normal(size=(500, 64)), 32
    yield "falling", draw.normal(size=(500, 64)) * np.logspace(0, -8, 64), 64
    yield "rising", draw.normal(size=(500, 64)) * np.logspace(-8, 0, 64), 64
    yield "one column", draw.normal(size=(50, 1)), 32
    yield "two columns", draw.normal(size=(50, 2)), 32
    yield "all values equal", tall * 5, 32
    yield "pairs of values", tall @ np.diag(np.repeat(np.arange(32, 0, -1.0), 2)) @ turned, 64
    yield "values very close", tall @ np.diag(1 + 1e-9 * draw.normal(size=64)) @ turned, 64
    yield "rank 20", draw.normal(size=(500, 20)) @ draw.normal(size=(20, 64)), 20
    yield "fewer rows", draw.normal(size=(10, 64)), 10
    yield "equal columns", np.repeat(draw.normal(size=(500, 16)), 4, axis=1), 16
    yield "empty columns", np.hstack([draw.normal(size=(500, 40)), np.zeros((500, 24))]), 40
    yield "glued", np.diag(np.sqrt(np.abs(np.arange(21) - 10.0) + 1)) + np.diag(np.ones(20), 1), 21


@pytest.mark.parametrize("name, rows, most", list(matrices()), ids=lambda x: x if isinstance(x, str) else "")
def test_singular_values_and_vectors(name, rows, most):
    r = np.linalg.qr(rows, mode="r")
    r = np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])
    values, vectors, total = right_singular(r, most)
    expected = np.linalg.svd(r, compute_uv=False) ** 2
    assert len(values) == min(most, rows.shape[1])
    assert np.allclose(values, expected[: len(values)], rtol=1e-8, atol=1e-26 * expected[0])
    assert np.isclose(total, expected.sum())
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-10
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max() < 1e-12 * expected[0]


def whitened_by_hand(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    y = (n * x - sums) / n
    _, roots, directions = np.linalg.svd(y, full_matrices=False)
    return n, ((n * x - sums) ** 2).sum(1), y, roots**2 / n, directions.T


def test_whitening(spark, sf_dir):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    n, deviation, y, values, directions = whitened_by_hand(list(vectors.values()))
    found = REGISTRY["op11_embedding_whitening"].run(spark, sf_dir).collect()
    assert len(found) == 32 * len(vectors)
    at = {i: k for k, i in enumerate(vectors)}
    w = np.zeros((n, 32))
    for r in found:
        assert r.n == n and r.deviation == deviation[at[r.vec_id]] and r.identity_error < 1e-9
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
        w[at[r.vec_id], r.component - 1] = r.whitened
    expected = y @ directions[:, :32] / np.sqrt(values[:32])
    assert np.abs(w * np.sign((w * expected).sum(0)) - expected).max() < 1e-7


@pytest.mark.parametrize("fan_in, parts", [(32, 3), (2, 9)])
def test_whitening_of_awkward_rows(spark, monkeypatch, fan_in, parts):
    monkeypatch.setattr(whitening, "FAN_IN", fan_in)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    draw = np.random.default_rng(8)
    good = [(i % 40 if i % 9 else None, [float(a), float(b), float(a), 5.0]) for i, (a, b) in enumerate(draw.normal(size=(60, 2)) * [3e4, 0.5])]
    bad = [(1, None), (2, []), (3, [None, 1.0, 2.0, 3.0]), (4, [float("nan")] * 4), (5, [float("inf"), 0.0, 0.0, 0.0]), (6, [1.0, 2.0])]
    schema = T.StructType.fromDDL("vec_id long, embedding array<double>, id long, x int, part int")
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in good + bad], schema).repartition(parts)
    rows = whitening.whole_numbers(frame)
    model = whitening.fit(rows)
    n, deviation, y, values, _ = whitened_by_hand([v for _, v in good])
    assert model.n == n == 60 and len(model.variances) == 2 and model.error < 1e-9
    assert np.allclose(model.variances, values[:2], rtol=1e-9)
    found = whitening.apply(rows, model).collect()
    assert Counter((r.id, int(r.deviation)) for r in found if r.component == 1) == Counter((i, int(d)) for (i, _), d in zip(good, deviation))
    for given in ([], bad[:5], good[:1], [good[0]] * 7):
        rows = whitening.whole_numbers(spark.createDataFrame([(*r, 1, 2, 3) for r in given], schema))
        model = whitening.fit(rows)
        assert model is None if given in ([], bad[:5]) else whitening.apply(rows, model).count() == 0


def test_deviations_beyond_64_bits(spark):
    rows = whitening.whole_numbers(spark.createDataFrame([(i, [float(i) * 1e10, -1e300]) for i in range(5)], "vec_id long, embedding array<double>"))
    found = whitening.apply(rows, whitening.fit(rows)).collect()
    x = [64 * i * 10**10 for i in range(5)]
    assert sorted(int(r.deviation) for r in found) == sorted((5 * v - sum(x)) ** 2 for v in x)
