"""The stages of the pipeline against plain Python, and on awkward and empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from afterplay.llm import secrets, transducer
from afterplay.llm.queries import REGISTRY, tokenizer

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, copies long, text_hash string, n int"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def first_of_each(rows):
    """Ids of one row per component of texts that are 75% alike, and of all rows without words."""
    sets = {r.doc_id: shingles(r.text) for r in rows}
    least = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0 and least[a] != least[b]:
                low, high = sorted((least[a], least[b]))
                least = {k: low if v == high else v for k, v in least.items()}
    return {i for i, label in least.items() if label == i}


def test_every_stage(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs.collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        assert number == 4 or sorted(out.columns) == sorted(docs.columns)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs.collect())
    given, good, single, clean, mixed, packed = seen
    judged = REGISTRY["op4_quality_classifier"].run(spark, sf_dir).filter("predicted = 1").collect()
    assert {r.doc_id for r in good} == {r.doc_id for r in judged} and len(good) == len(judged)
    assert {r.doc_id for r in single} == first_of_each(good) and len(single) < len(good)
    model = secrets.train(spark.read.parquet(str(tmp_path / "ngram_jaccard_join")))
    before = {r.doc_id: r for r in single}
    assert len(clean) == len(single)
    for r in clean:
        text = before[r.doc_id].text
        assert r.text == secrets.redacted(text, secrets.find_spans(text, model)) and r.n_chars == len(r.text)
    copies = Counter(r.doc_id for r in mixed)
    texts = {r.doc_id: r.text for r in clean}
    assert all(r.text == texts[r.doc_id] for r in mixed) and max(copies.values()) <= 3
    counted = dict(zip(texts, transducer.TokenCounter(tokenizer()).count(list(texts.values()))))
    assert sum(r.length for r in packed) == sum(n * (counted[i] + 1) for i, n in copies.items())
    ends = Counter()
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_tables(spark, tmp_path, empty):
    word = "The quick brown fox, jumps over mail a.b@c.example token = abcdefgh12345678 "
    texts = [None, "", " \t\n", "x", "x", "one two three", word * 5, word * 5, word * 4000, "é" * 50_000, "1234 " * 30]
    rows = [(i, t, "en", None if i % 3 else f"s{i}", 1, 2, 3, "h", 4) for i, t in enumerate(texts)]
    rows += [(None, "null id text " * 9, None, None, None, None, None, None, None)] * 3 + [rows[6], (6, "other text", *rows[6][2:])]
    docs = spark.createDataFrame([] if empty else rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert empty == (not found)
    for r in found:
        assert r.length > 0 and r.offset + r.length <= 2048
    if not empty:
        # one row of each group of copies went on, and repeated ids with other texts did not get lost
        ids = Counter(r.doc_id for r in found if r.piece == 0)
        assert 7 not in ids and 4 not in ids and ids[6] >= 1
        assert spark.read.parquet(f"{tmp_path}/documents.parquet").filter(F.col("text") == "other text").count() == 1
