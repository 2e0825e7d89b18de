"""Token counts of whole texts by a compiled tokenizer, without making the tokens.

Each Python process compiles the tokenizer once and keeps the states and steps that its texts
needed, at most ``transducer.MAX_STATES`` states. Whole texts are counted, in chunks side by side.

Defined results: a null or empty text has no bytes and no tokens. Names of special tokens inside a
text are one token each, as the tokenizer does by default. Repeated rows are counted each, null ids
stay null, an empty table gives no rows, other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from afterplay.llm.transducer import TokenCounter

_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """The compiled tokenizer of this Python process."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per row, by the tokenizer file at the path ``tokenizer``."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs[key].alias("doc_id"), text.alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("n_bytes long, n_tokens long").fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            tokens = pa.array(counter(tokenizer).count(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(texts).cast(pa.int64()), tokens], schema.names)

    return rows.mapInArrow(count, schema)
