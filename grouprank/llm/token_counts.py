"""Token counts of whole texts (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from grouprank.llm.common import narrow, text_slices
from grouprank.llm.tokenizing import BATCH_BYTES, token_lengths, tokenizer_path


#: The vocabulary's special string, which the library takes for one token inside texts.
SPECIAL = "<|endoftext|>"


def token_counts(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None, limit: int = 512) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Only lengths leave the encoder. Batches hold about a megabyte of text whatever the rows' sizes; a long text is
    cut where no token can span, so its pieces' counts add up to the whole text's count.
    Null text counts as empty (0 bytes, 0 tokens). A null doc_id stays null. Repeated rows are counted each.
    An empty table gives no rows. Special strings inside texts are handled as the library does by default.
    ``ranks`` is the rank file of the tokenizer's vocabulary, which encodes plain texts faster to the same ids; a
    tokenizer that is given without one encodes all texts itself.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    ranks = ranks if tokenizer else ranks or tokenizer_path("byte_bpe_50k.tiktoken")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 4 * BATCH_BYTES):
            n = token_lengths([t or "" for t in batch.column(1).to_pylist()], path, ranks, SPECIAL)
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(n, pa.int64()), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return narrow(docs, ("doc_id", "long"), ("text", "string")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
