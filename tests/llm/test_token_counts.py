from grouprank.llm.token_counts import token_counts
from grouprank.llm.tokenizing import json_tokenizer, safe_pieces, tokenizer_path
from tests.llm.helpers import awkward_documents, empty_documents, prose


def test_counts_equal_the_library(spark):
    docs = awkward_documents(spark)
    tokenizer = json_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids))
                  for r in docs.collect())
    rows = token_counts(docs, limit=100).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in rows)
    assert token_counts(empty_documents(spark)).collect() == []


def test_every_text_of_a_table(spark):
    """The rank file's counts are the library's for all documents, texts with special strings and other scripts too."""
    from pyspark.sql import functions as F
    from tests.conftest import SF01
    docs = spark.read.parquet(SF01.replace("0.01", "0.1") + "/documents.parquet").select("doc_id", "text")
    odd = ["<|endoftext|>", "a <|endoftext|>\n<|endoftext|> b", "日本語 text", "naïve café ﬁ", "\u0345 \u0250", "😀😀", "a\u0000b", "\u00a0 \u2003x"]
    docs = docs.union(spark.createDataFrame([(-1 - n, t) for n, t in enumerate(odd)], "doc_id long, text string"))
    tokenizer = json_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    rows = docs.collect()
    want = {r.doc_id: len(e) for r, e in zip(rows, tokenizer.encode_batch_fast([r.text or "" for r in rows], add_special_tokens=False), strict=True)}
    assert {r.doc_id: r.n_tokens for r in token_counts(docs).select(F.col("doc_id"), "n_tokens").collect()} == want
    few = docs.where("doc_id < 50")
    alone = token_counts(few, tokenizer=tokenizer_path("byte_bpe_50k.json"))
    assert {r.doc_id: r.n_tokens for r in alone.collect()} == {k: v for k, v in want.items() if k < 50}


def test_cuts_change_no_token():
    tokenizer = json_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    for text in [prose(1, 3000), "it's  we've\n\n\nthey'll 12 " * 300, "abc<|endoftext|> def " * 200, "a" * 3000, " \n " * 900]:
        pieces = safe_pieces(text, 500)
        assert "".join(pieces) == text
        whole = tokenizer.encode(text, add_special_tokens=False).ids
        assert sum((tokenizer.encode(p, add_special_tokens=False).ids for p in pieces), []) == whole
