import zlib

import numpy as np

from grouprank.llm.language_id import codewords, identify, language_id, ngram_bins, train
from tests.conftest import SF01
from tests.llm.helpers import awkward_documents, empty_documents


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF01 + "/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = language_id(docs).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 8, 20):
        code = codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= max(1, code.shape[1] // 4)
        assert (np.abs(code.sum(axis=0)) < n).all()  # every bit splits the languages
    assert codewords(1).shape == (1, 0)


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = language_id(docs).collect()
    assert len(rows) == docs.count()
    none = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert none == {3, 4, 8}
    assert all(r["score"] == 0 and r["ambiguous"] for r in rows if r["lang_pred"] == "und")
    assert language_id(empty_documents(spark)).collect() == []
    assert [r["lang_pred"] for r in language_id(docs.where("lang is null")).collect()].count("und") == docs.where("lang is null").count()


def test_numerals_are_no_letters(spark):
    texts = ["²³", "① ②", "🄀 𐄇", "𝒜", "😀", "Ⅷ ½ ٣", "12_3", "x²", "été", "ﬁ", "ʰ"]
    docs = spark.createDataFrame([(n, t, "en" if n % 2 else "fr") for n, t in enumerate(["some words", "des mots", *texts])], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in identify(docs, train(docs)).collect()}
    assert [found[n + 2] == "und" for n in range(len(texts))] == [not any(c.isalpha() for c in t) for t in texts]


def test_one_language(spark):
    docs = spark.createDataFrame([(1, "some text", "en"), (2, "more", "en")], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in identify(docs, train(docs)).collect()} == {("en", 1.0)}


def test_bins_see_whole_text():
    assert len(ngram_bins("ab")) == 3 + 2 + 1 and len(ngram_bins("1 !")) == 0
    assert sorted(ngram_bins("Ab  cd")) == sorted(ngram_bins("ab-CD"))
