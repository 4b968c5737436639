import numpy as np

from grouprank.llm.decontamination import RADIUS, ItemIndex, contaminated, similarity
from grouprank.llm.shingles import shingle_hashes, word_hashes
from tests.llm.helpers import awkward_documents, empty_documents, prose


def test_words_and_shingles():
    words, first = word_hashes(["The cat, the CAT!", None, "", "été_1 x"])
    assert np.diff(first).tolist() == [4, 0, 0, 2]
    assert words[0] == words[2] and words[1] == words[3] and words[0] != words[1]
    shingles, first = shingle_hashes(["a b c d e f a b c d e", "a b c", "c b a", "a b c d e"])
    assert np.diff(first).tolist() == [7, 1, 1, 1]
    assert shingles[0] == shingles[6] == shingles[9] and shingles[7] != shingles[8]


def test_blocks_find_all_within_the_radius():
    draw = np.random.default_rng(5)
    index = ItemIndex.of(list(range(60)), [prose(i, 30) for i in range(60)])
    for _ in range(200):
        print_ = index.prints[draw.integers(60)] ^ np.uint64(sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 30), False)))
        want = [i for i, p in enumerate(index.prints) if int(p ^ print_).bit_count() <= RADIUS]
        assert index.within_radius(print_).tolist() == want


def test_passages_are_found_and_clean_documents_left(spark):
    items = {i: prose(1000 + i, 20 + i) for i in range(30)}
    docs = [(i, f"{prose(i, 50)}. {items[i].upper()}! {prose(99 + i, 40)}") for i in range(30)]
    docs += [(100 + i, prose(2000 + i, 120)) for i in range(30)]
    docs += [(200, items[29].replace(items[29].split()[0], "other", 1)), (201, " ".join(items[29].split()[:25]))]
    benchmark = spark.createDataFrame([*items.items(), (50, None), (51, ""), (None, prose(3, 25))], "item_id long, text string")
    rows = {r["doc_id"]: r for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()}
    for i in range(30):
        r = rows[i]
        assert i in r["items"] and r["is_contaminated"] and r["similarities"][r["items"].index(i)] == 1.0
        assert (r["first_words"][r["items"].index(i)], r["n_words"][r["items"].index(i)]) == (50, 20 + i)
    assert not any(rows[100 + i]["is_contaminated"] for i in range(30))
    assert rows[200]["items"] == [29] and rows[201]["items"] == []


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    import grouprank.llm.decontamination as m
    docs = spark.createDataFrame([(i, prose(i, 60)) for i in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(prose(i, 60).split()[5:40])) for i in range(20)], "item_id long, text string")
    whole = sorted(contaminated(docs, items).collect())
    monkeypatch.setattr(m, "ITEM_BLOCK", 6)
    assert sorted(contaminated(docs, items).collect()) == whole and all(r["items"] == [r["doc_id"]] for r in whole)


def test_similarity_weighs_by_occurrence():
    a = np.array([1, 1, 2], np.uint64)
    assert similarity(a, np.array([1, 2, 3], np.uint64)) == 2 / 4


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    items = spark.createDataFrame([(1, prose(2, 80)), (None, prose(4, 60))], "item_id long, text string")
    found = sorted((str(r["doc_id"]), r["items"]) for r in contaminated(docs, items).collect())
    want = {"1": [1], "2": [1], "7": [1], "None": [1], "11": [None]}
    assert found == sorted((str(r["doc_id"]), want.get(str(r["doc_id"]), [])) for r in docs.collect())
    assert contaminated(empty_documents(spark), items).collect() == []
    assert not any(r["is_contaminated"] for r in contaminated(docs, items.limit(0)).collect())
