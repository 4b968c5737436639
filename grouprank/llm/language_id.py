"""Language identification by error-correcting output codes over byte n-grams (operator 9)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grouprank.llm.common import carried_schema, narrow, text_slices, with_carried

UNKNOWN = "und"
ORDERS = (2, 3, 4)
BINS = 1 << 14  # of each order
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Word characters that are neither letters nor digits: superscripts, circled and Roman numerals and the like. (A set of
#: characters up to U+FFFF is one lookup; with one beyond, it would be searched one by one.)
NUMERALS = re.compile("[" + "".join(c for c in map(chr, range(0x10000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()) + "]+")
ASTRAL = re.compile("[\U00010000-\U0010FFFF]")
#: Of the least loss of a codeword from the next one: closer ones are flagged ambiguous.
AMBIGUOUS_GAP = 0.02
#: How sharply differences of loss become a score.
SHARPNESS = 12.0


def ngram_bins(text: str) -> np.ndarray:
    """Bins of all n-grams of a text's lower-case words, one space between words; empty if there is no letter."""
    if not text.isascii():
        text = NUMERALS.sub(" ", text)
        text = ASTRAL.sub(lambda m: m[0] if m[0].isalpha() else " ", text)
    words = NOT_LETTERS.sub(" ", text).strip()
    if not words:
        return np.zeros(0, np.int64)
    b = np.frombuffer(f" {words.lower()} ".encode(), dtype=np.uint8).astype(np.uint32)
    found, key = [], b
    for order in range(2, max(ORDERS) + 1):
        key = key[:-1] * np.uint32(0x01000193) + b[order - 1:]  # wraps round, as hashes may
        if order in ORDERS:
            mixed = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            found.append((mixed >> np.uint32(18)).astype(np.int64) + ORDERS.index(order) * BINS)
    return np.concatenate(found)


def codewords(n: int) -> np.ndarray:
    """A row of +1/-1 for each of n classes. All splits of the classes if they are few, else spread random ones."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 7:
        splits = [s for s in range(1, 1 << (n - 1))]
        return np.array([[-1.0 if k and s >> (k - 1) & 1 else 1.0 for s in splits] for k in range(n)])
    bits, best, apart = 8 * int(np.ceil(np.log2(n))), None, -1
    draw = np.random.default_rng(9)
    for _ in range(64):
        code = np.array([draw.permutation(np.resize([1.0, -1.0], n)) for _ in range(bits)]).T
        distance = (bits - code @ code.T) / 2 + bits * np.eye(n)
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best


@dataclass
class LanguageCoder:
    """Languages, their codewords (languages x bits), weights of the bit classifiers (bins x bits), bits' strengths."""
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    strength: np.ndarray

    def losses(self, text: str) -> np.ndarray | None:
        """Loss of each language's codeword, None if the text has no letter."""
        bins = ngram_bins(text)
        if not len(bins) or not self.languages:
            return None
        total = np.zeros(self.code.shape[1])
        for at in range(0, len(bins), 1 << 18):
            total += self.weights.take(bins[at:at + (1 << 18)], axis=0).sum(axis=0, dtype=np.float64)
        margin = total / len(bins) / np.maximum(self.strength, 1e-9)
        share = self.strength / max(self.strength.sum(), 1e-9)
        return (np.logaddexp(0, -2 * self.code * margin) * share).sum(axis=1)

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous); the nearest codeword wins, ties go to the first language by name."""
        loss = self.losses(text) if text else None
        if loss is None:
            return UNKNOWN, 0.0, True
        close = np.exp(-SHARPNESS * (loss - loss.min()))
        order = np.sort(loss)
        near = len(order) > 1 and order[1] - order[0] < AMBIGUOUS_GAP
        return self.languages[int(loss.argmin())], float(close.max() / close.sum()), bool(near)


def fold(doc_id: str = "doc_id", parts: int = 4) -> Column:
    """crc32 of the id as text, modulo parts."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


def train(labelled: DataFrame) -> LanguageCoder:
    """Fit the bit classifiers from all rows of (text, lang): n-gram counts by language are summed over the corpus.

    Only the summed counts (languages x bins) reach the driver. A bit's classifier is the log-odds of an n-gram
    between the languages with the bit and those without, each language counting alike; its strength is the mean
    margin that these languages have.
    """
    bins = BINS * len(ORDERS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in text_slices(batches, "text", 4 << 20):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if len(found := ngram_bins(text)):
                    mine = sums.setdefault(lang, np.zeros(bins, np.int64))
                    some, n = np.unique(found, return_counts=True) if len(found) < bins else (slice(None), np.bincount(found, minlength=bins))
                    mine[some] += n
        for lang, mine in sums.items():
            some = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(mine[some], pa.int64())],
                ["lang", "bin", "n"])

    rows = (narrow(labelled, ("text", "string"), ("lang", "string")).where("text is not null and lang is not null")
            .mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
            .toArrow())
    languages = sorted(set(rows.column("lang").to_pylist()))
    place = {lang: k for k, lang in enumerate(languages)}
    counts = np.zeros((len(languages), bins))
    counts[[place[x] for x in rows.column("lang").to_pylist()], rows.column("bin").to_numpy()] = rows.column("n").to_numpy()
    share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * bins)
    code = codewords(len(languages))
    weights, strength = np.zeros((bins, code.shape[1]), np.float32), np.zeros(code.shape[1])
    for bit in range(code.shape[1]):
        yes, no = share[code[:, bit] > 0].mean(axis=0), share[code[:, bit] < 0].mean(axis=0)
        odds = np.log(yes / no)
        strength[bit] = ((yes - no) * odds).sum() / 2
        weights[:, bit] = odds - (((yes + no) / 2) * odds).sum()  # both sides' mean margins lie alike around 0
    return LanguageCoder(languages, code, weights, strength)


def identify(docs: DataFrame, coder: LanguageCoder, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and ambiguous for every document, from its whole text alone.

    Columns named in carry follow under c0, c1, ...
    Null text, and text without a letter, gives 'und' with score 0, flagged ambiguous. Null doc_id stays null,
    repeated rows are kept each, an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(coder)  # languages and bins bound its size

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 4 << 20):
            found = [model.value.decide(t) for t in batch.column(1).to_pylist()]
            lang, score, near = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(near, pa.bool_()), *batch.columns[2:]],
                ["doc_id", "lang_pred", "score", "ambiguous", *batch.schema.names[2:]])

    docs = with_carried(docs, (("doc_id", "long"), ("text", "string")), carry)
    return docs.mapInArrow(decide, "doc_id long, lang_pred string, score double, ambiguous boolean" + carried_schema(docs))


def language_id(docs: DataFrame, held_out_fold: int = 2, folds: int = 4) -> DataFrame:
    """Train on the documents outside the held-out fold, then predict all: doc_id, held_out, lang_pred, score, ambiguous.

    Documents without an id or a lang are predicted, not learned from.
    """
    coder = train(docs.where(fold("doc_id", folds) != held_out_fold))
    found = identify(docs, coder)
    held_out = F.coalesce(fold("doc_id", folds) == held_out_fold, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")
