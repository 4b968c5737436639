"""Encoding with public tokenizer files inside tasks: batches balanced by bytes, long texts cut where tokens end."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np

#: Pieces that long texts are cut into, and the bytes of text encoded at a time.
PIECE_CHARS = 32_768
BATCH_BYTES = 1 << 20

#: The byte-level pre-tokenizer always starts a new word where white space follows a letter, so a cut there
#: changes no token. (It looks ahead only within a run of white space, and no cut falls inside such a run.)
SAFE_CUT = re.compile(r"(?<=[A-Za-z])(?=[ \n])")

#: Code points past this one are left to the tokenizers library: two libraries may follow different Unicode versions.
PLAIN = re.compile("[^\x00-ɏ]")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def json_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def rank_encoder(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, most: int = PIECE_CHARS) -> list[str]:
    """Cut a text into pieces of about `most` characters whose tokens, one after another, are the text's tokens.

    A stretch without a safe place stays whole.
    """
    if len(text) <= most:
        return [text]
    pieces, start = [], 0
    while len(text) - start > most:
        cut = SAFE_CUT.search(text, start + most)
        if cut is None:
            break
        pieces.append(text[start:cut.start()])
        start = cut.start()
    pieces.append(text[start:])
    return pieces


def by_library(text: str, special: str) -> bool:
    """Whether only the tokenizers library is sure to encode a text: it has a special string, or characters past Latin."""
    return special in text or (not text.isascii() and PLAIN.search(text) is not None)


def token_lengths(texts: list[str], json_path: str, ranks_path: str | None, special: str) -> np.ndarray:
    """Tokens of each text as the tokenizers library counts them for json_path; ids never leave the encoder.

    With the rank file of the same vocabulary, texts that need no library (by_library) are encoded with that.
    """
    pieces, owner, total = [], [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        parts = safe_pieces(text)
        if ranks_path is None or by_library(text, special):
            pieces += parts
            owner += [i] * len(parts)
        else:
            encoder = rank_encoder(ranks_path)
            total[i] = sum(len(encoder.encode_to_numpy(p)) for p in parts if p)
    start, size = 0, 0
    for end, piece in enumerate(pieces, 1):
        size += len(piece)
        if size >= BATCH_BYTES or end == len(pieces):
            lengths = [len(e) for e in json_tokenizer(json_path).encode_batch_fast(pieces[start:end], add_special_tokens=False)]
            np.add.at(total, owner[start:end], lengths)
            start, size = end, 0
    return total


def token_ids(text: str, json_path: str, ranks_path: str, special: str) -> np.ndarray:
    """Ids of one text, as the tokenizers library gives them for json_path (uint32).

    The same vocabulary as a rank file is several times faster to encode with and gives the same ids for texts
    without special strings; texts with one, or with characters past Latin, go to the tokenizers library itself.
    """
    parts = safe_pieces(text)
    if by_library(text, special):
        encoded = json_tokenizer(json_path).encode_batch_fast(parts, add_special_tokens=False)
        ids = [np.array(e.ids, dtype=np.uint32) for e in encoded]
    else:
        encoder = rank_encoder(ranks_path)
        ids = [encoder.encode_to_numpy(p) if p else np.zeros(0, np.uint32) for p in parts]
    return ids[0].astype(np.uint32, copy=False) if len(ids) == 1 else np.concatenate(ids).astype(np.uint32, copy=False)
