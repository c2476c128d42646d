"""Byte-level BPE ids of whole texts, with a per-worker cache of text pieces.

A pre-token of the vocabulary's split rule never reaches over a place where
one plain space stands between two characters that are not white space.  Such
places cut a text into pieces whose ids do not depend on their neighbours, so
each distinct piece is encoded once per worker.  A text with any other white
space next to a space is encoded whole.

An added token of the vocabulary file (``<|endoftext|>``) that stands in a text
is plain text by default; with ``added`` it gets its own id, as from the file's
tokenizer called with ``add_special_tokens=False`` and nothing else set.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

CACHE_PIECES = 1 << 19  # pieces kept per worker before the cache starts anew (memory bound only)


class _Irregular(Exception):
    pass


def tiktoken_twin(path: str):
    """The same vocabulary as ranks beside ``path`` (much faster), or None."""
    import base64
    import os

    twin = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(twin):
        return None
    import public_tokenizers
    import tiktoken

    with open(twin, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# Runs this long are given to the slower library, which is linear in them.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


class Encoder(dict):
    """``ids(text)``: little-endian unsigned 32-bit ids, one after the other."""

    def __init__(self, path: str, added: bool = False):
        super().__init__()
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = not added
        self.added = [t.content for t in self.slow.get_added_tokens_decoder().values()] if added else []
        self.slow.no_truncation()
        self.fast = tiktoken_twin(path)

    def whole(self, text: str) -> bytes:
        if self.fast is None or LONG_RUN.search(text):
            ids = self.slow.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.asarray(ids, dtype="<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Irregular
        if len(self) >= CACHE_PIECES:
            self.clear()
        got = self.whole(" " + piece)
        if len(piece) <= 64:
            self[piece] = got
        return got

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if any(content in text for content in self.added):
            return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        pieces = text.split(" ")
        first = pieces.pop(0)
        if not pieces or (first and first[-1].isspace()):
            return self.whole(text)
        try:
            return (self.whole(first) if first else b"") + b"".join([self[p] for p in pieces])
        except _Irregular:
            return self.whole(text)

    def count(self, text: str) -> int:
        return len(self.ids(text)) // 4


@lru_cache(maxsize=2)
def encoder(path: str, added: bool = False) -> Encoder:
    """One encoder per worker process, vocabulary file and reading of added tokens."""
    return Encoder(path, added)
