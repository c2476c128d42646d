"""Edit-aware token counts: a segment tree of pre-token runs per document.

A text is cut into leaves of whole pre-tokens at places where one space stands
between two other characters, which no pre-token crosses.  A segment tree over
the leaves holds sums of characters and of token counts.  An edit finds the
leaves it touches by descending the tree, takes in a neighbour wherever the
edited text no longer ends at a safe place, encodes only that region anew and
updates the sums on the paths above it.

The tree lives with its document inside a task; documents are independent, so
nothing is shuffled, and a lost task repeats its own documents.

Edits ``(start, remove, insert)`` apply in array order, each to the text the
ones before left; positions are code points, cut to the text's length, and a
null array, edit or insert changes nothing.  A null text is empty.  Repeated
rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tillstar.llm.common import map_arrow
from tillstar.llm.tokens import Encoder, encoder

LEAF = 256  # characters a leaf has at least
SAFE = re.compile(r"(?<=\S) (?=\S)")
SCHEMA = (
    "doc_id bigint, n_tokens_before bigint, n_tokens bigint, n_chars bigint, n_edits int, "
    "n_leaves int, reencoded_chars bigint"
)


def leaves_of(text: str) -> list[str]:
    """Parts of a text of about ``LEAF`` characters, cut at safe places (before the space)."""
    out, start = [], 0
    while len(text) - start > LEAF:
        cut = SAFE.search(text, start + LEAF)
        if not cut:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


def safe(left: str, right: str) -> bool:
    """Whether no pre-token can reach over the border between two parts."""
    if not left or not right:
        return not left and not right
    return not left[-1].isspace() and len(right) > 1 and right[0] == " " and not right[1].isspace()


class TokenTree:
    """Leaves of one text, with sums of characters and tokens."""

    def __init__(self, text: str, enc: Encoder):
        self.enc, self.leaves = enc, leaves_of(text)
        self.width = 1 << (len(self.leaves) - 1).bit_length() if self.leaves else 1
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        self.encoded = 0  # characters encoded by edits
        for i, leaf in enumerate(self.leaves):
            self.chars[self.width + i] = len(leaf)
            self.tokens[self.width + i] = enc.count(leaf)
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _set(self, i: int, leaf: str, tokens: int) -> None:
        self.leaves[i] = leaf
        i += self.width
        self.chars[i], self.tokens[i] = len(leaf), tokens
        while i > 1:
            i //= 2
            self._sum(i)

    def find(self, at: int) -> tuple[int, int]:
        """(leaf, offset in it) of a character position; the end belongs to the last leaf."""
        if at >= self.chars[1]:
            i = len(self.leaves) - 1
            return i, len(self.leaves[i])
        i = 1
        while i < self.width:
            i *= 2
            if at >= self.chars[i]:
                at -= self.chars[i]
                i += 1
        return i - self.width, at

    def _beside(self, i: int, step: int) -> int | None:
        """The next leaf that is not empty."""
        i += step
        while 0 <= i < len(self.leaves):
            if self.leaves[i]:
                return i
            i += step
        return None

    def edit(self, start: int, remove: int, insert: str) -> None:
        start = max(0, min(start, self.chars[1]))
        stop = max(start, min(start + max(0, remove), self.chars[1]))
        a, i = self.find(start)
        b, j = self.find(stop)
        region = self.leaves[a][:i] + insert + self.leaves[b][j:]
        while (n := self._beside(a, -1)) is not None and not safe(self.leaves[n], region):
            a, region = n, self.leaves[n] + region
        while (n := self._beside(b, 1)) is not None and not safe(region, self.leaves[n]):
            b, region = n, region + self.leaves[n]
        self.encoded += len(region)
        for n in range(a + 1, b + 1):
            if self.leaves[n]:
                self._set(n, "", 0)
        self._set(a, region, self.enc.count(region))

    @property
    def text(self) -> str:
        return "".join(self.leaves)


def edited_counts(docs: DataFrame, tokenizer_path: str, added: bool = False) -> DataFrame:
    """Token counts before and after the edits of ``docs (doc_id, text, edits)``.

    ``edits``: array<struct<start:int, remove:int, insert:string>>.  With ``added`` the
    vocabulary's added tokens (without white space, so no leaf cuts them) count as one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        enc = encoder(tokenizer_path, added)
        for batch in batches:
            rows = []
            for doc, text, edits in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                tree = TokenTree(text.as_py() or "", enc)
                before, n = tree.tokens[1], 0
                for e in edits.as_py() or []:
                    if e is not None and e["start"] is not None:
                        tree.edit(e["start"], e["remove"] or 0, e["insert"] or "")
                        n += 1
                rows.append((doc, before, tree.tokens[1], tree.chars[1], n, len(tree.leaves), tree.encoded))
            yield {c.split()[0]: [r[i] for r in rows] for i, c in enumerate(SCHEMA.split(", "))}

    return map_arrow(docs.select("doc_id", "text", "edits"), run, SCHEMA)
