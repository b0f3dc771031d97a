"""Edit-aware token counts (operator 3).

A text is cut at places that are pre-token borders whatever stands further
away, and runs of pieces become the leaves of a segment tree that holds token
counts.  An edit re-encodes the leaves it touches and, where it reaches a
border, the neighbour beyond it; then only the sums on the paths to the root
change.
"""
from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from airlens.llm import common as U
from airlens.llm.tokens import SpacedIds, spaced_ids

LEAF_PIECES = 32

#: Edits of the registered query: personal data and secrets are masked.  The
#: patterns start at the beginning of a run only, so long runs cost no more.
MASKS = (
    ("<EMAIL>", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")),
    ("<PHONE>", re.compile(r"(?<![\w.])\+?\(?\d{1,4}\)?[ .-]\(?\d{2,4}\)?[ .-]\d{3,4}(?:[ .-]?\d{2,4})?(?![\w])")),
    ("<ADDRESS>", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w.])")),
    ("<SECRET>", re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+")),
)
_DIGIT = re.compile(r"\d")


def mask_edits(text: str) -> list[tuple[int, int, str]]:
    """(start, end, replacement), in order, none overlapping; of overlapping
    finds the first listed kind stays.  A secret has a digit."""
    taken: list[tuple[int, int, str]] = []
    if not _DIGIT.search(text) and "@" not in text:
        return taken
    for name, pattern in MASKS:
        before = list(taken)
        for m in pattern.finditer(text):
            if name == "<SECRET>" and not _DIGIT.search(m[0]):
                continue
            at = bisect(before, (m.start(),))
            if (not at or before[at - 1][1] <= m.start()) and (at == len(before) or m.end() <= before[at][0]):
                taken.append((m.start(), m.end(), name))
        taken.sort()
    return taken


class CountedText:
    """Token counts of a text under edits.

    ``leaves`` are the parts of the text; ``tree`` holds their counts at
    size..2*size-1 and sums above, tree[1] being the count of the text."""

    def __init__(self, text: str, encoder: SpacedIds, leaf_pieces: int = LEAF_PIECES):
        self.encoder = encoder
        pieces = encoder.pieces(text)
        counts = encoder.counts(pieces)
        cuts = range(0, len(pieces), leaf_pieces)
        self.leaves = ["".join(pieces[k:k + leaf_pieces]) for k in cuts]
        self.size = 1 << max(0, (len(self.leaves) - 1).bit_length())
        self.tree = np.zeros(2 * self.size, np.int64)
        own = np.add.reduceat(counts, list(cuts))
        self.tree[self.size:self.size + len(own)] = own
        self.length = np.zeros(2 * self.size, np.int64)
        self.length[self.size:self.size + len(own)] = [len(x) for x in self.leaves]
        for level in (self.tree, self.length):
            width = self.size
            while width > 1:
                level[width // 2:width] = level[width:2 * width].reshape(-1, 2).sum(axis=1)
                width //= 2
        self.encoded = 0  # characters that edits made us encode again

    @property
    def count(self) -> int:
        return int(self.tree[1])

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """(leaf, offset in it) of a character; the end is in the last leaf."""
        node = 1
        while node < self.size:
            node *= 2
            if at >= self.length[node] and self.length[node + 1]:
                at -= self.length[node]
                node += 1
        return node - self.size, int(at)

    def _set(self, leaf: int, text: str, count: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.size
        grow, more = len(text) - self.length[node], count - self.tree[node]
        while node:
            self.length[node] += grow
            self.tree[node] += more
            node //= 2

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters start..end by ``new``.

        A border stays a border as long as the two characters before and the
        two after it stay; otherwise the region grows over it."""
        first, lo = self._leaf_at(start)
        last, hi = self._leaf_at(max(start, end))
        while first and lo < 2:
            first -= 1
            lo += len(self.leaves[first])
        region = "".join(self.leaves[first:last + 1])
        cut = lo + end - start
        while last + 1 < len(self.leaves) and len(region) - cut < 2:
            last += 1
            region += self.leaves[last]
        region = region[:lo] + new + region[cut:]
        self.encoded += len(region)
        # Beyond the region nothing changes, as its outer borders stay.  The
        # pieces are dealt evenly over the region's leaves, so none grows by
        # taking in its neighbours.
        pieces = self.encoder.pieces(region)
        counts = self.encoder.counts(pieces)
        width = -(-len(pieces) // (last + 1 - first))
        for leaf in range(first, last + 1):
            at = (leaf - first) * width
            self._set(leaf, "".join(pieces[at:at + width]), sum(counts[at:at + width]))


COUNTED = ("doc_id long, n_tokens long, n_edits long, n_tokens_edited long, n_leaves long, n_chars long, "
           "reencoded_chars long")


def count_batches(batches: Iterator[pa.RecordBatch], path: str, edits_of) -> Iterator[pa.RecordBatch]:
    encoder = spaced_ids(path)
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py()
            counted = CountedText(text, encoder)
            before, edits = counted.count, edits_of(text)
            for start, end, new in reversed(edits):
                counted.edit(start, end, new)
            rows.append((doc_id, before, len(edits), counted.count, len(counted.leaves), len(text), counted.encoded))
        cols = zip(*rows) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                         names=[c.split()[0] for c in COUNTED.split(", ")])


def count_edited(docs: DataFrame, tokenizer_path: str, edits_of=mask_edits) -> DataFrame:
    """One row per row of ``docs``: token counts before and after its edits,
    which ``edits_of(text)`` gives as (start, end, replacement).

    Null and empty texts have no tokens; repeated rows are counted each for
    itself."""
    return U.doc_text(docs).mapInArrow(lambda it: count_batches(it, tokenizer_path, edits_of), COUNTED)


def op3_token_edits(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_edited(U.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
