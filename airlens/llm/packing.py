"""Sum-of-squares online packing of token sequences (operator 10).

Each document is placed, as it comes, into the fill level that makes the sum
over levels of (number of windows at that level) squared smallest.  Only the
array of level counts and the windows still open are kept; when these are too
many, the fullest are topped up with pieces of the emptiest until half of them
are left.  Texts longer than a window fill whole windows first.  When a
partition ends, its open windows are topped up in the same way, and what is
left of the last one is cut into lengths that are powers of two, which need no
padding.

Partitions pack independently, so nothing is shuffled and a lost task is
simply run again.
"""
from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm import common as U

SEQ_LEN = 2048
END_ID = 1
#: Open windows of a task: at most 8 MB of ids at 2,048 tokens a window.
MOST_OPEN = 1024
PIECES = ("doc_id long, row_id long, start long, length long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")


class SumOfSquares:
    """Windows of ``size`` tokens; a window is [fill, [(row, start, length)]].

    ``place`` returns the windows that became full."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(size + 1)]

    def level_for(self, n: int) -> int:
        """Fill level (0: a new window) for an item of n < size tokens.

        Moving a window from level h to h+n changes the sum of squares by
        2(N[h+n] - N[h]) + 2, a new window by 2 N[n] + 1, a window that
        becomes full by 1 - 2 N[h].  Ties go to the fuller window."""
        top, count = self.size - n, self.count
        cost = 2 * (count[n:self.size + 1] - count[:top + 1]) + 2
        cost[top] = 1 - 2 * count[top]
        cost[count[:top + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * count[n] + 1
        return top - int(np.argmin(cost[::-1]))

    def place(self, row: int, start: int, n: int) -> list | None:
        if n == self.size:
            return [(row, start, n)]
        h = self.level_for(n)
        if h:
            window = self.open[h].pop()
            self.count[h] -= 1
        else:
            window = []
        window.append((row, start, n))
        if h + n == self.size:
            return window
        self.open[h + n].append(window)
        self.count[h + n] += 1
        return None

    def _top_up(self, left: deque, until: int) -> Iterator[list]:
        """Full windows from ``left`` [(fill, window)], fullest first: the
        emptiest ones give their pieces, cut where needed.  Ends when ``until``
        are left, or none can be filled; what remains stays in ``left``."""
        giver: list = []
        while len(left) + bool(giver) > until and (len(left) > 1 or left and giver):
            fill, window = left.popleft()
            room = self.size - fill
            while room and (giver or left):
                if not giver:
                    giver = left.pop()[1]
                row, start, n = giver.pop()
                if n > room:
                    giver.append((row, start + room, n - room))
                    n = room
                window.append((row, start, n))
                room -= n
            if room:  # nothing is left to give
                left.append((self.size - room, window))
                return
            yield window
        if giver:
            left.append((sum(n for _, _, n in giver), giver))

    def _take_all(self) -> deque:
        left = deque((h, w) for h in range(self.size - 1, 0, -1) for w in self.open[h])
        self.open = [[] for _ in range(self.size + 1)]
        self.count[:] = 0
        return left

    def relieve(self, most: int) -> Iterator[list]:
        """Full windows, until at most half of ``most`` are open."""
        left = self._take_all()
        yield from self._top_up(left, most // 2)
        for fill, window in left:
            self.open[fill].append(window)
            self.count[fill] += 1

    @property
    def n_open(self) -> int:
        return int(self.count.sum())

    def finish(self) -> Iterator[list]:
        """Closes the open windows; the last rest is cut at powers of two."""
        left = self._take_all()
        yield from self._top_up(left, 0)
        giver = [piece for _, window in left for piece in window]
        rest = sum(n for _, _, n in giver)
        while rest:
            size = 1 << (rest.bit_length() - 1)
            rest -= size
            window, room = [], size
            while room:
                row, start, n = giver.pop()
                if n > room:
                    giver.append((row, start + room, n - room))
                    n = room
                window.append((row, start, n))
                room -= n
            yield window


def pack_batches(batches: Iterator[pa.RecordBatch], path: str, size: int, end_id: int,
                 most_open: int = MOST_OPEN) -> Iterator[pa.RecordBatch]:
    from airlens.llm.tokens import slices, word_ids
    encoder, end = word_ids(path), int(end_id).to_bytes(4, "little")
    part = TaskContext.get().partitionId() << 32
    packer = SumOfSquares(size)
    # row -> [doc_id, ids from a token on, tokens not yet emitted, all tokens, that token]
    texts: dict[int, list] = {}
    out: list[tuple] = []
    held, n_seq, n_row = 0, 0, 0
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "row_id", "start", "length", "doc_tokens",
                                                  "sequence_id", "offset")] + [("ids", pa.binary())])

    def emit(window: list) -> None:
        nonlocal held, n_seq
        offset = 0
        for row, start, n in window:
            doc = texts[row]
            doc_id, ids, _, total, base = doc
            out.append((doc_id, part + row, start, n, total, part + n_seq, offset,
                        ids[4 * (start - base):4 * (start + n - base)]))
            offset += n
            held += 4 * n + 64
            doc[2] -= n
            if not doc[2]:
                del texts[row]
        n_seq += 1

    def flush() -> pa.RecordBatch:
        nonlocal held
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        held = 0
        return batch

    for batch in batches:
        encoded = (ids for part in slices(batch.column("text").to_pylist()) for ids in encoder.many(part))
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
            ids += end
            total = len(ids) // 4
            texts[n_row] = [doc_id, ids, total, total, 0]
            whole = total - total % size
            for start in range(0, whole, size):
                emit([(n_row, start, size)])
                if held > 8_000_000:
                    yield flush()
            if total > whole:
                if whole:  # only the rest is kept while its window is open
                    texts[n_row][1], texts[n_row][4] = ids[4 * whole:], whole
                window = packer.place(n_row, whole, total - whole)
                if window:
                    emit(window)
                elif packer.n_open > most_open:
                    for window in packer.relieve(most_open):
                        emit(window)
                        if held > 8_000_000:
                            yield flush()
            n_row += 1
            if held > 8_000_000:
                yield flush()
    for window in packer.finish():
        emit(window)
        if held > 8_000_000:
            yield flush()
    if out:
        yield flush()


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, row_id (the document's row, as ids may
    repeat), start, length, doc_tokens, sequence_id, offset and ids (packed
    little-endian unsigned 32-bit).

    Null and empty texts are the end id alone; a null doc_id stays null;
    repeated rows are packed each for itself.  Every id lies in one piece,
    offsets in a sequence have no gaps, and no sequence needs padding except
    that its length is below ``seq_len`` only at a power of two."""
    src = U.doc_text(docs)
    return src.mapInArrow(lambda it: pack_batches(it, tokenizer_path, seq_len, end_id), PIECES)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack(U.documents(spark, sf_dir), tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
