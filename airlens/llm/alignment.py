"""Cross-tokenizer alignment with inverted pair bitmaps (operator 13).

Two tokenizers cut the same bytes.  Where tokens of both end, a group ends;
two tokens are linked where their byte ranges overlap.  For every pair of
linked ids there is a posting list: per block of up to 65,536 documents, one
compressed bitmap for each binary digit ("plane") of the number of links in a
document.  Partial bitmaps of a block are OR-merged; the planes' OR, popcounted,
is the number of documents of a pair, and the popcounts weighted by 2^plane are
its number of links.  The scored postings are then read back by block, which
gives each document the sums over its own links.

Texts are cut before single spaces between visible characters.  Both
tokenizers begin a token there, so tokens, groups and links of a text are those
of its pieces, and a worker works out each short piece once.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlens.llm import common as U
from airlens.llm.tokens import slices
from airlens.session import materialise, settled

#: Documents and postings of a block at most; postings held before they are written.
BLOCK_DOCS, BLOCK_POSTINGS, HELD_POSTINGS = 1 << 16, 1 << 24, 1 << 21
#: Pieces up to this length are remembered, in a table of up to so many bytes.
PIECE_CHARS, TABLE_BYTES = 48, 128 << 20
#: The space comes first, so that the search passes over all else quickly.
_SPACE = re.compile(r" (?<=[!-~\w] )(?=[!-~\w])")
#: Scores are broadcast up to so many pairs (40 MB), and joined by a shuffle beyond.
BROADCAST_PAIRS = 1_000_000
#: A bitmap of a block; fewer places than this are listed, two bytes each.
_MAP_BYTES = BLOCK_DOCS // 8
_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")

POSTINGS = "kind int, block long, a int, b int, plane int, docs binary"
DOCS = "slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ARROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int32()),
                    ("docs", pa.binary()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())])


class _Grow:
    """An array that grows at its end."""

    def __init__(self, dtype, *shape: int):
        self.buf, self.n = np.empty((1024, *shape), dtype), 0

    def add(self, more) -> None:
        end = self.n + len(more)
        if end > len(self.buf):
            wide = np.empty((max(end, 2 * len(self.buf)), *self.buf.shape[1:]), self.buf.dtype)
            wide[:self.n] = self.buf[:self.n]
            self.buf = wide
        self.buf[self.n:end] = more
        self.n = end

    @property
    def all(self) -> np.ndarray:
        return self.buf[:self.n]


def _byte_level() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: visible
    Latin-1 characters for themselves, the others in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Groups and links of texts under two vocabularies, by remembered pieces."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_level()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = (bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode())
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if self.b.is_byte(i) and (m := _BYTE_PIECE.fullmatch(p))
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        #: An id and what follows it: more of its side, the other side or a group, the end of a piece.
        self.text_a = np.array([[f"{i}{m}" for i in range(len(self.bytes_a))] for m in ",|"], object)
        self.text_b = np.array([[f"{i}{m}" for i in range(len(self.bytes_b))] for m in ",;\n"], object)
        #: A piece of B that goes on after a space would not end at our cuts.
        self.cut = _SPACE if not any("▁" in p.lstrip("▁") for p in pieces) else re.compile(r"(?!)")
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.pair_of: dict[int, int] = {}
        self.codes = _Grow(np.int64)                       # a << 32 | b of each pair number
        self.counts = _Grow(np.int64, 4)                   # n_a, n_b, n_groups, n_links of each piece; -1: no tokens
        self.first, self.size, self.links = _Grow(np.int64), _Grow(np.int64), _Grow(np.int32)
        self.held = 0

    def _learn(self, pieces: list[str]) -> None:
        """Work out pieces, each of which begins with a space, and append them."""
        ids_a = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        ids_b = self.b.encode([p[1:] for p in pieces], num_threads=1)
        raw = [p.encode() for p in pieces]
        ta, tb = self.bytes_a, self.bytes_b
        fa, fb = list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b))
        whole, good = b"".join(raw), np.ones(len(pieces), bool)
        if b"".join([ta[i] for i in fa]) != whole or b"".join([tb[i] for i in fb]) != whole:
            good = np.array([b"".join([ta[i] for i in x]) == r and b"".join([tb[i] for i in y]) == r
                             for x, y, r in zip(ids_a, ids_b, raw)], bool)
            fa = [i for x, ok in zip(ids_a, good) if ok for i in x]
            fb = [i for y, ok in zip(ids_b, good) if ok for i in y]
        a, b = np.array(fa, np.int64), np.array(fb, np.int64)
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ends = np.cumsum(np.where(good, [len(r) for r in raw], 0))
        # Between neighbouring ends of either kind lies exactly one linked pair.
        both = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        new = np.diff(both, prepend=-1) > 0
        every, common = both[new], both[~new]
        codes = a[np.searchsorted(ends_a, every)] << 32 | b[np.searchsorted(ends_b, every)] if len(every) else every

        def within(x: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(x, ends, side="right"), prepend=0)
        counts = np.stack([within(ends_a), within(ends_b), within(common), within(every)], 1)
        size = counts[:, 3].copy()
        counts[~good] = -1
        new_codes, inverse = np.unique(codes, return_inverse=True)
        missing = [c for c in new_codes.tolist() if c not in self.pair_of]
        self.pair_of.update(zip(missing, range(len(self.pair_of), len(self.pair_of) + len(missing))))
        self.codes.add(missing)
        numbers = np.array([self.pair_of[c] for c in new_codes.tolist()], np.int32)
        self.first.add(self.links.n + np.cumsum(size) - size)
        self.size.add(size)
        self.links.add(numbers[inverse] if len(codes) else numbers)
        self.counts.add(counts)
        texts = self._written(a, b, ends_a, ends_b, common, ends, good)
        self.groups += texts
        self.held += sum(map(len, texts)) + len(whole) + 4 * len(codes) + 250 * len(pieces) + 120 * len(missing)

    def _written(self, a, b, ends_a, ends_b, common, ends, good) -> list[str]:
        """The groups of each piece as text: every token's id with the mark that
        follows it, in the order of groups, A's before B's."""
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        n_a, n_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
        out = np.empty(len(a) + len(b), object)
        last_a, last_b = common[group_a] == ends_a, common[group_b] == ends_b
        mark_b = last_b.astype(int) + (ends[np.searchsorted(ends, ends_b)] == ends_b)
        out[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[group_a]] = self.text_a[last_a.astype(int), a]
        out[np.arange(len(b)) + np.cumsum(n_a)[group_b]] = self.text_b[mark_b, b]
        written = iter("".join(out.tolist()).split("\n"))
        return [next(written) if ok else "" for ok in good]

    def many(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(counts, digests, text, code, links): n_a, n_b, n_groups, n_links and
        the digest of the groups of each text; then, for each text and pair of
        ids that it links, how many links."""
        if self.held > TABLE_BYTES:
            self.clear()
        cut = [self.cut.split(t) if t else [] for t in texts]  # without the space before each piece
        numbers = [list(map(self.known.get, pieces)) for pieces in cut]
        missing = [[k for k, n in enumerate(x) if n is None] for x in numbers]
        wanted = {pieces[k] for pieces, at in zip(cut, missing) for k in at}
        short = [p for p in wanted if len(p) < PIECE_CHARS]
        if short:
            self.known.update(zip(short, range(len(self.groups), len(self.groups) + len(short))))
            self._learn([" " + p for p in short])
        # Long pieces are worked out for this call only; the pairs they meet stay.
        pairs = len(self.pair_of)
        known, stay = self.known, (len(self.groups), self.links.n, self.held)
        long = [p for p in wanted if len(p) >= PIECE_CHARS]
        once = dict(zip(long, range(stay[0], stay[0] + len(long))))
        if long:
            self._learn([" " + p for p in long])
        for pieces, x, at in zip(cut, numbers, missing):
            for k in at:
                x[k] = once[pieces[k]] if pieces[k] in once else known[pieces[k]]
        flat = np.fromiter(chain.from_iterable(numbers), np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in numbers])
        per_piece = self.counts.all[flat]
        lost = np.zeros(len(texts), bool)
        lost[owner[per_piece[:, 0] < 0]] = True
        keep = ~lost[owner]
        flat, owner, per_piece = flat[keep], owner[keep], per_piece[keep]
        ends = np.searchsorted(owner, np.arange(len(texts)), side="right")
        counts = np.diff(np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(per_piece, axis=0)])[ends], axis=0,
                         prepend=np.zeros((1, 4), np.int64))
        groups = self.groups
        digests = ["" if gone or not x else hashlib.sha256(";".join([groups[i] for i in x]).encode()).hexdigest()
                   for x, gone in zip(numbers, lost)]
        size = self.size.all[flat]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first.all[flat], size)
        key = np.sort(np.repeat(owner, size) << 32 | self.links.all[at])
        head = np.flatnonzero(np.diff(key, prepend=-1))
        links = np.diff(head, append=len(key))
        text, code = key[head] >> 32, self.codes.all[key[head] & 0xFFFFFFFF]
        if long:
            del self.groups[stay[0]:]
            self.counts.n = self.first.n = self.size.n = stay[0]
            self.links.n, self.held = stay[1], stay[2] + 120 * (len(self.pair_of) - pairs)
        return counts, digests, text, code, links


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process, kept between tasks."""
    return Aligner(path_a, path_b)


# -- bitmaps -----------------------------------------------------------------
def pack(slots: np.ndarray, head: np.ndarray) -> pa.Array:
    """Compressed bitmaps: ``slots`` sorted within runs that start at ``head``.
    A run is listed with two bytes a place, or a map of all places if shorter."""
    size = np.diff(head, append=len(slots))
    if not (size >= _MAP_BYTES // 2).any():
        offsets = np.append(head, len(slots)) * 2
        if offsets[-1] < 1 << 31:
            return pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                                                  pa.py_buffer(slots.astype(np.uint16).tobytes())])
    out = []
    for i, n in zip(head.tolist(), size.tolist()):
        mine = slots[i:i + n]
        if n < _MAP_BYTES // 2:
            out.append(mine.astype(np.uint16).tobytes())
        else:
            bits = np.zeros(BLOCK_DOCS, bool)
            bits[mine] = True
            out.append(np.packbits(bits, bitorder="little").tobytes())
    return pa.array(out, pa.binary())


def unpack(maps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap, slot) of every bit set."""
    offsets = np.frombuffer(maps.buffers()[1], np.int32, len(maps) + 1, maps.offset * 4).astype(np.int64)
    size = np.diff(offsets)
    data = maps.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    dense = np.flatnonzero(size == _MAP_BYTES)
    if not len(dense):
        return (np.repeat(np.arange(len(maps)), size // 2),
                np.frombuffer(raw[offsets[0]:offsets[-1]].tobytes(), np.uint16).astype(np.int64))
    at, slot = [], []
    edge = [0, *dense.tolist(), len(maps)]
    for k, (i, j) in enumerate(zip(edge, edge[1:])):
        i += k > 0  # the map itself came before
        at.append(np.repeat(np.arange(i, j), size[i:j] // 2))
        slot.append(np.frombuffer(raw[offsets[i]:offsets[j]].tobytes(), np.uint16).astype(np.int64))
        if j < len(maps):
            found = np.flatnonzero(np.unpackbits(raw[offsets[j]:offsets[j + 1]], bitorder="little"))
            at.append(np.full(len(found), j))
            slot.append(found)
    return np.concatenate(at), np.concatenate(slot)


def _planes(code: np.ndarray, slot: np.ndarray, links: np.ndarray) -> Iterator[tuple[np.ndarray, int, pa.Array]]:
    """(codes, plane, bitmaps) of postings sorted by code and slot."""
    plane = 0
    while len(code):
        bit = (links >> plane) & 1 == 1
        c, s = code[bit], slot[bit]
        if len(c):
            head = np.flatnonzero(np.diff(c, prepend=-1))
            yield c[head], plane, pack(s, head)
        plane += 1
        more = links >> plane > 0
        code, slot, links = code[more], slot[more], links[more]


def _table(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
                                       else columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def _index(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, block_docs: int,
           most_held: int) -> Iterator[pa.RecordBatch]:
    """Postings (kind 0) and documents (kind 1) of one task's blocks."""
    align, part = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
    block, n_docs, n_postings, held = 0, 0, 0, []

    def postings() -> Iterator[pa.RecordBatch]:
        code, slot, links = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.argsort(code, kind="stable")  # slots rise already
        for c, plane, maps in _planes(code[order], slot[order], links[order]):
            for at in range(0, len(c), 20_000):
                mine = c[at:at + 20_000]
                yield _table(len(mine), kind=np.zeros(len(mine), np.int32), block=np.full(len(mine), part + block),
                             a=(mine >> 32).astype(np.int32), b=(mine & 0xFFFFFFFF).astype(np.int32),
                             plane=np.full(len(mine), plane, np.int32), docs=maps.slice(at, 20_000))
    for batch in batches:
        ids, done = batch.column("doc_id"), 0
        for texts in slices(batch.column("text").to_pylist()):
            step = min(block_docs, 4096)
            for at in range(0, len(texts), step):
                mine = texts[at:at + step]
                if n_docs + len(mine) > block_docs or n_postings > BLOCK_POSTINGS:
                    if held:
                        yield from postings()
                    block, n_docs, n_postings = block + 1, 0, 0
                counts, digests, text, code, links = align.many(mine)
                yield _table(len(mine), kind=np.ones(len(mine), np.int32), block=np.full(len(mine), part + block),
                             slot=np.arange(n_docs, n_docs + len(mine), dtype=np.int32), doc_id=ids.slice(done, len(mine)),
                             n_a=counts[:, 0], n_b=counts[:, 1], n_groups=counts[:, 2], n_links=counts[:, 3],
                             groups_sha256=digests)
                if len(code):
                    held.append((code, text + n_docs, links))
                n_docs, n_postings, done = n_docs + len(mine), n_postings + len(code), done + len(mine)
                if sum(len(h[0]) for h in held) >= most_held:
                    yield from postings()
    if held:
        yield from postings()


def index(docs: DataFrame, path_a: str, path_b: str, block_docs: int = BLOCK_DOCS,
          most_held: int = HELD_POSTINGS) -> DataFrame:
    """Partial postings and documents, as one written table: rows of kind 0 are
    (block, a, b, plane, docs), rows of kind 1 the documents of a block."""
    found = U.doc_text(docs).mapInArrow(lambda it: _index(it, path_a, path_b, block_docs, most_held),
                                        f"{POSTINGS}, {DOCS}")
    return materialise(found, "pair-postings")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """OR of the bitmaps of each (block, a, b, plane), which come together;
    n_links is the weighted popcount, n_docs, on a pair's first plane in the
    block, the popcount of the planes' OR."""
    def merged(t: pa.RecordBatch) -> pa.RecordBatch:
        block, a, b, plane = (t.column(c).to_numpy().astype(np.int64) for c in ("block", "a", "b", "plane"))
        new = np.ones(t.num_rows, bool)
        new[1:] = (np.diff(block) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
        run, first = np.cumsum(new) - 1, np.flatnonzero(new)
        row, slot = unpack(t.column("docs"))
        key = np.unique(((run[row] << 6) + plane[row] << 16) + slot)
        group, slot = key >> 16, key & 0xFFFF
        head = np.flatnonzero(np.diff(group, prepend=-1))
        group, size = group[head], np.diff(head, append=len(slot))
        of = group >> 6
        n_docs = np.bincount(np.unique((np.repeat(of, size) << 16) + slot) >> 16, minlength=len(first))
        n_docs = np.where(np.diff(of, prepend=-1) > 0, n_docs[of], 0)
        at = first[of]
        return pa.RecordBatch.from_arrays(
            [pa.array(block[at]), pa.array(a[at].astype(np.int32)), pa.array(b[at].astype(np.int32)),
             pa.array((group & 63).astype(np.int32)), pack(slot, head), pa.array(n_docs), pa.array(size << (group & 63))],
            ["block", "a", "b", "plane", "docs", "n_docs", "n_links"])

    rest: pa.RecordBatch | None = None
    for batch in batches:
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("block", "a", "b")]
        same = np.logical_and.reduce([batch.column(c).to_numpy() == x for c, x in zip(("block", "a", "b"), last)])
        at = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        rest = batch.slice(at)
        if at:
            yield merged(pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
                                                     for c in batch.slice(0, at).columns], schema=batch.schema))
    if rest is not None and rest.num_rows:
        yield merged(rest)


def pair_postings(found: DataFrame) -> DataFrame:
    """(block, a, b, plane, docs, n_docs, n_links): one bitmap for each pair,
    block and plane.  The shuffle key has the block, so the commonest pair is
    dealt over its blocks."""
    rows = found.filter("kind = 0").select("block", "a", "b", "plane", "docs")
    return materialise(rows.repartition("block", "a", "b").sortWithinPartitions("block", "a", "b").mapInArrow(
        _merge, "block long, a int, b int, plane int, docs binary, n_docs long, n_links long"), "pair-bitmaps")


def pair_scores(postings: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, best): documents and links of every linked pair
    of ids, and whether no other A id has more links with this B id.  Not more
    rows than pairs of vocabulary entries that meet, whatever the corpus."""
    pairs = postings.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    top = F.max("n_links").over(Window.partitionBy("b"))
    return materialise(pairs.withColumn("best", F.col("n_links") == top), "pair-scores")


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each document of a block over its postings, which come first."""
    at, sums = None, np.zeros((BLOCK_DOCS, 3), np.int64)
    for batch in batches:
        block = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for i, j in zip(cuts, cuts[1:]):
            if i == j:
                continue
            if block[i] != at:
                at = block[i]
                sums[:] = 0
            kind = batch.column("kind").slice(i, j - i).to_numpy()
            mid = i + int(np.searchsorted(kind, 1))
            if mid > i:
                t = batch.slice(i, mid - i)
                plane = t.column("plane").to_numpy().astype(np.int64)
                row, slot = unpack(t.column("docs"))
                for c, name in enumerate(("best", "total", "docs_total")):
                    np.add.at(sums[:, c], slot, (t.column(name).to_numpy().astype(np.int64) << plane)[row])
            if mid < j:
                t = batch.slice(mid, j - mid)
                mine = sums[t.column("slot").to_numpy()]
                yield pa.RecordBatch.from_arrays(
                    [t.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                    + [pa.array(mine[:, 0]), pa.array(mine[:, 1]), t.column("groups_sha256"), pa.array(mine[:, 2])],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "doc_count_sum"])


def align_documents(docs: DataFrame, path_a: str, path_b: str, block_docs: int = BLOCK_DOCS,
                    most_held: int = HELD_POSTINGS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256, doc_count_sum (documents of the pair, summed over
    links).

    Null and empty texts, and texts that either vocabulary does not give back
    byte for byte, have no tokens: zeros and ''.  Repeated rows are documents
    each for itself, a null doc_id stays null."""
    def build() -> DataFrame:
        found = index(docs, path_a, path_b, block_docs, most_held)
        postings = pair_postings(found)
        scores = pair_scores(postings)
        if scores.count() <= BROADCAST_PAIRS:
            scores = F.broadcast(scores)
        scored = (postings.drop("n_docs", "n_links").join(scores, ["a", "b"])
                  .select(F.lit(0).alias("kind"), "block", "plane", "docs", F.col("best").cast("int").alias("best"),
                          F.col("n_links").alias("total"), F.col("n_docs").alias("docs_total")))
        plain = found.filter("kind = 1").select("kind", "block", *[c.split()[0] for c in DOCS.split(", ")])
        met = (scored.unionByName(plain, allowMissingColumns=True).repartition("block")
               .sortWithinPartitions("block", "kind"))
        return met.mapInArrow(_gather, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                       "count_sum long, groups_sha256 string, doc_count_sum long")
    return settled(docs.sparkSession, "aligned", build)


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op13_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return align_documents(U.documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
