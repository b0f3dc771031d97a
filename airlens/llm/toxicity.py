"""Toxicity by nearest labelled examples (operator 4).

Labelled texts and the texts to score are TF-IDF vectors over all their
terms: words and the beginnings of longer words, with document frequencies
over all rows, plus one constant term that every text has.  A term's weight
rises with its odds of standing in a toxic text, which are shrunk to none
where it is rare, and never falls to zero.  The nearest examples by exact
cosine come from an inverted index: the postings of rare terms are added up,
the commonest terms are columns of blocks of examples, and blocks are visited
by falling upper bound (largest weights of the block times the text's) until
none can hold a nearer example.  Votes weighted by distance are turned into a
probability by a logistic curve fitted on examples left out of the index;
the examples are the evidence.
"""
from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, islice
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.llm import common as U
from airlens.llm.licenses import WORD_BYTES
from airlens.llm.tokens import slices


@dataclass(frozen=True)
class Settings:
    """Bounds of what is learned: labelled rows that the odds are counted over,
    examples (half of each class at most, each standing for its share of the
    class) and their characters, all samples by hash of doc_id beyond that.
    No text loses a term."""
    most_labelled: int = 200_000
    most_examples: int = 4_096
    most_chars: int = 48_000_000
    floor: float = 0.2
    odds_unit: float = 3.0
    shrink: float = 5.0
    constant: float = 1.0
    block: int = 512
    columns: int = 768
    neighbours: int = 15
    prior_weight: float = 1.0


#: Characters of the beginnings that are terms of their own, and their mark.
BEGINNINGS = (4, 6)
MARK = "^"
#: Terms remembered in each worker, and characters of their words.
_TERMS, _CHARS = 600_000, 16_000_000
_TOGETHER = 128


def _number(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode())


class _Places(dict):
    """Places of keys in the order in which they were first asked for."""

    def __missing__(self, key):
        at = self[key] = len(self)
        return at


class Terms:
    """Terms of texts as 64-bit numbers, from a table of the words met so far;
    with ``known`` numbers in rising order, as their places there (others: -1)."""

    def __init__(self, known: np.ndarray | None = None):
        self.known = known
        self.clear()

    def clear(self) -> None:
        self.words, self.beginnings = _Places(), {}  # beginnings: by place among the terms
        self.chars = 0
        self.of_word = array("q")           # for each word its own term, then those of its beginnings (none: -1)
        self.value = array("q")             # number or place of each term

    def _learn(self, words: list[str]) -> None:
        begun, known, first, was = self.beginnings, self.known, len(self.value), len(self.beginnings)
        rows = np.empty((len(words), 1 + len(BEGINNINGS)), np.int64)
        rows[:, 0] = np.arange(first, first + len(words))
        n = first + len(words) - was
        for at, k in enumerate(BEGINNINGS, 1):  # the length of a beginning tells its kind
            rows[:, at] = [begun.setdefault(w[:k], n + len(begun)) if len(w) > k else -1 for w in words]
        new = [*islice(reversed(begun), len(begun) - was)][::-1]
        number = np.array([_number(t) for t in chain(words, (MARK + t for t in new))], np.uint64)
        if known is not None:
            at = np.searchsorted(known, number)
            at[at == len(known)] = 0
            number = np.where(known[at] == number, at, -1) if len(known) else np.full(len(number), -1)
        self.of_word.frombytes(rows.tobytes())
        self.value.frombytes(number.tobytes())
        self.chars += sum(map(len, words))

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, number or place of a term, frequency), sorted by text."""
        if len(self.value) > _TERMS or self.chars > _CHARS:
            self.clear()
        lists = [t.encode().translate(WORD_BYTES).decode().split() for t in texts]
        size, was = [len(x) for x in lists], len(self.words)
        word = np.fromiter(map(self.words.__getitem__, chain.from_iterable(lists)), np.int64, sum(size))
        if len(self.words) > was:
            self._learn([*islice(reversed(self.words), len(self.words) - was)][::-1])
        key, n = np.unique(np.repeat(np.arange(len(texts)) << 32, size) | word, return_counts=True)
        term = np.frombuffer(self.of_word, np.int64).reshape(-1, 1 + len(BEGINNINGS))[key & 0xFFFFFFFF]
        has = term >= 0
        key, n = ((key >> 32 << 32)[:, None] | term)[has], np.repeat(n, has.sum(axis=1))
        order = np.argsort(key)
        key, n = key[order], n[order]
        head = np.flatnonzero(np.diff(key, prepend=-1))
        key, n = key[head], np.add.reduceat(n, head) if len(head) else n
        return key >> 32, np.frombuffer(self.value, np.int64)[key & 0xFFFFFFFF], n

    def many(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(numbers in rising order, frequencies) of each text's terms."""
        text, number, n = self.counts(texts)
        number = number.view(np.uint64)
        order = np.lexsort((number, text))
        number, n = number[order], n[order].astype(float)
        cut = np.searchsorted(text, np.arange(len(texts) + 1))
        return [(number[i:j], n[i:j]) for i, j in zip(cut, cut[1:])]

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.many([text])[0]


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text is divisible by 5 (null: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled(labels: DataFrame, s: Settings) -> tuple[DataFrame, dict[bool, float]]:
    """(doc_id, toxic, example) of the rows to learn from, ``most_labelled`` at
    most, and the share of each class that are examples; null labels and null
    ids are left out, and of several labels the larger counts."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
            .filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = rows.count()
    if n > s.most_labelled:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * s.most_labelled / n))
    sizes = {bool(r["t"]): r["count"] for r in rows.groupBy((F.col("toxic") > 0).alias("t")).count().collect()}
    share = {t: min(1.0, s.most_examples / 2 / sizes[t]) if sizes.get(t) else 1.0 for t in (False, True)}
    place = F.pmod(F.xxhash64("doc_id", F.lit("example")), F.lit(1 << 20)) / float(1 << 20)
    return rows.select("doc_id", (F.col("toxic") > 0).alias("toxic"), place.alias("place")), share


@dataclass
class Model:
    """What is learned: the examples' terms with their weights, the examples
    (terms by place in ``terms``, frequencies, label, weight, doc_id) and the
    curve from votes to probabilities."""
    terms: np.ndarray
    weight: np.ndarray
    unknown: float
    cuts: np.ndarray
    place: np.ndarray
    freq: np.ndarray
    toxic: np.ndarray
    stands: np.ndarray
    doc_id: list
    s: Settings
    slope: float = 1.0
    offset: float = 0.0
    sizes: tuple = field(default=(0.0, 0.0))
    name: str = ""

    @property
    def prior(self) -> float:
        """Share of toxic rows among all that were learned from."""
        return (self.sizes[1] + 1) / (sum(self.sizes) + 2)

    def only(self, keep: np.ndarray) -> "Model":
        """The same with some of the examples."""
        n = np.diff(self.cuts)
        inside = np.repeat(keep, n)
        return Model(self.terms, self.weight, self.unknown, np.concatenate([[0], np.cumsum(n[keep])]), self.place[inside],
                     self.freq[inside], self.toxic[keep], self.stands[keep], [d for d, k in zip(self.doc_id, keep) if k],
                     self.s, self.slope, self.offset, self.sizes, self.name)


class BlockMaxIndex:
    """Exact nearest examples by cosine.  Examples are sorted by their heaviest
    term, so that like ones share a block."""

    def __init__(self, model: Model):
        self.m, s = model, model.s
        cuts, n = model.cuts, len(model.cuts) - 1
        value = (1 + np.log(np.maximum(model.freq, 1))) * model.weight[model.place] if len(model.place) else np.empty(0)
        owner = np.repeat(np.arange(n), np.diff(cuts))
        norm = np.sqrt(np.bincount(owner, value * value, n) + s.constant ** 2)
        heavy = np.full(n, -1)
        if len(value):
            by = np.lexsort((model.place, value, owner))
            heavy[owner[by]] = model.place[by]
        self.order = np.lexsort((np.arange(n), heavy))
        rank = np.empty(n, np.int64)
        rank[self.order] = np.arange(n)
        value, owner = value / norm[owner], rank[owner]
        self.n = n
        self.const = (s.constant / norm)[self.order].astype(np.float32)
        self.toxic, self.stands = model.toxic[self.order].astype(float), model.stands[self.order]
        # The commonest terms are columns, the others postings.
        seen = np.bincount(model.place, minlength=len(model.terms))
        self.column = np.full(len(model.terms), -1)
        top = np.argsort(-seen, kind="stable")[:s.columns]
        self.column[top] = np.arange(len(top))
        dense = self.column[model.place] >= 0
        self.dense = np.zeros((n, len(top)), np.float32)
        self.dense[owner[dense], self.column[model.place[dense]]] = value[dense]
        tail = np.flatnonzero(~dense)
        tail = tail[np.lexsort((owner[tail], model.place[tail]))]
        self.post_at, self.post_value = owner[tail], value[tail]
        self.post_cut = np.searchsorted(model.place[tail], np.arange(len(model.terms) + 1))
        # At -1, after the known terms, stand those that no example has.
        self.weight, self.column = np.append(model.weight, model.unknown), np.append(self.column, -2)
        self.heads = np.arange(0, n, s.block)
        self.highest = np.maximum.reduceat(self.dense, self.heads, axis=0) if n else self.dense[:0]
        self.high_const = np.maximum.reduceat(self.const, self.heads) if n else self.const

    def places(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """Texts given by their terms, as :meth:`search` takes them."""
        terms, number = self.m.terms, np.concatenate([np.empty(0, np.uint64), *[x for x, _ in texts]])
        at = np.searchsorted(terms, number)
        at[at == len(terms)] = -1
        if len(terms):
            at[terms[at] != number] = -1
        return (len(texts), np.repeat(np.arange(len(texts)), [len(x) for x, _ in texts]), at,
                np.concatenate([np.empty(0), *[f for _, f in texts]]))

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """:meth:`search` for texts given by their terms."""
        return self.search(*self.places(texts), k)

    def search(self, b: int, text: np.ndarray, place: np.ndarray, freq: np.ndarray,
               k: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """(cosines, examples in the index's order) of the ``k`` nearest of each
        of ``b`` texts, given by the places of their terms (unknown: -1) and
        frequencies, sorted by text; ties to the first."""
        s, n = self.m.s, self.n
        k = min(k or s.neighbours, n)
        w = self.weight[place] * (1 + np.log(freq))
        norm = np.sqrt(np.bincount(text, w * w, b) + s.constant ** 2)
        const, w = (s.constant / norm).astype(np.float32), w / norm[text]
        col = self.column[place]
        common, rare = np.flatnonzero(col >= 0), np.flatnonzero(col == -1)
        q = np.zeros((b, self.dense.shape[1]), np.float32)
        q[text[common], col[common]] = w[common]
        place, w, cut = place[rare], w[rare], np.searchsorted(text[rare], np.arange(b + 1))
        first = self.post_cut[place]
        size = self.post_cut[place + 1] - first
        first -= np.cumsum(size) - size
        ends = np.append(0, np.cumsum(size))[cut]
        scores = np.zeros((b, n), np.float32)
        for r in range(b):
            i, j = cut[r], cut[r + 1]
            where = np.repeat(first[i:j], size[i:j])
            where += np.arange(ends[r], ends[r + 1])
            value = np.repeat(w[i:j], size[i:j])
            value *= self.post_value[where]
            scores[r] = np.bincount(self.post_at[where], value, n)
        scores += const[:, None] * self.const[None]
        bound = q @ self.highest.T + np.maximum.reduceat(scores, self.heads, axis=1)
        done = np.zeros((b, len(self.heads)), bool)
        best = np.full((b, k), -np.inf, np.float32)
        worst = np.full(b, -np.inf)
        for j in np.argsort(-bound.max(axis=0), kind="stable"):
            rows = np.flatnonzero(bound[:, j] >= worst - 1e-5)
            if not len(rows):
                continue
            lo, hi = self.heads[j], min(self.heads[j] + self.m.s.block, n)
            scores[rows, lo:hi] += q[rows] @ self.dense[lo:hi].T
            done[rows, j] = True
            both = np.concatenate([best[rows], scores[rows, lo:hi]], 1)
            best[rows] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            worst[rows] = best[rows].min(axis=1)
        scores[~np.repeat(done, np.diff(np.append(self.heads, n)), axis=1)] = -1
        out = []
        for r in range(b):
            fit = np.flatnonzero(scores[r] >= worst[r] - 1e-5)
            value = scores[r][fit].round(5)
            order = np.lexsort((fit, -value))[:k]
            out.append((value[order].astype(float), fit[order]))
        return out

    def votes(self, b: int, *terms: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """(share of toxic among the weighted votes, cosines, examples) of texts
        as :meth:`search` takes them."""
        m, out = self.m, []
        for cosine, e in self.search(b, *terms) if self.n else [(np.empty(0), np.empty(0, int))] * b:
            weight = self.stands[e] / (0.02 + 1 - np.minimum(cosine, 1.0))
            out.append((float(((weight * self.toxic[e]).sum() + m.s.prior_weight * m.prior) / (weight.sum() + m.s.prior_weight)), cosine, e))
        return out

    def score(self, b: int, *terms: np.ndarray) -> list[tuple[float, list]]:
        """(probability, [(doc_id of an example, cosine)]) of texts as
        :meth:`search` takes them."""
        return [(probability(v, self.m.slope, self.m.offset), [(self.m.doc_id[self.order[i]], c) for i, c in zip(e[:3].tolist(), cosine[:3].tolist())])
                for v, cosine, e in self.votes(b, *terms)]


def probability(vote: float, slope: float, offset: float) -> float:
    return float(1 / (1 + np.exp(-(slope * np.log(vote / (1 - vote)) + offset))))


def fit_curve(votes: np.ndarray, toxic: np.ndarray, stands: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over the votes' log odds, by
    Newton's method on weighted rows with targets a little short of 0 and 1.
    Without five rows of each class votes are taken as they are."""
    if min(toxic.sum(), (~toxic).sum()) < 5:
        return 1.0, 0.0
    x, weight = np.log(votes / (1 - votes)), stands / stands.mean()
    pos, neg = toxic.sum(), (~toxic).sum()
    y = np.where(toxic, (pos + 1) / (pos + 2), 1 / (neg + 2))
    beta, design = np.array([1.0, 0.0]), np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (p - y)) + 1e-3 * (beta - [1.0, 0.0])
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.05)), float(beta[1])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches of a few texts, in runs of bounded length."""
    for batch in batches:
        for at in range(0, batch.num_rows, _TOGETHER):
            part = batch.slice(at, _TOGETHER)
            for texts in slices([t or "" for t in part.column("text").to_pylist()]):
                yield part.slice(0, len(texts)), texts
                part = part.slice(len(texts))


#: One table and one index are kept in each worker process, for the tasks of a run.
_TABLE: dict[str, Terms] = {}
_BUILT: dict[str, "BlockMaxIndex"] = {}


def kept(held: dict, run: str, build):
    """What ``build()`` made for a run in this worker process, made once."""
    if run not in held:
        held.clear()
        held[run] = build()
    return held[run]


def _examples(docs: DataFrame, labels: DataFrame, share: dict, s: Settings) -> list:
    """(doc_id, toxic, term numbers, frequencies) of the examples, in the order
    of their ids; bounded by ``most_examples`` and ``most_chars``."""
    rate = F.when(F.col("toxic"), F.lit(share[True])).otherwise(F.lit(share[False]))
    rows = U.doc_text(docs).join(F.broadcast(labels.filter(F.col("place") < rate)), "doc_id")
    n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    less = min(1.0, s.most_chars / max(chars, 1), 2 * s.most_examples / max(n, 1))  # ids may repeat
    if less < 1:
        share.update({t: x * less for t, x in share.items()})
        rows = rows.filter(F.col("place") < rate * F.lit(less))

    def run(batches):
        table = Terms()
        for part, texts in _spread(batches):
            texts = table.many(texts)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"),
                                              pa.array([x.tobytes() for x, _ in texts], pa.binary()),
                                              pa.array([f.astype(np.int32).tobytes() for _, f in texts], pa.binary())],
                                             ["doc_id", "toxic", "numbers", "freq"])
    got = rows.mapInArrow(run, "doc_id long, toxic boolean, numbers binary, freq binary").collect()
    return sorted(((r["doc_id"], r["toxic"], bytes(r["numbers"]), bytes(r["freq"])) for r in got), key=lambda r: (r[0], r[2], r[3]))


def _counts(docs: DataFrame, labels: DataFrame, terms: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
    """How many documents, toxic labelled and other labelled rows have each of
    ``terms``, over all rows; and those three numbers of rows."""
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        table, m = kept(_TABLE, name, lambda: Terms(held.value)), len(held.value)
        seen, total = np.zeros(3 * m, np.int32), np.zeros(3, np.int64)  # without label, toxic, other
        for batch in batches:
            label = np.array([0 if t is None else 1 if t else 2 for t in batch.column("toxic").to_pylist()])
            total += [len(label), (label == 1).sum(), (label == 2).sum()]
            at = 0
            for texts in slices(batch.column("text").to_pylist()):
                text, place, _ = table.counts(texts)
                np.add.at(seen, (label[at + text] * m + place)[place >= 0], 1)
                at += len(texts)
        seen = seen.reshape(3, m)
        n = seen.sum(axis=0)
        place = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(x, y)) for x, y in zip(
            (place, n[place], *seen[1:, place].astype(np.int64)), (-1, *total))], ["place", "n", "pos", "neg"])
    rows = U.doc_text(docs).join(F.broadcast(labels.select("doc_id", "toxic")), "doc_id", "left").select("text", "toxic")
    sums = (rows.mapInArrow(run, "place long, n long, pos long, neg long").groupBy("place")
            .agg(*[F.sum(c).alias(c) for c in ("n", "pos", "neg")])).toArrow()
    place = sums.column("place").to_numpy()
    out = np.zeros((3, len(terms) + 1))
    out[:, place] = [sums.column(c).to_numpy() for c in ("n", "pos", "neg")]  # -1: the last column
    return out[:, :-1], out[:, -1]


def learn(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Examples, term weights and curve.  What reaches the driver is bounded by
    the settings: the examples' terms, and three counts for each of these."""
    rows, share = labelled(labels, s)
    name = uuid4().hex
    found = _examples(docs, rows, share, s)
    number = [np.frombuffer(r[2], np.uint64) for r in found]
    terms = np.unique(np.concatenate([np.empty(0, np.uint64), *number]))
    counts, total = _counts(docs, rows, terms, name)
    n, pos, neg = total
    p = (pos + 1) / (pos + neg + 2)
    odds = np.log((counts[1] + s.shrink * p) / (counts[2] + s.shrink * (1 - p))) - np.log(p / (1 - p))
    weight = np.log((1 + n) / (1 + counts[0])) * (s.floor + np.maximum(odds, 0) / s.odds_unit)
    toxic = np.array([r[1] for r in found], bool)
    model = Model(terms, weight, float(np.log((1 + n) / 2)) * s.floor if n else 0.0,
                  np.concatenate([[0], np.cumsum([len(x) for x in number])]).astype(np.int64),
                  np.searchsorted(terms, np.concatenate([np.empty(0, np.uint64), *number])),
                  np.concatenate([np.empty(0), *[np.frombuffer(r[3], np.int32) for r in found]]), toxic,
                  np.where(toxic, 1 / share[True], 1 / share[False]), [r[0] for r in found], s, sizes=(float(neg), float(pos)), name=name)
    # Every fourth example, by a hash of its id, is left out to fit the curve.
    out = np.array([_number(f"curve {d}") % 4 == 0 for d in model.doc_id], bool)
    if out.any() and not out.all():
        index = BlockMaxIndex(model.only(~out))
        votes = [index.votes(*index.places([(number[i], np.frombuffer(found[i][3], np.int32)) for i in part]))
                 for part in np.array_split(np.flatnonzero(out), -(-int(out.sum()) // _TOGETHER))]
        model.slope, model.offset = fit_curve(np.array([v for part in votes for v, _, _ in part]), toxic[out], model.stands[out])
    return model


def scored(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The columns of ``docs``, then __score and __evidence
    (array of struct<doc_id, cosine>).

    Null and empty texts have the constant term alone.  Without labels the
    score is the prior.  Repeated rows score alike."""
    learned = learn(docs, labels, s)
    name, model = learned.name, docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = kept(_BUILT, name, lambda: BlockMaxIndex(model.value))
        table = kept(_TABLE, name, lambda: Terms(model.value.terms))
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))
        for part, texts in _spread(batches):
            got = index.score(len(texts), *table.counts(texts))
            evidence = [[{"doc_id": d, "cosine": c} for d, c in e] for _, e in got]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([v for v, _ in got], pa.float64()),
                                              pa.array(evidence, kind)], names=[*part.schema.names, "__score", "__evidence"])

    evidence = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType()), T.StructField("__evidence", evidence)])
    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    return scored(docs, labels).filter(F.col("__score") < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = U.documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = scored(docs, U.table(spark, sf_dir, "labels"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
                       (F.col("__score") >= 0.5).cast("int").alias("predicted"), F.col("__evidence").alias("evidence"))
