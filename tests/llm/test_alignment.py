"""Cross-tokenizer alignment against whole encodings and counting by hand."""
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airlens.llm import alignment

from .test_corpus import by_doc, corpus, frame

A, B = alignment.vocabulary("byte_bpe_50k.json"), alignment.vocabulary("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "doc_count_sum")


def tokens(text):
    """[(id, bytes)] of the whole text under both vocabularies."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment._byte_level()
    a = [(i, bytes(letters[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in sp.encode(text):
        p = sp.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])


def brute(rows):
    docs, count, n_docs = [], Counter(), Counter()
    for doc_id, text, *_ in rows:
        a, b = tokens(text) if text else ([], [])
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, raw in side:
                out.append((at, at + len(raw), i))
                at += len(raw)
            spans.append(out)
        links = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e]
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low < e <= end) for side in spans))
            low = end
        docs.append((doc_id, len(a), len(b), groups, links))
        count.update(links)
        n_docs.update(set(links))
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return sorted(((d, a, b, len(g), len(k), sum(count[p] == top[p[1]] for p in k), sum(count[p] for p in k),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "", sum(n_docs[p] for p in k))
                   for d, a, b, g, k in docs), key=repr)


def odd_texts():
    rnd = random.Random(3)
    return ["<|endoftext|> <s> a</s> <0x41> <unk>", "a▁b is no text that both give back", "▁", " ", "   x", "x   ", "a\0b c",
            "日本語の文章です。" * 30, "naïve café — “quoted” 1,234.5 é \U0001f600\U0001f469‍\U0001f4bb", "tab\there\n\nnew  lines \r\n x",
            "it's we'll don't 'tis", "x" * 5000, "word " * 700, "".join(chr(rnd.randrange(32, 0x2FF)) for _ in range(900)),
            " nbsp　wide   em", " a b", "a b ", "_ _x 1_2 ²  ½"]


@pytest.mark.parametrize("limits", [{}, {"block_docs": 7, "most_held": 20}])  # many blocks, many partial bitmaps
def test_alignment_equals_whole_encodings(spark, limits):
    rows = corpus(21, 50) + [(1000 + k, t, None, None, None) for k, t in enumerate(odd_texts())]
    rows = [(r[0], r[1][:3000] if r[1] else r[1], *r[2:]) for r in rows]
    got = alignment.align_documents(frame(spark, rows, clash=True), A, B, **limits)
    assert by_doc(got, *COLUMNS) == brute(rows)


def test_no_documents_and_documents_without_tokens(spark):
    assert alignment.align_documents(frame(spark, []), A, B).count() == 0
    got = alignment.align_documents(frame(spark, [(1, None, None, None, None), (None, "", None, None, None)]), A, B)
    assert by_doc(got, *COLUMNS) == sorted([(1, 0, 0, 0, 0, 0, 0, "", 0), (None, 0, 0, 0, 0, 0, 0, "", 0)], key=repr)


def test_pair_scores_count_documents_and_links(spark):
    rows = [(k, "the cat the cat the" if k % 2 else "the dog", None, None, None) for k in range(40)]
    found = alignment.index(frame(spark, rows), A, B)
    scores = {(r["a"], r["b"]): (r["n_docs"], r["n_links"], r["best"]) for r in
              alignment.pair_scores(alignment.pair_postings(found)).collect()}
    the, the_b = tokens("the")
    assert scores[the[0][0], the_b[0][0]] == (40, 20 * 3 + 20, True)


def test_bitmaps_round_trip_and_merge():
    rnd = np.random.default_rng(5)
    sets = [np.sort(rnd.choice(alignment.BLOCK_DOCS, n, replace=False)) for n in (1, 4095, 4096, 4097, 65536, 2, 60000)]
    head = np.cumsum([0] + [len(s) for s in sets[:-1]])
    maps = alignment.pack(np.concatenate(sets), head)
    assert max(len(m.as_py()) for m in maps) == alignment.BLOCK_DOCS // 8
    row, slot = alignment.unpack(maps)
    assert [slot[row == k].tolist() for k in range(len(sets))] == [s.tolist() for s in sets]
    row, slot = alignment.unpack(maps.slice(2, 3))
    assert [slot[row == k].tolist() for k in range(3)] == [s.tolist() for s in sets[2:5]]
    # two halves of one pair's documents, planes 0 and 1, in batches of one row
    even, odd = np.arange(0, 50000, 2), np.arange(1, 50000, 2)
    rows = [(7, 1, 2, 0, even), (7, 1, 2, 0, odd), (7, 1, 2, 1, even), (8, 1, 2, 3, even[:5])]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0]], pa.int64()), *[pa.array([x], pa.int32()) for x in r[1:4]],
                                           alignment.pack(r[4], np.array([0]))], ["block", "a", "b", "plane", "docs"]) for r in rows]
    out = [r for t in alignment._merge(iter(batches)) for r in t.to_pylist()]
    assert [(r["block"], r["plane"], r["n_docs"], r["n_links"]) for r in out] == [
        (7, 0, 50000, 50000), (7, 1, 0, 50000), (8, 3, 5, 40)]


def test_table_is_bounded_and_answers_do_not_depend_on_it(monkeypatch):
    texts = [f"w{k} {k * 7919 % 1000} {'日本' * (k % 40)} x{k}" for k in range(3000)]
    free = alignment.Aligner(A, B)
    want = [free.many(texts[k:k + 500]) for k in range(0, 3000, 500)]
    monkeypatch.setattr(alignment, "TABLE_BYTES", 100_000)
    tight, most = alignment.Aligner(A, B), 0
    for k, w in zip(range(0, 3000, 500), want):
        got = tight.many(texts[k:k + 500])
        most = max(most, tight.held)
        assert (got[0] == w[0]).all() and got[1] == w[1]
        assert Counter(zip(got[2].tolist(), got[3].tolist(), got[4].tolist())) == Counter(
            zip(w[2].tolist(), w[3].tolist(), w[4].tolist()))
    assert most < 1_500_000 < free.held


def test_pieces_are_looked_up_once_and_joined_again(monkeypatch):
    """op13: cut at single spaces between visible characters, looked up once a
    piece; digests and counts do not depend on what the table holds already."""
    fresh = lambda: alignment.Aligner(alignment.vocabulary("byte_bpe_50k.json"), alignment.vocabulary("piece_bpe_32k.model"))
    texts = ["a b c", " lead and trail ", "two  spaces", "", "x" * 46 + " " + "y" * 47 + " " + "z" * 48, "naïve über a", "\tq w\n r"]
    one = fresh()
    assert [one.cut.split(t) for t in texts[:3]] == [["a", "b", "c"], [" lead", "and", "trail "], ["two  spaces"]]
    looked = []
    class Counted(dict):
        def get(self, key, default=None):
            looked.append(key)
            return dict.get(self, key, default)
    one.known = Counted()
    first, again = one.many(texts), one.many(texts)
    assert len(looked) == 2 * sum(len(one.cut.split(t)) for t in texts if t)
    apart = [fresh().many([t]) for t in texts]
    for got in (first, again):
        assert got[1] == [x[1][0] for x in apart]
        assert got[0].tolist() == [x[0][0].tolist() for x in apart]
