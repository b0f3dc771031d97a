"""Tables and open windows stay within their bounds, and results do not depend on them."""
import random
import tracemalloc

import numpy as np
import pytest

from airlens.llm import packing, tokens


def unspaced(n, length, seed=1):
    rnd = random.Random(seed)
    return ["".join(chr(rnd.randrange(0x4E00, 0x9F00)) for _ in range(length)) for _ in range(n)]


def test_words_without_spaces_are_not_remembered():
    path = packing.tokenizer_file()
    table, texts = tokens.WordIds(path), unspaced(400, 700)
    want = [np.array(e.ids, "<u4").tobytes() for e in table.encoder.encode_batch(texts, add_special_tokens=False)]
    table.many(["some words first"])
    held = table.held
    tracemalloc.start()
    got = [ids for k in range(0, 400, 50) for ids in table.many(texts[k:k + 50])]
    assert got == want and table.held == held and max(map(len, table.known)) <= tokens.LONGEST
    grown = tracemalloc.get_traced_memory()[0] - sum(map(len, got))
    tracemalloc.stop()
    assert grown < 4_000_000


@pytest.mark.parametrize("most", [1, 20_000])
def test_a_full_table_is_emptied_and_ids_stay(most):
    path = packing.tokenizer_file()
    free, tight = tokens.WordIds(path), tokens.WordIds(path, most)
    texts = [" ".join(f"wörd{k}-{j}. Plain{j} x{k}," for j in range(30)) for k in range(200)] + unspaced(5, 90)
    for k in range(0, 205, 20):
        assert tight.many(texts[k:k + 20]) == free.many(texts[k:k + 20])
        assert tight.held <= most + 20 * 90 * (tokens.ENTRY_BYTES + 80)


def test_spaced_counts_are_bounded_too():
    path = packing.tokenizer_file("byte_bpe_50k.json")
    free, tight = tokens.SpacedIds(path), tokens.SpacedIds(path, 5_000)
    for t in [" ".join(f"a{k} b{j}" for j in range(50)) for k in range(40)] + unspaced(20, 500):
        pieces = tokens.SpacedIds.pieces(t)
        assert tight.counts(pieces) == free.counts(pieces) == [len(e.ids) for e in free.encoder.encode_batch(pieces)]
    assert tight.held < 5_000 + 110 * (tokens.ENTRY_BYTES + 8) and max(map(len, free.known)) <= tokens.LONGEST


def test_open_windows_are_bounded_and_nothing_is_padded():
    p, rnd = packing.SumOfSquares(2048), random.Random(2)
    placed, windows, most = 0, [], 0
    for row in range(6000):
        n = rnd.randint(1400, 1600)  # no two of them share a window
        placed += n
        w = p.place(row, 0, n)
        if w:
            windows.append(w)
        elif p.n_open > 256:
            windows += list(p.relieve(256))
        most = max(most, p.n_open)
    assert most <= 257 and all(sum(n for _, _, n in w) == 2048 for w in windows)
    windows += list(p.finish())
    sizes = [sum(n for _, _, n in w) for w in windows]
    assert sum(sizes) == placed and all(s == 2048 or s & (s - 1) == 0 for s in sizes)
    cover = {}
    for w in windows:
        for row, start, n in w:
            cover.setdefault(row, []).append((start, n))
    for parts in cover.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0


def test_pieces_are_whole_with_few_windows_open(spark):
    rows = [(k, " ".join(["word"] * (150 + k % 9))) for k in range(120)] + [(500, "long text " * 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    path = packing.tokenizer_file()
    pieces = docs.mapInArrow(lambda it: packing.pack_batches(it, path, 256, 1, 8), packing.PIECES).collect()
    table, by_doc = tokens.WordIds(path), {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    for doc_id, text in rows:
        assert b"".join(x for _, x in sorted(by_doc[doc_id])) == table(text) + (1).to_bytes(4, "little")
