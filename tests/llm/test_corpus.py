"""Corpus operators against brute force, with the odd rows every one must take."""
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.llm import (common, exact_dedup, html_text, licenses, mixing, near_dedup, packing, quality, token_edits,
                         toxicity, urls)
from airlens.llm import components as components_module
from airlens.llm.components import components
from airlens.llm.tokens import SpacedIds, WordIds

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
#: Extra columns named like the operators' own ones.
CLASH = ("row_id", "text_key", "size", "kept", "name", "level", "n", "group", "toxic", "score", "copies", "key", "block")
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASH]) if clash else df


def corpus(seed=1, n=90):
    """Prose with exact and near copies, junk, odd white space and nulls."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "é", "ß"])
                     for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    texts = []
    for k in range(n):
        kind = rnd.random()
        if texts and kind < 0.15:
            texts.append(rnd.choice(texts))
        elif texts and kind < 0.45:
            w = (rnd.choice(texts) or "").split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            texts.append(" ".join(w))
        else:
            w = [rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 5, 30, 120, 400]))]
            texts.append("".join(x + rnd.choice([" "] * 12 + ["\n", "\t", "  ", ".\n", ", "]) for x in w).capitalize())
    rows = [(k, t, "en", f"src{k % 4}", len(t)) for k, t in enumerate(texts)]
    rows += [(n, None, None, None, None), (n + 1, "", "en", "src1", 0), (n + 2, " \n\t ", "en", None, 4),
             (n + 3, texts[0], None, "src2", None), (n + 3, texts[0], None, "src2", None), (None, texts[1], "en", "", 3),
             (None, None, None, None, None), (n + 4, "\x0b\u00a0 a\u2003b \x1c c", "en", "Ω", 9)]
    return rows


def by_doc(df, *cols):
    return sorted((tuple(r[c] for c in ("doc_id",) + cols) for r in df.collect()), key=repr)


# -- exact dedup -----------------------------------------------------------
def brute_exact(rows):
    groups = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(rows):
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        order = sorted(ids, key=lambda d: (d is not None, d or 0), reverse=True)
        out += [(d, order[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, d in enumerate(order)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,digest", [(4096, F.xxhash64), (7, F.xxhash64), (5, lambda b: F.length(b).cast("long"))])
def test_exact_groups_equal_brute_force_even_if_digests_collide(spark, block, digest):
    rows = [r[:1] + (r[1][:40] if r[1] else r[1],) + r[2:] for r in corpus(2, 60)]
    got = exact_dedup.exact_groups(frame(spark, rows), block, digest)
    assert by_doc(got, "keep_id", "group_size", "kept", "text_sha256") == brute_exact(rows)


def test_exact_dedup_keeps_one_row_and_every_column(spark):
    rows = corpus(3, 40)
    docs = frame(spark, rows, clash=True)
    got = exact_dedup.drop_exact_copies(docs)
    assert got.columns == docs.columns
    want = sorted(((r[0], r[1]) for r in {(k, d): (d, t) for k, (d, t) in enumerate(
        (d, t) for (d, _, _, keep, h) in brute_exact(rows) if keep
        for t in [next(x[1] for x in rows if hashlib.sha256((x[1] or "").encode()).hexdigest() == h and x[0] == d)])}.values()), key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == want
    assert exact_dedup.drop_exact_copies(docs.limit(0)).count() == 0


# -- near dedup ------------------------------------------------------------
def brute_near(rows, words, percent):
    sets = []
    for _, text, *_ in rows:
        w = SPACES.findall(lower(text))
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                label[root(i)] = root(j)
    group = defaultdict(list)
    for i in range(len(rows)):
        group[root(i)].append(i)
    out = []
    for members in group.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return sorted(out, key=repr), [len(s) for s in sets], group


@pytest.mark.parametrize("chunk", [(2048, 2_000_000), (3, 200)])
@pytest.mark.parametrize("m", [near_dedup.CONTRACT, near_dedup.MinHash()])
def test_near_groups_equal_brute_force(spark, monkeypatch, m, chunk):
    monkeypatch.setattr(near_dedup, "BUCKET_CHUNK", chunk[0])
    monkeypatch.setattr(near_dedup, "CLUSTER_CHUNK", chunk[1])
    rows = corpus(4, 110)
    got = near_dedup.near_groups(frame(spark, rows, clash=True), m)
    assert by_doc(got, "n_shingles", "component_id") == brute_near(rows, m.words, m.percent)[0]


def test_one_of_each_near_group_stays(spark):
    rows = corpus(5, 60)
    docs = frame(spark, rows, clash=True)
    _, sizes, group = brute_near(rows, 5, 80)
    got = near_dedup.drop_near_copies(docs)
    assert got.columns == docs.columns
    full = [g for g in group.values() if sizes[g[0]]]
    assert got.count() == len(full) + sum(1 for n in sizes if not n)
    kept = Counter(r["doc_id"] for r in got.collect())
    for g in full:
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        assert not ids or kept[min(ids)] == 1
    assert near_dedup.drop_near_copies(docs.limit(0)).count() == 0


def test_estimate_is_corrected_for_chance():
    m = near_dedup.MinHash(words=1, percent=80)
    rnd = np.random.default_rng(0)
    pool = rnd.integers(1, 1 << 62, 3000, dtype=np.uint64)
    for share in (0.2, 0.5, 0.9):
        a, b = pool[:1000], np.concatenate([pool[:int(1000 * share)], pool[1000:2000 - int(1000 * share)]])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        low = near_dedup.minima([np.sort(a), np.sort(b)], m.hashes)
        sig = near_dedup.pack_bits(low, m.bits)
        fields = int((low[0] & np.uint64(3) != low[1] & np.uint64(3)).sum())
        unequal = near_dedup.unequal_fields(sig[:1], sig[1:], m.bits)
        assert int(unequal[0]) == fields
        assert abs(m.resemblance(unequal)[0] - true) < 0.2


def test_words_are_looked_up_once():
    """op10: one look at the table for each word, whose ids are those of the
    whole text."""
    table, looked = WordIds(packing.tokenizer_file()), []

    class Counted(dict):
        def get(self, key, default=None):
            looked.append(key)
            return dict.get(self, key, default)
    table.known = Counted()
    texts = ["Plain words, straße don't 3x.", "words again; plain", "w" * 70 + " über!", "", "a <|x b"]
    for _ in range(2):
        assert table.many(texts) == [np.array(table.encoder.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert len(looked) == 2 * sum(len(t.split()) for t in texts[:4])


def test_links_are_contracted_before_the_rounds(spark, monkeypatch):
    """op6, pipeline: runs of links leave as stars around their smallest nodes,
    and links that are stars already need no round at all."""
    rng = np.random.default_rng(5)
    for u, v in ((np.arange(1, 3000), np.arange(2999)), (rng.permutation(2000)[:900] + 7, rng.permutation(2000)[:900])):
        nodes, least = components_module.least_reachable(u, v)
        want = {int(n): int(n) for n in np.concatenate([u, v])}
        for _ in range(len(u)):
            before = dict(want)
            for a, b in zip(u.tolist(), v.tolist()):
                want[a] = want[b] = min(want[a], want[b])
            if want == before:
                break
        assert dict(zip(nodes.tolist(), least.tolist())) == want
    batch = pa.RecordBatch.from_arrays([pa.array([5, 4, 9, 9]), pa.array([4, 1, 8, 8])], names=["u", "v"])
    got = [b.to_pydict() for b in components_module.contract_batches(iter([batch, batch.slice(0, 0)]))]
    assert got == [{"u": [4, 5, 9], "v": [1, 1, 8]}]
    monkeypatch.setattr(components_module, "_star", None)  # no round
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 3), (9, 8)], "a long, b long").coalesce(1)
    assert dict(components(edges).collect()) == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}


def test_links_in_many_runs(spark, monkeypatch):
    """Runs of one link each: the rounds join what no task sees together."""
    edges = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(30)] + [(k, 499 - k) for k in range(300, 330)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(16)
    got = dict(components(frame).collect())
    want = {k: 0 for k in range(41)} | {100: 100} | {200 + k: 100 for k in range(30)}
    for k in range(300, 330):
        want |= {k: min(k, 499 - k), 499 - k: min(k, 499 - k)}
    assert {k: got[k] for k in range(41)} == {k: 0 for k in range(41)}
    assert set(got) == set(want)
    assert all(got[a] == got[b] for a, b in edges)
    assert all(got[got[n]] == got[n] <= n for n in got)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 299), (41, 40)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(42)}, **{k: 100 for k in range(100, 140)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- mixing ----------------------------------------------------------------
def brute_targets(sizes, share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    total, level = share * sum(sizes.values()), 0.0
    full = set()
    while True:
        free = sum(weight[s] for s in names if s not in full)
        level = (total - sum(2 * sizes[s] for s in full)) / free if free else level
        more = {s for s in names if 2 * sizes[s] < level * weight[s]}
        if more <= full:
            return {s: min(2.0 * sizes[s], level * weight[s]) for s in names}
        full |= more


def test_mix_meets_targets_and_bounds(spark):
    rows = corpus(6, 150)
    docs = frame(spark, rows, clash=True)
    plan, got = mixing.mix(docs, block_words=8)
    got = got.collect()
    size = lambda t: len(SPACES.findall(t or ""))
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += size(t)
    want = brute_targets(sizes)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got) == sorted(
        (r[0] is None, r[0] or 0, size(r[1])) for r in rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by_target = defaultdict(float)
    for r in got:
        by_target[round(r["target"], 6), r["source_size"]] += r["taken"]
    for s, t in want.items():
        assert abs(by_target[round(t, 6), sizes[s]] - t) <= 5, (s, t)
    again = mixing.mix(docs.repartition(3), block_words=8)[1].collect()
    assert sorted((r["text_key"], r["taken"]) for r in got if r["doc_id"] is not None and r["doc_id"] < 150) == sorted(
        (r["text_key"], r["taken"]) for r in again if r["doc_id"] is not None and r["doc_id"] < 150)
    ranks = defaultdict(list)
    for r in plan.collect():
        ranks[r["idx"]].append((r["slot"], r["rank"]))
    for pairs in ranks.values():
        assert [k for _, k in sorted(pairs)] == list(range(len(pairs)))
    whole = mixing.mixed_documents(docs, 8)
    assert whole.columns == docs.columns and max(Counter(r["doc_id"] for r in whole.collect() if r["doc_id"] in range(150)).values()) == 2
    assert mixing.mix(docs.limit(0))[1].count() == 0


def test_mix_of_many_small_sources_meets_every_target(spark):
    rows = [(k, " ".join(f"w{j}" for j in range(65 if k % 3 else 30)), "en", f"site{k:03d}", 0) for k in range(400)]
    rows += [(1000 + k, "one two", "en", "tiny", 0) for k in range(3)] + [(2000, "", "en", "empty", 0)]
    plan, got = mixing.mix(frame(spark, rows))
    got = [r.asDict() | {"source": s[3]} for r, s in zip(sorted(got.collect(), key=lambda r: r["doc_id"]), sorted(rows))]
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 2.1, (s, taken[s], t)
        assert taken[s] > 0 or s == "empty"
    assert abs(sum(taken.values()) / sum(target.values()) - 1) < 0.005
    slots = [r["slot"] for r in plan.collect()]
    assert sorted(slots) == list(range(len(slots)))


def test_golden_points_are_even(spark):
    x = np.array([r[0] for r in spark.range(5000).select(mixing.golden_point(F.col("id"))).collect()])
    for width in (0.01, 0.1, 0.37):
        assert abs((x < width).sum() - 5000 * width) < 8
    far = spark.range(1 << 38, (1 << 38) + 1000).select(mixing.golden_point(F.col("id"))).collect()
    assert abs(sum(r[0] < 0.25 for r in far) - 250) < 8


# -- packing ---------------------------------------------------------------
def test_pieces_give_back_every_token(spark):
    rows = corpus(7, 120) + [(999, "word " * 9000, "en", "s", 1), (998, "<|endoftext|> A's don't IT'S Σας", "en", "s", 1)]
    path = packing.tokenizer_file()
    pieces = packing.pack(frame(spark, rows, clash=True).repartition(3), path, 256).collect()
    encoder = WordIds(path).encoder
    want = sorted(np.array(encoder.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes() for _, t, *_ in rows)
    docs, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        docs[p["row_id"]].append((p["start"], bytes(p["ids"]), p["doc_tokens"]))
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    got = []
    for parts in docs.values():
        parts.sort()
        joined = b"".join(x for _, x, _ in parts)
        assert [s for s, _, _ in parts] == list(np.cumsum([0] + [len(x) // 4 for _, x, _ in parts])[:-1])
        assert len(joined) == 4 * parts[0][2]
        got.append(joined)
    assert sorted(got) == want
    for parts in seqs.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end == 256 or end & (end - 1) == 0 and end < 256
    assert packing.pack(frame(spark, rows).limit(0), path).count() == 0


def test_placement_minimises_the_sum_of_squares():
    rnd, p = random.Random(3), packing.SumOfSquares(50)
    for _ in range(400):
        n = rnd.randint(1, 49)
        cost = {}
        for h in range(0, 51 - n):
            if h == 0 or p.count[h]:
                c = p.count.copy()
                if h:
                    c[h] -= 1
                if h + n < 50:
                    c[h + n] += 1
                cost[h] = int((c[1:50] ** 2).sum())
        h = p.level_for(n)
        assert cost[h] == min(cost.values()) and h == max(k for k, v in cost.items() if v == cost[h])
        p.place(0, 0, n)


def test_word_table_gives_the_tokenizers_ids():
    words = WordIds(packing.tokenizer_file(), most=50)
    for _, text, *_ in corpus(8, 60) + [(0, "a.b c.. d, É. <|startoftext|>x Ünḯ code\u0301. 3.14, l'été! o'clock; \u2003 x", 0, 0, 0)]:
        ids = words.encoder.encode(text or "", add_special_tokens=False).ids
        assert words(text or "") == np.array(ids, "<u4").tobytes()


# -- quality ---------------------------------------------------------------
def brute_quality(text):
    text = text or ""
    words = SPACES.findall(text)
    lines = [x for x in text.split("\n") if SPACES.search(x)]
    seen = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if seen[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)),
            len(hit), sum(a == b for a, b in zip(words, words[1:])), sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text))


def test_ledger_policies_and_ablation(spark):
    rows = corpus(9, 60) + [(500, "x y z p q " * 30, "", "", 0), (501, "A B\nA B\n\nA B\n### $$", "", "", 0), (502, "no no no no " * 9, "", "", 0)]
    got = quality.ledger(frame(spark, rows, clash=True)).cache()
    assert by_doc(got, *quality.MEASURES) == sorted(((r[0],) + brute_quality(r[1]) for r in rows), key=repr)
    led = got.collect()
    mask = quality.mask(quality.CURRENT)
    for r in quality.ablate(got).collect():
        bit = quality.BIT[r["rule"]]
        assert r["failed"] == sum(bool(x["failed_rules"] & bit) for x in led)
        assert r["only"] == sum(x["failed_rules"] & mask == bit for x in led)
    assert quality.ablate(got.limit(0), "base").collect()[0]["failed"] == 0


# -- licences --------------------------------------------------------------
def test_base_places_and_labels(spark):
    odd = [(700, "Released under the MIT License. mit-license MIT\u00a0License", "", "", 0), (701, "GNU General  PUBLIC\nlicense, Apache License", "", "", 0),
           (702, "Licensed under CC BY-NC 4.0.", "", "", 0), (703, "general license mit apache public", "", "", 0),
           (704, "mit license " * 50, "", "", 0),
           (705, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "", "", 0)]
    rows = corpus(10, 40) + odd
    got = {}
    for r in licenses.scan(frame(spark, rows, clash=True)).collect():
        got[r["doc_id"]] = r
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        places = [(i, label) for phrase, label in licenses.BASE.items() for p in [phrase.split()]
                  for i in range(len(words)) if words[i:i + len(p)] == p]
        r = got[doc_id]
        if doc_id is not None:
            assert r["n_words"] == len(words)
        assert (r["n_base"], r["first_word"], r["last_word"]) == (
            len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert got[702]["labels"] == "cc-by-nc" and got[705]["labels"] == "mit" and got[705]["base_labels"] == ""
    assert licenses.scan(frame(spark, rows).limit(0)).count() == 0


# -- html ------------------------------------------------------------------
@pytest.mark.parametrize("html,want", [
    ("", []), ("just text", ["just text"]),
    ("<nav><p>menu</p></nav><article><h1>T &amp; U</h1><p>a\n <b>b</b>c<br>d<p>e</article><footer>f</footer>", ["T & U", "a bc d", "e"]),
    ("<div class='ad'>Buy</div><article><p>x</p><aside>no</aside><form>q<input></form><div id=user-comments>c</div><p>y", ["x", "y"]),
    ("<script>var t='</p>';</script><style>p{}</style><main><ul><li>one<li>two</ul></main>", ["one", "two"]),
    ("<!-- <p>no</p> --><article><p>&copy; &#233; &lt;b&gt; &am</p><div class='cookie-notice'>n</div></article>", ["© é <b> &am"]),
    ("<article></article><p>", []),
])
def test_html_blocks(html, want):
    assert html_text.main_lines(html) == want


def test_regions_are_chosen_by_text_to_tag_ratio():
    menu = "".join(f"<li><a href='/{k}'>go {k}</a></li>" for k in range(30))
    body = "".join(f"<p>{'plain words of the story ' * 12}</p>" for _ in range(6)) + "<p>Short.</p>"
    page = f"<html><body><div><ul>{menu}</ul></div><div>{body}</div><div><ul>{menu}</ul></div></body></html>"
    lines = html_text.main_lines(page)
    assert len(lines) == 7 and lines[-1] == "Short."


STORY = "".join(f"<p>{'plain words of the story ' * 12}</p>" for _ in range(6))


def test_an_article_does_not_hide_the_rest_of_the_page():
    card = "<article><h3>Read next</h3><p><a href='/n'>Another story</a></p></article>"
    for page in (f"<body>{card}<div>{STORY}</div></body>", f"<body><div>{STORY}</div>{card}</body>"):
        assert sum(line.startswith("plain words") for line in html_text.main_lines(page)) == 6


def test_link_lists_in_an_article_are_judged_by_ratio():
    links = "".join(f"<li><a href='/{k}'>go {k}</a></li>" for k in range(30))
    facts = "<ul><li>a fact</li><li>one <a href='/f'>more</a> short fact</li></ul>"
    lines = html_text.main_lines(f"<article><h1>Title</h1>{STORY}{facts}<p>End.</p>{STORY}<ul>{links}</ul></article>")
    assert len(lines) == 16 and "a fact" in lines and "End." in lines and "one more short fact" in lines
    assert not any(line.startswith("go ") for line in lines)


@pytest.mark.parametrize("html,want", [
    ("<body class='has-sidebar'><article><p>x</p><p>y</p></article></body>", ["x", "y"]),
    ("<main class='no-sidebar'><p>x</p></main>", ["x"]),
    ("<article class='post comments-open'><div class='post-header'><h1>Title</h1></div><p>x</p></article>", ["Title", "x"]),
    ("<div id='page-with-nav'><p>x</p></div>", ["x"]),
    ("<div class='ad'>Buy</div><div><p>x</p></div>", ["x"]),
])
def test_words_of_class_and_id_do_not_empty_a_page(html, want):
    assert html_text.main_lines(html) == want


def test_a_word_rules_out_only_what_is_not_running_text():
    menu = "<ul>" + "".join(f"<li><a href='/{k}'>go {k}</a></li>" for k in range(30)) + "</ul>"
    page = f"<body><div id='page-with-nav'>{menu}<div class='content'>{STORY}</div><div class='promo'>Buy now</div></div><div>{menu}</div>"
    lines = html_text.main_lines(page)
    assert len(lines) == 6 and all(line.startswith("plain words") for line in lines)


def test_extract_rows(spark):
    rows = [(1, "u", "<article><p>a b</p>"), (1, "u", None), (None, None, ""), (2, "v", "<p>" + "z" * 300_000)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 0), (1, 0), (1, 3), (2, 300_000)]


# -- urls ------------------------------------------------------------------
def test_url_rules_and_verdicts(spark):
    rows = [(1, "http://WWW.Example.com/en/1?x"), (2, "https://a.example.com/en/"), (3, "http://com/x"), (4, "http://xcom/x"),
            (5, "http://a.net/es/#q"), (6, "http://a.net/de/"), (7, None), (8, "no scheme"), (9, "http://a.org?b/c"),
            (10, "ftp://casinowin.org/a://b"), (11, "http://a.com"), (None, "http://b.org/x"), (6, "http://a.net/de/"),
            (12, "http://plain-words.org/en/4"), (13, "http://casino-win.org/en/5")] + [(k, f"http://host{k % 7}.org/en/{k}") for k in range(20, 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("n", F.lit(2))
    docs = frame(spark, corpus(11, 20))
    got = {r["page_id"]: r for r in urls.judge(pages, docs).collect()}
    one = lambda k: (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"])
    assert one(1) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert one(2)[2:] == ("example.com/en/", "block") and one(3)[2:] == ("com/", "allow") and one(4)[2] is None
    assert one(5) == ("a.net", "/es/", "net/es/", "block") and one(6)[2] is None
    assert one(7) == ("", "", None, "allow") and one(8)[:3] == ("", "", None) and one(9)[:2] == ("a.org", "")
    assert one(10) == ("casinowin.org", "/a://b", None, "block") and one(11) == ("a.com", "", None, "allow")
    assert one(12)[3] == "allow" and one(13)[3] == "block"
    assert urls.judge(pages, docs).count() == len(rows)
    assert urls.judge(pages.limit(0), docs.limit(0)).count() == 0


def test_what_rules_block_is_no_example_to_allow(spark):
    by_rule = [(k, f"http://river.stones.net/es/{k}") for k in range(40)]
    rest = [(100 + k, f"http://host{k % 7}.org/en/{k}") for k in range(60)]
    rest += [(200, "http://river-stones.org/es/1"), (201, "http://paydayloans.org/1"), (202, "http://lottery-x.org/2")]
    docs = frame(spark, [(1, "river stones payday loans lottery host", "", "", 0)] * 20)
    judged = lambda rows: {r["page_id"]: (r["verdict"], r["block_odds"]) for r in urls.judge(spark.createDataFrame(
        rows, "page_id long, url string"), docs).collect() if r["page_id"] >= 100}
    got = judged(by_rule + rest)
    assert got == judged(rest)
    assert got[201][0] == got[202][0] == "block" and {got[100 + k][0] for k in range(60)} == {"allow"}


def test_all_words_are_counted_for_host_parts(spark):
    long = "donaudampfschifffahrtsgesellschaft"
    docs = frame(spark, [(1, f"stra\u00dfen bahn {long}", "", "", 0)] * 50)
    parts = spark.createDataFrame([("stra\u00dfenbahn",), (long + "bahn",)], "part string")
    got = {r["part"]: r["words"] for r in urls.segment(parts, docs).collect()}
    assert got == {"stra\u00dfenbahn": ["stra\u00dfen", "bahn"], long + "bahn": [long, "bahn"]}


def test_viterbi_finds_the_likeliest_split():
    known = {"spam": 50.0, "farm": 40.0, "spa": 30.0, "arm": 20.0, "free": 60.0}
    assert urls.viterbi("spamfarm", known, 1000.0) == ["spam", "farm"]
    assert urls.viterbi("freezq", known, 1000.0)[0] == "free"
    assert "".join(urls.viterbi("x" * 57, known, 1000.0)) == "x" * 57


# -- token counts ----------------------------------------------------------
def test_edited_counts_equal_counting_anew():
    import public_tokenizers
    encoder = SpacedIds(public_tokenizers.path("byte_bpe_50k.json"), most=500)
    full = lambda t: len(encoder.encoder.encode(t, add_special_tokens=False).ids)
    rnd = random.Random(5)
    for _, text, *_ in corpus(12, 60):
        c = token_edits.CountedText(text or "", encoder, leaf_pieces=3)
        now = text or ""
        assert c.count == full(now)
        for _ in range(12):
            s = rnd.randint(0, len(now))
            e = min(len(now), s + rnd.choice([0, 0, 1, 2, 7, 80]))
            new = rnd.choice(["", " ", "  ", "\n", "'s", "x", " y z ", "é", "\u00a0", "longer words here"])
            c.edit(s, e, new)
            now = now[:s] + new + now[e:]
            assert c.text == now and c.count == full(now)
            assert c.tree[1] == c.tree[c.size:].sum()


def test_masking_edits(spark):
    import public_tokenizers
    rows = corpus(13, 20) + [(800, "write to a.b@c.org or +1 (980) 555-6268 at 10.0.0.1 now", "", "", 0), (801, "k" * 200_000 + " a@b.co", "", "", 0)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    full = lambda t: len(SpacedIds(path).encoder.encode(t, add_special_tokens=False).ids)
    got = {r["doc_id"]: r for r in token_edits.count_edited(frame(spark, rows, clash=True), path).collect()}
    assert got[800]["n_edits"] == 3 and got[800]["n_tokens_edited"] == full("write to <EMAIL> or <PHONE> at <ADDRESS> now")
    assert got[801]["n_tokens_edited"] == full("k" * 200_000 + " <EMAIL>")
    assert got[90 - 70]["n_tokens"] == 0  # the null text


# -- toxicity --------------------------------------------------------------
def toxic_corpus(seed=0, n=400):
    rnd = random.Random(seed)
    plain = [f"w{k}" for k in range(300)]
    bad = ["idiot", "scum", "trash", "loser", "moron"]
    rows, labels = [], []
    for k in range(n):
        t = [rnd.choice(plain) for _ in range(rnd.choice([5, 40, 200]))]
        toxic = rnd.random() < 0.25
        for _ in range(rnd.randint(2, 5) if toxic else 0):
            t.insert(rnd.randrange(len(t)), rnd.choice(bad))
        rows.append((k, " ".join(t), "en", "s", 0))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    odd = [(900, None, None, None, None), (901, "", "", "", 0), (None, "idiot scum trash", "", "", 0), (902, "You IDIOT, scum!", "", "", 0), (3, "", "", "", 0)]
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows + odd, clash=True)
    got = toxicity.scored(docs, lab)
    assert got.columns[:-2] == docs.columns
    out = got.collect()
    assert len(out) == len(rows) + 5 and all(0 <= r["__score"] <= 1 for r in out)
    truth = {k: t for k, _, t in labels}
    for r in out:
        if r["doc_id"] in truth and r["text"] and crc32(str(r["doc_id"]).encode()) % 5 == 0:
            assert (r["__score"] >= 0.5) == bool(truth[r["doc_id"]])
    kept = toxicity.drop_toxic(docs, lab)
    assert kept.columns == docs.columns
    assert not any("IDIOT" in (r["text"] or "") for r in kept.collect())
    assert toxicity.scored(docs.limit(0), lab.limit(0)).count() == 0
    assert {r["__score"] for r in toxicity.scored(docs, lab.limit(0)).collect()} == {0.5}


def small_model(texts, toxic, s):
    """A model with random weights over the terms of ``texts``."""
    found = [toxicity.Terms().of(t) for t in texts]
    terms = np.unique(np.concatenate([np.empty(0, np.uint64), *[x for x, _ in found]]))
    weight = np.random.default_rng(1).uniform(0.2, 4, len(terms))
    return toxicity.Model(terms, weight, 0.7, np.concatenate([[0], np.cumsum([len(x) for x, _ in found])]),
                          np.searchsorted(terms, np.concatenate([x for x, _ in found])), np.concatenate([f for _, f in found]),
                          np.array(toxic, bool), np.ones(len(texts)), list(range(len(texts))), s, sizes=(5.0, 5.0))


@pytest.mark.parametrize("columns", [0, 7, 400])
def test_nearest_examples_are_exact(columns):
    rnd = random.Random(2)
    s = toxicity.Settings(block=4, neighbours=5, columns=columns)
    text = lambda: " ".join(f"term{rnd.randrange(40)}" for _ in range(rnd.randint(0, 9)))
    texts = [text() for _ in range(203)]
    m = small_model(texts, [k % 3 == 0 for k in range(203)], s)
    index, terms = toxicity.BlockMaxIndex(m), toxicity.Terms()

    def unit(t):
        out = np.zeros(len(m.terms) + 2)
        for number, n in zip(*terms.of(t)):
            at = np.searchsorted(m.terms, number)
            if at < len(m.terms) and m.terms[at] == number:
                out[at] = (1 + np.log(n)) * m.weight[at]
            else:
                out[-1] = np.hypot(out[-1], (1 + np.log(n)) * m.unknown)
        out[-2] = s.constant
        out /= np.linalg.norm(out)
        out[-1] = 0
        return out
    dense = np.stack([unit(texts[i]) for i in index.order])
    asked = [text() + " unseen words" for _ in range(60)] + ["", texts[17]]
    for q, (cosine, e) in zip(asked, index.nearest([terms.of(q) for q in asked])):
        cos = dense @ unit(q)
        assert np.allclose(cosine, np.sort(cos)[::-1][:5], atol=2e-5) and np.allclose(cos[e], cosine, atol=2e-5)
    assert index.nearest([terms.of(texts[17])])[0][0][0] == pytest.approx(1.0, abs=2e-5)


def test_terms_come_as_places_from_a_table_that_a_run_keeps(monkeypatch):
    def brute(text):
        out = Counter()
        for w in text.encode().translate(toxicity.WORD_BYTES).decode().split():
            out.update([w, *[toxicity.MARK + w[:k] for k in toxicity.BEGINNINGS if len(w) > k]])
        return {toxicity._number(t): n for t, n in out.items()}
    rnd = random.Random(8)
    words = ["stem", "stems", "stemming", "STEMMED", "stemmata", "\u00e9t\u00e9", "\u00e9t\u00e9s\u00e9t\u00e9s", "a", "a^b", "\u6f22" * 9, "x" * 300]
    words += ["".join(rnd.choices("abc", k=rnd.randint(1, 9))) for _ in range(200)]
    texts = ["", " ", "stem stem stems stemming"] + [rnd.choice(" \n-").join(rnd.choices(words, k=rnd.randint(1, 60))) for _ in range(90)]
    known = np.array(sorted(n for n in {n for t in texts[:40] for n in brute(t)} if n % 3), np.uint64)
    for chars in (toxicity._CHARS, 50):  # the second empties the table at every call
        monkeypatch.setattr(toxicity, "_CHARS", chars)
        held = {}
        for batch in (texts[:50], texts[50:], texts):
            table = toxicity.kept(held, "run", lambda: toxicity.Terms(known))
            text, place, n = table.counts(batch)
            assert (np.diff(text) >= 0).all()
            for k, t in enumerate(batch):
                want = Counter()
                for number, freq in brute(t).items():
                    at = int(np.searchsorted(known, np.uint64(number)))
                    want[(at if at < len(known) and int(known[at]) == number else -1, freq)] += 1
                assert Counter(zip(place[text == k].tolist(), n[text == k].tolist())) == want
        assert (len(table.words) == len({w for t in texts for w in t.encode().translate(toxicity.WORD_BYTES).decode().split()}))
        assert table is held["run"] and toxicity.kept(held, "next", lambda: toxicity.Terms(known)) is not table and len(held) == 1
    plain = toxicity.Terms()
    for t, (number, freq) in zip(texts, plain.many(texts)):
        assert (np.diff(number.astype(object)) > 0).all() and dict(zip(number.tolist(), freq.tolist())) == brute(t)
    assert (toxicity.Terms(known[:0]).counts(texts)[1] == -1).all()


def test_counts_of_terms_are_those_of_all_rows(spark, monkeypatch):
    rows, labels = toxic_corpus(5, 120)
    rows = rows + rows[:30] + [(None, "idiot w1", "", "", 0), (7000, None, "", "", 0)]
    numbers = [set(toxicity.Terms().of(t or "")[0].tolist()) for _, t, *_ in rows]
    terms = np.array(sorted(set().union(*numbers))[::2], np.uint64)
    label = dict((k, t) for k, _, t in labels if k % 3)
    lab = spark.createDataFrame([(k, bool(t)) for k, t in label.items()], "doc_id long, toxic boolean")
    counts, total = toxicity._counts(frame(spark, rows).repartition(3), lab, terms, "counted")
    kinds = [label.get(r[0]) for r in rows]
    assert total.tolist() == [len(rows), kinds.count(1), kinds.count(0)]
    for k, fit in enumerate((lambda x: True, lambda x: x == 1, lambda x: x == 0)):
        seen = Counter(n for x, found in zip(kinds, numbers) if fit(x) for n in found)
        assert counts[k].tolist() == [seen[int(t)] for t in terms]


def test_every_text_with_words_has_a_vector_and_copies_find_their_example(spark):
    rows, labels = toxic_corpus(3, 260)
    used = [(k, t) for k, t, *_ in rows if dict((k, x) for k, _, x in labels).get(k) == 1 and crc32(str(k).encode()) % 5]
    copies = [(10_000 + k, t, "en", "s", 0) for k, t in used]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn(frame(spark, rows + copies), lab)
    assert (np.diff(model.cuts) > 0).all() and (model.weight > 0).mean() > 0.99 and len(model.doc_id) == sum(
        crc32(str(k).encode()) % 5 > 0 for k, _, _ in labels)
    got = {r["doc_id"]: r["__evidence"] for r in toxicity.scored(frame(spark, rows + copies), lab).collect()}
    texts = dict((k, t) for k, t, *_ in rows)
    for k, t in used:
        assert texts[got[10_000 + k][0]["doc_id"]] == t and got[10_000 + k][0]["cosine"] == pytest.approx(1.0, abs=2e-5)


def test_samples_stand_for_their_class_and_bounds_hold(spark):
    rows = [(k, f"bad w{k} x{k % 7}" if k % 10 == 0 else f"good w{k} y{k % 5}", "", "", 0) for k in range(3000)]
    lab = spark.createDataFrame([(k, 1, int(k % 10 == 0)) for k in range(3000)], "doc_id long, quality int, toxic int")
    train = [k for k in range(3000) if crc32(str(k).encode()) % 5]
    pos = sum(k % 10 == 0 for k in train)
    model = toxicity.learn(frame(spark, rows), lab, toxicity.Settings(most_examples=400))
    assert model.sizes == (len(train) - pos, pos) and len(model.doc_id) <= 480
    for t, n in ((True, pos), (False, len(train) - pos)):
        assert abs(model.stands[model.toxic == t].sum() / n - 1) < 0.35
    few = toxicity.learn(frame(spark, rows), lab, toxicity.Settings(most_examples=400, most_chars=1500))
    assert len(few.doc_id) < len(model.doc_id) / 2


def test_scores_are_probabilities():
    rnd = np.random.default_rng(6)
    p = rnd.uniform(0.02, 0.98, 6000)
    toxic = rnd.random(6000) < p
    bent = 1 / (1 + np.exp(-(0.4 * np.log(p / (1 - p)) - 1)))  # votes that are neither steep enough nor centred
    slope, offset = toxicity.fit_curve(bent, toxic, np.ones(6000))
    got = np.array([toxicity.probability(v, slope, offset) for v in bent])
    for lo in np.arange(0, 1, 0.2):
        m = (got >= lo) & (got < lo + 0.2)
        assert abs(toxic[m].mean() - got[m].mean()) < 0.05
    assert toxicity.fit_curve(bent[:4], toxic[:4], np.ones(4)) == (1.0, 0.0)


def test_held_out_scores_are_reliable(spark):
    from airlens.llm import common
    docs, lab = (common.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in lab.collect()}
    rows = toxicity.op4_toxicity(spark, "/root/testdata/sf0.1").filter("held_out").select("doc_id", "score").collect()
    s, y = (np.array(x) for x in zip(*[(r["score"], truth[r["doc_id"]]) for r in rows if truth.get(r["doc_id"]) is not None]))
    assert (y[s >= 0.5] == 1).mean() > 0.95 and (s[y == 1] >= 0.5).mean() > 0.9
    for lo, hi in ((0, 0.3), (0.3, 0.7), (0.7, 1.01)):
        m = (s >= lo) & (s < hi)
        assert m.sum() < 15 or abs(s[m].mean() - y[m].mean()) < 0.06


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = toxic_corpus(1, 200)
    turned = [(k, q, 1 - t if crc32(str(k).encode()) % 5 == 0 else t) for k, q, t in labels]
    score = lambda lab: by_doc(toxicity.scored(frame(spark, rows), spark.createDataFrame(lab, "doc_id long, quality int, toxic int")), "__score")
    assert score(labels) == score(turned)


# -- shared ----------------------------------------------------------------
def test_keep_rows_leaves_as_many_copies_as_named(spark):
    docs = frame(spark, [(1, "a", "x", "s", 1)] * 3 + [(2, None, "y", "s", 1), (None, "b", "z", "s", 1)], clash=True)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    kept = spark.createDataFrame([(1, sha("a"), 3)] * 2 + [(2, sha(""), 1), (None, sha("b"), 1)], "doc_id long, text_key string, copies long")
    got = common.keep_rows(docs, kept)
    assert got.columns == docs.columns
    assert Counter(r["doc_id"] for r in got.collect()) == {1: 2, 2: 1, None: 1}
