"""Word segmentation and naive Bayes against brute force, and recall beyond the listed words."""
import math
import random
import re
from collections import Counter

from airlens.llm import urls

PAGES = "page_id long, url string, html string"
DOCS = "doc_id long, text string"


def split_all(part, known, total):
    """Smallest cost over every way to cut ``part``."""
    best = None
    for mask in range(1 << (len(part) - 1)):
        words, at = [], 0
        for k in range(1, len(part)):
            if mask >> (k - 1) & 1:
                words.append(part[at:k])
                at = k
        words.append(part[at:])
        cost = sum(math.log(total / known[w]) if w in known else math.log(total / 10) + len(w) * math.log(10) for w in words)
        best = cost if best is None else min(best, cost)
    return best


def test_viterbi_is_the_cheapest_of_all_cuts():
    rnd = random.Random(1)
    for _ in range(60):
        letters = "abc"
        known = {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4))): rnd.randint(1, 500) for _ in range(15)}
        part = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 11)))
        total = 5000.0
        words = urls.viterbi(part, known, total)
        cost = sum(math.log(total / known[w]) if w in known else math.log(total / 10) + len(w) * math.log(10) for w in words)
        assert "".join(words) == part and abs(cost - split_all(part, known, total)) < 1e-9


def brute(pages, docs):
    counts = Counter(w for _, t in docs for w in re.findall(r"[a-z\x80-\U0010ffff]+", (t or "").lower()))
    total = float(sum(counts.values())) + 1e6
    extra = {w: max(1.0, total / 1e5) for w in urls.BLOCK_WORDS + urls.NAME_WORDS}
    known = {w: counts[w] + extra.get(w, 0.0) for w in {*counts, *extra}}
    rows = []
    for page_id, url, _ in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        fit = [(len(h + p), what, h + p) for what, h, p in urls.RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        listed = max(fit)[1:] if fit else (None, None)
        tokens = [t for t in re.split(r"[^a-z#\x80-\U0010ffff]+", re.sub(r"[0-9]+", "#", path.lower())) if t]
        words = [w for part in re.split(r"[^a-z\x80-\U0010ffff]+", host) if part for w in urls.viterbi(part, known, total)]
        rows.append([page_id, host, path, listed, words, tokens, bool(set(words) & set(urls.BLOCK_WORDS))])
    odds = None
    for _ in range(2):
        bad = [r[6] or odds is not None and round(o, 6) > urls.SURE for r, o in zip(rows, odds or [0] * len(rows))]
        seen = {0: Counter(), 1: Counter()}
        n = Counter()
        for r, b in zip(rows, bad):
            if b or r[3][0] != "block":
                seen[b].update(["h:" + w for w in r[4]] + ["p:" + t for t in r[5]])
                n[b] += 1
        every = {*seen[0], *seen[1]}
        scale = math.log((sum(seen[0].values()) + len(every) + 1) / (sum(seen[1].values()) + len(every) + 1))
        weight = {t: math.log((seen[1][t] + 1) / (seen[0][t] + 1)) + scale for t in every}
        prior = math.log((n[1] + 1) / (n[0] + 1))
        odds = [prior + sum(weight.get("h:" + w, 0.0) for w in r[4]) + sum(weight.get("p:" + t, 0.0) for t in r[5]) for r in rows]
    return {r[0]: (r[1], r[2], r[3][1], r[3][0] or ("block" if o > 0 else "allow"), round(o, 5)) for r, o in zip(rows, odds)}


def web(seed=3):
    rnd = random.Random(seed)
    good = ["river", "garden", "music", "school", "kitchen", "travel", "history", "science", "library", "weather"]
    gray = ["lucky", "stake", "bonus", "spin", "dealer"]
    pages, k = [], 0
    for _ in range(160):
        host = "".join(rnd.sample(good, 2))
        pages.append((k := k + 1, f"https://{host}.org/{rnd.choice(good)}/{rnd.randrange(99)}", None))
    for _ in range(60):  # listed words beside others
        host = rnd.choice(["casino", "poker", "betting"]) + "-" + "".join(rnd.sample(gray, 2))
        pages.append((k := k + 1, f"http://{host}.biz/{rnd.choice(['offer', 'signup'])}/{rnd.randrange(9)}", None))
    hidden = []
    for _ in range(40):  # none of the listed words
        host = "".join(rnd.sample(gray, 2)) + rnd.choice(gray)
        pages.append((k := k + 1, f"http://{host}.biz/offer/{rnd.randrange(9)}", None))
        hidden.append(k)
    pages += [(k + 1, "https://a.example.com/en/x", None), (k + 2, "https://www.example.com/en/", None), (k + 3, "http://sub.b.net/es/casino", None),
              (k + 4, None, None), (k + 5, "no url", None), (k + 6, "http://" + "x" * 300 + ".org/a", None), (k + 7, "http://d.com/casino?x=/y", None),
              (k + 8, "HTTP://CASINO.example.ORG#top", None), (k + 9, "http://日本casino.jp/ä", None)]
    docs = [(j, " ".join(rnd.choice(good + gray) for _ in range(60))) for j in range(30)] + [(99, None)]
    return pages, docs, hidden


def test_judgement_equals_brute_force(spark):
    pages, docs, _ = web()
    got = urls.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(docs, DOCS))
    out = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], round(r["block_odds"], 5)) for r in got.collect()}
    want = brute(pages, docs)
    assert out.keys() == want.keys()
    for k, v in want.items():
        assert out[k][:4] == v[:4] and abs(out[k][4] - v[4]) < 2e-5, (k, out[k], v)


def test_hosts_without_a_listed_word_are_found(spark):
    pages, docs, hidden = web(5)
    out = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(docs, DOCS)).collect()}
    hosts = {p[0]: p[1] for p in pages}
    assert not any(w in hosts[k] for k in hidden for w in urls.BLOCK_WORDS)
    assert sum(out[k] == "block" for k in hidden) >= 0.95 * len(hidden)
    assert all(out[k] == "allow" for k in range(1, 161))
