"""URL filter: rules, host word segmentation and naive Bayes (operator 8).

Listed rules come first.  For the rest, the parts of a host are split into
words by a unigram Viterbi whose counts come from all documents, and a
multinomial naive Bayes scores the host's words and the path's tokens.  Its
two classes are learned from the pages' own urls in two rounds: first hosts
with a listed word are examples to block and all others examples to allow, but
for urls that a rule blocks, which are no example to allow; then the urls that
the first round is sure of (odds of nine to one) are examples to block too, so
that words and paths that keep company with listed ones count, and unlisted
hosts made of them are found.

Counts, words and scores stay in tables that are joined by word, host or path
shape; nothing that grows with the input is broadcast.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm import common as U
from airlens.session import materialise, settled

# Fixed values: (verdict, host, path) rules of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Words whose hosts are examples to block, and words that a
# general corpus may lack but names are made of.
BLOCK_WORDS = ("adult", "ads", "advert", "bet", "bets", "betting", "bingo", "bookmaker", "camgirls", "cams", "casino", "casinos",
               "cialis", "clickbait", "cracks", "erotic", "escort", "escorts", "gamble", "gambling", "hentai", "hookup",
               "jackpot", "keygen", "keygens", "loan", "loans", "lottery", "lotto", "malware", "milf", "nude", "nudes", "payday",
               "phishing", "pills", "poker", "porn", "porno", "roulette", "scam", "scams", "sex", "sexy", "slots", "spam",
               "spyware", "steroids", "sweepstakes", "trojan", "viagra", "warez", "webcams", "xxx")
NAME_WORDS = ("best", "blog", "buy", "cheap", "deals", "download", "example", "farm", "free", "info", "mail", "news", "online",
              "shop", "site", "store", "track", "web", "win", "www")
#: Log odds from which a url of the first round is an example to block.
SURE = math.log(9)
#: Letters of the longest part of a host name.
LONGEST = 63
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of letters and non-ASCII characters, A-Z lower-cased; a row per word and batch."""
    keep = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
    for batch in batches:
        seen = Counter()
        for text in batch.column("text"):
            seen.update(text.as_py().encode().translate(keep).split())
        words = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words], pa.string()),
                                          pa.array([seen[w] for w in words], pa.int64())], names=["word", "n"])


def viterbi(part: str, known: dict[str, float], total: float) -> list[str]:
    """Most likely words of a name.  An unknown word of n letters has the
    chance 10 / (total * 10**n)."""
    best, back = [0.0] + [math.inf] * len(part), [0] * (len(part) + 1)
    for end in range(1, len(part) + 1):
        for start in range(max(0, end - LONGEST), end):
            n = known.get(part[start:end])
            cost = math.log(total / n) if n else math.log(total / 10) + (end - start) * math.log(10)
            if best[start] + cost < best[end]:
                best[end], back[end] = best[start] + cost, start
    words, end = [], len(part)
    while end:
        words.append(part[back[end]:end])
        end = back[end]
    return words[::-1]


def segment(parts: DataFrame, docs: DataFrame) -> DataFrame:
    """(part, words) of the distinct ``parts``; a host part longer than a word
    may be is cut into words no longer than LONGEST."""
    found = parts.select("part", F.explode(F.sequence(F.lit(1), F.length("part"))).alias("start"))
    found = found.select("part", F.explode(F.transform(
        F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("part") - F.col("start") + 1)),
        lambda n: F.substring(F.col("part"), F.col("start"), n))).alias("word")).distinct()
    counts = materialise(U.doc_text(docs).mapInArrow(count_words, "word string, n long")
                         .groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    total = float(counts.agg(F.sum("n")).first()[0] or 0) + 1e6
    known = found.join(counts, "word").groupBy("part").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    extra = {w: max(1.0, total / 1e5) for w in BLOCK_WORDS + NAME_WORDS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [viterbi(part, extra | {x["word"]: x["n"] + extra.get(x["word"], 0.0) for x in known or ()}, total)
                    for part, known in zip(batch.column("part").to_pylist(), batch.column("known").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(rows, pa.list_(pa.string()))], names=["part", "words"])

    return parts.join(known, "part", "left").mapInArrow(run, "part string, words array<string>")


def tokens(path: Column) -> Column:
    """Lower-case path tokens; digits count as one sign each run."""
    low = F.regexp_replace(F.translate(path, UPPER, LOWER), r"[0-9]+", "#")
    return F.filter(F.split(low, r"[^a-z#\x80-\x{10FFFF}]+"), lambda t: t != "")


def score_urls(seen: DataFrame, words: DataFrame, rows: DataFrame) -> DataFrame:
    """(host, shape, block_odds) of ``seen`` (host, shape) by multinomial naive
    Bayes with add-one smoothing, learned from ``rows`` (host, shape, listed, n,
    bad); ``words`` are those of each host."""
    classed = rows.filter("bad = 1 or listed is null or listed <> 'block'")
    by_host = classed.groupBy("host", "bad").agg(F.sum("n").alias("n"))
    from_host = words.join(by_host, "host").select(F.concat(F.lit("h:"), "word").alias("token"), "bad", "n")
    path_tokens = F.explode(F.filter(F.split("shape", "/"), lambda t: t != "")).alias("t")
    from_path = (classed.groupBy("shape", "bad").agg(F.sum("n").alias("n")).select(path_tokens, "bad", "n")
                 .select(F.concat(F.lit("p:"), "t").alias("token"), "bad", "n"))
    counts = materialise(from_host.unionByName(from_path).groupBy("token").agg(
        F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(0)).alias("block"),
        F.sum(F.when(F.col("bad") == 0, F.col("n")).otherwise(0)).alias("allow")), "url-tokens")
    size, block, allow = counts.agg(F.count(F.lit(1)), F.sum("block"), F.sum("allow")).first()
    n_block, n_allow = by_host.agg(F.sum(F.when(F.col("bad") == 1, F.col("n"))),
                                   F.sum(F.when(F.col("bad") == 0, F.col("n")))).first()
    prior = math.log(((n_block or 0) + 1) / ((n_allow or 0) + 1))
    scale = math.log(((allow or 0) + size + 1) / ((block or 0) + size + 1))
    odds = counts.select("token", (F.log((F.col("block") + 1.0) / (F.col("allow") + 1.0)) + scale).alias("odds"))

    # By distinct host and by distinct path shape, then together.
    host_odds = (words.select("host", F.concat(F.lit("h:"), "word").alias("token")).join(odds, "token")
                 .groupBy("host").agg(F.sum("odds").alias("host_odds")))
    shape_odds = (seen.select("shape").distinct().select("shape", path_tokens)
                  .select("shape", F.concat(F.lit("p:"), "t").alias("token")).join(odds, "token")
                  .groupBy("shape").agg(F.sum("odds").alias("shape_odds")))
    return (seen.select("host", "shape").join(host_odds, "host", "left").join(shape_odds, "shape", "left")
            .select("host", "shape", F.round(F.lit(prior) + F.coalesce("host_odds", F.lit(0.0))
                                             + F.coalesce("shape_odds", F.lit(0.0)), 6).alias("block_odds")))


def judge(pages: DataFrame, docs: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and block_odds (log odds of the
    naive Bayes), one row per row of ``pages``.

    A null url, or one without "://", has an empty host and path, fits no rule
    and is judged by the prior alone.  Repeated rows are judged alike."""
    host, path = host_path(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    urls = materialise(urls.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("listed"),
                                   F.array_join(tokens(F.col("path")), "/").alias("shape")), "urls")
    counted = materialise(urls.groupBy("host", "shape", "listed").agg(F.count(F.lit(1)).alias("n")), "seen-urls")
    seen = counted.select("host", "shape").distinct()

    # Words of each host, and its class.
    of_host = seen.select("host").distinct().select("host", F.posexplode(F.filter(
        F.split("host", r"[^a-z\x80-\x{10FFFF}]+"), lambda p: p != "")).alias("at", "part"))
    of_host = materialise(of_host, "host-parts")
    parts = segment(of_host.select("part").distinct(), docs)
    words = of_host.join(parts, "part").select("host", F.explode("words").alias("word"))
    words = materialise(words, "host-words")
    bad = words.filter(F.col("word").isin(*BLOCK_WORDS)).select("host").distinct().withColumn("bad", F.lit(1))

    rows = counted.join(bad, "host", "left").select("host", "shape", "listed", "n", F.coalesce("bad", F.lit(0)).alias("bad"))
    first = materialise(score_urls(seen, words, rows), "first-odds")
    sure = first.filter(F.col("block_odds") > SURE).select("host", "shape", F.lit(1).alias("sure"))
    rows = (rows.join(sure, ["host", "shape"], "left")
            .select("host", "shape", "listed", "n", F.greatest("bad", F.coalesce("sure", F.lit(0))).alias("bad")))
    scored = score_urls(seen, words, rows)
    return (urls.join(scored, ["host", "shape"])
            .select("page_id", "host", "path", "rule",
                    F.coalesce("listed", F.when(F.col("block_odds") > 0, "block").otherwise("allow")).alias("verdict"),
                    "block_odds"))


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    return settled(spark, "judged", lambda: judge(U.table(spark, sf_dir, "pages"), U.documents(spark, sf_dir)))
