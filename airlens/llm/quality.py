"""Quality rules as a bitmask ledger (operator 5).

Every rule is evaluated once per text; the ledger keeps the measurements and
one bit per failed rule.  A policy is a set of bits with a version name, so
applying another policy, or asking what a rule adds to it, is bitwise work on
the ledger and reads no text.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm import common as U
from airlens.llm.wordhash import shingle_hashes, word_hashes

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_twin_words",
            "n_upper", "n_lower")

#: name -> condition on the measurements; the position is the bit.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 40 * n_lines",
    "shouting": "100 * n_upper > 60 * (n_upper + n_lower)",
    "word_length": "10 * word_chars < 25 * n_words OR word_chars > 12 * n_words",
    "twin_words": "100 * n_twin_words > 40 * n_words",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}
#: Versions of the policy: the rules that drop a text.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "2024-1": ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    "2024-2": tuple(RULES),
}
CURRENT = "2024-2"


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def repeated_words(hashes: np.ndarray) -> int:
    """Words in windows of WINDOW words that the text has twice or more."""
    if len(hashes) < WINDOW:
        return 0
    windows = shingle_hashes(hashes, WINDOW)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    often = np.zeros(len(windows), bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    step = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(often)
    step[at] += 1
    np.subtract.at(step, at + WINDOW, 1)
    return int((np.cumsum(step) > 0).sum())


def measure(texts: list[str]) -> Iterator[tuple]:
    """The MEASURES of each text."""
    raws = [t.encode() for t in texts]
    hashes, counts = word_hashes(raws)
    count = lambda raw, chars: len(raw) - len(raw.translate(None, chars))
    for text, raw, h in zip(texts, raws, np.split(hashes, np.cumsum(counts)[:-1])):
        lines = [x for x in raw.split(b"\n") if x.strip()]
        yield (len(h), len(text) - count(raw, b" \t\n\v\f\r"), count(raw, b"#*$%&|<>"), len(lines),
               len(lines) - len(set(lines)), repeated_words(h), int((h[1:] == h[:-1]).sum()),
               count(raw, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(raw, b"abcdefghijklmnopqrstuvwxyz"))


def measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            got = zip(*measure(part.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in got)],
                                             names=["doc_id", *MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the MEASURES and failed_rules, one row per row of ``docs``.

    A null text has no words and so fails few_words; rules that divide are
    written as products, so texts without words or lines fail none of them."""
    measured = U.doc_text(docs).mapInArrow(measure_batches, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES.items()]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("failed_rules", total.cast("long"))


def fails(policy: str) -> Column:
    return F.col("failed_rules").bitwiseAND(F.lit(mask(policy))) != 0


def ablate(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """(rule, failed, only, both): per rule of the policy, the rows that fail
    it, the rows that only it drops, and per other rule (in RULES order) the
    rows that fail both.  One aggregate over the ledger."""
    bits = F.col("failed_rules").bitwiseAND(F.lit(mask(policy)))
    has = lambda r: bits.bitwiseAND(F.lit(BIT[r])) != 0
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    rules = [F.struct(F.lit(r).alias("rule"), n(has(r)).alias("failed"), n(bits == BIT[r]).alias("only"),
                      F.array(*[n(has(r) & has(o)) for o in RULES]).alias("both")) for r in POLICIES[policy]]
    return rows.agg(F.array(*rules).alias("all")).select(F.inline("all"))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    return ledger(U.documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        fails("base").alias("base_failed"), (~fails(CURRENT)).alias("kept"), "failed_rules")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), g AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5
), v AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 4]) AS n FROM g
), r AS (SELECT doc_id, count(*) AS n FROM (
           SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS p FROM v WHERE n > 1) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_twin_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id
), b AS (SELECT *, """ + " + ".join(f"CASE WHEN {rule} THEN {BIT[name]} ELSE 0 END" for name, rule in RULES.items()) + rf""" AS f FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f & {mask('base')} <> 0 AS base_failed,
       f & {mask(CURRENT)} = 0 AS kept, f::BIGINT AS failed_rules FROM b
"""
