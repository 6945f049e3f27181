"""Columns that clash with an operator's own, and texts full of secrets."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from cohortlake.llm import mixing, quality_rules, secret_scan, substring_dedup  # noqa: E402

SCHEMA = "doc_id long, text string, source string, __key string, __h long, __block long, __spans string, __w int, __l int, key string, spans int, score int, n_chars long"
TEXT = " ".join(f"word{i}" for i in range(40))


def docs(spark):
    return spark.createDataFrame([(i, f"{TEXT} own{i} text{i}" if i < 6 else None, "ab"[i % 2], f"k{i}", i, -i, "s", 1, 2, "key", 3, 4, 5) for i in range(8)], SCHEMA)


def test_clashing_columns_come_back_as_they_were(spark):
    frame = docs(spark)
    others = [c for c in frame.columns if c not in ("text", "doc_id")]
    before = {r.doc_id: tuple(r[c] for c in others) for r in frame.collect()}
    cut = substring_dedup.remove_repeats(frame)
    assert cut.columns == frame.columns
    assert {r.doc_id: tuple(r[c] for c in others) for r in cut.collect()} == before
    judged = quality_rules.judge(frame)
    assert {r.doc_id: tuple(r[c] for c in others) for r in judged.collect()} == before
    drawn = mixing.Mixture(frame).rows().collect()
    assert drawn and all(tuple(r[c] for c in others) == before[r.doc_id] for r in drawn)


def test_a_megabyte_of_keys_takes_seconds(spark):
    text = " ".join(f"AKIA{i:016d}" for i in range(1 << 16))[: 1 << 20]
    ranks = secret_scan._ranks(spark.range(1), secret_scan.VOCABULARY)
    spans = secret_scan.scanner(ranks, 20, 2.0)
    spans("AKIA" + "A" * 20)  # the vocabulary is read once
    begun = time.perf_counter()
    found = spans(text)
    assert time.perf_counter() - begun < 10
    assert len([x for x in found if x[1] == 1]) == len([w for w in text.split(" ") if len(w) >= 20])
