"""Draws of the mixture and rows of the pipeline against plain Python, document by document."""

from __future__ import annotations

import os
import re
import sys
from collections import Counter, defaultdict

import xxhash

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortlake.llm import mixing, quality_classifier, secret_scan  # noqa: E402
from cohortlake.llm.common import stored  # noqa: E402
from test_text_operators import SF, brute_components  # noqa: E402


def spark_hash(*values) -> int:
    """Spark's xxhash64: each value is hashed with the hash of those before it; (value, bytes) is an integer of that width."""
    h = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True)
            h = xxhash.xxh64_intdigest(data, h)
    return h - (1 << 64) if h >> 63 else h


def plain_draws(docs, targets, block_docs, seed=6):
    """Draws of each row of (doc_id, source, text), in the order of the rows."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, _, t in docs]
    h = [spark_hash((seed, 4), None if d is None else (d, 8), t) for d, _, t in docs]
    of_source = defaultdict(list)
    for i, (_, source, _) in enumerate(docs):
        of_source[source].append(i)
    times = [0] * len(docs)
    for source, rows in of_source.items():
        key = "" if source is None else "=" + source
        total = sum(size[i] for i in rows)
        whole = int(targets[source] // total) if total else 0
        rest = targets[source] - whole * total
        blocks = defaultdict(list)
        for i in rows:
            blocks[h[i] % -(-len(rows) // block_docs)].append(i)
        for block in sorted(blocks, key=lambda b: (spark_hash((seed, 4), key, (b, 8)), b)):
            held = blocks[block]
            words = sum(size[i] for i in held)
            for i in held:
                times[i] += whole
            if words <= rest:
                for i in held if words else ():
                    times[i] += 1
            elif rest > 0:  # the border: documents by hash, as near to the rest as they come
                by_hash = defaultdict(list)
                for i in held:
                    by_hash[spark_hash((h[i], 8))].append(i)
                upto = 0
                for g in sorted(by_hash):
                    here = sum(size[i] for i in by_hash[g])
                    if 2 * (upto + here) - here <= 2 * rest:
                        for i in by_hash[g]:
                            times[i] += 1
                    upto += here
            rest -= words
    return size, times


def test_drawn_documents_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    for block_docs in (3, 1000):
        mixed = mixing.Mixture(docs, block_docs=block_docs)
        targets = {r.source: r.target for r in mixed.sources.collect()}
        size, times = plain_draws(rows, targets, block_docs)
        got = {r.doc_id: (r.size, r.taken) for r in mixed.taken().collect()}
        assert got == {d: (s, s * n) for (d, _, _), s, n in zip(rows, size, times)}
        drawn = Counter(r.doc_id for r in mixed.rows().select("doc_id").collect())
        assert drawn == Counter({d: n for (d, _, _), n in zip(rows, times) if n})


def test_pipeline_rows_equal_plain_python_stage_by_stage(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    weights = quality_classifier.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality_classifier.scored(docs, weights).select("doc_id", "score").collect()}
    whole = {r.doc_id: r.asDict() for r in docs.collect()}
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()

    # Benchmark windows as plain sets of word tuples, not through the automaton.
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for r in items:
        w = split(r.text)
        for i in range(max(1, len(w) - 9)) if w else ():
            windows[len(w[i : i + 10])].add(tuple(w[i : i + 10]))

    def holds_window(text):
        w = split(text)
        return any(tuple(w[i : i + n]) in held for n, held in windows.items() for i in range(len(w) - n + 1))

    frame, at = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, SF), "test-stage")
        at[name] = frame.collect()
    ids = lambda name: sorted(r.doc_id for r in at[name])

    good = sorted(d for d, s in scores.items() if s >= 0.3)
    assert ids("quality classifier") == good
    components = brute_components([(d, whole[d]["text"]) for d in good], 5, 80)
    alone = sorted(max(d, 0) for d, _, c in components if d == c)  # the brute force knows id 0 as -1
    assert ids("near duplicates") == alone
    clean = [d for d in alone if not holds_window(whole[d]["text"])]
    assert ids("benchmark decontamination") == clean
    for name in list(at)[:3]:
        assert all(r.asDict() == whole[r.doc_id] for r in at[name])

    redacted = {r.doc_id: r.asDict() for r in at["secret scans"]}
    assert sorted(redacted) == clean
    for d, row in redacted.items():
        text = whole[d]["text"] or ""
        covered = [False] * len(text)
        for s, _, e in secret_scan.base_spans(text):
            covered[s:e] = [True] * (e - s)
        marks = row["text"].split("[SECRET]") if row["text"] else [""]
        if not any(covered) and len(marks) == 1:
            assert row == whole[d]
        assert not secret_scan.base_spans(row["text"] or "")
        # What is left between the marks stands in the text, in order, outside of base spans.
        at_char = 0
        for part in marks:
            at_char = text.index(part, at_char)
            assert not any(covered[at_char : at_char + len(part)])
            at_char += len(part)
        assert {k: v for k, v in row.items() if k not in ("text", "n_chars")} == {k: v for k, v in whole[d].items() if k not in ("text", "n_chars")}

    rows = [(d, r["source"], r["text"]) for d, r in redacted.items()]
    targets = {r.source: r.target for r in mixing.Mixture(spark.createDataFrame(rows, "doc_id long, source string, text string")).sources.collect()}
    _, times = plain_draws(rows, targets, 1000)
    expected = Counter({d: n for (d, _, _), n in zip(rows, times) if n})
    assert Counter(r.doc_id for r in at["mixing"]) == expected
    assert all(r.text == redacted[r.doc_id]["text"] for r in at["mixing"])
    final = corpus_pipeline.run(spark, SF)
    assert Counter(r.doc_id for r in final.select("doc_id").collect()) == expected
