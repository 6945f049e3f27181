"""Collocations, conversation repair and exact duplicates: brute-force twins and defined cases."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from cohortlake.llm import collocations, exact_dedup, turn_repair  # noqa: E402
from cohortlake.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ collocations
def phrases_by_hand(rows, least, top):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            words[lang] += len(w)
            for k in range(1, 6):
                counts[lang].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: n for p, n in f.items() if n >= least and " " in p}
        inside = {}
        for p, n in found.items():
            w = p.split(" ")
            for i in range(len(w)):
                for j in range(i + 1, len(w) + 1):
                    if j - i < len(w):
                        q = " ".join(w[i:j])
                        inside[q] = max(n, inside.get(q, 0))
        made = []
        for p, a in found.items():
            if 100 * inside.get(p, 0) >= 100 * a:
                continue
            w = p.split(" ")
            cuts = [(1000 * a * words[lang] // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            made.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        out += [(lang, i, p.decode(), -a, l, r, words[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(made)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    vocabulary = ["New", "york", "city", "é", "of", "the", "a b", "#", "x" * 300]
    rows = []
    for i in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ", ", ".\n", " ", " ", "\x0b"]) for w in words)
        rows.append((rng.choice(["en", "fr", None, "und"]), text))
    rows += [("en", None), ("en", ""), (None, " .,; "), ("xx", "in short in short in short in short"), ("en", "new york " * 5000)]
    return rows, spark.createDataFrame([(*r, "mine", 7) for r in rows], "lang string, text string, phrase string, f int")


@pytest.mark.parametrize("least,top,bits", [(4, 2000, 16), (1, 50, 16), (12, 2000, 18)])
def test_collocations_equal_brute_force(texts, least, top, bits):
    rows, frame = texts
    got = [tuple(r) for r in collocations.collocations(frame, min_count=least, top=top, filter_bits=bits).collect()]
    assert sorted(got) == phrases_by_hand(rows, least, top)


def test_collocation_scores_pass_64_bits(spark):
    a, n = 10**13, 4 * 10**13
    score = spark.range(1).selectExpr(f"{a}L a", f"{n}L n", f"{a + 5}L l", f"{a + 7}L r").select(
        F.expr("(CAST(1000 AS DECIMAL(38, 0)) * a * n) div (CAST(l AS DECIMAL(38, 0)) * r)")).first()[0]
    assert score == 1000 * a * n // ((a + 5) * (a + 7))


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string"), filter_bits=16).collect() == []


# ------------------------------------------------------------------ conversation repair
AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows):
    """(cost, audit, lines) over every sequence of edits; rows are (role, text, doomed, truncated)."""
    tops = {"": (0, "", ())}

    def inserted(tops):
        tops = dict(tops)
        for _ in range(3):
            for at, (c, a, lines) in list(tops.items()):
                for x, name in turn_repair.ROLES.items():
                    if x in AFTER[at]:
                        made = (c + 2, a + "I", (*lines, f"{name}:"))
                        tops[AFTER[at][x]] = min(tops.get(AFTER[at][x], made), made)
        return tops

    for role, text, doomed, truncated in rows:
        new = {}
        for at, (c, a, lines) in inserted(tops).items():
            offers = [(at, (c + 3, a + "D", lines))]
            if not doomed:
                if role[:1] in AFTER[at]:
                    offers.append((role[:1], (c + truncated, a + "K", (*lines, f"{role}:{text}"))))
                offers += [(x, (c + 2 + truncated, a + "R", (*lines, f"{name}:{text}"))) for x, name in turn_repair.ROLES.items() if x in AFTER[at]]
            for to, made in offers:
                new[to] = min(new.get(to, made), made)
        tops = new
    return min(top for at, top in inserted(tops).items() if at in ("", "a"))


def repaired_by_hand(turns):
    out = {}
    for conv in {t[0] for t in turns}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in turns if c == conv]
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, rows, n = set(), [], Counter()
        for _, role, text in own:
            blank = not re.search(r"[^ \t-\r]", text)
            doomed = blank or (role, text) in seen
            cut = not doomed and not re.search(r"[.!?][ \t-\r]*\Z", text)
            n.update({"blank": blank, "duplicate": doomed and not blank, "truncated": cut})
            seen.add((role, text))
            rows.append((role, text, doomed, cut))
        numbered = [t for t, _, _ in own if t is not None]
        gaps = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = cheapest(rows)
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(turns, **options):
    made = turn_repair.repair_conversations(turns, **options)
    sums = {r.conv_id: r.sha256 for r in turn_repair.digests(made.turns).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, sums.get(r.conv_id, nothing)) for r in made.report.collect()}


@pytest.fixture(scope="module")
def conversations(spark):
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            text = rng.choice(["Yes.", "So", "What? ", "", " \n", None, "é!", f"Text {turn}.", f"Cut {turn}", "a\nb?"])
            rows.append((conv, rng.choice([turn, turn + rng.randint(0, 3), None]), role, text))
    rows += [(99, i // 3, "user" if i % 2 else "assistant", f"Said {i % 50}.") for i in range(900)]
    rows += [(98, 0, "user", "Again.")] * 300
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")


@pytest.mark.parametrize("segment", [512, 3])
def test_repair_equals_brute_force(conversations, segment):
    rows, frame = conversations
    assert repaired(frame, segment=segment) == repaired_by_hand(rows)


def test_repair_does_not_depend_on_partitions(spark, conversations):
    rows, frame = conversations
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert repaired(frame, segment=40) == repaired_by_hand(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_repaired_turns_are_legal_and_whole(conversations):
    rows, frame = conversations
    made = turn_repair.repair_conversations(frame)
    by_conv = defaultdict(list)
    for r in made.turns.collect():
        by_conv[r.conv_id].append(((r.part, r.segment, r.i, r.j), r.role[:1]))
    for turns in by_conv.values():
        assert re.fullmatch("s?(ua)+", "".join(x for _, x in sorted(turns)))


def test_repair_of_nothing_and_of_nested_grammars(spark):
    made = turn_repair.repair_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert made.report.collect() == [] and made.turns.collect() == []
    with pytest.raises(ValueError):
        turn_repair.RoleParser((("C", "uCa"), ("C", "ua")))


# ------------------------------------------------------------------ exact duplicates
def weak(block, salt):
    """References that two blocks share at first, and not later."""
    return [F.xxhash64(F.lit(salt), block) % (2 if salt < 2 else 1 << 40), F.lit(0).cast("long")]


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("ab cé") for _ in range(5000))
    rows = [(1, "same"), (2, "same"), (3, "samf"), (4, ""), (5, None), (None, "same"), (None, "alone"), (6, long), (7, long), (8, long[:-1]), (9, long + "x"),
            (10, "x" + long), (2, "same"), (2, "other"), (11, long[:2048]), (12, "a" * 64), (13, "a" * 65), (14, "a" * 128), (15, "a" * 64)]
    rows += [(100 + i, "ab" * (i % 7)) for i in range(60)]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, name int")


def copies_by_hand(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[text or ""].append((doc is not None, doc or 0, -i, doc))
    out = []
    for text, members in groups.items():
        best = max(members)
        out += [(m[3], best[3], len(members), m is best, hashlib.sha256(text.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,refer", [(2048, exact_dedup.reference), (16, exact_dedup.reference), (1, exact_dedup.reference), (64, weak)])
def test_exact_duplicates_equal_brute_force(copies, block, refer):
    rows, frame = copies
    got = exact_dedup.exact_duplicates(frame.coalesce(1), block=block, refer=refer).select("id", "keep_id", "group_size", "kept", "sha256").collect()
    assert sorted([tuple(r) for r in got], key=str) == copies_by_hand(rows)


def test_dropping_copies_keeps_columns(copies, spark):
    rows, frame = copies
    got = exact_dedup.drop_exact_duplicates(frame)
    assert got.columns == frame.columns
    kept = [(d, t) for d, t, *_ in got.collect()]
    assert sorted(t or "" for _, t in kept) == sorted({t or "" for _, t in rows})
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_exact_duplicates_run_no_python(copies):
    plan = exact_dedup.exact_duplicates(copies[1])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_identities_of_the_given_documents(spark):
    docs = table(spark, SF, "documents")
    made = exact_dedup.identities(docs, block=256)
    assert made.select("round", "name").distinct().count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
