"""Near duplicates: common passages, repeated ids, clashing names."""

from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from cohortlake.llm import near_dup  # noqa: E402


def components_by_hand(texts, width, percent):
    sets = [{tuple(t.lower().split()[i : i + width]) for i in range(max(1, len(t.split()) - width + 1))} if t.split() else set() for t in texts]
    comp = list(range(len(texts)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                comp[y] = x
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [4, 1024])
def test_texts_with_a_common_passage(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(3000)}"
    common = [word() for _ in range(60)]
    texts = []
    for _ in range(60):
        texts.append(" ".join(common + [word() for _ in range(rng.choice([2, 6, 10, 20, 30]))]))
    for t in rng.sample(texts, 25):  # near copies, above and below the threshold
        words = t.split()
        for _ in range(rng.choice([1, 2, 3, 8])):
            words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    got = near_dup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width=3, percent=85).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(components_by_hand(texts, 3, 85)))


def test_an_id_on_several_texts_loses_only_its_copies(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a + " end"
    rows = [(1, a), (2, a), (2, b), (3, near), (3, c), (3, c), (4, b + " end"), (None, a), (None, a), (5, ""), (5, None), (6, None), (7, c + " x"), (7, c + " y")]
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows], "doc_id long, text string, id string, key int")
    left = near_dup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (3, c), (None, a), (None, a), (5, ""), (5, None), (6, None)], key=str)


def test_two_texts_of_one_id_in_one_component_leave_one(spark):
    a = " ".join(f"a{i}" for i in range(60))
    docs = spark.createDataFrame([(1, a + " x"), (1, a + " y"), (2, a)], "doc_id long, text string")
    assert [r.doc_id for r in near_dup.drop_near_duplicates(docs).collect()] == [1]
