"""The forest of the n-gram join: how far prefixes are shortened, repeats, and the recall against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import ngram_join

WORDS = ["".join(p) for p in ((a, b, c) for a in "abcdefgh" for b in "aeiou" for c in "lmnr")]


def changed(r, words, share):
    return [r.choice(WORDS) if r.random() < share else w for w in words]


def test_chance_to_meet_and_estimate():
    assert ngram_join.meeting(1.0, 6) == 1 and ngram_join.meeting(0.8, 6) < ngram_join.meeting(0.8, 5) < ngram_join.meeting(0.8, 4)
    assert ngram_join.estimated_recall({96: 500}, 0.8, 6) == 1.0
    assert ngram_join.estimated_recall({}, 0.8, 6) == 0.0 and ngram_join.estimated_recall({70: 5}, 0.8, 6) == 0.0
    low, high = (ngram_join.estimated_recall({77: 1000}, 0.8, d) for d in (6, 4))
    assert abs(low - ngram_join.meeting(77 / 96, 6)) < 1e-9 and low < 0.999 < high


def depths(monkeypatch, spark, rows, **options):
    """Depths that the walk goes through."""
    seen = []
    real = ngram_join._met

    def met(dealt, key, payload, label):
        if key == "vertex":
            seen.append(len(seen))
        return real(dealt, key, payload, label)

    monkeypatch.setattr(ngram_join, "_met", met)
    out = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    return [ngram_join.TALLEST - x for x in seen], out


def test_prefixes_are_shortened_on_the_data(spark, monkeypatch):
    r = random.Random(1)
    texts = [[r.choice(WORDS) for _ in range(200)] for _ in range(40)]
    alike = [(i * 40 + k, " ".join([*t[:-1], WORDS[k]])) for i, t in enumerate(texts) for k in range(30)]
    assert depths(monkeypatch, spark, alike, evidence=100)[0] == [6]
    monkeypatch.undo()
    unlike = [(i * 40 + k, " ".join(changed(r, t, 0.02))) for i, t in enumerate(texts) for k in range(10)]
    assert depths(monkeypatch, spark, unlike, evidence=100)[0][-1] < 6
    monkeypatch.undo()
    assert depths(monkeypatch, spark, alike[:3])[0] == [6, 5, 4]


def test_a_row_repeated_a_thousand_times(spark, monkeypatch):
    lists = []
    real = ngram_join._met

    def met(dealt, key, payload, label):
        if key == "root":
            lists.append(dealt.groupBy("root").count().agg(F.max("count")).first()[0])
        return real(dealt, key, payload, label)

    monkeypatch.setattr(ngram_join, "_met", met)
    r = random.Random(2)
    words = [r.choice(WORDS) for _ in range(300)]
    rows = [(7, " ".join(words))] * 1000 + [(8, " ".join([*words[:-1], "other"])), (9, "something else entirely here now")]
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert lists == [2]
    assert sorted(set(map(tuple, got))) == [(7, 7, 1000, 1000), (8, 7, 1000, 1), (9, 9, 0, 1)] and len(got) == 1002


@pytest.mark.parametrize("seed", [3, 4])
def test_recall_against_all_pairs(spark, seed):
    r = random.Random(seed)
    rows = []
    for i in range(60):
        t = [r.choice(WORDS) for _ in range(r.randint(30, 300))]
        for _ in range(8):
            rows.append((len(rows), " ".join(changed(r, t, r.choice([0, 0.005, 0.01, 0.02, 0.03])))))
    sets = []
    for _, t in rows:
        w = t.split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    linked = {i: sum(len(sets[i] & s) >= 0.8 * len(sets[i] | s) - 1e-9 for s in sets) - 1 for i in range(0, len(rows), 20)}
    got = {x.doc_id: x.n_links for x in ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] for i in linked) >= 0.99 * sum(linked.values()) > 0 and all(got[i] <= n for i, n in linked.items())
