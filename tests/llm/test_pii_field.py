"""The semi-Markov field against enumeration, and what it finds."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import pii


def cuts(n, candidates):
    """All ways to cut n tokens: lists of (i, j, state), state 0 for a token outside every entity."""
    if n == 0:
        yield []
        return
    for rest in cuts(n - 1, candidates):
        yield [*rest, (n - 1, n, 0)]
    for i, j in candidates:
        if j == n:
            for rest in cuts(i, candidates):
                for state in range(1, pii.N_STATES):
                    yield [*rest, (i, j, state)]


def total(cut, score, follows):
    out, before = 0.0, 0
    for i, j, state in cut:
        out += follows[before][state] + (score[i, j][state - 1] if state else 0.0)
        before = state
    return out


def test_forward_backward_is_the_sum_over_all_cuts():
    r = np.random.default_rng(2)
    lengths = [1, 3, 4]
    candidates = [[(0, 1)], [(0, 1), (0, 2), (1, 3)], [(0, 2), (1, 2), (2, 4), (1, 4)]]
    follows = r.normal(size=(pii.N_STATES, pii.N_STATES))
    dense = np.full((3, 4, pii.MOST_TOKENS, len(pii.KINDS)), -np.inf)
    scores = []
    for b, own in enumerate(candidates):
        scores.append({x: r.normal(size=len(pii.KINDS)) for x in own})
        for (i, j), x in scores[b].items():
            dense[b, j - 1, j - i - 1] = x
    z, inside, steps = pii.forward_backward(dense, follows, np.array(lengths))
    for b, n in enumerate(lengths):
        all_cuts = [(c, math.exp(total(c, scores[b], follows))) for c in cuts(n, candidates[b])]
        whole = sum(p for _, p in all_cuts)
        assert abs(z[b] - math.log(whole)) < 1e-9
        for i, j in candidates[b]:
            for state in range(1, pii.N_STATES):
                want = sum(p for c, p in all_cuts if (i, j, state) in c) / whole
                assert abs(inside[b, j - 1, j - i - 1, state - 1] - want) < 1e-9
        for a in range(pii.N_STATES):
            for s in range(pii.N_STATES):
                want = sum(p * sum(x == (a, s) for x in zip([0, *(q[2] for q in c)], [q[2] for q in c])) for c, p in all_cuts) / whole  # noqa: B905
                assert abs(steps[b, :, a, s].sum() - want) < 1e-9


@pytest.fixture(scope="module")
def field():
    return pii.default_field()


def best_of_all(field, text):
    span = pii.tokens(text)
    words = [text[a:b] for a, b in span]
    left = [pii.left_of(words, k) for k in range(len(span))]
    marked = [pii._marked(w, x) for w, x in zip(words, left, strict=True)]
    score = {(i, j): field.score(text[span[i][0] : span[j - 1][1]], left[i], j - i) for i, j in pii.segments(text, span, marked)}
    return max(((total(c, score, field.follows), c) for c in cuts(len(span), sorted(score))), key=lambda x: x[0]), span


def test_best_cut_is_the_best_of_all_cuts(field):
    r = random.Random(3)
    for _ in range(60):
        text = " ".join(r.choice(["1234", "password:", "hunter", "Dr.", "Anna", "5", "Main Street", "a@b.c", "+1", "(555)", "555-1234"]) for _ in range(r.randint(1, 3)))
        (p, cut), span = best_of_all(field, text)
        got = field.decode(text)
        want = [(pii.KINDS[s - 1], span[i][0], span[j - 1][1]) for i, j, s in cut if s]
        if got != want:  # a tie
            chosen = {(a, b): pii.KINDS.index(k) + 1 for k, a, b in got}
            words = [text[a:b] for a, b in span]
            left = [pii.left_of(words, k) for k in range(len(span))]
            whole, k = [], 0
            while k < len(span):
                end = next((j for j in range(k + 1, len(span) + 1) if (span[k][0], span[j - 1][1]) in chosen), None)
                whole.append((k, end or k + 1, chosen[span[k][0], span[end - 1][1]] if end else 0))
                k = end or k + 1
            score = {(i, j): field.score(text[span[i][0] : span[j - 1][1]], left[i], j - i) for i, j, _ in whole}
            assert abs(total(whole, score, field.follows) - p) < 1e-9, text


def test_parts_of_a_text_are_cut_as_the_whole_is(field):
    r = random.Random(9)
    for n in range(40):
        text = r.choice([" ", "  ", "\n", " \t"]).join(r.choice(["word", "Capital", "12", "password = x1y2z3q", "Mr. Tom Bond", "ends.", '"quoted"', "4 Elm Road", "é²", "a@b", "DE12 3456 7890 1234 5678 90"]) if r.random() < 0.2 + n / 80 else "plain" for _ in range(200))
        span = pii.tokens(text)
        words = [text[a:b] for a, b in span]
        left = [pii.left_of(words, k) for k in range(len(span))]
        marked = [pii._marked(w, x) for w, x in zip(words, left, strict=True)]
        whole = [(kind, span[i][0], span[j - 1][1]) for kind, i, j in field.best_cut(text, span, left, marked)]
        assert field.decode(text) == whole


@pytest.mark.parametrize(("text", "want"), [
    ("My password: hunter and my secret: opensesame", [("secret", "hunter"), ("secret", "opensesame")]),
    ('token = "abcdefghijk" api_key: Zm9vYmFyCg', [("secret", "abcdefghijk"), ("secret", "Zm9vYmFyCg")]),
    ("password: correcthorsebattery", [("secret", "correcthorsebattery")]),
    ("Authorization: Bearer abcdefabcdef123", [("secret", "abcdefabcdef123")]),
    ("pay to FR76 3000 6000 0112 3456 7890 189 now", [("identifier", "FR76 3000 6000 0112 3456 7890 189")]),
    ("my id 123-45-6789.", [("identifier", "123-45-6789")]),
    ("lives at 221 Baker Street in town with Dr. John Watson of there", [("address", "221 Baker Street"), ("name", "John Watson")]),
    ("in 12 days see page 3. In 1999 the 16 token of 2024-01-02 was 12:30", []),
])
def test_what_the_field_finds(field, text, want):
    assert [(k, text[a:b]) for k, a, b in field.decode(text)] == want


def test_held_out_sentences(field):
    right = wrong = 0
    for text, gold in pii.made_examples(300, seed=99):
        right += len(set(gold) & set(field.decode(text)))
        wrong += len(set(gold) ^ set(field.decode(text)))
    assert right > 560 and wrong < 40


def test_octets_of_any_length():
    assert pii.base_spans("0" * 5000 + ".1.1.1") == [("ip", 0, 5006)]
    assert pii.base_spans("0" * 5000 + "256.1.1.1") == [] and pii.base_spans("000.00.0.0") == [("ip", 0, 10)]
    assert pii.base_spans("1" * 100_000 + ".1.1.1") == []
