"""Queries that no SQL expresses, against plain programs written from their definitions."""

import hashlib
import html.parser
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tidemark.llm import media_sequences, piece_dropout, token_counts, toxicity

DATA = "/root/testdata/sf0.001"


class Texts(html.parser.HTMLParser):
    """Text between block tags, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.parts, self.held, self.skip = [], "", 0

    def flush(self):
        text = re.sub(r"\s+", " ", self.held).strip()
        self.parts += [text] if text else []
        self.held = ""

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        if tag in media_sequences.BREAKING:
            self.flush()

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")
        if tag in media_sequences.BREAKING:
            self.flush()

    def handle_data(self, data):
        self.held += "" if self.skip else data


def test_pages_interleaved(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = {r.page_id: r for r in media_sequences.pages_interleaved(spark, DATA).collect()}
    assert set(got) == set(pages) and len(pages) >= 50
    for i, page in pages.items():
        t = Texts()
        t.feed(page)
        t.flush()
        head = Texts()
        head.feed(page[: page.find("</h1>") + 5])
        head.flush()
        k = i % media_sequences.CHARTS
        assert (got[i].n_parts, got[i].n_texts, got[i].position, got[i].caption, got[i].size) == (len(t.parts) + 1, len(t.parts), len(head.parts), f"Chart {k} of the page", 100 * k)
        assert got[i].texts_sha256 == hashlib.sha256("\n".join(t.parts).encode()).hexdigest()


MASK = (1 << 64) - 1


def mixed(key, number):
    x = (key + (number + 1) * 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
    return (x ^ x >> 31) >> 11


def plain_pieces(sp, text, seed, dropout):
    """Merge dropout by its definition: all adjacent pairs are looked through for each step."""
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    ids = []
    text_key = xxhash.xxh3_64_intdigest(text.encode(), seed)
    for place, chunk in enumerate(re.findall(r" *[^ ]+| +", " " + text)):
        key, number, skipped = mixed(text_key, place), 0, set()
        symbols = [(i, "▁" if c == " " else "\ufdd0\ufdd0" if c == "▁" else c) for i, c in enumerate(chunk)]
        while True:
            pairs = [(-score[a[1] + b[1]], a[0], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a[1] + b[1] in score and (a, b) not in skipped]  # noqa: B905
            if not pairs:
                break
            k = min(pairs)[2]
            a, b = symbols[k], symbols[k + 1]
            number += 1
            if mixed(key, number - 1) < round(dropout * 2**53):
                skipped.add((a, b))
            else:
                symbols[k : k + 2] = [(a[0], a[1] + b[1])]
        for _, s in symbols:
            ids += [sp.piece_to_id(s)] if s in score else [sp.piece_to_id(f"<0x{x:02X}>") for x in ("▁" if s == "\ufdd0\ufdd0" else s).encode()]
    return ids


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_pieces_are_those_of_the_definition(dropout):
    import sentencepiece

    path = token_counts.tokenizer_path(piece_dropout.MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(2)
    texts = ["".join(r.choice(["the ", "ing", "an", "é", "漢", "▁", "  ", "x9", "tion", "\n", "Straße ", "incomprehensibility"]) for _ in range(r.randint(1, 25))) for _ in range(60)]
    encoder = piece_dropout.Encoder(path, 11, dropout)
    ids, ends = encoder.encode_all([*texts, None, ""])
    assert ends[-1] == ends[-3]
    for i, t in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == plain_pieces(sp, t, 11, dropout), t


def plain_features(word):
    return [word] + [word[:k] + "-" for k in (4, 5, 6) if len(word) >= k]


def test_toxicity_scores_are_those_of_the_counts(spark):
    """The score of undisguised texts, from counts by feature without any hashing."""
    r = random.Random(9)
    bad, words = ["idiot", "scumbag", "moronic"], ["".join(r.choice("abcdefghijk") for _ in range(r.randint(1, 8))) for _ in range(80)]
    words = [w for w in words if not re.search(r"(.)\1\1", w)]
    rows, labels = [], {}
    for i in range(300):
        toxic = i % 3 == 0
        rows.append((i, " ".join([r.choice(words) for _ in range(12)] + [r.choice(bad)] * toxic)))
        labels[i] = int(toxic)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train_toxicity(docs, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    counts = {0: Counter(), 1: Counter()}
    for i, t in rows:
        counts[labels[i]].update({f for w in t.split() for f in plain_features(w)})
    n = Counter(labels.values())

    def weight(f):
        return float(toxicity.bound(np.array([counts[1][f]]), np.array([counts[0][f]]), n[1], n[0])[0]) if counts[1][f] else 0.0

    for x in toxicity.score_toxicity(docs, model).collect():
        strongest = max(weight(f) for w in x.text.split() for f in plain_features(w))
        assert x.score == pytest.approx(model.probability(strongest), abs=1e-6)


def test_what_restoring_changes(spark):
    """Disguised words are told only where they are restored."""
    r = random.Random(12)
    words = ["".join(r.choice(["th", "er", "an", "in", "re", "ed", "on", "es", "st", "en"]) for _ in range(r.randint(1, 4))) for _ in range(300)]
    bad = ["idiot", "moron", "trash", "loser", "clown", "stupid", "pathetic", "worthless"]
    make = lambda extra: " ".join(r.choice(words) for _ in range(20)) + extra
    rows = [(i, make(" " + r.choice(bad) if i % 4 == 0 else "")) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train_toxicity(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    leet = str.maketrans("aeiost", "@31057")

    def disguised(w):
        return r.choice([w.translate(leet), " ".join(w), ".".join(w), "".join(c * r.choice([1, 4]) for c in w) + w[-1] * 3, w[0] + w[1:-1].translate(leet) + w[-1]])

    hidden = [make(" " + disguised(r.choice(bad)) + " ") for _ in range(200)]
    clean = [make(r.choice(["", " 12:30", " a1b2", " (note)", " x9"])) for _ in range(200)]
    scores = toxicity.WordScores(model.weight, model.chars)
    with_it = sum(model.probability(toxicity.evidence(t, scores)) >= 0.5 for t in hidden)
    without = sum(model.probability(max(max((w for f in toxicity.forms(x, None) for w in [scores[f]]), default=0.0) for x in t.lower().split())) >= 0.5 for t in hidden)
    wrong = sum(model.probability(toxicity.evidence(t, scores)) >= 0.5 for t in clean)
    print(f"restored {with_it} of 200, not restored {without}, clean told {wrong}")
    assert with_it >= 170 and without <= 60 and wrong <= 4
