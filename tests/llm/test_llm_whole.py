"""Training-data operators on what a cut once left out."""

import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest

from tidemark.llm import language_id, media_sequences, pii, piece_dropout, token_counts, toxicity


def test_words_are_segmented_anew_at_each_place():
    path = token_counts.tokenizer_path(piece_dropout.MODEL)
    model = piece_dropout.PieceModel.load(path)
    encoder = piece_dropout.Encoder(path, 7, 0.1)
    plain, came = model.encode_chunk(" tokenization")
    cuts = [encoder.encode("tokenization " * 50 + str(i)) for i in range(100)]
    assert all(model.decode(np.frombuffer(x, np.int32)) == "tokenization " * 50 + str(i) for i, x in enumerate(cuts))
    ways, whole = set(), 0
    for x in cuts:
        piece: list[str] = []
        for i in [*np.frombuffer(x, np.int32).tolist(), None]:
            raw = "" if i is None else model.raw[i].decode()
            if piece and (i is None or raw.startswith(" ")):
                if "".join(piece) == " tokenization":
                    ways.add(tuple(piece))
                    whole += len(piece) == len(plain) // 4
                piece = []
            piece.append(raw)
    assert len(ways) > 10  # two for the whole corpus when the skips were keyed by the chunk alone
    r = random.Random(1)  # the same share stays in the plain form when each candidate is skipped by a coin of its own
    coins = [model.encode_chunk(" tokenization", [k for k in range(99) if r.random() < 0.1])[0] for _ in range(5000)]
    assert abs(whole - sum(len(x) == len(plain) for x in coins)) < 250 and came > 3
    assert encoder.encode("tokenization " * 50) == piece_dropout.Encoder(path, 7, 0.1).encode("tokenization " * 50)


def test_cached_and_direct_skips_agree(monkeypatch):
    path = token_counts.tokenizer_path(piece_dropout.MODEL)
    text = "the wonderful tokenization of incomprehensibilities and x9f8e7d6c5b4a39281706f5e4d3c2b1a0 " * 20
    for rate in (0.1, 0.5, 0.9, 1.0):
        cached = piece_dropout.Encoder(path, 3, rate).encode(text)
        with monkeypatch.context() as m:
            m.setattr(piece_dropout, "SHORT", 0)
            assert piece_dropout.Encoder(path, 3, rate).encode(text) == cached
        assert piece_dropout.PieceModel.load(path).decode(np.frombuffer(cached, np.int32)) == text


LONG = {"letters": "abcdefghij" * 100_000, "same letter": "a" * 1_000_000, "dots": "." * 1_000_000, "zeros": "0" * 1_000_000, "open tags": "<a " * 333_000, "comments": "<!-- " * 200_000, "dotted line": "chapter" + "." * 500_000 + "12", "rule": "word" + "-" * 500_000 + "word", "spaces": " " * 1_000_000, "breaks": "\n" * 1_000_000, "han": "漢字仮名" * 80_000}


def seconds(fn, *args):
    began = time.process_time()
    fn(*args)
    return time.process_time() - began


@pytest.mark.parametrize("name", LONG)
def test_long_chunks_are_encoded_in_linear_time(name):
    path = token_counts.tokenizer_path(piece_dropout.MODEL)
    model = piece_dropout.PieceModel.load(path)
    encoder = piece_dropout.Encoder(path, 7, 0.1)
    encoded: list[bytes] = []
    assert seconds(lambda: encoded.append(encoder.encode(LONG[name]))) < 5
    assert model.decode(np.frombuffer(encoded[0], np.int32)) == LONG[name]


def test_heap_and_list_agendas_agree(monkeypatch):
    path = token_counts.tokenizer_path(piece_dropout.MODEL)
    model, r = piece_dropout.PieceModel.load(path), random.Random(4)
    for _ in range(400):
        chunk = " " * r.randint(0, 3) + "".join(r.choice("theandring▁é漢0.") for _ in range(r.randint(1, 90)))
        skips = sorted(r.sample(range(60), r.randint(0, 20)))
        found = []
        for least in (0, 1000):
            monkeypatch.setattr(piece_dropout, "HEAP_FROM", least)
            found.append(model.encode_chunk(chunk, skips))
        assert found[0] == found[1]


@pytest.mark.parametrize("name", LONG)
def test_long_texts_are_scored_and_parsed_in_linear_time(name):
    logp = np.log(np.full((64, 64, 64), 1 / 64)).tolist()
    scores = toxicity.WordScores(np.zeros(toxicity.SLOTS, np.float32), toxicity.CharModel(logp))
    assert seconds(toxicity.evidence, LONG[name], scores) < 5
    assert seconds(media_sequences.parse_html, LONG[name]) < 5
    field = pii.default_field()
    assert seconds(pii.all_spans, LONG[name], field) < 5


def test_edges_of_tokens():
    edge = re.compile(r"^(?:(?![@$€£|][^\W\d_])[\W_])+|(?:(?<![^\W\d_])[\W_]|(?![@$€£|]$)[\W_])+$")
    r = random.Random(3)
    for _ in range(20_000):
        token = "".join(r.choice("ab1$@.-_é|") for _ in range(r.randint(0, 9)))
        assert toxicity.trimmed(token) == edge.sub("", token), token


def likelihood(word, cost, model):
    p, last = -cost, (0, 0)
    for code in [*map(toxicity._code, word), 0]:
        p += model.logp[last[0]][last[1]][code]
        last = (last[1], code)
    return p


def test_restored_reading_is_the_likeliest_of_all():
    r = random.Random(6)
    corpus = toxicity.trigram_codes("the idiot said to the moron that it is a trash and the clown was a loser " * 3)
    key, n = np.unique((corpus[:-2].astype(int) * 64 + corpus[1:-1]) * 64 + corpus[2:], return_counts=True)
    model = toxicity.CharModel.fit(key, n)
    assert [toxicity.restore(x, model) for x in ("1d10t", "m0r0n", "tr@sh", "i d i o t", "cl.0.wn", "looooser", "m0r" + "o" * 90 + "n")] == ["idiot", "moron", "trash", "idiot", "clown", "loser", "moron"]
    for _ in range(200):
        token = "".join(r.choice("theidotmrn01@ .") for _ in range(r.randint(1, 7)))
        best: dict[str, float] = {}
        for arcs in itertools.product(*toxicity.lattice(token)):
            word = "".join(x for x, _ in arcs)
            best[word.strip()] = max(best.get(word.strip(), -1e18), likelihood(word, sum(c for _, c in arcs), model))
        assert abs(best[toxicity.restore(token, model)] - max(best.values())) < 1e-9


def test_pages_that_are_not_well_formed():
    def kinds(page):
        return [(p["kind"], p["text"] or p["src"], p["caption"]) for p in media_sequences.parse_html(page)]

    assert kinds('<figure><img src="a.png"><figcaption>cap<p>two</p><p>three</p> four') == [("media", "a.png", "cap"), ("text", "two", None), ("text", "three", None), ("text", "four", None)]
    assert kinds('<p><img src=a.png alt="lead alt"></p><figcaption>stray</figcaption>') == [("media", "a.png", "lead alt"), ("text", "stray", None)]
    assert kinds('<figure><img src="a.png"><figcaption>one <b>two</b></figure>x<figure><img src="b.png"></figure>') == [("media", "a.png", "one two"), ("text", "x", None), ("media", "b.png", None)]
    assert kinds("a < b <i c") == [("text", "a < b <i c", None)]
    assert kinds('x<!-- never <p>closed</p>') == [("text", "x", None)]
    assert kinds("<SCRIPT>if (a<b) '</p>'</Script >y<style>p{}</STYLE>z") == [("text", "yz", None)]
    assert kinds("""<img alt='it is "so"' src = "a>b.png">don't "stop" <p title=it's>now</p>""") == [("media", "a>b.png", 'it is "so"'), ("text", "don't \"stop\"", None), ("text", "now", None)]
    assert kinds("<figure><figcaption>before</figcaption><img src=a alt=b></figure>") == [("media", "a", "before")]
    assert kinds("<figure><figcaption>alone</figcaption></figure>z") == [("text", "alone", None), ("text", "z", None)]


def spoken_rows(spark, n=40):
    """Texts of three languages with sounds of their own; letters beyond 0x8000 make keys whose highest bit is set."""
    r = random.Random(6)
    letters = {"en": "abcdefghij", "fr": "abcdeéèçfg", "ko": "한국어말하기를좋아"}
    make = lambda x: " ".join("".join(r.choice(letters[x]) for _ in range(r.randint(2, 7))) for _ in range(30))
    rows = [(i * 3 + j, make(x), x) for i in range(n) for j, x in enumerate(letters)]
    return spark.createDataFrame([*rows, (900, "", "en"), (901, None, "en"), (902, "𐐨𐐩 12", "fr")], "doc_id long, text string, lang string")


def test_language_models_beyond_what_is_gathered_are_whole(spark, monkeypatch):
    monkeypatch.setattr(language_id, "PACKED_GRAMS", 700, raising=False)
    monkeypatch.setattr(language_id, "PART_GRAMS", 2000, raising=False)
    docs = spoken_rows(spark)
    gathered, shipped = (language_id.train_language_models(docs, most_grams=most) for most in (10**7, 100))
    assert sum(len(g) for m in shipped.models for g, _ in m.grams) > 5000
    for one, other in zip(gathered.models, shipped.models, strict=True):
        for a, b in zip(one.grams + one.contexts, other.grams + other.contexts, strict=True):
            assert (a[0] == b[0]).all() and np.allclose(a[1], b[1], rtol=1e-5, atol=1e-5)
    assert np.allclose(gathered.ceiling, shipped.ceiling, rtol=1e-5)
    found = [sorted(language_id.identify_languages(docs, m).collect(), key=lambda x: x.doc_id) for m in (gathered, shipped)]
    for a, b in zip(*found, strict=True):
        assert (a.doc_id, a.lang_pred, a.rejected) == (b.doc_id, b.lang_pred, b.rejected) and abs(a.score - b.score) < 1e-5


def test_language_query_prunes_no_rare_grams(spark, tmp_path, monkeypatch):
    spoken_rows(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = lambda: sorted(language_id.op9_language_id(spark, str(tmp_path)).collect(), key=lambda x: x.doc_id)
    want = rows()
    monkeypatch.setattr(language_id, "isqrt", lambda n: 50)  # as with 2,500 * 10**8 characters
    assert rows() == want


def test_media_columns_move_no_payload(spark, tmp_path, monkeypatch):
    texts = [None, "", "same " * 300, "same " * 300, "é" * 288, "other"] * 3
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    described, plans = media_sequences.describe_media, []

    def watched(media):
        plans.append(media._jdf.queryExecution().executedPlan().toString())
        return described(media)

    monkeypatch.setattr(media_sequences, "describe_media", watched)
    got = {x.doc_id: x for x in media_sequences.op4_media_columns(spark, str(tmp_path)).collect()}
    assert plans and "Exchange" not in plans[0]
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (max(-(-len(raw) // 576), 1) * 576 - len(raw))
        assert (got[i].n_bytes, got[i].payload_bytes, got[i].payload_sha256, got[i].tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert got[i][1:] == got[i % 6][1:]
