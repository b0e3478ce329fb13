"""Small tables with nulls, empty and long texts, repeats and clashing columns, against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language_id, license_scan, media_sequences, ngram_join, pii, piece_dropout, token_counts, toxicity, url_rules
from tidemark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, label int, bucket long, root string, parts int, score double"


def documents(spark, rows):
    """Rows (doc_id, text[, lang]) with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, (*x, "en")[0], "s", len(t or ""), "n", 7, 1, "r", 2, 0.5) for i, t, *x in rows], SCHEMA)


def prose(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(3)
    rows = [(None, "no id here at all friend"), (1, None), (2, ""), (3, "  ...  "), (4, "one two"), (5, "One, TWO!"), (6, "one")]
    base = [prose(r, 60) for _ in range(6)]
    k = 10
    for b in base:
        for _ in range(6):
            w = b.split()
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = "zz" + str(r.randrange(50))
            rows.append((k, " ".join(w)))
            k += 1
    rows += [(100, base[0]), (101, base[0]), (101, base[0]), (102, base[0].upper()), (200, prose(r, 5000))]
    return rows


def brute_classes(rows, n=5, least=0.8):
    sets = []
    for _, t in rows:
        w = ngram_join.lower_words(t)
        k = min(n, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    use = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    linked = {i: {j for j in use if j != i and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= least} for i in use}
    out = []
    for i, (d, _) in enumerate(rows):
        if i not in linked:
            out.append((d, d, 0, 1))
            continue
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((d, min(rows[j][0] for j in seen), len(linked[i]), sum(sets[j] == sets[i] for j in use)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [{}, {"block_members": 3, "block_shingles": 100}])
def test_ngram_join(spark, corpus, block):
    got = ngram_join.ngram_jaccard_join(documents(spark, corpus), **block).collect()
    assert sorted(map(tuple, got), key=str) == brute_classes(corpus)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.ngram_jaccard_join(documents(spark, [])).collect() == []


def test_forest_depth():
    assert ngram_join.forest_depth(0.8, 0.999) == 4
    assert 1 - (1 - 0.8**4) ** 16 >= 0.999 > 1 - (1 - 0.8**5) ** 16


def test_components_of_a_path(spark):
    r = random.Random(1)
    names = list(range(60))
    r.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(39)] + [(names[i], names[40]) for i in range(41, 60)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {}
    for node, root in got:
        roots.setdefault(root, set()).add(node)
    assert sorted(map(sorted, roots.values())) == sorted([sorted(names[:40]), sorted(names[40:])])


def test_toxicity(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        w = prose(r, 30).split()
        if bad:
            w[r.randrange(30)] = r.choice(["idiot", "moron", "scumbag"])
        rows.append((i, "a " * (i % 3 == 0) + " ".join(w)))
        labels.append((i, int(bad)))
    docs = documents(spark, [*rows, (1000, None), (1001, ""), (None, "you idiot"), (1002, "you 1d10t of a kind"), (1003, "what an i d i o t"), (1004, "m0rooooon"), (1005, "plain abc words"), (1005, "plain abc words"), (1006, "what a m o r o n"), (1007, "m0r" + "o" * 90 + "n"), (1008, "x9" * 5000), (1009, "a b c d e")])
    model = toxicity.train_toxicity(docs, spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int"))
    scored = toxicity.score_toxicity(docs, model)
    assert scored.columns == docs.columns and scored.count() == docs.count()
    got = {(x.doc_id, x.text): x.score for x in scored.collect()}
    assert all((got[r_] >= 0.5) == (i % 4 == 0) for i, r_ in enumerate(rows))
    assert all(got[k] >= 0.5 for k in got if k[0] in (1002, 1003, 1004, 1006, 1007, None))
    assert all(got[k] < 0.5 for k in got if k[0] in (1000, 1001, 1005, 1008, 1009))
    none = toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")))
    assert none.where("score < 0.01").count() == docs.count()
    assert toxicity.score_toxicity(documents(spark, []), model).collect() == []


def naive_spans(t):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, p in patterns.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")) or kind == "card" and 16 <= len(d) <= 19 and pii.luhn(d) or kind == "phone" and 8 <= len(d) <= 15:
                out.append((kind, *m.span()))
    return out


def test_pii(spark):
    r = random.Random(9)
    texts = ["".join(r.choice("ab1234567890@@..-+ ()x_%\n") for _ in range(r.randint(0, 60))) for _ in range(400)]
    texts += ["é card 4111 1111 1111 1111, mail a.b@c.de", "password=abcdef0123456789", "id 123-45-6789.", None, "", "x" * 100_000 + "@", "1" * 50_000, "1.2.3.4.5.6.7.8"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "+1 (555) 555-0000"), (0, texts[0])]
    found = pii.find_pii(documents(spark, rows))
    assert found.count() == len(rows)
    got = {}
    for x in found.collect():
        got[x.doc_id] = [s for s in zip(x.kinds, x.starts, x.ends, x.is_base, strict=True)]
    for i, t in enumerate(texts):
        assert [s[:3] for s in got[i] if s[3]] == naive_spans(t), t
    assert [s[0] for s in got[401]] == ["secret"] and [s[0] for s in got[402]] == ["identifier"]
    clean = pii.redact(documents(spark, [(1, texts[400]), (2, None)]))
    assert [x.text for x in clean.orderBy("doc_id").collect()] == ["é card <card>, mail <email>", None]


def test_media(spark):
    page = '<html><script>var a="<p>";</script><p>One &amp; two</p><figure><img src="digest:d1"><img src="digest:dx" alt="y"><figcaption>cap</figcaption></figure>tail<!-- x --><img src="u.png" alt="z"></html>'
    pages = spark.createDataFrame([(1, page), (1, page), (2, None), (None, "")], "page_id long, html string")
    media = spark.createDataFrame([("d1", 5), ("d1", 5), (None, 6)], "digest string, size int")
    got = media_sequences.resolve_media(media_sequences.interleaved_sequences(pages), media).collect()
    assert len(got) == 4
    first = next(x for x in got if x.id == 1).parts
    assert [(p.position, p.kind, p.text, p.src, p.caption, p.media and p.media.size) for p in first] == [
        (0, "text", "One & two", None, None, None), (1, "media", None, "digest:d1", "cap", 5), (2, "media", None, "digest:dx", "cap", None), (3, "text", "tail", None, None, None), (4, "media", None, "u.png", "z", None),
    ]
    for text in (None, "", "é" * 288, "a" * 577):
        raw = (text or "").encode()
        want = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        one = spark.createDataFrame([(text,)], "text string").select(F.lit("k").alias("digest"), media_sequences.stored_form(media_sequences.payload_of(F.col("text"))).alias("data"))
        x = media_sequences.describe_media(one).first()
        assert (x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-32:]))


def naive_overlap(text, items, k=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hit, found = set(), set()
    for item, t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        n = min(k, len(w))
        for g in {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == g:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("slice_words", [1_000_000, 25])
def test_decontamination(spark, slice_words):
    r = random.Random(2)
    items = [(i, prose(r, r.choice([3, 10, 25, 40]))) for i in range(8)] + [(50, None), (51, ""), (52, "one")]
    rows = [(i, " ".join([prose(r, 12), r.choice(items)[1] or "", prose(r, 12)]).upper()) for i in range(30)] + [(90, None), (91, ""), (92, "one ONE é"), (None, items[0][1]), (90, None)]
    bench = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, words string")
    got = decontaminate.benchmark_overlap(documents(spark, rows), bench, slice_words=slice_words)
    have = sorted(((x.doc_id, x.n_words, x.n_hit, x.items) for x in got.collect()), key=str)
    assert have == sorted(((i, *naive_overlap(t, items)) for i, t in rows), key=str)
    cut = decontaminate.remove_contamination(documents(spark, [(1, f"Keep this {items[1][1]} and that too, all of it. " + prose(r, 90)), (2, items[2][1]), (3, None)]), bench, slice_words=slice_words)
    kept = {x.doc_id: x.text for x in cut.collect()}
    assert 1 in kept and 3 in kept and kept[3] is None and naive_overlap(kept[1], items[:8])[1] == 0 and kept[1].startswith("Keep this and that") == (kept[1].count(items[1][1]) == 0)
    assert decontaminate.benchmark_overlap(documents(spark, [(1, "a b")]), bench.limit(0)).first().n_words == 2


@pytest.mark.parametrize("broadcast", [100, 0])
def test_urls(spark, broadcast):
    rules = [("com", "/", "allow"), ("a.com", "/x", "block"), ("A.com", "/x/y/", "allow"), ("net", "/es/", "block"), (None, "/", "block")]
    urls = ["http://a.com/x/y/z", "https://b.A.COM/xq?u=/x/y/", "ftp://ba.com/x", "http://a.com", None, "a.com/x", "http://n.net/es", "http://n.net/es/?a#b", "HTTP://u@x.net:80/es/", "http://a.com/x\n/y"]

    def naive(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host) :]).group()
            host = host.lower()
        fit = [(len(h.lower() + p), h.lower() + p, v) for h, p, v in rules if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
        return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow"

    pages = spark.createDataFrame([(i % 7, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = url_rules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), broadcast_rules=broadcast)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((i % 7, *naive(u)) for i, u in enumerate(urls)), key=str)


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction."
    rows = [(1, None), (2, ""), (3, "Text here.\nReleased under the MIT License."), (3, "ALL RIGHTS RESERVED"), (4, "x released under the mit license y"), (5, f"{mit} Something else. The software is provided as is, without warranty of any kind, express or implied."), (6, "Licensed under the Apache License, Version 2.0.\nAll rights reserved." + " pad" * 50_000)]
    got = {(x.doc_id, x.license): x for x in license_scan.scan_licenses(documents(spark, rows)).collect()}
    assert set(got) == {(1, None), (2, None), (3, "MIT"), (3, "LicenseRef-All-Rights-Reserved"), (4, None), (5, "MIT"), (6, "Apache-2.0")}
    assert got[5, "MIT"].sentence_ids == ["mit.grant", "asis.warranty"]
    plan = license_scan.scan_licenses(documents(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_pieces(spark):
    import sentencepiece

    texts = ["  a  b", "\n\nx\t y ", "", None, "▁a ▁▁", "É é̀ ﬁ 😀 漢字 ﷐", "hello wonderful tokenization of words " * 300, "    "]
    docs = documents(spark, list(enumerate(texts)) + [(None, "same"), (0, "  a  b")])
    for rate in (0.0, 0.1, 0.5):
        back = piece_dropout.decode_pieces(piece_dropout.encode_pieces(docs, dropout=rate)).collect()
        assert len(back) == len(texts) + 2 and all(x.decoded == (x.text or "") for x in back)
    plain = {x.doc_id: list(x.piece_ids) for x in piece_dropout.encode_pieces(docs, dropout=0.0).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=token_counts.tokenizer_path(piece_dropout.MODEL))
    assert all(plain[i] == sp.encode(t) for i, t in enumerate(texts) if t is not None and "▁" not in t)
    one, same, two = (piece_dropout.encode_pieces(docs, seed=s, dropout=0.3).where("doc_id = 6").first().piece_ids for s in (1, 1, 2))
    assert one == same != two and len(one) > len(plain[6])


def test_language(spark):
    r = random.Random(4)
    make = lambda letters: " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(40))
    rows = [(i, make("abcdefgh" if i % 2 else "defghijk"), "xx" if i % 2 else "yy") for i in range(80)]
    model = language_id.train_language_models(documents(spark, rows))
    extra = [(90, None, "xx"), (91, "", "xx"), (92, "123 !", "xx"), (93, "abab caba", None), (None, "kijk", "yy"), (90, None, "xx"), (94, make("abcdefgh") * 3000, "xx")]
    got = language_id.identify_languages(documents(spark, [*rows, *extra]), model).collect()
    assert len(got) == 87
    by = {x.doc_id: x for x in got}
    assert all(by[i].lang_pred == lang for i, _, lang in rows)
    assert all(by[i].lang_pred == "und" and by[i].rejected for i in (90, 91, 92)) and by[93].lang_pred == by[94].lang_pred == "xx" and by[None].lang_pred == "yy"
    assert all(0 <= x.score <= 1 for x in got)
    nothing = language_id.train_language_models(documents(spark, []))
    assert {x.lang_pred for x in language_id.identify_languages(documents(spark, extra), nothing).collect()} == {"und"}


def test_language_of_other_scripts(spark):
    r = random.Random(5)
    letters = {"en": "abcdefghijklm", "ru": "абвгдежзиклмн", "uk": "абвгґдеєжзиіїй", "el": "αβγδεζηθικλμν", "fr": "abcdeéèçfghij"}
    make = lambda x: " ".join("".join(r.choice(letters[x]) for _ in range(r.randint(2, 7))) for _ in range(40))
    model = language_id.train_language_models(documents(spark, [(i, make(x), x) for i in range(40) for x in letters]))
    fresh = [(i * 10 + j, make(x), x) for i in range(10) for j, x in enumerate(letters)]
    got = {x.doc_id: x.lang_pred for x in language_id.identify_languages(documents(spark, fresh), model).collect()}
    assert all(got[i] == x for i, _, x in fresh)


def naive_kneser_ney(texts, order=4, discount=0.75, symbols=65536):
    """p(symbol, context) from the definition, over strings of symbols, boundaries included."""
    counts = [collections.Counter() for _ in range(order + 1)]
    for t in texts:
        s = re.sub(r"[\W\d_]+", "\0", "\0" + t.lower() + "\0").strip("\0")
        s = "\0" * (order - 1) + s + "\0"
        for i in range(order, len(s) + 1):
            counts[order][s[i - order : i]] += 1
    for k in range(order - 1, 0, -1):
        for g in counts[k + 1]:
            counts[k][g[1:]] += 1

    def p(symbol, context):
        k = len(context) + 1
        shorter = p(symbol, context[1:]) if context else 1 / symbols
        own = {g: n for g, n in counts[k].items() if g[:-1] == context}
        total = sum(own.values())
        return shorter if not total else max(own.get(context + symbol, 0) - discount, 0) / total + discount * len(own) / total * shorter

    return p


def test_kneser_ney_is_the_defined_one_and_sums_to_one(spark):
    texts = ["the cat sat on the mat and the hat", "Größe, é and жж: the 3 cats", "a"]
    model = language_id.train_language_models(documents(spark, list(enumerate(texts)))).models[0]
    p = naive_kneser_ney(texts)
    r = random.Random(5)
    for _ in range(60):
        context = "".join(r.choice("\0the catsäжq") for _ in range(3)).replace(" ", "\0")
        symbol = r.choice("\0theacsäжqz")
        key = np.array([sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(context + symbol))], np.uint64)
        assert abs(float(np.exp(model.log_probability(key, 4)[0])) / p(symbol, context) - 1) < 1e-4, (context, symbol)


@pytest.mark.parametrize("least", [1, 2, 5])
def test_kneser_ney_sums_to_one_when_rare_grams_are_dropped(spark, monkeypatch, least):
    monkeypatch.setattr(language_id, "isqrt", lambda x: least)
    texts = ["the cat sat on the mat and the hat that the cat hates " * 3, "another one"]
    model = language_id.train_language_models(documents(spark, list(enumerate(texts)))).models[0]
    kept = [len(g) for g, _ in model.grams]
    assert kept[3] > 0 and (least == 1 or kept[3] < 60)
    for context in ("\0\0t", "the", "at\0", "xyz", "\0an"):
        keys = np.uint64(sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(context))) | np.arange(1 << 16, dtype=np.uint64)
        assert abs(np.exp(model.log_probability(keys, 4).astype(float)).sum() - 1) < 1e-3


def test_close_languages_are_told_apart_by_their_letters(spark):
    r = random.Random(8)
    letters = {"da": "aeæøåndrst", "sv": "aeäöåndrst", "is": "aeáéíndrst", "cs": "aečřšndrst", "ja": "日本語東京大学生水火木", "zh": "中国語北京大学生水火术", "ru": "абвзягдеж", "uk": "абвіїгдеж"}
    make = lambda x: " ".join("".join(r.choice(letters[x]) for _ in range(r.randint(2, 7))) for _ in range(8))
    model = language_id.train_language_models(documents(spark, [(i, make(x), x) for i in range(400) for x in letters]), rejection_rate=0.02)
    fresh = [(i * 10 + j, make(x), x) for i in range(20) for j, x in enumerate(letters)]
    got = {x.doc_id: x for x in language_id.identify_languages(documents(spark, fresh), model).collect()}
    assert sum(got[i].lang_pred == x for i, _, x in fresh) >= 158
    assert sum(got[i].rejected for i, _, x in fresh) <= 16
    strange = language_id.identify_languages(documents(spark, [(1, "αβγδε ζηθ ικλμν ξοπρσ"), (2, "𐐨𐐩𐐪 𐐫𐐬𐐭 😀"), (3, "😀😀")]), model).collect()
    assert [(x.rejected, x.lang_pred == "und") for x in sorted(strange)] == [(True, False), (True, False), (True, True)]
    assert language_id.symbols_of("a😀b𐐀").tolist() == [0, 97, 0, 98, 0xD801, 0xDC28, 0]


def test_ties_go_to_the_first_language(spark):
    same = [(i, "abc abd acb", x) for i in range(4) for x in ("yy", "xx")]
    model = language_id.train_language_models(documents(spark, same))
    assert {x.lang_pred for x in language_id.identify_languages(documents(spark, same), model).collect()} == {"xx"}


def test_token_counts(spark, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_counts.tokenizer_path(token_counts.TOKENIZER))
    rows = [(1, "hello world"), (2, "hello world"), (None, None), (3, ""), (4, "a <|endoftext|> b"), (5, "word " * 30_000), (1, "again")]
    docs, cache = documents(spark, rows), str(tmp_path / "cache")
    for _ in range(2):
        got = token_counts.cached_token_counts(docs, cache).collect()
        want = [(i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False)), n > 512) for i, t in rows]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
        assert spark.read.parquet(cache).count() == 5  # distinct contents, encoded once
    assert token_counts.cached_token_counts(documents(spark, []), str(tmp_path / "none")).collect() == []


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(8)
    base = [prose(r, 80) for _ in range(5)]
    bench = prose(r, 20)
    rows = [(i, base[i]) for i in range(5)] + [(10, base[0]), (11, base[1] + " tail"), (12, base[2] + " " + bench + " " + prose(r, 200)), (13, f"mail me at a.b@c.de {prose(r, 40)}"), (14, bench), (20, None), (21, ""), (22, "")]
    rows += [(100 + i, prose(r, 25) + (" you idiot" if i % 3 == 0 else "")) for i in range(90)]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    clean = {100 + i for i in range(90) if i % 3}
    assert set(got) == {0, 1, 2, 3, 4, 12, 13, 20, 21, 22} | clean
    assert bench not in got[12].text and "a.b@c.de" not in got[13].text and got[3].text == base[3]
    assert all(x.n_chars is None or x.text is None or x.n_chars == len(x.text) for x in got.values())
