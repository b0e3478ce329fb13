"""Empty tables, long texts, clashing names, ties and repeats of every training-data operator."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language_id, license_scan, media_sequences, ngram_join, pii, piece_dropout, token_counts, toxicity, url_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, place long, items string, spans string, words string, score double, html string, url string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "d", 1, "i", "s", "w", 0.5, "h", "u") for i, t in rows], SCHEMA)


def test_empty_tables(spark, tmp_path):
    none = documents(spark, [])
    rules = spark.createDataFrame([("com", "/", "allow")], "host string, path string, verdict string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    model = toxicity.train_toxicity(none, spark.createDataFrame([], "doc_id long, toxic int"))
    outs = {
        "op1": ngram_join.ngram_jaccard_join(none), "op2": toxicity.score_toxicity(none, model), "op3": pii.find_pii(none), "op3 redacted": pii.redact(none),
        "op4": media_sequences.interleaved_sequences(none, id_col="doc_id"), "op5": decontaminate.benchmark_overlap(none, bench), "op5 joined": decontaminate.benchmark_overlap(none, bench, slice_words=1),
        "op5 cut": decontaminate.remove_contamination(none, bench), "op6": url_rules.judge_urls(none, rules, id_col="doc_id"), "op7": license_scan.scan_licenses(none),
        "op8": piece_dropout.decode_pieces(piece_dropout.encode_pieces(none)), "op9": language_id.identify_languages(none, language_id.train_language_models(none)), "op10": token_counts.cached_token_counts(none, f"{tmp_path}/c"),
    }
    for name, out in outs.items():
        assert out.collect() == [], name
    parts = media_sequences.interleaved_sequences(none, id_col="doc_id")
    assert media_sequences.resolve_media(parts, spark.createDataFrame([], "digest string, size int")).collect() == []


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline_of_long_texts(spark, tmp_path):
    import corpus_pipeline

    long_ = {0: "." * 500_000, 1: "0" * 500_000, 2: "<a " * 150_000, 3: "ab" * 250_000, 4: "a b " * 100_000, 5: "x@" * 20_000, 6: None, 7: ""}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in long_.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {x.doc_id: x.text for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(long_) and all(got[i] == long_[i] for i in long_)


def test_long_texts(spark, tmp_path):
    texts = ["a" * 300_000, "漢" * 100_000, "word " * 60_000, "1." * 100_000, "\n" * 200_000, "=" * 200_000]
    docs = documents(spark, list(enumerate(texts)))
    assert [x.doc_id for x in pii.find_pii(docs).orderBy("doc_id").collect()] == list(range(6))
    back = piece_dropout.decode_pieces(piece_dropout.encode_pieces(docs)).select("doc_id", (F.col("decoded") == F.col("text")).alias("same")).collect()
    assert all(x.same for x in back) and len(back) == 6
    bench = spark.createDataFrame([(1, "word " * 9 + "word")], "item_id long, text string")
    for words in (1_000_000, 3):
        assert {x.doc_id: x.n_hit for x in decontaminate.benchmark_overlap(docs, bench, slice_words=words).collect()}[2] == 60_000
    pages = spark.createDataFrame([(1, "http://" + "a." * 50_000 + "com/" + "x/" * 50_000), (2, "http://n.com/x")], "page_id long, url string")
    judged = url_rules.judge_urls(pages, spark.createDataFrame([("com", "/x/", "block")], "host string, path string, verdict string")).orderBy("page_id").collect()
    assert [(x.verdict, x.rule) for x in judged] == [("block", "com/x/"), ("allow", None)]


def test_clashing_names_of_media(spark):
    pages = spark.createDataFrame([(1, '<img src="digest:d1" alt="a">', "p", "x", 5)], "page_id long, html string, parts string, digest string, id int")
    media = spark.createDataFrame([("d1", "p", "row", 7)], "digest string, parts string, row string, id int")
    got = media_sequences.resolve_media(media_sequences.interleaved_sequences(pages), media).collect()
    assert [(x.id, x.parts[0].caption, x.parts[0].media.asDict()) for x in got] == [(1, "a", {"parts": "p", "row": "row", "id": 7})]


def test_ties(spark):
    docs = documents(spark, [(1, "one two three four five six"), (2, "one two three four five six"), (2, "one two three four five six"), (5, "other words altogether in here now")])
    got = sorted(set(map(tuple, ngram_join.ngram_jaccard_join(docs).collect())))
    assert got == [(1, 1, 2, 3), (2, 1, 2, 3), (5, 5, 0, 1)]
    twice = spark.createDataFrame([("com", "/a", "allow"), ("com", "/a", "block"), ("com", "/a", "block")], "host string, path string, verdict string")
    assert url_rules.judge_urls(spark.createDataFrame([(1, "http://x.com/ab")], "page_id long, url string"), twice).first().verdict == "block"
    same = license_scan.scan_licenses(documents(spark, [(1, "Released under the MIT License. Released under the MIT License. Licensed under CC BY 4.0.")])).first()
    assert (same.license, same.licenses, same.sentence_ids) == ("MIT", ["MIT", "CC-BY-4.0"], ["mit.notice", "mit.notice", "ccby4.notice"])
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    assert len({x.score for x in toxicity.score_toxicity(docs, model).where("doc_id < 5").collect()}) == 1
    field = pii.SemiMarkov({"bias": (0.0,) * len(pii.KINDS)}, [[0.0] * pii.N_STATES for _ in range(pii.N_STATES)])
    assert field.decode("call 555 or 12") == []  # all cuts are equal: nothing is inside an entity


@pytest.mark.parametrize("filled", [0.5, 1.0])
def test_token_cache_that_is_partly_full(spark, tmp_path, filled):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice("abcde") * r.randint(1, 5) for _ in range(20))) for i in range(60)] + [(60, None), (61, "")]
    first = documents(spark, rows[: int(len(rows) * filled)])
    cache = f"{tmp_path}/cache"
    token_counts.cached_token_counts(first, cache).collect()
    before = {x.content: x.n_tokens for x in spark.read.parquet(cache).collect()}
    got = {x.doc_id: x.n_tokens for x in token_counts.cached_token_counts(documents(spark, rows), cache).collect()}
    after = spark.read.parquet(cache).collect()
    count = token_counts.counter(token_counts.tokenizer_path(token_counts.TOKENIZER))
    assert got == {i: count([t or ""])[0] for i, t in rows}
    assert len(after) == len({t or "" for _, t in rows}) and all(after_row.n_tokens == before.get(after_row.content, after_row.n_tokens) for after_row in after)
    assert {hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows} == {x.content for x in after}


def test_decontamination_by_join_is_that_by_broadcast(spark):
    r = random.Random(7)
    word = lambda: r.choice(["alpha", "beta", "Gamma", "é", "x1"])
    items = [(i, " ".join(word() for _ in range(r.choice([1, 4, 10, 30])))) for i in range(40)]
    docs = documents(spark, [(i % 50, " ".join(word() for _ in range(60)) + " " + (r.choice(items)[1] if i % 3 else "")) for i in range(90)] + [(1, None), (2, "")])
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, two = (sorted(map(str, decontaminate.benchmark_overlap(docs, bench, slice_words=n).collect())) for n in (1_000_000, 1))
    assert one == two
    cut = [sorted(map(str, decontaminate.remove_contamination(docs, bench, slice_words=n).collect())) for n in (1_000_000, 1)]
    assert cut[0] == cut[1]
