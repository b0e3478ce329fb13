"""Benchmark decontamination: normalised test windows, broadcast where they are few, scanned for in whole texts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_BYTES, TokenHashes, bounded_batches, drop_held, map_rows, mixed, release_memory, stored, table, words_of

WINDOW = 10
#: Words of benchmark text that are broadcast at most (some 100 bytes each); a larger benchmark is met in a join.
SLICE_WORDS = 1_000_000
#: The contract's word pattern on UTF-8 bytes after ASCII lower-casing.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_with_spans(text: str) -> list[tuple[int, int]]:
    """Code point spans of the words, in order."""
    raw = text.encode("utf-8", "surrogatepass")
    spans = [m.span() for m in WORD.finditer(raw.translate(WORD_BYTES))]
    if len(raw) == len(text):
        return spans
    starts = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return [(int(starts[a]) - 1, int(starts[b - 1])) for a, b in spans]


class WindowSet:
    """Hash set of the distinct windows of the benchmark, with the items that hold each.

    Words become small numbers; a window is found by a bit filter, then by its hash in a sorted array, and is
    then verified word by word.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        grouped: dict[int, dict[bytes, set[str]]] = {}
        for item, words in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint32)
            if not len(ids):
                continue
            k = min(window, len(ids))
            for at in range(len(ids) - k + 1):
                grouped.setdefault(k, {}).setdefault(ids[at : at + k].tobytes(), set()).add(item)
        self.tables = []
        for k, found in sorted(grouped.items()):
            rows = np.frombuffer(b"".join(found), np.uint32).reshape(-1, k)
            keys = self.hashed([rows[:, j] for j in range(k)])
            order = np.argsort(keys, kind="stable")
            bits = max(16, int(np.ceil(np.log2(len(keys) * 16))))
            seen = np.zeros(1 << bits, bool)
            seen[keys >> np.uint64(64 - bits)] = True
            owners = list(found.values())
            self.tables.append((k, keys[order], rows[order], [sorted(owners[i]) for i in order], seen, np.uint64(64 - bits)))

    @staticmethod
    def hashed(columns: list[np.ndarray]) -> np.ndarray:
        h = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            h = h * np.uint64(0x9E3779B97F4A7C15) + c
        return mixed(h)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Hit flags of the words, and the items with occurring windows."""
        hit, items = np.zeros(len(words), bool), set()
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint32, len(words))
        known = ids > 0
        if not known.any():
            return hit, items
        total = np.r_[0, np.cumsum(known)]
        for k, keys, rows, owners, seen, shift in self.tables:
            if len(ids) < k:
                continue
            at = np.flatnonzero(total[k:] - total[:-k] == k)
            if not len(at):
                continue
            h = self.hashed([ids[at + j] for j in range(k)])
            may = seen[h >> shift]
            at, h = at[may], h[may]
            lo = np.searchsorted(keys, h, "left")
            for a, x, i in zip(at.tolist(), h.tolist(), lo.tolist(), strict=True):
                while i < len(keys) and int(keys[i]) == x:
                    if (rows[i] == ids[a : a + k]).all():
                        hit[a : a + k] = True
                        items.update(owners[i])
                    i += 1
        return hit, items


def window_hashes(words: list[bytes], k: int, hashes: TokenHashes) -> np.ndarray:
    """64-bit hashes of all windows of ``k`` words."""
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(own) - k + 1
    return WindowSet.hashed([own[j : j + n] for j in range(k)]) if n > 0 else own[:0]


def _runs(hit: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8))).tolist()


def mark_overlap(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, slice_words: int = SLICE_WORDS,
    names: tuple[str, str, str] = ("n_words", "items", "runs"),
) -> DataFrame:
    """All columns of ``docs`` and three more, called ``names``: words, items with occurring windows (sorted
    strings), and [first word, last word + 1, ...] of the runs of hit words.

    A word is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is ``window`` consecutive
    words of a benchmark item (all its words where it has fewer); every word of a document inside an occurrence
    is hit. A benchmark of at most ``slice_words`` words is broadcast as a set of windows; of a larger one only a bit
    filter of fixed size is, and what passes it meets the windows in a join (``_marked_by_join``), with the same result.
    Null or empty texts and items have no words; texts of any length are scanned whole; repeated items and rows act
    alike; an empty table gives an empty result, an empty benchmark no hits.
    """
    bounded_batches(docs.sparkSession)
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    # two characters hold one word at most
    most = rows.agg(F.coalesce(F.sum(F.floor((F.length("text") + 1) / 2)), F.lit(0))).first()[0]
    if most > slice_words:
        return _marked_by_join(docs, rows, text_col, window, names)
    out = docs.withColumns({names[0]: F.lit(0).cast("long"), names[1]: F.array().cast("array<string>"), names[2]: F.array().cast("array<long>")})
    inputs = docs.columns
    windows = docs.sparkSession.sparkContext.broadcast(WindowSet([(item, words_of(text)) for item, text in rows.toLocalIterator()], window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                n_words, items, runs = [], [], []
                for t in rows.column(text_col).to_pylist():
                    words = words_of(t)
                    hit, found = windows.value.scan(words)
                    n_words.append(len(words))
                    items.append(sorted(found))
                    runs.append(_runs(hit))
                made = [pa.array(n_words, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(runs, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in inputs), *made], names=[*inputs, *names])
        release_memory()

    return docs.mapInArrow(run, out.schema)


#: Bits of the filter that is broadcast for a large benchmark (16 MB), and of a part of it that one task makes.
FILTER_BITS, PART_BITS = 27, 20


def _marked_by_join(docs: DataFrame, rows: DataFrame, text_col: str, window: int, names: tuple[str, str, str]) -> DataFrame:
    """Windows of documents that pass the bit filter meet those of the benchmark on their hash and words.

    The marks are kept by the digest of the text, so equal texts are marked once and no corpus is written anew.
    """
    hashes = TokenHashes()
    parts = ", ".join(("k int", "h long", "words binary"))

    def windows_of(item, text):
        out: dict = {"k": [], "h": [], "words": [], "item": []}
        for i, t in zip(item, text, strict=True):
            words = words_of(t)
            k = min(window, len(words))
            for at, h in enumerate(window_hashes(words, k, hashes).view(np.int64).tolist() if k else ()):
                for name, value in zip(out, (k, h, b" ".join(words[at : at + k]), i), strict=True):
                    out[name].append(value)
        return out

    windows = stored(map_rows(rows, windows_of, f"{parts}, item string", 16).distinct(), "overlap-windows")
    lengths = sorted(r[0] for r in windows.select("k").distinct().collect())  # ``window`` of them at most

    def bits(pdf):
        import pandas as pd  # only here: a worker without it is smaller by some 50 MB

        part = np.zeros(1 << PART_BITS, bool)
        part[pdf["bit"].to_numpy() & ((1 << PART_BITS) - 1)] = True
        return pd.DataFrame({"part": [int(pdf["bit"].iloc[0]) >> PART_BITS], "bits": [np.packbits(part).tobytes()]})

    place = windows.select(F.shiftrightunsigned("h", 64 - FILTER_BITS).alias("bit")).distinct()
    made = place.withColumn("part", F.shiftright("bit", PART_BITS)).groupBy("part").applyInPandas(bits, "part long, bits binary")
    filter_ = np.zeros((1 << FILTER_BITS) // 8, np.uint8).reshape(-1, (1 << PART_BITS) // 8)
    for r in made.toLocalIterator():
        filter_[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(filter_.ravel())

    def candidates(text):
        out: dict = {"digest": [], "place": [], "k": [], "h": [], "words": []}
        for t in text:
            words = words_of(t)
            digest = hashlib.md5((t or "").encode()).hexdigest()
            for k in lengths:
                h = window_hashes(words, k, hashes)
                bit = h >> np.uint64(64 - FILTER_BITS)
                for at in np.flatnonzero(shared.value[(bit >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (bit & np.uint64(7)).astype(np.uint8)) & 1).tolist():
                    for name, value in zip(out, (digest, at, k, int(h[at : at + 1].view(np.int64)[0]), b" ".join(words[at : at + k])), strict=True):
                        out[name].append(value)
        return out

    found = map_rows(docs.select(F.col(text_col).alias("text")), candidates, f"digest string, place long, {parts}", 64).distinct()
    hits = found.join(windows, ["k", "h", "words"])
    digest, items, spans = (f"{'_' * max(map(len, [*docs.columns, *names]))}{x}" for x in ("digest", "items", "spans"))
    marks = hits.groupBy(F.col("digest").alias(digest)).agg(F.sort_array(F.collect_set("item")).alias(items), F.flatten(F.collect_set(F.array("place", F.col("place") + F.col("k")))).alias(spans))
    inputs = docs.columns
    met = docs.withColumn(digest, F.md5(F.coalesce(text_col, F.lit("")).cast("binary"))).join(marks, digest, "left")
    schema = docs.withColumns({names[0]: F.lit(0).cast("long"), names[1]: F.array().cast("array<string>"), names[2]: F.array().cast("array<long>")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                n_words, runs = [], []
                for t, at in zip(rows.column(text_col).to_pylist(), rows.column(spans).to_pylist(), strict=True):
                    n_words.append(len(words_of(t)))
                    hit = np.zeros(n_words[-1], bool)
                    for a, b in zip((at or [])[::2], (at or [])[1::2], strict=True):
                        hit[a:b] = True
                    runs.append(_runs(hit))
                made = [pa.array(n_words, pa.int64()), pa.array([x or [] for x in rows.column(items).to_pylist()], pa.list_(pa.string())), pa.array(runs, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in inputs), *made], names=[*inputs, *names])

    return met.mapInArrow(run, schema)


def benchmark_overlap(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: doc_id, n_words, items, runs as in ``mark_overlap``, and n_hit, the number of hit words.

    Other columns are ignored; rows with null or repeated ids are kept one by one.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = mark_overlap(docs, benchmark, **options)
    n_hit = F.aggregate("runs", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("sign")), lambda s, x: F.struct((s["n"] + s["sign"] * x).alias("n"), (-s["sign"]).alias("sign")))["n"]
    return marked.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "runs")


def remove_contamination(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", drop_share: float = 0.5, **options) -> DataFrame:
    """Cut hit spans out of the texts; drop documents of which more than ``drop_share`` of the words are hit.

    All other columns and rows stay as they are; a null text stays null. A cut span runs from the first to the
    last hit word of a run; of the spaces around the cut one stays.
    """
    names = tuple(f"{'_' * max(map(len, docs.columns))}{x}" for x in ("words", "items", "runs"))
    marked = mark_overlap(docs, benchmark, text_col=text_col, names=names, **options)

    def clean(text: str | None, n_words: int, runs: list[int]) -> tuple[str | None, bool]:
        if not runs:
            return text, True
        edge = np.array(runs).reshape(-1, 2)
        if (edge[:, 1] - edge[:, 0]).sum() > drop_share * n_words:
            return text, False
        spans = words_with_spans(text)
        out, at = [], 0
        for a, b in edge:
            lo, hi = spans[a][0], spans[b - 1][1]
            piece = text[at:lo]
            if text[hi : hi + 1] == " " and (not piece or piece[-1].isspace()):
                hi += 1
            out.append(piece)
            at = hi
        return "".join(out) + text[at:], True

    return rewrite_text(marked, clean, docs.schema, text_col, (names[0], names[2]))


def rewrite_text(docs: DataFrame, fn: Callable[..., tuple[str | None, bool]], schema, text_col: str = "text", using: tuple[str, ...] = ()) -> DataFrame:
    """Rows with the text ``fn(text, *using) -> (text, keep)``; the other columns of ``schema`` pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                done = [fn(*x) for x in zip(*(rows.column(c).to_pylist() for c in (text_col, *using)), strict=True)]
                cols = [pa.array([t for t, _ in done], pa.string()) if c == text_col else rows.column(c) for c in schema.names]
                out = pa.RecordBatch.from_arrays(cols, names=schema.names)
                yield out if all(k for _, k in done) else out.filter(pa.array([k for _, k in done]))
        release_memory()

    return docs.mapInArrow(run, schema)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), g AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), ks AS (SELECT DISTINCT k FROM g), p AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)
), m AS (SELECT p.doc_id, p.i, p.k, g.item_id FROM p JOIN g ON p.k = g.k AND p.s = g.s),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
