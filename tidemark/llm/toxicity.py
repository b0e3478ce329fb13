"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, crc_mod, drop_held, held, map_rows, pa_schema, release_memory, table

#: Symbols of the character model: 0 for a boundary, 1-26 for a-z, other letters folded onto 27-63.
LETTERS = 64
#: Feature counters: two rows of 2^19, and a feature is worth the lesser of its two, so that a collision counts for nothing.
HALF = 1 << 19
SLOTS = 2 * HALF
#: Labelled rows that are learnt from at most; with more, those of the lowest id hashes are taken.
MAX_LABELLED = 4_000_000

#: Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou", "#": "aeiou", "%": "aeiou",
}
PUNCTUATION = ".,;:!?\"'()[]{}<>"
SEPARATORS = " ._-*~/\\'"
#: Costs of the channel, in nats: a sign for its letter, a separator or a repeated letter inside a word, a sign that means nothing.
SIGN_COST, SEPARATOR_COST, REPEAT_COST, DROP_COST = 0.7, 0.4, 0.2, 6.0
#: Signs that may stand for a letter at the edge of a word.
LOOKALIKE = "@$€£|"
#: Longest token in characters whose outcome is kept for its next occurrence, which bounds the bytes of the caches.
KEPT = 64

xxh = xxhash.xxh3_64_intdigest

#: Single letters or signs, one separator between every two, three or more of them, standing alone.
_SPACED = re.compile(r"(?<![^\s])[\w@$!|+€](?:[ ._\-*~/][\w@$!|+€]){2,}(?![^\s.,;:!?)\"'])")
_REPEAT = re.compile(r"([^\W\d_])\1\1")
_LONG_REPEAT = re.compile(r"(.)\1{3,}", re.S)
_SIGN = re.compile(r"[0-9@$!|+€£(*#%]")
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+")


def trimmed(token: str) -> str:
    """A token without its edges: punctuation and runs of signs go; a single sign that looks like a letter stays
    where it stands next to one."""
    lo, hi = 0, len(token)
    while lo < hi and not token[lo].isalnum() and not (token[lo] in LOOKALIKE and token[lo + 1 : lo + 2].isalpha()):
        lo += 1
    if hi - lo > 1 and token[hi - 1] in LOOKALIKE and token[hi - 2].isalpha():
        return token[lo:hi]
    while hi > lo and not token[hi - 1].isalnum():
        hi -= 1
    return token[lo:hi]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code of each code point under 0x250: 0 for anything but letters, 1 to 26 for a-z, 27 to 63 for the others."""
    codes = np.zeros(0x250, np.uint8)
    others = [c for c in range(0x250) if chr(c).isalpha() and chr(c) == chr(c).lower() and not "a" <= chr(c) <= "z"]
    codes[97:123] = np.arange(1, 27)
    codes[others] = 27 + np.arange(len(others)) % 37
    return codes


def trigram_codes(text: str) -> np.ndarray:
    """Symbols of the lower-cased letters, with a single 0 for each run of other characters, and 0 at both ends."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letters()[np.minimum(cp, 0x24F)]
    high = np.flatnonzero(cp >= 0x250)
    if len(high):
        letters = np.fromiter((chr(x).isalpha() for x in cp[high].tolist()), bool, len(high))
        codes[high] = np.where(letters, 27 + cp[high] % 37, 0)
    codes = np.r_[np.uint8(0), codes, np.uint8(0)]
    return codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]]


@dataclass
class CharModel:
    """Log probabilities of a letter after two others, interpolated from counts of the whole corpus."""

    logp: list[list[list[float]]]

    @staticmethod
    def fit(key: np.ndarray, n: np.ndarray) -> CharModel:
        c3 = np.zeros(LETTERS**3)
        c3[key] = n
        c3 = c3.reshape(LETTERS, LETTERS, LETTERS)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 0.5) / (c1.sum() + 0.5 * LETTERS)
        p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2[None]) / (c3.sum(2, keepdims=True) + 5)
        return CharModel(np.log(p3).tolist())


@lru_cache(maxsize=100_000)
def _code(c: str) -> int:
    x = trigram_codes(c)
    return int(x[1]) if len(x) == 3 else 0


def lattice(token: str) -> Iterator[list[tuple[str, float]]]:
    """For each character of a disguised word the letters it may stand for ("" for none), with their costs."""
    last = ""
    for c in token:
        arcs: list[tuple[str, float]] = []
        if c.isalpha():
            arcs.append((c, 0.0))
        arcs += [(x, SIGN_COST) for x in SIGNS.get(c, "")]
        if c in SEPARATORS:
            arcs.append(("", SEPARATOR_COST))
            if c == " ":
                arcs.append((" ", 0.0))
        elif c == last:
            arcs.append(("", REPEAT_COST))
        elif not c.isalpha():
            arcs.append(("", DROP_COST))
        yield arcs
        last = c


def restore(token: str, model: CharModel) -> str:
    """The most likely reading of a disguised token, by Viterbi search over its whole lattice.

    A reading is a word, or several where spaces stay spaces. A state is the last two letters written; of each
    state the best path is kept, as a chain of letters, so that time and memory are linear in the token. Ties go
    to the reading that was met first, in the order of the lattice's arcs.
    """
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    logp = model.logp
    for arcs in lattice(token):
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        coded = [(x, cost, _code(x) if x else 0) for x, cost in arcs]
        for (a, b), (p, path) in states.items():
            row = logp[a][b]
            for x, cost, code in coded:
                total = p - cost + (row[code] if x else 0.0)
                to = (b, code) if x else (a, b)
                if to not in following or total > following[to][0]:
                    following[to] = (total, (path, x) if x else path)
        states = following
    best, path = max(((p + logp[a][b][0], path) for (a, b), (p, path) in states.items()), key=lambda x: x[0])
    letters = []
    while path is not None:
        path, x = path
        letters.append(x)
    return "".join(letters[::-1]).strip()


def is_disguised(token: str) -> bool:
    return bool(_REPEAT.search(token)) or bool(_SIGN.search(token) and _LETTER.search(token))


def forms(token: str, model: CharModel | None) -> list[str]:
    """The words that a token of a lower-cased text stands for: itself without its edges, or where it is disguised
    the words of its most likely reading. Without a model a disguised token stands for nothing.
    """
    bare = token.strip(PUNCTUATION)
    if not bare.isalpha():
        bare = trimmed(token)
    elif not _REPEAT.search(bare):
        return [bare]
    spaced = _SPACED.fullmatch(bare)
    if not spaced and not is_disguised(bare):
        return [bare] if bare.isalpha() else _WORD.findall(bare)
    if model is None or len(bare) < 3:
        return []
    return list(dict.fromkeys(restore(_LONG_REPEAT.sub(r"\1\1\1", bare), model).split()))


def spaced_words(text: str) -> list[str]:
    """Words written letter by letter, as they stand."""
    return [m.group() for m in _SPACED.finditer(text)]


def word_features(word: str) -> tuple[int, ...]:
    """64-bit hashes of a word and of its first four, five and six letters."""
    n = len(word)
    own = xxh(word)
    if n < 4:
        return (own,)
    if n == 4:
        return own, xxh(word + "-")
    return (own, xxh(word[:4] + "-"), xxh(word[:5] + "-")) if n == 5 else (own, xxh(word[:4] + "-"), xxh(word[:5] + "-"), xxh(word[:6] + "-"))


class TokenFeatures(dict):
    """Features of plain tokens, kept up to a bounded number."""

    def __missing__(self, token: str) -> tuple[int, ...]:
        words = forms(token, None)
        out = word_features(words[0]) if len(words) == 1 else tuple(h for w in words for h in word_features(w))
        if len(token) <= KEPT:
            if len(self) >= 150_000:
                self.clear()
            self[token] = out
        return out


class WordScores(dict):
    """Best evidence in any form of a token; kept for repeated tokens up to a bounded number."""

    def __init__(self, weight: np.ndarray, model: CharModel, most: int = 500_000):
        super().__init__()
        self.weight, self.model, self.most = weight, model, most
        self.flag = (weight > 0).astype(np.uint8).tobytes()

    def __missing__(self, token: str) -> float:
        best, flag = 0.0, self.flag
        for word in forms(token, self.model):
            for h in word_features(word):
                one, two = h & (HALF - 1), HALF + (h >> 40 & (HALF - 1))
                if flag[one] and flag[two]:
                    best = max(best, float(min(self.weight[one], self.weight[two])))
        if len(token) <= KEPT:
            if len(self) >= self.most:
                self.clear()
            self[token] = best
        return best


def evidence(text: str | None, scores: WordScores) -> float:
    """The strongest evidence of any word of the whole text."""
    if not text:
        return 0.0
    text = text.lower()
    return max(map(scores.__getitem__, {*text.split(), *spaced_words(text)}), default=0.0)


def bound(pos: np.ndarray, neg: np.ndarray, n_pos: float, n_neg: float) -> np.ndarray:
    """Lower bound of the log odds that a feature gives for label 1, 0 at least."""
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    return np.maximum(odds - 1.64 * np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5)), 0).astype(np.float32)


@dataclass
class ToxicityModel:
    weight: np.ndarray
    chars: CharModel
    slope: float
    offset: float

    def probability(self, x: float) -> float:
        return float(1 / (1 + np.exp(-(self.slope * x + self.offset))))


def _doc_slots(text: str, features: TokenFeatures) -> tuple[np.ndarray, np.ndarray]:
    """The two counters of each distinct feature of a training text's plain words."""
    found = set().union(*map(features.__getitem__, set(text.lower().split())))
    h = np.fromiter(found, np.uint64, len(found))
    return (h & np.uint64(HALF - 1)).astype(np.int64), HALF + (h >> np.uint64(40) & np.uint64(HALF - 1)).astype(np.int64)


def _statistics(docs: DataFrame) -> DataFrame:
    """(kind, key, a, b) sums over (text, label): kind 0 counts a feature's documents by label (a: 1, b: 0) and,
    at key -1, all labelled documents; kind 1 counts letter triples over every row, labelled or not."""
    schema = pa_schema("kind int, key int, a long, b long")
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        triples = np.zeros(LETTERS**3, np.int64)
        seen = np.zeros((2, SLOTS), np.int32)
        total = [0, 0]
        features = TokenFeatures()
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                rows = batch.slice(lo, 128).to_pydict()
                codes = []
                for text, label in zip(rows["text"], rows["label"], strict=True):
                    if label is not None:
                        total[label] += 1
                    if not text:
                        continue
                    codes.append(trigram_codes(text))
                    if label is not None:
                        for s in _doc_slots(text, features):
                            seen[label, s] += 1
                if codes:
                    c = np.concatenate(codes).astype(np.int32)  # each text begins and ends with a boundary
                    c = np.r_[np.int32(0), c]
                    triples += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS**3)
        for kind, a, b in ((0, seen[1], seen[0]), (1, triples, np.zeros_like(triples))):
            at = np.flatnonzero((a > 0) | (b > 0))
            for lo in range(0, len(at), 50_000):
                k = at[lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.astype(np.int32)), pa.array(a[k].astype(np.int64)), pa.array(b[k].astype(np.int64))], schema=schema)
        yield pa.RecordBatch.from_pydict({"kind": [0], "key": [-1], "a": [total[1]], "b": [total[0]]}, schema=schema)
        del triples, seen, features
        release_memory()

    return docs.select("text", "label").mapInArrow(run, "kind int, key int, a long, b long").groupBy("kind", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def with_labels(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """(doc_id, text, label); label is null where there is none. The broadcast side has ``max_labelled`` rows at most."""
    labels = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    labels = labels.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = labels.count()
    if n > max_labelled:
        share = max_labelled / n * 0.95
        labels = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    return docs.join(F.broadcast(labels), "doc_id", "left")


def train_toxicity(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = MAX_LABELLED,
) -> ToxicityModel:
    """Fit from the texts of ``docs`` and the rows of ``labels`` (doc_id, 0 or 1).

    Three parts: a letter model of every text; bounded log odds of hashed word features over the labelled texts
    (at most 2^20 slots, whatever the size); and a logistic curve from a text's strongest evidence to its
    probability, fitted on evidence that leaves the text's own label out. Word features are learnt from undisguised
    words: what a disguise hides is told by the letter model alone. A label row that repeats counts once,
    the greater label winning; null labels and ids are ignored; a row of ``docs`` that repeats counts each time.
    Null and empty texts have a label but no features; texts of any length are read whole. Without labels of both
    kinds every score is the share of label 1 among the labels, or 0 where there are none. Other columns, whatever
    their names, are ignored. An empty table gives such a model too.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    labels = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
    labelled = with_labels(docs, labels, max_labelled)
    sums = _statistics(labelled)
    got = sums.where("kind = 1 OR a > 0 OR key = -1").toArrow()
    kind, key, a, b = (got.column(c).to_numpy() for c in ("kind", "key", "a", "b"))
    chars = CharModel.fit(key[kind == 1], a[kind == 1])
    own = (kind == 0) & (key >= 0)
    n_pos, n_neg = (int(x[(kind == 0) & (key < 0)].sum()) for x in (a, b))
    weight = np.zeros(SLOTS, np.float32)
    if not n_pos or not n_neg:
        base = 1 - 1e-6 if n_pos else 1e-6
        return ToxicityModel(weight, chars, 0.0, float(np.log(base / (1 - base))))
    pos, neg = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
    pos[key[own]], neg[key[own]] = a[own], b[own]
    weight[pos > 0] = bound(pos[pos > 0], neg[pos > 0], n_pos, n_neg)
    counts = docs.sparkSession.sparkContext.broadcast((key[own].astype(np.int32), a[own], b[own]))

    features = TokenFeatures()

    def left_out(text, label):
        key, a, b = counts.value
        pos, neg = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        pos[key], neg[key] = a, b
        bins = []
        for t, y in zip(text, label, strict=True):
            one, two = _doc_slots(t or "", features)
            some = (pos[one] > y) & (pos[two] > y)
            x = np.minimum(*(bound(pos[s] - y, neg[s] - (1 - y), n_pos - y, n_neg - (1 - y)) for s in (one[some], two[some])))
            bins.append(int(round(10 * float(x.max(initial=0)))))
        return {"bin": bins, "label": label}

    binned = map_rows(labelled.where("label IS NOT NULL").select("text", "label"), left_out, "bin int, label int", 1000)
    table_ = np.array([tuple(r) for r in binned.groupBy("bin").agg(F.sum("label"), F.count("*")).collect()], float)
    return ToxicityModel(weight, chars, *logistic(table_[:, 0] / 10, table_[:, 1], table_[:, 2]))


def logistic(x: np.ndarray, ones: np.ndarray, all_: np.ndarray) -> tuple[float, float]:
    """Slope (0 at least) and offset by Newton steps, with a weak prior that keeps separable labels finite."""
    w = np.array([0.0, 0.0])
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (ones - all_ * p) - 0.05 * w
        hess = (design * (all_ * p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return max(float(w[0]), 0.0), float(w[1])


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text, however long: null and empty ones have no evidence.

    The score is that of the strongest word of the restored text: each disguised token stands for its most likely
    reading and nothing else. Rows are scored one by one, so repeats score alike; of words with equal evidence it
    does not matter which is taken. A column that is already called ``score_col`` is replaced. An empty table gives
    an empty result.
    """
    bounded_batches(docs.sparkSession)
    at = np.flatnonzero(model.weight).astype(np.int32)
    name = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast((at, model.weight[at], model.chars, model.slope, model.offset))
    inputs = [c for c in docs.columns if c != score_col]
    schema = docs.select(*inputs).withColumn(score_col, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def load() -> tuple[ToxicityModel, WordScores]:
            at, value, chars, slope, offset = shared.value
            weight = np.zeros(SLOTS, np.float32)
            weight[at] = value
            return ToxicityModel(weight, chars, slope, offset), WordScores(weight, chars)

        model, scores = held(("toxicity", name), load)  # the words of a worker's earlier tasks stay scored
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                rows = batch.slice(lo, 128)
                found = [model.probability(evidence(t, scores)) for t in rows.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in inputs), pa.array(found, pa.float64())], names=[*inputs, score_col])
        release_memory()

    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, *, most: float = 0.5, **options) -> DataFrame:
    """Rows of ``docs`` whose score is under ``most``; trained on ``labels`` and ``docs`` themselves."""
    model = train_toxicity(docs, labels, **options)
    name = "_" * max(map(len, docs.columns)) + "score"
    return score_toxicity(docs, model, score_col=name).where(F.col(name) < most).drop(name)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0))
    found = score_toxicity(docs, model)
    return found.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
