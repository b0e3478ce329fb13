"""N-gram Jaccard self-join through a MinHash LSH forest, prefixes shortened on the data, with exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TokenHashes, map_rows, mixed, pa_schema, release_memory, stored, table, words_of
from .components import components

TREES, TALLEST = 16, 6
_rng = np.random.default_rng(20240229)
_MULT = (_rng.integers(0, 2**63, TREES * TALLEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_XOR = _rng.integers(0, 2**63, TREES * TALLEST, dtype=np.uint64)[:, None]
_BASE = np.uint64(0x9E3779B97F4A7C15)


#: Bytes of a hash value in a label.
WIDE = 2


def meeting(similarity: np.ndarray | float, depth: int, trees: int = TREES) -> np.ndarray | float:
    """How likely a pair of that similarity shares a prefix of ``depth`` values in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def forest_depth(similarity: float, target_recall: float, trees: int = TREES, tallest: int = TALLEST) -> int:
    """The longest prefix at which even pairs that are no more alike than ``similarity`` meet often enough."""
    depth = tallest
    while depth > 1 and meeting(similarity, depth, trees) < target_recall:
        depth -= 1
    return depth


def estimated_recall(found: dict[int, int], similarity: float, depth: int) -> float:
    """Share of the linked pairs that prefixes down to ``depth`` have brought together, from the pairs that they have.

    ``found`` counts pairs by the hash values in which they agree. Each stands for one over its chance to meet pairs of
    its kind; pairs that look less alike than ``similarity`` are left out.
    """
    n = TREES * TALLEST
    seen = {k: c for k, c in found.items() if k >= similarity * n}
    whole = sum(c / float(meeting(max(k / n, similarity), depth)) for k, c in seen.items())
    return sum(seen.values()) / whole if whole else 0.0


def shingles(words: list[bytes], n: int, hashes: TokenHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of n-word shingles; a shorter text that has words is one shingle."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    k = min(n, len(h))
    m = len(h) - k + 1
    x = h[:m].copy()
    for j in range(1, k):
        x = x * _BASE + h[j : j + m]
    return np.unique(mixed(x))


def signature(x: np.ndarray) -> np.ndarray:
    """MinHash values, those of a tree next to each other."""
    out = np.full(TREES * TALLEST, 2**32 - 1, np.uint32)
    for at in range(0, len(x), 1024):
        part = (((x[at : at + 1024][None, :] ^ _XOR) * _MULT) >> np.uint64(32)).astype(np.uint32)
        np.minimum(out, part.min(1), out=out)
    return out


def digest(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def lower_words(text: str | None) -> list[bytes]:
    return words_of(text.lower()) if text else []


class Forest:
    """Roots over positions of one block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def _dealt(members: DataFrame, key: str, weight: str, block: int) -> DataFrame:
    """Members (key, node, ...) of keys that have several, with the number of blocks of their key and their own block.

    A block has about ``block`` weight. A key's weight comes from a partial aggregate, so a hot key is cut before its rows
    meet; the join that tells each row its key's number of blocks has one row a key on the other side, so that adaptive
    execution splits a hot one.
    """
    sizes = members.groupBy(key).agg(F.sum(weight).alias("w"), F.count("*").alias("c")).where("c > 1")
    parts = sizes.select(key, F.ceil(F.col("w") / block).cast("int").alias("parts"))
    return members.join(parts, key).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def _met(dealt: DataFrame, key: str, payload: list[str], label: str) -> DataFrame:
    """Bring every two blocks of a key together once, as (left, right) arrays; right is null for a block with itself.

    No task ever holds more than two blocks of a key.
    """
    blocks = stored(dealt.groupBy(key, "parts", "part").agg(F.collect_list(F.struct("node", *payload)).alias("m")), label)
    whole = blocks.where("parts = 1").select(F.col("m").alias("left"), F.lit(None).cast(blocks.schema["m"].dataType).alias("right"))
    both = blocks.where("parts > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = both.withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")}).groupBy(key, "lo", "hi")
    met = both.agg(F.first(F.when(F.col("part") == F.col("lo"), F.col("m")), True).alias("left"), F.first(F.when((F.col("part") == F.col("hi")) & (F.col("lo") < F.col("hi")), F.col("m")), True).alias("right"))
    # a block to which no node was dealt has no partner
    return whole.unionByName(met.where("left IS NOT NULL AND (lo = hi OR right IS NOT NULL)").select("left", "right"))


def _candidates(least: float):
    """Kernel: nodes of different roots whose signatures agree enough, as edges (a, b, agreeing values) of a spanning
    forest of one block or between two."""
    schema = pa_schema("a binary, b binary, agree int")

    def agreement(sa: np.ndarray, sb: np.ndarray) -> np.ndarray:
        hits = np.zeros((len(sa), len(sb)), np.int16)
        for k in range(sa.shape[1]):
            hits += sa[:, k][:, None] == sb[:, k][None, :]
        return hits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(0), batch.column(1)
            edges: list[tuple[bytes, bytes, int]] = []
            for row in range(batch.num_rows):
                one = {m["node"]: m for m in left[row].as_py()}
                two = {m["node"]: m for m in right[row].as_py() or [] if m["node"] not in one}
                members = [one[x] for x in sorted(one)] + [two[x] for x in sorted(two)]
                sig = np.frombuffer(b"".join([m["sig"] for m in members]), np.uint16).reshape(len(members), -1)
                root = np.unique(np.array([m["root"] for m in members], np.int64), return_inverse=True)[1]
                roots = Forest(len(members))
                first: dict[int, int] = {}
                for i, x in enumerate(root.tolist()):  # what longer prefixes have joined is joined
                    roots.join(i, first.setdefault(x, i))
                k, enough = len(one), least * sig.shape[1]
                lo, hi = (slice(0, k), slice(k, None)) if two else (slice(0, k), slice(0, k))
                hits = agreement(sig[lo], sig[hi])
                near = (hits >= enough) & (root[lo][:, None] != root[hi][None, :])
                if not two:
                    near = np.triu(near, 1)
                i, j = np.nonzero(near)
                best = np.argsort(-hits[i, j], kind="stable")  # the likest pairs make the forest
                for x, y in zip(i[best].tolist(), (j[best] + (k if two else 0)).tolist(), strict=True):
                    if roots.root(x) != roots.root(y):
                        roots.join(x, y)
                        edges.append((members[x]["node"], members[y]["node"], int(hits[x, y - (k if two else 0)])))
            yield pa.RecordBatch.from_arrays([pa.array([e[c] for e in edges], t) for c, t in enumerate((pa.binary(), pa.binary(), pa.int32()))], schema=schema)
        release_memory()

    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from a shingle-by-set incidence matrix built a stripe at a time."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.r_[True, values[1:] != values[:-1]]
    column = np.cumsum(new) - 1
    twice = np.bincount(column)[column] > 1
    owner, column = owner[twice], column[twice]
    column = np.unique(column, return_inverse=True)[1]
    out = np.zeros((n, n), np.float64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, [at, at + 4096])
        m = np.zeros((n, 4096), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        out += m @ m.T
    return out.astype(np.int64)


def _verified(similarity: float):
    """Kernel: exact Jaccard of the sets of two blocks; per node the documents it links to, and local components."""
    schema = pa_schema("a binary, b binary, links long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(0), batch.column(1)
            for row in range(batch.num_rows):
                one = {m["node"]: m for m in left[row].as_py()}
                two = {m["node"]: m for m in right[row].as_py() or [] if m["node"] not in one}
                members = [*one.values(), *two.values()]
                k = len(one)
                sets = [np.frombuffer(m["grams"], np.uint64) for m in members]
                both = common_counts(sets)
                size = np.array([len(s) for s in sets])
                linked = both >= similarity * (size[:, None] + size[None, :] - both) - 1e-9
                if two:
                    linked[:k, :k] = linked[k:, k:] = False
                np.fill_diagonal(linked, False)
                copies = np.array([m["copies"] for m in members])
                links = linked @ copies
                roots = Forest(len(members))
                for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
                    roots.join(int(i), int(j))
                keep = [i for i in range(len(members)) if links[i]]
                yield pa.RecordBatch.from_arrays([pa.array([members[i]["node"] for i in keep], pa.binary()), pa.array([members[roots.root(i)]["node"] for i in keep], pa.binary()), pa.array([int(links[i]) for i in keep], pa.int64())], schema=schema)
        release_memory()

    return run


def _forest(nodes: DataFrame, similarity: float, target_recall: float, screen: float, block_members: int, evidence: int) -> DataFrame | None:
    """(node, root) of the nodes that the forest brings together; None where it brings none.

    The vertex of a tree's trie at some depth is the prefix of that length of the tree's label; below it are the nodes
    whose labels have that prefix. All tries are walked from their deepest vertices upwards, a depth at a time: where
    nodes of different roots are below a vertex, those that look alike are joined. The walk ends when the pairs joined
    so far tell that the target recall is met, provided that they are ``evidence`` at least; and in any case at the
    depth where even the least alike pairs meet that often.
    """
    known: DataFrame | None = None
    edges: DataFrame | None = None
    for depth in range(TALLEST, forest_depth(similarity, target_recall) - 1, -1):
        labels = F.array(*[F.xxhash64(F.lit(t), F.substring("sig", WIDE * TALLEST * t + 1, WIDE * depth)) for t in range(TREES)])
        rooted = nodes.select("node", "sig", F.xxhash64("node").alias("root"))
        if known is not None:
            rooted = nodes.select("node", "sig").join(known, "node", "left").select("node", "sig", F.xxhash64(F.coalesce("root", "node")).alias("root"))
        entries = rooted.select("node", "root", F.explode(labels).alias("vertex"))
        sizes = entries.groupBy("vertex").agg(F.count("*").alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        sizes = sizes.select("vertex", F.ceil(F.col("c") / block_members).cast("int").alias("parts"))
        dealt = entries.join(sizes, "vertex").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        met = _met(dealt.join(nodes.select("node", "sig"), "node"), "vertex", ["sig", "root"], "ngram-vertices")
        fresh = stored(met.mapInArrow(_candidates(screen), "a binary, b binary, agree int"), "ngram-candidates")
        edges = fresh if edges is None else edges.unionByName(fresh)
        found = dict(edges.groupBy("agree").count().collect())
        if not found:
            continue
        known = stored(components(edges, "ngram-roots"), "ngram-roots")
        if sum(found.values()) >= evidence and estimated_recall(found, similarity, depth) >= target_recall:
            break
    return known


def ngram_jaccard_join(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, similarity: float = 0.8,
    target_recall: float = 0.999, screen: float = 0.62, block_members: int = 128, block_shingles: int = 8192, evidence: int = 1000,
) -> DataFrame:
    """Link documents whose sets of n-word shingles have a Jaccard similarity of at least ``similarity``.

    Returns one row per input row: doc_id, class_id (least doc_id connected through links), n_links (documents
    linked to it directly, copies included), n_copies (documents with the very same shingle set, itself included).

    Method: equal shingle sets collapse to one node. Each node has a signature of 96 MinHash values, which are its labels
    in 16 tries of height six. Nodes meet under the deepest vertices they share; the matched prefix is shortened, for
    all tries at once, until the pairs found tell that ``target_recall`` is met (``_forest``). Components of what looks
    alike are then compared exactly on their shingles. Neither vertices nor components are capped: large ones are
    dealt into blocks that meet two at a time, and only counts and one edge per node leave a task.

    Words are runs of letters and digits of the lower-cased text. A text of fewer than n words is one shingle; texts of
    any length are read whole. A null text, an empty text or one without words has no links and is its own class. Rows
    with a null id keep class_id null and 0 links. Repeated rows count as copies of each other. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hashes = TokenHashes()

    def describe(doc_id, text):
        out = {"doc_id": doc_id, "node": [], "n": [], "sig": []}
        for t in text:
            x = shingles(lower_words(t), n, hashes)
            out["n"].append(len(x))
            out["node"].append(digest(x) if len(x) else None)
            out["sig"].append(signature(x).astype(np.uint16).tobytes() if len(x) else None)
        return out

    described = stored(map_rows(docs, describe, "doc_id long, node binary, n long, sig binary"), "ngram-signatures")
    nodes = (
        described.where("doc_id IS NOT NULL AND n > 0")
        .groupBy("node")
        .agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "n", "sig")).alias("m"))
        .select("node", "copies", F.col("m.doc_id").alias("first_id"), "m.n", "m.sig")
    )
    nodes = stored(nodes, "ngram-nodes")
    near = _forest(nodes, similarity, target_recall, screen, block_members, evidence)
    if near is None:
        near = nodes.select("node", F.col("node").alias("root")).where("false")
    wanted = nodes.join(near, "node").select("node", "root", "copies", "n", F.col("first_id").alias("doc_id"))
    # a block has a bounded number of shingles and, where texts are short, of nodes
    wanted = wanted.withColumn("n", F.greatest("n", F.lit(block_shingles // block_members).cast("long")))
    wanted = _dealt(wanted, "root", "n", block_shingles).drop("n")

    def regram(doc_id, text, **kept):
        kept["grams"] = [x.tobytes() for x in (shingles(lower_words(t), n, hashes) for t in text)]
        right = [i for i, (g, node) in enumerate(zip(kept["grams"], kept["node"], strict=True)) if hashlib.blake2b(g, digest_size=16).digest() == node]
        return {k: [v[i] for i in right] for k, v in kept.items()}

    sets = map_rows(docs.join(wanted, "doc_id"), regram, "root binary, node binary, copies long, parts int, part int, grams binary", 64)
    # rows that repeat an id and its text are one node: one of them goes on
    sets = sets.groupBy("root", "node", "copies", "parts", "part").agg(F.first("grams").alias("grams"))
    met = _met(sets, "root", ["copies", "grams"], "ngram-sets")
    links = stored(met.mapInArrow(_verified(similarity), "a binary, b binary, links long"), "ngram-links")
    classes = components(links, "ngram-classes")
    degree = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    small = nodes.select("node", "copies", "first_id")
    rooted = small.join(classes, "node").join(degree, "node", "left")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    rooted = rooted.join(least, "root").select("node", "class_id", "links")
    # written, so that the last join has bare exchanges, of which one that a hot text fills can be split
    small = small.join(rooted, "node", "left").select("node", "copies", F.coalesce("class_id", "first_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    small = stored(small, "ngram-classes")
    has = described.where("doc_id IS NOT NULL AND n > 0").select("doc_id", "node")
    none = described.where("doc_id IS NULL OR n = 0")
    return (
        has.join(small, "node")
        .select("doc_id", "class_id", F.col("links").alias("n_links"), F.col("copies").alias("n_copies"))
        .unionByName(none.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies")))
    )


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))
