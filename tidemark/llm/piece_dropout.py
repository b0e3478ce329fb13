"""SentencePiece merges with seeded dropout, and the lossless way back."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat
from struct import pack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, held, release_memory, table
from .token_counts import tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: No piece continues over a space, so merges never leave spaces-then-word chunks.
CHUNK = re.compile(r" *[^ ]+| +")
#: Longest chunk in characters that is merged in arrays with others and cached, which bounds the bytes of the cache's keys.
SHORT = 20
#: From so many symbols on the agenda of a longer chunk is a heap over linked symbols; below, a short list is quicker.
HEAP_FROM = 48
#: Stands for a U+2581 of the text itself: two characters, so no single character and no piece equals it.
LITERAL = "\ufdd0\ufdd0"
NEVER = float("inf")
GOLDEN, SECOND, THIRD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_models: dict[str, PieceModel] = {}


class PieceModel:
    """Pieces, merge priorities and bytes of a merge-type SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.raw: list[bytes] = []
        self.byte_ids = [0] * 256
        self._pairs: PairTable | None = None
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.ids[piece] = i
                self.score[piece] = -sp.get_score(i)
                self.raw.append(piece.replace(SPACE, " ").encode())

    @staticmethod
    def load(path: str) -> PieceModel:
        if path not in _models:
            _models[path] = PieceModel(path)
        return _models[path]

    def pairs(self) -> PairTable:
        if self._pairs is None:
            self._pairs = PairTable(self)
        return self._pairs

    def encode_chunk(self, chunk: str, skips: Iterable[int] = ()) -> tuple[bytes, int]:
        """Piece ids of one chunk as int32 bytes, and how many candidates came up.

        Candidate merges wait in an agenda, best score first, then leftmost. The candidates that come up are
        numbered from 0 and those in ``skips`` (ascending, read as far as needed) are skipped; a skipped one comes
        up again only if a neighbouring merge makes it anew. Characters without a piece become byte pieces, and so does a literal
        U+2581, which is thereby told from a space.
        """
        symbols = [SPACE if c == " " else c for c in chunk]
        literal = [i for i, c in enumerate(chunk) if c == SPACE] if SPACE in chunk else []
        for i in literal:
            symbols[i] = LITERAL
        skips = iter(skips)
        merge = self._merge_heap if len(symbols) >= HEAP_FROM else self._merge_list
        symbols, came = merge(symbols, skips)
        out = list(map(self.ids.get, symbols))
        if None in out:
            out = [x for s, i in zip(symbols, out, strict=True) for x in ([i] if i is not None else [self.byte_ids[b] for b in (SPACE if s == LITERAL else s).encode()])]
        return pack(f"{len(out)}i", *out), came

    def _merge_list(self, symbols: list[str], skips: Iterator[int]) -> tuple[list[str], int]:
        get = self.score.get
        agenda = [get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]  # noqa: B905
        came, skip = 0, next(skips, -1)
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            came += 1
            if came - 1 == skip:
                skip = next(skips, -1)
                agenda[i] = NEVER
                continue
            s = symbols[i] + symbols[i + 1]
            symbols[i] = s
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = get(s + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = get(symbols[i - 1] + s, NEVER)
        return symbols, came

    def _merge_heap(self, symbols: list[str], skips: Iterator[int]) -> tuple[list[str], int]:
        """As ``_merge_list`` in n log n steps. An entry is (priority, place of its left symbol, the two symbols'
        lengths); it is stale where one of the symbols has grown or gone since."""
        get, n = self.score.get, len(symbols)
        heap = [(x, i, len(symbols[i]), len(symbols[i + 1])) for i in range(n - 1) if (x := get(symbols[i] + symbols[i + 1])) is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        came, skip = 0, next(skips, -1)
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if j == n or len(symbols[i]) != left or len(symbols[j]) != right:
                continue
            came += 1
            if came - 1 == skip:
                skip = next(skips, -1)
                continue
            s = symbols[i] + symbols[j]
            symbols[i], symbols[j] = s, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (x := get(s + symbols[k])) is not None:
                    heappush(heap, (x, i, len(s), len(symbols[k])))
            h = before[i]
            if h >= 0 and (x := get(symbols[h] + s)) is not None:
                heappush(heap, (x, h, len(symbols[h]), len(s)))
        return [s for s in symbols if s], came

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.raw.__getitem__, ids.tolist())).decode()[1:]


def draws(keys: np.ndarray, number: np.ndarray | int) -> np.ndarray:
    """Keyed hashes, 53 bits each: of a chunk's key and the number of the candidate merge in the chunk."""
    x = keys + (np.atleast_1d(number).astype(np.uint64) + np.uint64(1)) * GOLDEN
    x = (x ^ (x >> np.uint64(30))) * SECOND
    x = (x ^ (x >> np.uint64(27))) * THIRD
    return (x ^ (x >> np.uint64(31))) >> np.uint64(11)


def skipped_numbers(key: np.uint64, least: int) -> Iterator[int]:
    """Numbers of the candidates that are skipped, ascending, a block at a time."""
    at = 0
    while True:
        yield from (np.flatnonzero(draws(np.full(1024, key), np.arange(at, at + 1024)) < least) + at).tolist()
        at += 1024


class Merged:
    """Piece ids of chunks, one after another in ``ids()``, with the place and number of each chunk's."""

    def __init__(self, n: int):
        self.start, self.size, self.came = (np.zeros(n, np.int64) for _ in range(3))
        self.parts: list[np.ndarray] = []
        self.used = 0

    def put(self, rows: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.start[rows] = self.used + np.cumsum(sizes) - sizes
        self.size[rows] = sizes
        self.parts.append(ids)
        self.used += len(ids)

    def ids(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)


def spread(into: np.ndarray, places: np.ndarray, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Copy runs of ``ids`` to where they belong."""
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    into[np.repeat(places, sizes) + within] = ids[np.repeat(starts, sizes) + within]


class PairTable:
    """Ranks and merged ids of adjacent symbols, in an open-addressed table of arrays.

    Symbols are piece ids; a character of a piece that is no piece itself has an id from ``first_extra`` on, any
    other character the negative of its code point less one.
    """

    def __init__(self, model: PieceModel):
        pieces = model.ids
        self.first_extra = len(model.raw)
        extra = sorted({c for p in pieces for c in p} - set(pieces))
        symbol = pieces | {c: self.first_extra + i for i, c in enumerate(extra)}
        self.extra, self.byte_ids = extra, model.byte_ids
        self.width = self.first_extra + len(extra)
        order = {x: i for i, x in enumerate(sorted(set(model.score.values())))}
        made = {}
        for p, i in pieces.items():
            for k in range(1, len(p)):
                if p[:k] in symbol and p[k:] in symbol:
                    made[symbol[p[:k]] * self.width + symbol[p[k:]]] = (order[model.score[p]], i)
        keys = np.fromiter(made, np.int64, len(made))
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int32 if self.width**2 < 2**31 else np.int64)
        # outcomes in order of rank; where ranks differ, the lesser outcome is the better one
        outcomes = sorted(set(made.values()))
        self.rank = np.array([*(r for r, _ in outcomes), 2**31 - 1], np.int32)
        self.merged = np.array([*(i for _, i in outcomes), -1], np.int32)
        self.ranks_differ = len(order) == len(model.score)
        self.last = len(outcomes)  # where no merge is possible
        self.value = np.full(1 << self.bits, self.last, np.int32)
        place = {x: i for i, x in enumerate(outcomes)}
        values = np.array([place[x] for x in made.values()], np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            at, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[at >= 0]
            taken = slot[first]
            self.keys[taken], self.value[taken] = keys[left[first]], values[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)
        self.symbols = -1 - np.arange(0x110000, dtype=np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                self.symbols[ord(c)] = i
        self.symbols[ord(" ")] = symbol.get(SPACE, -1 - ord(SPACE))
        self.symbols[ord(SPACE)] = -1 - ord(SPACE)  # a literal U+2581, told from a space

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Outcome of each pair."""
        key = a.astype(self.keys.dtype) * self.width + b
        key[(a < 0) | (b < 0)] = -2
        slot = self._slot(key)
        met = self.keys[slot]
        rest = np.flatnonzero((met != key) & (met >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
            met = self.keys[slot[rest]]
            rest = rest[(met != key[rest]) & (met >= 0)]
        return self.value[slot]

    def merge(self, chunks: list[str], keys: np.ndarray | None, least: int) -> Merged:
        """Piece ids of each chunk when no candidate is left, and how many candidates came up.

        All chunks go on together, a candidate each at a time: the best, the leftmost of equals. With ``keys`` the
        candidate is skipped where its draw is under ``least``.
        """
        n = np.fromiter(map(len, chunks), np.int64, len(chunks))
        out = Merged(len(chunks))
        flat = self.symbols[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)]
        start = np.cumsum(n) - n
        by_length = np.argsort(n, kind="stable")
        cut = np.searchsorted(n[by_length], [1, 4, 6, 8, 10, 13, 16, max(SHORT, 16)], "right")
        for lo, hi in zip([0, *cut], [*cut, len(chunks)]):  # noqa: B905
            row = by_length[lo:hi]
            if not len(row):
                continue
            width = int(n[row[-1]])
            place = np.arange(width)
            size = n[row].copy()
            s = np.where(place < size[:, None], flat[np.minimum(start[row][:, None] + place, len(flat) - 1)], np.int32(-1))
            at = self.find(s[:, :-1].ravel(), s[:, 1:].ravel()).reshape(len(row), width - 1) if width > 1 else np.full((len(row), 1), self.last, np.int32)
            number = 0
            while len(row):
                i = (at if self.ranks_differ else self.rank[at]).argmin(1)
                every = np.arange(len(row))
                best = at[every, i]
                done = best == self.last
                if done.any():
                    self._finish(out, row[done], s[done], size[done])
                    out.came[row[done]] = number
                    go = ~done
                    row, s, at, size, i, best = row[go], s[go], at[go], size[go], i[go], best[go]
                    if not len(row):
                        break
                    every = np.arange(len(row))
                m = every
                number += 1
                if keys is not None:
                    skip = draws(keys[row], number - 1) < least
                    at[every[skip], i[skip]] = self.last
                    m, i, best = every[~skip], i[~skip], best[~skip]
                    if not len(m):
                        continue
                s[m, i] = self.merged[best]
                after = place[None, :] + (place[None, :] > i[:, None])
                after[:, -1] = width - 1
                s[m] = s[m[:, None], after]
                size[m] -= 1
                s[m, size[m]] = -1
                gone = place[None, :-1] + (place[None, :-1] >= i[:, None])
                gone[:, -1] = width - 2
                at[m] = at[m[:, None], gone]
                at[m, size[m] - 1] = self.last
                side = i + 1 < size[m]
                right, j = m[side], i[side]
                at[right, j] = self.find(s[right, j], s[right, j + 1])
                side = i > 0
                left, j = m[side], i[side]
                at[left, j - 1] = self.find(s[left, j - 1], s[left, j])
        return out

    def _finish(self, out: Merged, row: np.ndarray, s: np.ndarray, size: np.ndarray) -> None:
        inside = np.arange(s.shape[1]) < size[:, None]
        odd = (((s < 0) | (s >= self.first_extra)) & inside).any(1)
        if odd.any():
            own = [self._with_bytes(x[:n]) for x, n in zip(s[odd].tolist(), size[odd].tolist(), strict=True)]
            out.put(row[odd], np.array([i for ids in own for i in ids], np.int32), np.array([len(ids) for ids in own]))
            row, s, size, inside = row[~odd], s[~odd], size[~odd], inside[~odd]
        out.put(row, s[inside], size)

    def _with_bytes(self, symbols: list[int]) -> list[int]:
        """Symbols as ids; characters without a piece become byte pieces."""
        ids = []
        for x in symbols:
            if 0 <= x < self.first_extra:
                ids.append(x)
            else:
                c = self.extra[x - self.first_extra] if x >= 0 else chr(-1 - x)
                ids += [self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")]
        return ids


class Encoder:
    """Encodes texts; keeps what short chunks come to without a skip, up to a bounded number.

    The cache holds what its key gives, so it has no part in which merges are skipped.
    """

    def __init__(self, path: str, seed: int, dropout: float, most: int = 400_000):
        self.model = PieceModel.load(path)
        self.pairs = self.model.pairs()
        self.seed, self.most = seed & (1 << 64) - 1, most
        self.least = round(min(max(dropout, 0.0), 1.0) * 2**53)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.size, self.came = (np.zeros(1 << 14, np.int64) for _ in range(3))

    @staticmethod
    def kept(path: str, seed: int, dropout: float) -> Encoder:
        """The worker process's encoder: the cache of the last settings serves the tasks that follow."""
        return held(("pieces", path, seed, dropout), lambda: Encoder(path, seed, dropout))

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0].tobytes()

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """int32 ids of whole texts, one after another, and where each text's end (a leading 0 before them).

        Every candidate merge of every chunk of a text is skipped or not by a draw of its own, keyed by the seed, the
        text, the chunk's place in the text and the candidate's number in the chunk; so a word is segmented anew at
        each place, and equal texts are segmented alike under one seed."""
        found = [CHUNK.findall(" " + t) if t else [] for t in texts]
        chunks = [c for f in found for c in f]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(counts)
        if not chunks:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        text_keys = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"), self.seed) if t else 0 for t in texts], np.uint64)
        place = np.arange(len(chunks)) - np.repeat(ends - counts, counts)
        keys = draws(np.repeat(text_keys, counts), place)
        slots = self._slots_of(chunks)
        size = np.where(slots >= 0, self.size[slots], 0)
        plain = slots >= 0
        groups = []
        if self.least:
            hit = self._skipping(keys, slots)
            merged = self.pairs.merge([chunks[i] for i in hit.tolist()], keys[hit], self.least)
            size[hit], plain[hit] = merged.size, False
            groups.append((hit, merged.ids(), merged.start))
        long_ = np.flatnonzero(slots < 0)
        own = [np.frombuffer(self.model.encode_chunk(chunks[i], skipped_numbers(keys[i], self.least) if self.least else ())[0], np.int32) for i in long_.tolist()]
        size[long_] = [len(x) for x in own]
        at = np.cumsum(size) - size
        ids = np.empty(int(size.sum()), np.int32)
        rows = np.flatnonzero(plain)
        for rows, source, starts in [(rows, self.ids, self.start[slots[rows]]), *groups]:
            spread(ids, at[rows], source, starts, size[rows])
        for i, x in zip(long_.tolist(), own, strict=True):
            ids[at[i] : at[i] + len(x)] = x
        return ids, np.r_[0, np.cumsum(size)][np.r_[0, ends]]

    def _slots_of(self, chunks: list[str]) -> np.ndarray:
        """Place of each chunk in the cache, into which new ones are put; -1 for long ones."""
        if len(self.slots) >= self.most:
            self._forget()
        new = [c for c in set(chunks).difference(self.slots) if len(c) <= SHORT]
        if new:
            merged = self.pairs.merge(new, None, 0)
            n, k, found = len(self.slots), len(new), merged.ids()
            if n + k > len(self.start):
                self.start, self.size, self.came = (np.concatenate([x, np.zeros(max(len(x), k), np.int64)]) for x in (self.start, self.size, self.came))
            if self.used + len(found) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(found)), np.int32)])
            self.slots.update(zip(new, range(n, n + k), strict=True))
            self.start[n : n + k], self.size[n : n + k], self.came[n : n + k] = merged.start + self.used, merged.size, merged.came
            self.ids[self.used : self.used + len(found)] = found
            self.used += len(found)
        return np.fromiter(map(self.slots.get, chunks, repeat(-1)), np.int64, len(chunks))

    def _skipping(self, keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Short chunks of which some candidate is skipped: up to the first skip they go on as the cached ones do."""
        short = np.flatnonzero(slots >= 0)
        came = self.came[slots[short]]
        owner = np.repeat(short, came)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(came) - came, came)
        hit = owner[draws(keys[owner], number) < self.least]
        return hit[np.r_[True, hit[1:] != hit[:-1]]] if len(hit) else hit


def encode_pieces(docs: DataFrame, *, text_col: str = "text", ids_col: str = "piece_ids", seed: int = 20240229, dropout: float = 0.1, model: str = MODEL) -> DataFrame:
    """All columns of ``docs`` and the array of piece ids of the whole text under the seed.

    Null and empty texts have an empty array (a null text decodes to the empty one). A column that is already
    called ``ids_col`` is replaced. Rows pass one by one, whatever their ids, and repeated ones are encoded alike; texts of any
    length are encoded whole, of candidates of equal rank the leftmost comes first; an empty table gives an empty
    result. ``dropout=0`` is the plain segmentation of the model, ``dropout=1`` skips every merge.
    """
    bounded_batches(docs.sparkSession)
    path = tokenizer_path(model)
    inputs = [c for c in docs.columns if c != ids_col]
    schema = docs.select(*inputs).withColumn(ids_col, F.array().cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()  # what an earlier stage has left
        encoder = Encoder.kept(path, seed, dropout)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                found, ends = encoder.encode_all(rows.column(text_col).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32), pa.int32()), pa.array(found, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in inputs), ids], names=[*inputs, ids_col])
        release_memory()

    return docs.mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, *, ids_col: str = "piece_ids", text_col: str = "decoded", model: str = MODEL, keep_ids: bool = True) -> DataFrame:
    """All columns and the decoded text; null or empty arrays decode to the empty text."""
    path = tokenizer_path(model)
    inputs = [c for c in encoded.columns if c != text_col and (keep_ids or c != ids_col)]
    schema = encoded.select(*inputs).withColumn(text_col, F.lit("").cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel.load(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                rows = batch.slice(lo, 128)
                texts = [pieces.decode(np.array(x.values, copy=False)) if x.is_valid else "" for x in rows.column(ids_col)]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in inputs), pa.array(texts, pa.string())], names=[*inputs, text_col])
        release_memory()

    return encoded.mapInArrow(run, schema)


def op8_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    encoded = encode_pieces(docs).withColumn("n_pieces", F.size("piece_ids").cast("long")).withColumn("ids_hash", F.xxhash64("piece_ids"))
    back = decode_pieces(encoded, keep_ids=False)
    return back.select("doc_id", "n_pieces", "ids_hash", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), (F.col("decoded") == F.col("text")).alias("lossless"))
