"""Personal data: pattern spans, and more spans from a semi-Markov conditional random field."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import map_rows, table
from .decontaminate import rewrite_text

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "identifier", "name", "address")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can't begin inside a run of digits: had it begun earlier it would have taken them, and none ends before a digit.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str | None) -> list[Span]:
    """The contract's pattern matches, leftmost and non-overlapping for each kind; failing ones are dropped.

    E-mail addresses are sought from their ``@``, outwards, so that long runs of letters cost linear time.
    """
    if not text:
        return []
    out: list[Span] = []
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (p.lstrip("0") for p in m.group().split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


# -- the field: tokens are cut into segments, each with a kind or none; a segment is scored whole

#: Longest entity in tokens.
MOST_TOKENS = 9
#: Longest span whose features are kept, which bounds the bytes of the cache.
KEPT = 64
#: A run without quotes and brackets, or one of those; full stops and the like at its end, and a name before its = or :, are
#: tokens of their own (see ``tokens``).
_TOKEN = re.compile(r"[^\s\"'<>{}\[\]()]+|[\"'<>{}\[\]()]")
_PAIR = re.compile(r"(?:[^\W\d][\w-]*(?=:)|[^\s=]+(?==))")
_STOPS = ",;.:!?"
#: No entity holds these tokens, nor a line break.
_BARS = frozenset("\"'<>{}[],;!?=")
_WORDY = re.compile(r"[^\W\d_]+")
_TITLED = re.compile(r"[^\W\d_][\w'’-]*(?: [^\W\d_][\w'’-]*\.?)*")
_HEX = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_ACCOUNT = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?")
#: Words that name a secret, titles before a name, and words of a street.
_NAMES = re.compile(r"(?i)(?:[a-z0-9]*[_-])?(?:passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth|authorization|bearer|credential)s?")
_TITLES = frozenset(["mr", "mrs", "ms", "miss", "dr", "prof", "sir", "madam", "herr", "frau", "monsieur", "madame", "señor", "señora"])
_LINKS = frozenset(["de", "du", "des", "la", "of", "the"])
_INNER = re.compile(r"[.:]\s")
_STREET = re.compile(r"(?i)\b(?:street|st|road|rd|avenue|ave|lane|ln|drive|boulevard|blvd|court|square|rue|calle|avenida|\w*stra(?:ß|ss)e|\w*gasse|\w*platz|\w*weg|\w*allee)\b")


def tokens(text: str, start: int = 0, stop: int | None = None) -> list[tuple[int, int]]:
    """Places of the tokens of a text, or of a part that begins and ends at white space, in time linear in its length."""
    out: list[tuple[int, int]] = []
    for m in _TOKEN.finditer(text, start, len(text) if stop is None else stop):
        lo, hi = m.span()
        if m := _PAIR.match(text, lo, hi):
            out += [m.span(), (m.end(), m.end() + 1)]
            lo = m.end() + 1
        end = hi
        while end > lo and text[end - 1] in _STOPS:
            end -= 1
        if lo < end:
            out.append((lo, end))
        if end < hi:
            out.append((end, hi))
    return out


_DIGIT, _DIGITS = re.compile(r"[\d@]"), re.compile(r"[\d@]+")


def left_of(words: list[str], i: int) -> str:
    """What stands before token ``i``: the name of a secret, a title, a quote, or something else."""
    k = i - 1
    if k >= 0 and words[k] in "\"'" and words[k]:
        k -= 1
    quoted = k < i - 1
    if k >= 0 and words[k] in (":", "=", ":=", "->"):
        if k >= 1 and _NAMES.fullmatch(words[k - 1]):
            return "after name"
        if k >= 2 and words[k - 1] in "\"'" and _NAMES.fullmatch(words[k - 2]):
            return "after name"
        return "after sign"
    if k >= 0 and words[k].lower() == "bearer":
        return "after name"
    if k >= 0 and words[k].lower() in _TITLES or k >= 1 and words[k] == "." and words[k - 1].lower() in _TITLES:
        return "after title"
    return "after quote" if quoted else "after other"


def _marked(word: str, left: str) -> bool:
    return left in ("after name", "after title") or bool(_DIGIT.search(word))


#: A part of every name of a secret; one of them or a title is where a mark without a digit comes from.
_HINTS = ("passw", "passphrase", "pwd", "secret", "token", "api", "access", "auth", "bearer", "credential")


def marks(text: str) -> list[tuple[int, int]]:
    """Places, ascending, around which marked tokens may be: digits, at signs, names of secrets and titles."""
    out = [m.span() for m in _DIGITS.finditer(text)]
    lower = text.lower()
    if len(lower) != len(text):  # a letter whose small form has two code points
        lower = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
    for hint in (*_HINTS, *_TITLES):
        at = lower.find(hint)
        while at >= 0:
            end = at + len(hint)
            if hint not in _TITLES or not (lower[at - 1 : at].isalnum() or lower[end : end + 1].isalnum()):
                out.append((at, end))
            at = lower.find(hint, end)
    return sorted(out)


def regions(text: str, chunks: int = MOST_TOKENS + 4) -> list[list[int]]:
    """Parts of the text, cut at white space, that hold all that may bear a mark and so many chunks on both sides."""
    out: list[list[int]] = []
    size = len(text)
    for start, hi in marks(text):
        floor = out[-1][1] if out else 0
        for _ in range(chunks):
            hi = text.find(" ", hi + 1)
            if hi < 0:
                hi = size
                break
        lo = start
        for _ in range(chunks):
            if lo <= floor:
                break
            lo = text.rfind(" ", floor, lo)
        if out and lo <= floor:
            out[-1][1] = max(hi, floor)
        else:
            out.append([max(lo, 0), hi])
        if out[-1][1] == size:
            break
    return out


def stretches(text: str, span: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[str], list[bool]]]:
    """(first token, end, left contexts, marks) of the runs of tokens that an entity may reach.

    An entity holds a marked token, one with a digit or an at sign or one after a secret's name or a title; so tokens
    from which none is within ``MOST_TOKENS`` are outside every entity, and the best cut of the runs is that of the
    whole text.
    """
    words = [text[a:b] for a, b in span]
    left = [left_of(words, k) for k in range(len(words))]
    marked = [_marked(w, x) for w, x in zip(words, left, strict=True)]
    out: list[list[int]] = []
    for k in (k for k, x in enumerate(marked) if x):
        lo, hi = max(k - MOST_TOKENS + 1, 0), min(k + MOST_TOKENS, len(span))
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    for lo, hi in out:
        yield lo, hi, left[lo:hi], marked[lo:hi]


def segments(text: str, span: list[tuple[int, int]], marked: list[bool]) -> Iterator[tuple[int, int]]:
    """Places (i, j) of the candidate entities of a run, by their end: of bounded length, with a mark, on one line."""
    barred = [text[a:b] in _BARS for a, b in span]
    broken = [k > 0 and "\n" in text[span[k - 1][1] : span[k][0]] for k in range(len(span))]
    for j in range(1, len(span) + 1):
        some = False
        for i in range(j - 1, max(j - MOST_TOKENS, 0) - 1, -1):
            if barred[i]:
                break
            some = some or marked[i]
            if some:
                yield i, j
            if broken[i]:
                break


def shape_features(s: str) -> tuple[str, ...]:
    """Features of a whole candidate span."""
    return _kept_features(s) if len(s) <= KEPT else _features(s)


def _features(s: str) -> tuple[str, ...]:
    n = len(s)
    digits = sum(c.isdecimal() for c in s)
    upper = sum(c.isupper() for c in s)
    lower = sum(c.islower() for c in s)
    solid = not any(c.isspace() for c in s)
    out = [f"length:{min(n.bit_length(), 8)}", f"digits:{round(4 * digits / n)}", f"solid:{solid}", f"edges:{s[0].isalnum() or s[0] == '+'}:{s[-1].isalnum()}"]
    if _WORDY.fullmatch(s):
        out.append("word")
    if s[0].isupper() and not digits and _TITLED.fullmatch(s):
        words = s.split()
        out.append(f"capitalised:{all(w[0].isupper() for w in words)}:{min(len(words), 4)}")
    if solid and digits and upper and not lower:
        out.append(f"capitals and digits:{min(n // 8, 4)}")
    if solid and n >= 16 and _HEX.fullmatch(s):
        out.append(f"hex:{min(n // 8, 8)}:{bool(digits) and digits < n}")
    if solid and digits and upper + lower and n >= 12:
        bits = -sum(k / n * math.log2(k / n) for k in Counter(s).values())
        out.append(f"mixed:{int(bits)}")
    if digits and not solid and _STREET.search(s):
        words = s.split()
        out.append(f"street:{s[0].isdigit()}:{s[-1].isdigit()}:{min(len(words), 6)}")
        loose = sum(not (w[0].isupper() or w.isdigit() or _STREET.fullmatch(w) or w in _LINKS) for w in words)
        ends = ["number" if w.isdigit() else "street" if _STREET.fullmatch(w) else "link" if w in _LINKS else "large" if w[0].isupper() else "other" for w in (words[0], words[-1])]
        out += [f"street words:{min(loose, 2)}", "street ends:" + ":".join(ends)]
    if not solid and _INNER.search(s):
        out.append("stop inside")
    if not solid and digits:
        out.append(f"first digits:{s[0].isdigit()}:{s[-1].isdigit()}:{min(digits // 4, 6)}")
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", s):
        out.append("3-2-4")
    if _ACCOUNT.fullmatch(s):
        out.append("account")
    if "@" in s:
        out.append("at")
    if _PHONE.fullmatch(s):
        out.append("phone form")
    if _IP.fullmatch(s):
        out.append("address form")
    if digits >= 16 and _CARD.fullmatch(s) and digits <= 19:
        out.append(f"card form:{luhn(_NOT_DIGIT.sub('', s))}")
    return tuple(out)


_kept_features = lru_cache(maxsize=20_000)(_features)


def segment_features(s: str, left: str, n: int) -> tuple[str, ...]:
    """Of the span, of what stands before it, of both, and of its number of tokens."""
    shape = shape_features(s)
    word = "word" if "word" in shape else "value"
    return (*shape, left, f"{left}:{word}:{min(len(s), 6) if word == 'word' else 0}", *(f"{left}:{f}" for f in shape if f.startswith("capitalised")), f"tokens:{n}")


N_STATES = len(KINDS) + 1  # none is state 0


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = np.maximum(x.max(axis), -1e30)
    return np.log(np.maximum(np.exp(x - np.expand_dims(top, axis)).sum(axis), 1e-300)) + top


def forward_backward(score: np.ndarray, follows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log partition sums (b), and the probabilities of the segments (as ``score``) and of the steps (b, boundary, state, state).

    ``score`` (b, end, length in tokens less one, kind) is minus infinity where there is no candidate. A token outside
    every entity is a segment of its own with score 0; ``follows`` (state, state) scores neighbours.
    """
    b, n, most, kinds = score.shape
    low = -1e30
    score = np.maximum(score, low)
    alpha, entered = np.full((b, n + 1, kinds + 1), low), np.full((b, n + 1, kinds + 1), low)
    alpha[:, 0, 0] = 0
    for j in range(n + 1):
        if j:
            alpha[:, j, 0] = entered[:, j - 1, 0]
            m = min(j, most)
            alpha[:, j, 1:] = log_sum(entered[:, j - m : j, 1:][:, ::-1] + score[:, j - 1, :m], 1)
        entered[:, j] = log_sum(alpha[:, j, :, None] + follows, 1)
    z = log_sum(alpha[np.arange(b), length], 1)
    beta, rest = np.full((b, n + 1, kinds + 1), low), np.full((b, n + 1, kinds + 1), low)
    for j in range(n, -1, -1):
        if j < n:
            rest[:, j, 0] = beta[:, j + 1, 0]
            m = min(most, n - j)
            ahead = np.stack([score[:, j + d, d] + beta[:, j + d + 1, 1:] for d in range(m)], 1)
            rest[:, j, 1:] = log_sum(ahead, 1)
            beta[:, j] = log_sum(follows[None] + rest[:, j, None, :], 2)
        beta[length == j, j] = 0
        rest[length <= j, j] = low
    inside = np.full(score.shape, low)
    for j in range(1, n + 1):
        m = min(j, most)
        inside[:, j - 1, :m] = entered[:, j - m : j, 1:][:, ::-1] + score[:, j - 1, :m] + beta[:, j, None, 1:]
    steps = alpha[:, :, :, None] + follows + rest[:, :, None, :]
    return z, np.exp(np.minimum(inside - z[:, None, None, None], 0)), np.exp(np.minimum(steps - z[:, None, None, None], 0))


@dataclass
class SemiMarkov:
    """A semi-Markov conditional random field: weights of (feature, kind) and of neighbouring states."""

    weights: dict[str, tuple[float, ...]]
    follows: list[list[float]]

    def __post_init__(self) -> None:
        self._scores: dict[tuple[str, str, int], tuple[float, ...]] = {}

    def __getstate__(self) -> tuple:
        return self.weights, self.follows

    def __setstate__(self, state: tuple) -> None:
        self.weights, self.follows = state
        self._scores = {}

    def score(self, s: str, left: str, n: int) -> tuple[float, ...]:
        """Of a candidate span as each kind."""
        key = (s, left, n)
        found = self._scores.get(key)
        if found is None:
            rows = [w for f in segment_features(s, left, n) if (w := self.weights.get(f))]
            found = tuple(map(sum, zip(self.weights["bias"], *rows, strict=True)))
            if len(s) <= KEPT:
                if len(self._scores) >= 20_000:
                    self._scores.clear()
                self._scores[key] = found
        return found

    def best_cut(self, text: str, span: list[tuple[int, int]], left: list[str], marked: list[bool]) -> list[tuple[str, int, int]]:
        """(kind, first token, last token + 1) of the entities of the best cut of a run.

        Of equal cuts the one wins whose last differing segment is outside every entity, then shorter, then of the
        kind listed first.
        """
        n, follows = len(span), self.follows
        low = -math.inf
        best = [[low] * N_STATES for _ in range(n + 1)]
        came: list[list[tuple[int, int]]] = [[(-1, 0)] * N_STATES for _ in range(n + 1)]
        enter: list[list[tuple[float, int]]] = []
        best[0][0] = 0.0
        by_end: dict[int, list[int]] = {}
        for i, j in segments(text, span, marked):
            by_end.setdefault(j, []).append(i)
        for j in range(n + 1):
            if j:
                best[j][0], before = enter[j - 1][0]
                came[j][0] = (j - 1, before)
                for i in by_end.get(j, ()):
                    own = self.score(text[span[i][0] : span[j - 1][1]], left[i], j - i)
                    for k in range(1, N_STATES):
                        total = enter[i][k][0] + own[k - 1]
                        if total > best[j][k]:
                            best[j][k] = total
                            came[j][k] = (i, enter[i][k][1])
            row = best[j]
            live = [s for s in range(N_STATES) if row[s] > low]
            enter.append([max(((row[s] + follows[s][k], -s) for s in live)) for k in range(N_STATES)])
            enter[-1] = [(p, -s) for p, s in enter[-1]]
        out = []
        j, k = n, max(range(N_STATES), key=lambda s: (best[n][s], -s))
        while j > 0:
            i, before = came[j][k]
            if k:
                out.append((KINDS[k - 1], i, j))
            j, k = i, before
        return out[::-1]

    def decode(self, text: str) -> list[Span]:
        """The entities of the best cut of the whole text."""
        out = []
        for start, stop in regions(text):
            span = tokens(text, start, stop)
            for lo, hi, left, marked in stretches(text, span):
                out += [(kind, span[lo + i][0], span[lo + j - 1][1]) for kind, i, j in self.best_cut(text, span[lo:hi], left, marked)]
        return out

    @staticmethod
    def learn(examples: list[tuple[str, list[Span]]], rounds: int = 60, step: float = 0.4, prior: float = 0.02) -> SemiMarkov:
        """Penalised maximum likelihood by full-batch ascent with steps scaled by past gradients."""
        kinds = {k: i for i, k in enumerate(KINDS)}
        ids: dict[str, int] = {"bias": 0}
        cells, rows, cols, gold, lengths, steps = [], [], [], [], [], np.zeros((N_STATES, N_STATES))
        for e, (text, truth) in enumerate(examples):
            span = tokens(text)
            words = [text[a:b] for a, b in span]
            left = [left_of(words, k) for k in range(len(span))]
            marked = [_marked(w, x) for w, x in zip(words, left, strict=True)]
            wanted = {(a, b): kinds[kind] for kind, a, b in truth}
            lengths.append(len(span))
            ends: dict[int, tuple[int, int]] = {}
            for i, j in segments(text, span, marked):
                kind = wanted.get((span[i][0], span[j - 1][1]), -1)
                if kind >= 0:
                    ends[j] = (i, kind + 1)
                for f in ("bias", *segment_features(text[span[i][0] : span[j - 1][1]], left[i], j - i)):
                    rows.append(len(cells))
                    cols.append(ids.setdefault(f, len(ids)))
                cells.append((e, j - 1, j - i - 1))
                gold.append(kind)
            states, j = [], len(span)
            while j > 0:
                j, state = ends.get(j, (j - 1, 0))
                states.append(state)
            for before, state in zip([0, *states[::-1]], states[::-1]):  # noqa: B905
                steps[before, state] += 1
        at = tuple(np.array(cells).T)
        rows_, cols_ = np.array(rows), np.array(cols)
        starts = np.r_[0, np.flatnonzero(np.diff(rows_)) + 1]
        order = np.argsort(cols_, kind="stable")
        groups = np.r_[0, np.flatnonzero(np.diff(cols_[order])) + 1]
        length = np.array(lengths)
        truth_ = np.zeros((len(cells), len(KINDS)))
        known = np.array(gold) >= 0
        truth_[known, np.array(gold)[known]] = 1
        w, t = np.zeros((len(ids), len(KINDS))), np.zeros((N_STATES, N_STATES))
        past_w, past_t = np.zeros_like(w), np.zeros_like(t)
        for _ in range(rounds):
            score = np.full((len(examples), length.max(), MOST_TOKENS, len(KINDS)), -1e30)
            score[at] = np.add.reduceat(w[cols_], starts, axis=0)
            _, inside, passed = forward_backward(score, t, length)
            miss = (truth_ - inside[at])[rows_[order]]
            grad_w = np.add.reduceat(miss, groups, axis=0) - prior * w
            grad_t = steps - passed.sum((0, 1)) - prior * t
            grad_t[0, 0] = 0  # the score of staying outside is the zero of all others
            past_w += grad_w**2
            past_t += grad_t**2
            w += step * grad_w / np.sqrt(past_w + 1e-8)
            t += step * grad_t / np.sqrt(past_t + 1e-8)
        return SemiMarkov({f: tuple(w[i].tolist()) for f, i in ids.items()}, t.tolist())


def made_examples(n: int = 500, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Sentences of invented words with planted values of each kind, and look-alikes that are none."""
    r = random.Random(seed)
    letters, hexes = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
    small = lambda: "".join(r.choice(letters) for _ in range(r.randint(1, 10)))
    large = lambda: small().capitalize()
    word = lambda: large() if r.random() < 0.2 else small()
    number = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    mixed = lambda k: "".join(r.choice(letters + letters.upper() + "0123456789") for _ in range(k))

    def card() -> str:
        body = "4" + number(14)
        full = next(body + d for d in "0123456789" if luhn(body + d))
        return r.choice([full, " ".join(full[i : i + 4] for i in range(0, 16, 4)), "-".join(full[i : i + 4] for i in range(0, 16, 4))])

    def secret() -> tuple[str, str]:
        x = r.random()
        if x < 0.6:
            name = r.choice(["password", "passwd", "secret", "token", "api_key", "Password", "PASSWORD", "db_password", "client-secret", "pwd", "access_key"])
            value = r.choice([lambda: "".join(r.choice(hexes) for _ in range(r.randint(8, 40))), lambda: small() + small(), lambda: mixed(r.randint(6, 30)), small, lambda: small() + number(2)])()
            return name + r.choice(["=", ":", ": ", " = ", ' = "', ': "', "='"]), value
        if x < 0.7:
            return r.choice(["Authorization: Bearer ", "Bearer ", "bearer "]), mixed(r.randint(12, 40))
        return "", "".join(r.choice(hexes) for _ in range(r.choice([32, 40, 64]))) if x < 0.85 else r.choice(["AKIA", "ASIA"]) + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))

    def address() -> str:
        street = r.choice(["Street", "St", "Road", "Rd", "Avenue", "Ave", "Lane", "Drive", "Boulevard", "Court", "Square"])
        return r.choice([
            f"{number(r.randint(1, 4))} {large()} {street}", f"{number(r.randint(1, 3))} {large()} {large()} {street}", f"{large()}{r.choice(['straße', 'strasse', 'gasse', 'platz', 'weg', 'allee'])} {number(r.randint(1, 3))}",
            f"{number(r.randint(1, 3))} rue {r.choice(['', 'de ', 'du '])}{large()}", f"{r.choice(['Calle', 'Avenida', 'calle'])} {large()} {number(r.randint(1, 3))}",
        ])

    def account() -> str:
        gap = r.choice([" ", " ", ""])
        groups = [number(4) for _ in range(r.randint(3, 6))] + [number(r.randint(1, 3))] * r.randint(0, 1)
        return gap.join([r.choice(["DE", "FR", "ES", "IT", "PL"]) + number(2), *groups])

    makers = {
        "email": lambda: ("", f"{small()}.{number(2)}@{small()}{r.randint(0, 9)}.{r.choice(['com', 'org', 'example.com'])}"),
        "ip": lambda: ("", ".".join(str(r.randint(1, 254)) for _ in range(4))),
        "card": lambda: ("", card()),
        "phone": lambda: ("", f"+{r.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}" if r.random() < 0.6 else f"+{number(2)} {number(3)} {number(7)}"),
        "secret": secret,
        "identifier": lambda: ("", f"{number(3)}-{number(2)}-{number(4)}" if r.random() < 0.4 else account()),
        "name": lambda: (r.choice(["Mr. ", "Mrs. ", "Ms. ", "Dr. ", "Prof. ", "Mr ", "Mrs ", "Dr ", "Herr ", "Frau ", "Madame "]), " ".join(large() for _ in range(r.randint(1, 3)))),
        "address": lambda: ("", address()),
    }
    decoys = [
        lambda: number(r.randint(1, 8)), lambda: f"{number(4)}-{number(2)}-{number(2)}", lambda: f"{number(2)}:{number(2)}", lambda: f"{small()}={small()}", lambda: f"{number(2)}.{number(2)}", lambda: f"{word()}{number(2)}",
        lambda: "$" + number(3), lambda: number(12), lambda: f"page={number(2)}", lambda: " ".join(number(r.randint(1, 5)) for _ in range(r.randint(2, 9))), lambda: number(16), lambda: f"{large()} {number(2)}", lambda: f"{number(2)} {large()}",
        lambda: f"{number(2)} {large()} {large()}", lambda: f"{small()}: {small()}", lambda: f"the {r.choice(['password', 'token', 'secret'])} {small()}", lambda: r.choice(["mr", "Dr", "Miss"]) + " " + small(), lambda: f"{large()} {large()}", lambda: f"{r.choice(['Street', 'Road', 'Weg'])} {small()}",
        lambda: f"{number(1)}.", lambda: f"{number(4)}, {number(2)}",
    ]
    out = []
    for _ in range(n):
        text, gold = "", []
        for _ in range(r.randint(2, 8)):
            text += " " * bool(text)
            x = r.random()
            if x < 0.4:
                kind = r.choice([*makers, "secret"])
                before, value = makers[kind]()
                quote = before[-1] if before[-1:] in "\"'" and before else ""
                text += before
                gold.append((kind, len(text), len(text) + len(value)))
                text += value + quote + r.choice(["", "", ".", ","])
                if kind in ("name", "address"):  # a capitalised word after it could be one more of its words
                    text += " " + small()
            else:
                text += (r.choice(decoys)() if x < 0.65 else word()) + r.choice(["", "", "", "."])
        out.append((text, gold))
    return out


@lru_cache(maxsize=1)
def default_field() -> SemiMarkov:
    return SemiMarkov.learn(made_examples())


def all_spans(text: str | None, field: SemiMarkov) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: the base ones and those of the field that overlap none of them."""
    base = base_spans(text)
    found: list[Span] = []
    if text:
        found = field.decode(text)
    if found:
        taken = sorted((a, b) for _, a, b in base)
        kept, k, reach = [], 0, -1
        for kind, a, b in sorted(found, key=lambda s: s[1]):
            while k < len(taken) and taken[k][0] < b:
                reach = max(reach, taken[k][1])
                k += 1
            if reach <= a:
                kept.append((kind, a, b))
        found = kept
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + found, key=lambda s: (order[s[0]], s[1]))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", field: SemiMarkov | None = None) -> DataFrame:
    """doc_id, kinds, starts, ends and is_base (parallel arrays, by kind as listed, then start) of each whole text.

    Offsets are code points, ends exclusive. The field is trained on made sentences when none is given; it cuts the
    whole text, and its spans are added where they overlap no base span. Its entities hold at most nine tokens, one of
    them with a digit or ``@``, or after the name of a secret or a title, all on one line. Of equally good cuts the one
    with fewer tokens in entities wins. Null and empty texts have no spans; texts of any length are read whole; rows
    with null or repeated ids are kept one by one; other columns are ignored; an empty table gives an empty result.
    """
    field = field or default_field()
    order = {k: i for i, k in enumerate(KINDS)}
    from pyspark.sql import functions as F

    def find(doc_id, text):
        out: dict = {"doc_id": doc_id, "kinds": [], "starts": [], "ends": [], "is_base": []}
        for t in text:
            base, spans = all_spans(t, field)
            known = set(base)
            out["kinds"].append([order[k] for k, _, _ in spans])
            out["starts"].append([a for _, a, _ in spans])
            out["ends"].append([b for _, _, b in spans])
            out["is_base"].append([int(s in known) for s in spans])
        return out

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = map_rows(rows, find, "doc_id long, kinds array<int>, starts array<long>, ends array<long>, is_base array<int>", 128)
    names = F.array(*[F.lit(k) for k in KINDS])
    return found.withColumn("kinds", F.transform("kinds", lambda k: F.get(names, k)))


def redact(docs: DataFrame, *, text_col: str = "text", field: SemiMarkov | None = None) -> DataFrame:
    """All rows and columns; each span of the text is replaced by its kind in angle brackets.

    Overlapping spans are replaced as one, by the kind of the one that starts first (then the longer). Null and empty
    texts stay as they are, repeated rows are redacted alike, an empty table gives an empty result.
    """
    field = field or default_field()

    def clean(text: str | None) -> tuple[str | None, bool]:
        spans = sorted(all_spans(text, field)[1], key=lambda s: (s[1], -s[2]))
        out, at = [], 0
        for kind, a, b in spans:
            if a >= at:
                out += [text[at:a], f"<{kind}>"]
            at = max(at, b)
        return "".join(out) + text[at:] if spans else text, True

    return rewrite_text(docs, clean, docs.schema, text_col)


def span_string(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    found = find_pii(table(spark, sf_dir, "documents"))
    rows = found.select("doc_id", F.arrays_zip("kinds", "starts", "ends", "is_base").alias("s"))
    text = lambda x: F.concat_ws(":", x["kinds"], x["starts"].cast("string"), x["ends"].cast("string"))
    base = F.filter("s", lambda x: x["is_base"] == 1)
    of = lambda kind: F.size(F.filter(base, lambda x: x["kinds"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of(kind) for kind in BASE]
    return rows.select(
        "doc_id", *counts, F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"), F.array_join(F.transform("s", text), ",").alias("spans"),
    )


def base_digest(text: str | None) -> str:
    return hashlib.sha256(span_string(base_spans(text)).encode()).hexdigest()
