"""Text expressions: tests, normal forms and measures that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE_END = (".", "!", "?", "…")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ends_sentence(word: Column | str) -> Column:
    return F.right(F.trim(col(word)), F.lit(1)).isin(*SENTENCE_END)


def norm_text(text: Column | str, respell: Callable[[Column], Column] | None = None) -> Column:
    """Without stress marks and anything that is no letter, digit or underscore; lower case, yo as ye.

    ``respell`` goes first, where a dictionary spells names as they are sung: both sides of a comparison take it.
    """
    said = col(text) if respell is None else respell(F.coalesce(col(text), F.lit("")))
    bare = F.lower(F.translate(said, "+ёЁ", "\0еЕ"))
    return F.regexp_replace(bare, r"[^\p{L}\p{N}_]+", "")


def alnum_key(text: Column | str) -> Column:
    return F.regexp_replace(F.lower(col(text)), r"[^\p{L}\p{N}]+", "")


def latin_words(text: Column | str) -> Column:
    """Lower-case letters a-z, digits, apostrophes and single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(col(text)), r"[^a-z0-9' ]+", " "), r" +", " "))


def pace_chars(text: Column | str) -> Column:
    return F.length(F.trim(F.regexp_replace(F.replace(col(text), F.lit("+"), F.lit("")), r"\s+", " "))).cast("long")


def clock(ms: Column | str) -> Column:
    s = F.floor(col(ms) / 1000)
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def plan_span(chars: Column, span_ms: Column, slot_ms: Column, slow: int = 9, fast: int = 13, fill: float = 0.95) -> Column:
    """Planned length in ms: the span held between the fast and slow reading, shortened to fit its slot (null: none)."""
    quick = F.floor(chars * 1000 / fast)
    wanted = F.greatest(quick, F.least(span_ms, F.floor(chars * 1000 / slow)))
    room = F.floor(slot_ms * fill)
    return F.when(slot_ms.isNotNull() & (wanted > room), F.greatest(room, quick)).otherwise(wanted).cast("long")


def budget_flag(chars: Column, span_ms: Column, fast: int = 13) -> Column:
    """SHORT, else LONG, else null."""
    room = span_ms * fast
    return F.when((span_ms >= 1500) & (chars * 10_000 < room * 8), "SHORT").when(chars * 100_000 > room * 115 + 1_000_000, "LONG")


def manifest_hash(speaker: Column, text: Column, reference: Column, pace: str = "pace7") -> Column:
    return F.sha1(F.concat_ws("|", speaker, text, reference, F.lit(pace)).cast("binary"))


# -- numbers in words

# Russian cardinal words.
UNITS = ["ноль", "один", "два", "три", "четыре", "пять", "шесть", "семь", "восемь", "девять", "десять", "одиннадцать", "двенадцать", "тринадцать", "четырнадцать", "пятнадцать", "шестнадцать", "семнадцать", "восемнадцать", "девятнадцать"]
TENS = ["двадцать", "тридцать", "сорок", "пятьдесят", "шестьдесят", "семьдесят", "восемьдесят", "девяносто"]
HUNDREDS = ["сто", "двести", "триста", "четыреста", "пятьсот", "шестьсот", "семьсот", "восемьсот", "девятьсот"]
SCALES = [("тысяча", "тысячи", "тысяч"), ("миллион", "миллиона", "миллионов"), ("миллиард", "миллиарда", "миллиардов")]


def _pick(words, at: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), at.cast("int"))


def number_words(n: Column) -> Column:
    """Words of 0 <= n < 10^12, joined by spaces; a lone thousand drops its "one"."""
    parts = []
    for level in range(3, -1, -1):
        group = F.floor(n / F.lit(1000**level)) % 1000 if level else n % 1000
        last, teen, rest = group % 10, group % 100, group % 100
        unit = F.when(rest < 20, rest).otherwise(last)
        units = _pick([None, "одна", "две", *UNITS[3:]] if level == 1 else [None, *UNITS[1:]], unit)
        if level == 1:
            units = F.when(group != 1, units)
        scale = _pick(SCALES[level - 1], F.when((teen > 10) & (teen < 20) | (last == 0) | (last > 4), 2).when(last == 1, 0).otherwise(1)) if level else F.lit(None)
        words = F.concat_ws(" ", _pick([None, *HUNDREDS], F.floor(group / 100)), F.when(rest >= 20, _pick([None, None, *TENS], F.floor(rest / 10))), units, scale)
        parts.append(F.when(group > 0, words))
    return F.when(n == 0, UNITS[0]).otherwise(F.concat_ws(" ", *parts))


def heard_words(text: Column) -> Column:
    """Comparable words: no stress marks, lower case, yo as ye, digits spelt out (of more than twelve, one by one)."""
    tokens = F.regexp_extract_all(F.translate(F.lower(text), "+ё", "\0е").cast("string"), F.lit("([а-яa-z]+|[0-9]+)"), F.lit(1))
    digits = lambda t: F.array_join(F.transform(F.regexp_extract_all(t, F.lit("([0-9])"), F.lit(1)), lambda d: _pick(UNITS, d)), " ")
    spelt = F.transform(tokens, lambda t: F.when(F.rlike(t, F.lit("^[0-9]{13,}$")), digits(t)).when(F.rlike(t, F.lit("^[0-9]")), number_words(t.cast("long"))).otherwise(t))
    return F.filter(F.split(F.array_join(spelt, " "), " "), lambda w: w != "")
