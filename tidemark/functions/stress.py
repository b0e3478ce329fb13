"""Stress marks on Russian text as JVM expressions: dictionaries become branches of a plan, no row leaves the engine."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dictionaries import HOMOGRAPHS, NAME_STEMS

_PARTS = r"([\p{L}\p{N}_+-]+|[^\p{L}\p{N}_+-]+)"
_WORD = r"^[\p{L}\p{N}_+-]"
#: Signs around a word of the translator's that do not belong to it.
AROUND = ".,!?…;:—()«»\"'"


def each_word(text: Column, fn: Callable[[Column], Column]) -> Column:
    """The text with ``fn`` of each run of letters, digits, plus signs and hyphens; all between stays."""
    parts = F.regexp_extract_all(text, F.lit(_PARTS), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(F.rlike(p, F.lit(_WORD)), fn(p)).otherwise(p)), "")


def without_marks(text: Column) -> Column:
    return F.replace(text, F.lit("+"), F.lit(""))


def _first_of(branches: list[tuple[Column, Column]], otherwise: Column) -> Column:
    return reduce(lambda rest, b: F.when(b[0], b[1]).otherwise(rest), reversed(branches), otherwise)


def _holds_any(text: Column, stems) -> Column:
    """A quick test of the whole text, so that most rows never walk the branches."""
    return F.rlike(text, F.lit("|".join(stems))) if stems else F.lit(False)


def name_stress(text: Column, stems: dict[str, str] = NAME_STEMS, *, force: bool = False) -> Column:
    """Words that begin with a dictionary stem take its marked form, the longest stem first; endings stay.

    A word that starts with a small letter starts so afterwards. Words that carry a mark stay as they are, unless ``force``
    takes their marks away first, where a stem is found.
    """
    order = sorted(stems, key=len, reverse=True)

    def one(token: Column) -> Column:
        plain = without_marks(token) if force else token
        low = F.lower(plain)
        small = F.rlike(plain, F.lit(r"^\p{Ll}"))
        branches = []
        for stem in order:
            marked = stems[stem]
            start = F.when(small, F.lit(marked[:1].lower() + marked[1:])).otherwise(F.lit(marked))
            branches.append((low.startswith(stem), F.concat(start, F.substring(plain, len(stem) + 1, 2**31 - 1))))
        found = _first_of(branches, token)
        return found if force else F.when(F.contains(token, F.lit("+")), token).otherwise(found)

    return F.when(_holds_any(F.lower(without_marks(text)), order), each_word(text, one)).otherwise(text)


def homographs(text: Column, english: Column, forms: dict[str, list[dict]] = HOMOGRAPHS) -> Column:
    """A form of the list becomes its first variant of which a cue stands in the source text; without one it stays.

    Marked words stay. A capital at the start of the form stays one. Empty cues count for nothing.
    """
    source = F.lower(F.coalesce(english, F.lit("")))

    def one(token: Column) -> Column:
        low = F.lower(token)
        capital = F.rlike(token, F.lit(r"^\p{Lu}"))
        branches = []
        for form, variants in forms.items():
            for v in variants:
                cues = [F.contains(source, F.lit(cue)) for cue in v["en"] if cue]
                if cues:
                    marked = v["marked"]
                    shown = F.when(capital, F.lit(marked[:1].upper() + marked[1:])).otherwise(F.lit(marked))
                    branches.append(((low == form) & reduce(lambda a, b: a | b, cues), shown))
        return _first_of(branches, token)

    return F.when(_holds_any(F.lower(text), list(forms)), each_word(text, one)).otherwise(text)


def _key(word: Column) -> Column:
    return F.lower(F.translate(word, "+ёЁ", "\0еЕ"))


def translator_marks(marked: Column, text: Column) -> Column:
    """Words marked in ``marked`` override the same words of ``text``, whatever their marks there; the last of a word counts."""
    cores = F.transform(F.split(F.coalesce(marked, F.lit("")), r"\s+"), lambda t: F.btrim(t, F.lit(AROUND)))
    own = F.transform(F.filter(cores, lambda c: F.contains(c, F.lit("+"))), lambda c: F.struct(_key(c).alias("key"), c.alias("core")))

    def one(token: Column) -> Column:
        same = F.filter(own, lambda o: o["key"] == _key(token))
        return F.when(F.size(same) > 0, F.get(same, F.size(same) - 1)["core"]).otherwise(token)

    return F.when(F.contains(marked, F.lit("+")), each_word(text, one)).otherwise(text)


def resolve(text: Column, english: Column, *, stems: dict[str, str] = NAME_STEMS, forms: dict[str, list[dict]] = HOMOGRAPHS) -> Column:
    """Names, then homographs, of a text that no accent model has seen."""
    return homographs(name_stress(text, stems), english, forms)


def priority_stack(text: Column, english: Column, accented: Column, *, stems: dict[str, str] = NAME_STEMS, forms: dict[str, list[dict]] = HOMOGRAPHS) -> Column:
    """Stress of a text from four sources, the lowest first: ``accented`` (an accent model's output), the names forced over it,
    homographs with a cue, and the translator's own marks."""
    named = name_stress(accented, stems, force=True)
    told = homographs(without_marks(text), english, forms)
    return translator_marks(text, translator_marks(told, named))
