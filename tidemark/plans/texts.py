"""Queries of stress marks, numbers in words and heard words, on Russian lines dealt to the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stress, text
from ..functions.dictionaries import HOMOGRAPHS, NAME_STEMS
from .binding import table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def put(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return put


#: Lines with their source: names in several cases, homographs with and without a cue, and translator's marks.
LINES = [
    ("Он жил в Ванкувере, над Ванкувером.", "He lived in Vancouver."),
    ("Думаешь в душе?", "You think in the shower?"),
    ("В душе я знал: Мейман прав", "Deep down Maiman was right"),
    ("Стоит попробовать!", "It is worth trying"),
    ("сто+ит на столе, а Гельбарт стоит", "It costs a lot"),
    ("«Замок» и замок", "A castle and a castle"),
    ("рида-соломона код, Рида-Соломона", "the code"),
    ("Лазерный луч — самое ёмкое, самое-самое", "the laser beam"),
    ("т+о же с+амое, еще раз", "the same again"),
    ("обычное предложение без имён 2024", "plain sentence"),
    ("Мука и мука; белки, орган 12", "flour and proteins and the body"),
]


def _lines(spark, sf) -> DataFrame:
    """(doc_id, ru, en, accented): three lines for each document; the accent model marks each small vowel before a letter."""
    pick = lambda part, at: F.element_at(F.array(*[F.lit(x[part]) for x in LINES]), (at % len(LINES) + 1).cast("int"))
    k = F.col("doc_id")
    places = (k, F.floor(k / len(LINES)), k * 7 + 3)
    joined = lambda part: F.concat_ws(" ", *[pick(part, x) for x in places])
    d = table(spark, sf, "documents").select("doc_id", joined(0).alias("ru"), joined(1).alias("en"))
    return d.withColumn("accented", F.regexp_replace(F.replace("ru", F.lit("+"), F.lit("")), r"([аеиоуыэюя])(\p{L})", "+$1$2"))


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _lines_sql() -> str:
    lists = ["[" + ", ".join(_quoted(x[part]) for x in LINES) + "]" for part in (0, 1)]
    n = len(LINES)
    row = lambda part: "concat_ws(' ', " + ", ".join(f"({lists[part]})[{at} % {n} + 1]" for at in ("doc_id", f"(doc_id // {n})", "(doc_id * 7 + 3)")) + ")"
    return f"l0 AS (SELECT doc_id, {row(0)} AS ru, {row(1)} AS en FROM documents), l AS (SELECT *, regexp_replace(replace(ru, '+', ''), '([аеиоуыэюя])(\\p{{L}})', '+\\1\\2', 'g') AS accented FROM l0)"


def _words_sql(source: str, branch: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({source}, '[\\p{{L}}\\p{{N}}_+-]+|[^\\p{{L}}\\p{{N}}_+-]+'), lambda p: CASE WHEN NOT regexp_matches(p, '^[\\p{{L}}\\p{{N}}_+-]') THEN p {branch} ELSE p END), '')"


def _names_sql(source: str, force: bool = False) -> str:
    plain = "replace(p, '+', '')" if force else "p"
    branch = "" if force else "WHEN contains(p, '+') THEN p "
    for stem in sorted(NAME_STEMS, key=len, reverse=True):
        m = NAME_STEMS[stem]
        branch += f"WHEN starts_with(lower({plain}), {_quoted(stem)}) THEN CASE WHEN regexp_matches({plain}, '^\\p{{Ll}}') THEN {_quoted(m[:1].lower() + m[1:])} ELSE {_quoted(m)} END || substr({plain}, {len(stem) + 1}) "
    return _words_sql(source, branch)


def _homographs_sql(source: str) -> str:
    branch = ""
    for form, variants in HOMOGRAPHS.items():
        for v in variants:
            m, cues = v["marked"], " OR ".join(f"contains(lower(en), {_quoted(c)})" for c in v["en"] if c)
            branch += f"WHEN lower(p) = {_quoted(form)} AND ({cues}) THEN CASE WHEN regexp_matches(p, '^\\p{{Lu}}') THEN {_quoted(m[:1].upper() + m[1:])} ELSE {_quoted(m)} END "
    return _words_sql(source, branch)


def _marks_sql(marked: str, source: str) -> str:
    key = lambda x: f"lower(replace(translate({x}, 'ёЁ', 'еЕ'), '+', ''))"
    own = f"list_filter(list_transform(string_split_regex({marked}, '\\s+'), lambda t: trim(t, {_quoted(stress.AROUND)})), lambda c: contains(c, '+'))"
    return _words_sql(source, f"WHEN len(list_filter({own}, lambda o: {key('o')} = {key('p')})) > 0 THEN list_filter({own}, lambda o: {key('o')} = {key('p')})[-1]")


@query(f"WITH {_lines_sql()} SELECT doc_id, {_names_sql('ru')} AS marked FROM l")
def name_stress(spark, sf):
    return _lines(spark, sf).select("doc_id", stress.name_stress(F.col("ru")).alias("marked"))


@query(f"WITH {_lines_sql()} SELECT doc_id, {_names_sql('accented', True)} AS marked FROM l")
def forced_name_stress(spark, sf):
    return _lines(spark, sf).select("doc_id", stress.name_stress(F.col("accented"), force=True).alias("marked"))


@query(f"WITH {_lines_sql()} SELECT doc_id, {_homographs_sql('ru')} AS marked FROM l")
def homographs(spark, sf):
    return _lines(spark, sf).select("doc_id", stress.homographs(F.col("ru"), F.col("en")).alias("marked"))


@query(f"WITH {_lines_sql()} SELECT doc_id, {_marks_sql('ru', 'accented')} AS marked FROM l")
def translator_marks(spark, sf):
    return _lines(spark, sf).select("doc_id", stress.translator_marks(F.col("ru"), F.col("accented")).alias("marked"))


@query(f"""WITH {_lines_sql()}, a AS (SELECT *, {_names_sql('accented', True)} AS named, {_homographs_sql("replace(ru, '+', '')")} AS told FROM l),
b AS (SELECT *, {_marks_sql('told', 'named')} AS both_ FROM a) SELECT doc_id, {_marks_sql('ru', 'both_')} AS marked FROM b""")
def stress_stack(spark, sf):
    return _lines(spark, sf).select("doc_id", stress.priority_stack(F.col("ru"), F.col("en"), F.col("accented")).alias("marked"))


def _number_sql(n: str) -> str:
    arr = lambda words: "[" + ", ".join(_quoted(w) for w in words) + "]"
    parts = []
    for level in range(3, -1, -1):
        g = f"({n} // {1000**level} % 1000)"
        units = ["одна", "две", *text.UNITS[3:]] if level == 1 else text.UNITS[1:]
        unit = f"(CASE WHEN {g} % 100 < 20 THEN {g} % 100 ELSE {g} % 10 END)"
        lone = f"AND {g} <> 1" if level == 1 else ""
        bits = [f"CASE WHEN {g} >= 100 THEN ({arr(text.HUNDREDS)})[{g} // 100] END", f"CASE WHEN {g} % 100 >= 20 THEN ({arr(text.TENS)})[{g} % 100 // 10 - 1] END", f"CASE WHEN {unit} > 0 {lone} THEN ({arr(units)})[{unit}] END"]
        if level:
            bits.append(f"({arr(text.SCALES[level - 1])})[CASE WHEN {g} % 100 BETWEEN 11 AND 19 OR {g} % 10 = 0 OR {g} % 10 > 4 THEN 3 WHEN {g} % 10 = 1 THEN 1 ELSE 2 END]")
        parts.append(f"CASE WHEN {g} > 0 THEN concat_ws(' ', {', '.join(bits)}) END")
    return f"CASE WHEN {n} = 0 THEN '{text.UNITS[0]}' ELSE concat_ws(' ', {', '.join(parts)}) END"


@query(f"SELECT p_partkey, {_number_sql('(p_partkey * 1000003)')} AS words FROM part")
def num_words(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.number_words(F.col("p_partkey") * 1_000_003).alias("words"))


_DIGITS_SQL = "array_to_string(list_transform(regexp_extract_all(t, '[0-9]'), lambda d: ([" + ", ".join(_quoted(w) for w in text.UNITS[:10]) + "])[CAST(d AS INT) + 1]), ' ')"


@query(f"""WITH d AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(replace(replace(lower(text), '+', ''), 'ё', 'е'), '[а-яa-z]+|[0-9]+'),
  lambda t: CASE WHEN regexp_matches(t, '^[0-9]{{13,}}$') THEN {_DIGITS_SQL} WHEN regexp_matches(t, '^[0-9]') THEN {_number_sql('CAST(t AS BIGINT)').replace('CAST(t AS BIGINT)', 'TRY_CAST(t AS BIGINT)')} ELSE t END), ' ') AS words FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN words = '' THEN 0 ELSE len(string_split(words, ' ')) END AS n_words, words FROM d""")
def qc_words(spark, sf):
    w = text.heard_words(F.col("text"))
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", w.alias("w")).select("doc_id", F.size("w").cast("long").alias("n_words"), F.array_join("w", " ").alias("words"))
