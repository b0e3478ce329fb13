"""Stress, splitting and number rules: known cases, and plain Python on random lines."""

import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tidemark.functions import speech, stress, text
from tidemark.functions.dictionaries import FORBIDDEN, GLOSSARY, HOMOGRAPHS, NAME_STEMS
from tidemark.operators import rules
from tidemark.plans import catalogue


def applied(spark, fn, *columns):
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(zip(*columns, strict=True))], "i int, " + ", ".join(f"c{k} string" for k in range(len(columns))))
    return [r[0] for r in rows.orderBy("i").select(fn(*[F.col(f"c{k}") for k in range(len(columns))])).collect()]


def test_translator_marks(spark):
    """TestTranslatorMarks: override, yo, no marks."""
    marked = ["з+амок стоит", "то же с+амое", "просто текст", "«К+от» и к+от, кот+ом", "д+ом дом+а д+Ом"]
    plain = ["зам+ок сто+ит", "т+о же само+ё", "пр+осто т+екст", "Кот, кот и котом", "дом, Дома"]
    assert applied(spark, stress.translator_marks, marked, plain) == ["з+амок сто+ит", "т+о же с+амое", "пр+осто т+екст", "к+от, к+от и кот+ом", "д+Ом, дом+а"]


def test_name_stress(spark):
    """TestNameStress: inflected forms, case, marked tokens, unknown words."""
    lines = ["он жил в Ванкувере", "над Ванкувером", "Ванкувер", "в Ванкув+ере", "обычное предложение без имён", "рида-соломона", None, ""]
    assert applied(spark, stress.name_stress, lines) == ["он жил в Ванк+увере", "над Ванк+увером", "Ванк+увер", "в Ванкув+ере", lines[4], "р+ида-Солом+она", None, ""]
    forced = applied(spark, lambda c: stress.name_stress(c, force=True), ["Гельб+арта и л+азерный", "сто+ит"])
    assert forced == ["Г+ельберта и л+азерный", "сто+ит"]
    assert applied(spark, lambda c: stress.name_stress(c, {"кор": "К+ор", "коринф": "Кор+инф"}), ["Коринфяне и кора, к+орень"]) == ["Кор+инфяне и к+ора, к+орень"]


def test_homographs(spark):
    """TestHomographs: cue, no cue, capital, marked; an empty cue counts for nothing."""
    lines = ["думаешь в душе", "в душе я знал", "этим стоит заниматься", "Стоит попробовать", "сто+ит на столе", "замок", "замок"]
    english = ["you think in the shower", "deep down in my soul I knew", "completely unrelated", "it is worth trying", "worth a lot", None, "the LOCK"]
    assert applied(spark, stress.homographs, lines, english) == ["думаешь в д+уше", "в душ+е я знал", lines[2], "Ст+оит попробовать", lines[4], "замок", "зам+ок"]
    forms = {"дом": [{"marked": "д+ом", "en": [""]}, {"marked": "дом+", "en": ["x"]}]}
    assert applied(spark, lambda a, b: stress.homographs(a, b, forms), ["дом", "дом"], ["any", "x"]) == ["дом", "дом+"]


def test_resolve_and_stack(spark):
    """TestResolve: combined, missing English."""
    lines = ["она живёт в Ванкувере, и об этом стоит подумать в душе", "замок на двери в Ванкувере"]
    english = ["she lives in Vancouver, worth thinking about in the shower", None]
    assert applied(spark, stress.resolve, lines, english) == ["она живёт в Ванк+увере, и об этом ст+оит подумать в д+уше", "замок на двери в Ванк+увере"]
    got = applied(spark, stress.priority_stack, ["Гельбарт сто+ит в душе"], ["in the shower it is worth"], ["Гельб+арт ст+оит в душ+е"])
    assert got == ["Г+ельберт сто+ит в д+уше"]


def naive_words(t, fn):
    return re.sub(r"[\w+-]+", lambda m: fn(m.group()), t)


def test_stack_on_random_lines(spark):
    r = random.Random(4)
    parts = ["Ванкувер", "ванкувером", "сто+ит", "стоит", "Стоит", "душе", "Замок", "ёж", "её", "с+амое", "самоё", "—", "(да)", "2024", "Рида-Соломона", "кот+"]
    lines = [" ".join(r.choice(parts) + r.choice(["", ",", "!"]) for _ in range(8)) for _ in range(120)]
    english = [r.choice(["worth it", "the castle shower", "lock", None, "soul stands"]) for _ in lines]
    accented = [re.sub("([аеиоуыэюя])", lambda m: r.choice(["", "+"]) + m.group(), x.replace("+", "")) for x in lines]
    order = sorted(NAME_STEMS, key=len, reverse=True)

    def named(t):
        def one(w):
            plain = w.replace("+", "")
            stem = next((s for s in order if plain.lower().startswith(s)), None)
            if stem is None:
                return w
            m = NAME_STEMS[stem]
            return (m[0].lower() if plain[0].islower() else m[0]) + m[1:] + plain[len(stem):]

        return naive_words(t, one)

    def told(t, en):
        def one(w):
            v = next((v for v in HOMOGRAPHS.get(w.lower(), []) if any(c and c in (en or "").lower() for c in v["en"])), None)
            return w if v is None else v["marked"][0].upper() + v["marked"][1:] if w[0].isupper() else v["marked"]

        return naive_words(t, one)

    def key(w):
        return w.replace("+", "").replace("ё", "е").replace("Ё", "Е").lower()

    def marks(m, t):
        own = {key(c): c for c in (x.strip(stress.AROUND) for x in m.split()) if "+" in c}
        return naive_words(t, lambda w: own.get(key(w), w))

    want = [marks(x, marks(told(x.replace("+", ""), en), named(a))) for x, en, a in zip(lines, english, accented, strict=True)]
    assert applied(spark, stress.priority_stack, lines, english, accented) == want


def test_dictionaries_are_sound(spark):
    stems = spark.createDataFrame(list(NAME_STEMS.items()), "key string, value string")
    assert rules.stem_findings(stems).where("severity = 'fail'").collect() == []
    variants = [(k, i, v["marked"], v["en"]) for k, vs in HOMOGRAPHS.items() for i, v in enumerate(vs)]
    assert rules.variant_findings(spark.createDataFrame(variants, "key string, ord int, marked string, en array<string>")).collect() == []
    t = spark.createDataFrame([(0, "The Nobel prize", "премия"), (1, "He was floating", "он парит"), (2, "x", "нобелевская премия")], "ord long, en string, ru string")
    terms = [*GLOSSARY, *({"forbid": x} for x in FORBIDDEN)]
    assert sorted((r.ord, r.term[:5]) for r in rules.term_findings(t, terms, source="en", target="ru").collect()) == [(0, "nobel"), (1, "levit"), (2, "nobel"), (2, "нобел")]


LONG_RUSSIAN = (
    "И Мейман был уверен: рубин не просто генерирует — это один из лучших материалов. — Вы его знали? — Он был моим другом до конца. "
    "Так лазер и попал ко мне. И это очень длинная история о том, как всё начиналось в тысяча девятьсот шестидесятом году."
)


@pytest.mark.parametrize("line", ["Видимо, Ванкувер притягивает людей.", LONG_RUSSIAN, "а" * 65 + ", " + "б" * 65, ("очень длинное предложение без точек, " * 4).strip(), "х" * 200, "В+идимо, есть в Ванк+увере чт+о-то волш+ебное. " * 3])
def test_split_single_batch(line):
    """TestSplitSingleBatch: one piece, byte budget, nothing lost, Cyrillic, comma, hard cut, marks."""
    pieces = speech.split_text(line)
    assert all(len(p.encode()) <= 150 for p in pieces)
    assert "".join(pieces).replace(" ", "") == line.replace(" ", "")
    assert len(pieces) == 1 or len(line.encode()) > 150


def test_split_rules():
    assert speech.split_text("") == [] and speech.split_text("   ") == []
    assert speech.split_text("aaaa bbbb cccc", 8) == ["aaaa bbb", "b cccc"]  # a space is no place to cut
    assert speech.split_text("aa, bb cc", 6) == ["aa,", "bb cc"] and speech.split_text("a. b. c.", 5) == ["a. b.", "c."]


def test_numbers_and_heard_words(spark):
    r = random.Random(3)
    numbers = [0, 1, 5, 11, 20, 42, 400, 1000, 1960, 2000, 5000, 21_000, 111_111, 4 * 10**8, 10**9, 999_999_999_999] + [r.randrange(10 ** r.randint(1, 12)) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in numbers], "n long")
    assert {x.n: x.w for x in df.select("n", text.number_words(F.col("n")).alias("w")).collect()} == {x: " ".join(speech.number_words(x)) for x in numbers}
    lines = ["В 2000 г+оду ёж", "x1y22 1234567890123456", "", "Ещё 5,5 — Она!", "no digits"]
    got = applied(spark, lambda c: F.array_join(text.heard_words(c), " "), lines)
    assert got == [" ".join(speech.heard_words(x)) for x in lines]


# -- queries without SQL, against plain Python


DATA = "/root/testdata/sf0.001"


def rows_of(spark, name):
    return [r.asDict() for r in catalogue.QUERIES[name](spark, DATA).collect()]


def test_text_split_query(spark):
    want = {(r.conv_id, r.turn, k): p for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect() if r.text is not None for k, p in enumerate(naive_split(r.text))}
    assert {(r["conv_id"], r["turn"], r["piece"]): r["text"] for r in rows_of(spark, "text_split")} == want


def naive_split(t, limit=150):
    out, held = [], ""
    for part in re.split(r"(?<=[.!?…;]) +", t):
        joined = (held + " " + part).strip()
        if held and len((held + " " + part).encode()) > limit:
            out.append(held)
            joined = part
        held = joined
        while len(held.encode()) > limit:
            k = 0
            while len(held[: k + 1].encode()) <= limit:
                k += 1
            cuts = [i for i in range(1, k) if held[i] in ",—:"]
            k = cuts[-1] + 1 if cuts else k
            out.append(held[:k].strip())
            held = held[k:].strip()
    return [x for x in [*out, held] if x]


def test_script_sim_query(spark):
    said = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect()}
    words = lambda t: re.findall("[а-яa-z]+", t.lower().replace("ё", "е"))
    got = {(r["conv_id"], r["turn"]): r["sim"] for r in rows_of(spark, "script_sim")}
    plain = {k: t for k, t in said.items() if t and not re.search(r"\d", t) and (k[0], k[1] + 1) in said and said[k[0], k[1] + 1] and not re.search(r"\d", said[k[0], k[1] + 1])}
    assert len(plain) > 20
    for (c, t), line in plain.items():
        assert got[c, t] == pytest.approx(SequenceMatcher(None, words(line), words(said[c, t + 1])).ratio(), abs=1e-6)


def folded(spark):
    from tidemark.plans.tracks import _folded

    return [r.asDict() for r in _folded(spark, DATA).collect()]


def test_repeat_audit_query(spark):
    from tidemark.operators.multitrack import FILLERS

    rows = sorted(folded(spark), key=lambda r: (r["media"], r["start_ms"], r["ord"]))
    word = lambda t: [w for w in re.sub("[^a-z0-9 ]", "", t.lower()).split(" ") if w]
    want = {}
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            wa, wb = ([w for w in word(x["text"]) if w not in FILLERS] for x in (a, b))
            if a["media"] != b["media"] or a["speaker"] == b["speaker"] or b["start_ms"] > max(a["end_ms"], a["start_ms"] + 20_000) or min(len(wa), len(wb)) < 2:
                continue
            shared = sum(m.size for m in SequenceMatcher(None, wa, wb, autojunk=False).get_matching_blocks())
            if shared >= 2 and shared >= 0.3 * min(len(wa), len(wb)):
                want[a["media"], a["ord"], b["ord"]] = shared
    assert {(r["media"], r["a"], r["b"]): r["shared"] for r in rows_of(spark, "repeat_audit")} == want and want


def test_repeat_pairs_query(spark):
    from tidemark.plans.timeline import conversation_segments

    rows = [r.asDict() for r in conversation_segments(spark, DATA).collect()]
    word = lambda t: re.sub(" +", " ", re.sub("[^a-z0-9' ]+", " ", t.lower())).strip().split(" ")
    want = {}
    for a in rows:
        for b in rows:
            wa, wb = word(a["text"]), word(b["text"])
            if a["media"] != b["media"] or a["ord"] >= b["ord"] or a["speaker"] == b["speaker"] or None in (a["speaker"], b["speaker"]) or min(len(wa), len(wb)) < 2:
                continue
            if not (a["start_ms"] < b["start_ms"] + 1 and b["start_ms"] < max(a["end_ms"], a["start_ms"] + 60_000)):
                continue
            shared = sum(m.size for m in SequenceMatcher(None, wa, wb, autojunk=False).get_matching_blocks())
            if shared >= 2 and shared >= 0.3 * min(len(wa), len(wb)):
                want[a["media"], a["ord"], b["ord"]] = shared
    assert {(r["media"], r["a"], r["b"]): r["shared"] for r in rows_of(spark, "repeat_pairs")} == want
