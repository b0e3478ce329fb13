"""Dictionaries of stressed names, homographs and terms."""

from __future__ import annotations

# Stems of names and rare words with their stressed form.
NAME_STEMS = {
    "ванкувер": "Ванк+увер",
    "мейман": "М+ейман",
    "гельбарт": "Г+ельберт",
    "эрншоу": "+Эрншоу",
    "цейс": "Ц+ейс",
    "фарнсуорт": "Ф+арнсуорт",
    "сарнофф": "С+арнофф",
    "рабинов": "Рабин+ов",
    "михельсон": "Мих+ельсон",
    "технион": "Техни+он",
    "эйндховен": "+Эйндховен",
    "маск": "М+аск",
    "кардиум": "К+ардиум",
    "ликвидметалл": "Ликвидмет+алл",
    "лазер": "л+азер",
    "рубин": "руб+ин",
    "бакелит": "бакел+ит",
    "тефлон": "тефл+он",
    "графен": "граф+ен",
    "мемфис": "М+емфис",
    "стэнфорд": "Ст+энфорд",
    "берлин": "Берл+ин",
    "ютуб": "Ют+уб",
    "кэтлин": "К+этлин",
    "дэн": "Д+эн",
    "дэном": "Д+эном",
    "майк": "М+айк",
    "миша": "М+иша",
    "мише": "М+ише",
    "мишей": "М+ишей",
    "тед": "Т+ед",
    "нобелевск": "н+обелевск",
    "нобель": "Н+обель",
    "нобеля": "Н+обеля",
    "рида-соломона": "Р+ида-Солом+она",
    "рид-соломон": "Р+ид-Солом+он",
    "крео": "Кр+ео",
    "иаг": "И+АГ",
    "амос": "+Амос",
    "фраунгофер": "Фраунг+офер",
    "саймер": "С+аймер",
    "слокам": "Сл+окам",
    "хаммерштейн": "Хаммершт+ейн",
    "мюшет": "Мюш+ет",
    "планкетт": "Пл+анкетт",
    "альтмана": "+Альтмана",
    "кейнс": "К+ейнс",
    "веритазиум": "Веритази+ум",
    "ирншоу": "+Ирншоу",
}

# Homographs, and the cues of the source text by which their variants are told apart, in order.
HOMOGRAPHS = {
    "душе": [{"marked": "д+уше", "en": ["shower"]}, {"marked": "душ+е", "en": ["soul", "heart", "deep down", "at heart"]}],
    "душ": [{"marked": "д+уш", "en": ["shower"]}],
    "стоит": [{"marked": "ст+оит", "en": ["worth", "should", "costs", "cost"]}, {"marked": "сто+ит", "en": ["stands", "standing", "is located", "sits"]}],
    "замок": [{"marked": "з+амок", "en": ["castle"]}, {"marked": "зам+ок", "en": ["lock", "padlock", "latch"]}],
    "замка": [{"marked": "з+амка", "en": ["castle"]}, {"marked": "замк+а", "en": ["lock", "padlock", "latch"]}],
    "мука": [{"marked": "мук+а", "en": ["flour"]}, {"marked": "м+ука", "en": ["torment", "agony", "torture"]}],
    "белки": [{"marked": "белк+и", "en": ["protein", "proteins"]}, {"marked": "б+елки", "en": ["squirrel", "squirrels"]}],
    "орган": [{"marked": "+орган", "en": ["organ ", "body", "agency"]}, {"marked": "орг+ан", "en": ["pipe organ", "organ music"]}],
    "атлас": [{"marked": "+атлас", "en": ["atlas", "map"]}, {"marked": "атл+ас", "en": ["satin"]}],
    "хлопок": [{"marked": "хл+опок", "en": ["cotton"]}, {"marked": "хлоп+ок", "en": ["clap", "pop", "bang"]}],
    "парить": [{"marked": "пар+ить", "en": ["float", "hover", "soar", "glide"]}, {"marked": "п+арить", "en": ["steam"]}],
    "парит": [{"marked": "пар+ит", "en": ["float", "hover", "soar", "glide"]}, {"marked": "п+арит", "en": ["steam"]}],
    "дорога": [{"marked": "дор+ога", "en": ["road", "way", "path"]}, {"marked": "дорог+а", "en": ["dear", "precious", "valuable"]}],
    "уже": [{"marked": "уж+е", "en": ["already", "no longer", "by now"]}, {"marked": "+уже", "en": ["narrower"]}],
    "берегу": [{"marked": "берег+у", "en": ["shore", "bank", "coast"]}],
    "потом": [{"marked": "пот+ом", "en": ["then", "later", "afterwards"]}, {"marked": "п+отом", "en": ["sweat"]}],
    "привод": [{"marked": "пр+ивод", "en": ["drive", "actuator", "motor", "gear", "transmission", "chuck", "motion", "stage", "axis", "axes"]}, {"marked": "прив+од", "en": ["police", "summons", "custody"]}],
    "привода": [{"marked": "пр+ивода", "en": ["drive", "actuator", "motor", "gear", "transmission", "chuck", "motion", "stage", "axis", "axes"]}, {"marked": "прив+ода", "en": ["police", "summons", "custody"]}],
    "приводу": [{"marked": "пр+иводу", "en": ["drive", "actuator", "motor", "gear", "transmission", "chuck", "motion", "stage", "axis", "axes"]}, {"marked": "прив+оду", "en": ["police", "summons", "custody"]}],
    "приводом": [{"marked": "пр+иводом", "en": ["drive", "actuator", "motor", "gear", "transmission", "chuck", "motion", "stage", "axis", "axes"]}, {"marked": "прив+одом", "en": ["police", "summons", "custody"]}],
    "приводе": [{"marked": "пр+иводе", "en": ["drive", "actuator", "motor", "gear", "transmission", "chuck", "motion", "stage", "axis", "axes"]}, {"marked": "прив+оде", "en": ["police", "summons", "custody"]}],
    "приводы": [{"marked": "пр+иводы", "en": ["drive", "actuator", "motor", "gear", "transmission", "chuck", "motion", "stage", "axis", "axes"]}, {"marked": "прив+оды", "en": ["police", "summons", "custody"]}],
    "приводов": [{"marked": "пр+иводов", "en": ["drive", "actuator", "motor", "gear", "transmission", "chuck", "motion", "stage", "axis", "axes"]}, {"marked": "прив+одов", "en": ["police", "summons", "custody"]}],
    "самое": [{"marked": "с+амое", "en": ["same", "most", "itself"]}],
}

# Terms of the source text, the stem that a translation must hold, and what it must not match without.
GLOSSARY = [
    {"pattern": "levitat|\\bfloat(?!ing[- ]point)", "want": "левит", "avoid": "\\bпар+?(и(ть|т|л|шь|м|те|вш)|ящ|я\\b)"},
    {"pattern": "nobel", "want": "нобел", "avoid": "\\bнобелевск"},
]

# Stems that a translation must not hold.
FORBIDDEN = ["нобелевск"]
