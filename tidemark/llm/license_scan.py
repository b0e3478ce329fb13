"""Licence detection: sentences become identifiers, identifier sequences are matched against ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Published licence sentences and usual notices, in normalised form, with their identifiers.
SENTENCES = [
    ("mit.title", "mit license"),
    ("mit.title", "the mit license"),
    ("mit.title", "the mit license mit"),
    ("mit.notice", "released under the mit license"),
    ("mit.notice", "licensed under the mit license"),
    ("mit.notice", "this project is licensed under the mit license"),
    ("mit.notice", "distributed under the mit license"),
    ("mit.grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit.grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit.condition", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("asis.warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("asis.warranty", "the software is provided as is without warranty of any kind express or implied"),
    ("mit.liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc.title", "isc license"),
    ("isc.grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache2.title", "apache license version 2 0 january 2004"),
    ("apache2.title", "apache license version 2 0 january 2004 http www apache org licenses"),
    ("apache2.title", "apache license version 2 0 january 2004 https www apache org licenses"),
    ("apache2.terms", "terms and conditions for use reproduction and distribution"),
    ("apache2.notice", "licensed under the apache license version 2 0"),
    ("apache2.notice", "licensed under the apache license version 2 0 the license"),
    ("apache2.notice", "released under the apache license version 2 0"),
    ("apache2.comply", "you may not use this file except in compliance with the license"),
    ("apache2.copy", "you may obtain a copy of the license at"),
    ("apache2.copy", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache2.asis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache2.see", "see the license for the specific language governing permissions and limitations under the license"),
    ("bsd2.title", "bsd 2 clause license"),
    ("bsd3.title", "bsd 3 clause license"),
    ("bsd.redistribute", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd.source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd.binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd.endorse", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd.disclaimer", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("gpl2.title", "gnu general public license version 2 june 1991"),
    ("gpl3.title", "gnu general public license version 3 29 june 2007"),
    ("lgpl21.title", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl3.title", "gnu lesser general public license version 3 29 june 2007"),
    ("agpl3.title", "gnu affero general public license version 3 19 november 2007"),
    ("gnu.verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl3.notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl3.notice", "licensed under the gnu general public license version 3"),
    ("gnu.free", "this program is free software"),
    ("gpl2.later", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl3.later", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl3.later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl3.later", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl21.later", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl3.later", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl.hope", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl.implied", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl.hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("mpl2.title", "mozilla public license version 2 0"),
    ("mpl2.notice", "this source code form is subject to the terms of the mozilla public license v"),
    ("unlicense.notice", "this is free and unencumbered software released into the public domain"),
    ("bsl1.title", "boost software license version 1 0 august 17th 2003"),
    ("bsl1.notice", "distributed under the boost software license version 1 0"),
    ("zlib.warranty", "this software is provided as is without any express or implied warranty"),
    ("zlib.grant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("ccbync4.notice", "licensed under cc by nc 4 0"),
    ("ccbysa4.notice", "licensed under cc by sa 4 0"),
    ("ccbysa4.notice", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("ccby4.notice", "licensed under cc by 4 0"),
    ("ccby4.notice", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0.notice", "this work is released under cc0 1 0"),
    ("arr.notice", "all rights reserved"),
]
#: Sentences with a name in the middle: (identifier, beginning, ending), in normalised form.
FRAMES = [
    ("bsd.endorse", "neither the name of ", " may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("arr.notice", "copyright ", " all rights reserved"),
]
#: Identifiers of an SPDX line that are told.
SPDX = [
    "MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "Unlicense", "BSL-1.0", "Zlib", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
]
#: Rules in order of precedence: (licence, identifiers that follow each other).
RULES = [
    ("MIT", ["mit.grant", "mit.condition", "asis.warranty", "mit.liability"]),
    ("MIT", ["mit.grant", "mit.condition", "asis.warranty"]),
    ("MIT", ["mit.grant", "mit.condition"]),
    ("BSD-3-Clause", ["bsd.redistribute", "bsd.source", "bsd.binary", "bsd.endorse", "bsd.disclaimer"]),
    ("BSD-3-Clause", ["bsd.redistribute", "bsd.source", "bsd.binary", "bsd.endorse"]),
    ("BSD-3-Clause", ["bsd.redistribute", "bsd.endorse"]),
    ("BSD-2-Clause", ["bsd.redistribute", "bsd.source", "bsd.binary", "bsd.disclaimer"]),
    ("BSD-2-Clause", ["bsd.redistribute", "bsd.source", "bsd.binary"]),
    ("ISC", ["isc.grant"]),
    ("Apache-2.0", ["apache2.title", "apache2.terms"]),
    ("Apache-2.0", ["apache2.notice", "apache2.comply", "apache2.copy", "apache2.asis", "apache2.see"]),
    ("Apache-2.0", ["apache2.notice", "apache2.comply", "apache2.copy"]),
    ("GPL-2.0-only", ["gpl2.title", "gnu.verbatim"]),
    ("GPL-3.0-only", ["gpl3.title", "gnu.verbatim"]),
    ("LGPL-2.1-only", ["lgpl21.title", "gnu.verbatim"]),
    ("LGPL-3.0-only", ["lgpl3.title", "gnu.verbatim"]),
    ("AGPL-3.0-only", ["agpl3.title", "gnu.verbatim"]),
    ("GPL-2.0-or-later", ["gnu.free", "gpl2.later", "gpl.hope", "gpl.implied"]),
    ("GPL-3.0-or-later", ["gnu.free", "gpl3.later", "gpl.hope", "gpl.implied"]),
    ("GPL-3.0-or-later", ["gpl3.later", "gpl.hope"]),
    ("GPL-2.0-or-later", ["gpl2.later"]),
    ("GPL-3.0-or-later", ["gpl3.later"]),
    ("AGPL-3.0-or-later", ["agpl3.later"]),
    ("LGPL-2.1-or-later", ["lgpl21.later"]),
    ("LGPL-3.0-or-later", ["lgpl3.later"]),
    ("MPL-2.0", ["mpl2.notice"]),
    ("Zlib", ["zlib.warranty", "zlib.grant"]),
    ("Unlicense", ["unlicense.notice"]),
    *((name, [f"spdx.{name}"]) for name in SPDX),
    ("MIT", ["mit.notice"]),
    ("MIT", ["mit.grant"]),
    ("Apache-2.0", ["apache2.notice"]),
    ("GPL-3.0-only", ["gpl3.notice"]),
    ("BSL-1.0", ["bsl1.notice"]),
    ("CC-BY-NC-4.0", ["ccbync4.notice"]),
    ("CC-BY-SA-4.0", ["ccbysa4.notice"]),
    ("CC-BY-4.0", ["ccby4.notice"]),
    ("CC0-1.0", ["cc0.notice"]),
    ("BSD-2-Clause", ["bsd.redistribute"]),
    ("MIT", ["mit.title"]),
    ("ISC", ["isc.title"]),
    ("Apache-2.0", ["apache2.title"]),
    ("BSD-2-Clause", ["bsd2.title"]),
    ("BSD-3-Clause", ["bsd3.title"]),
    ("GPL-2.0-only", ["gpl2.title"]),
    ("GPL-3.0-only", ["gpl3.title"]),
    ("LGPL-2.1-only", ["lgpl21.title"]),
    ("LGPL-3.0-only", ["lgpl3.title"]),
    ("AGPL-3.0-only", ["agpl3.title"]),
    ("MPL-2.0", ["mpl2.title"]),
    ("BSL-1.0", ["bsl1.title"]),
    ("LicenseRef-All-Rights-Reserved", ["arr.notice"]),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks in a prepared text, in which they are blanked before: a sentence ends; an SPDX expression begins.
END, EXPRESSION = "\x01", "\x02"
#: An SPDX line; an initial, whose full stop ends no sentence; two line breaks with no letter or digit of ASCII between
#: them (comment signs may stand there); and a sentence's punctuation before white space. Each is linear in the text,
#: whatever it repeats.
SPDX_LINE, INITIAL, BLANK_LINE, STOP = r"(?i)SPDX-License-Identifier:[ \t]*([^\n]*)", r"([ \n][A-Z])\.", r"\n[^A-Za-z0-9]*\n", r"[.!?;:][ \t\n]"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), r"[^a-z0-9]+", " "))


def sentences_of(text: Column) -> Column:
    """Sentences of a text, wrapped lines still in them; they end at blank lines and at punctuation."""
    text = F.translate(F.coalesce(text, F.lit("")), END + EXPRESSION, "  ")
    text = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), SPDX_LINE, f"\n\n{EXPRESSION}$1\n\n")
    text = F.regexp_replace(text, INITIAL, "$1")
    return F.split(F.regexp_replace(F.regexp_replace(text, BLANK_LINE, END), STOP, END), END)


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sentences=SENTENCES, frames=FRAMES, rules=RULES) -> DataFrame:
    """Licences of each whole text, with DataFrame functions only.

    Returns doc_id, sentence_ids (identifiers of the known sentences in text order; unknown sentences between
    them do not matter), licenses (distinct, in rule order), license (the first rule's; null without any).

    A sentence may be wrapped over lines, indented and behind comment signs: letters and digits of ASCII,
    lower-cased, are compared. One that is unknown as a whole is tried line by line, so that a notice on a line of its own
    counts without punctuation. An ``SPDX-License-Identifier`` line gives the identifiers of its expression. Each
    rule must match a run of neighbouring identifiers; a rule that matches takes its identifiers out, so that a
    shorter rule below it does not match the same sentences again; of rules that would fit the same run the first
    in the list wins.

    The sentence and rule lists are constants of the plan (at most a few hundred entries); no row leaves its task.
    Texts of any length are read whole. Null and empty texts have no licence; rows are kept one by one, whatever
    their ids and however often they repeat; other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = F.create_map(*[F.lit(x) for ident, s in sentences for x in (s, ident)])
    expression = F.create_map(*[F.lit(x) for name in SPDX for x in (name.lower(), f"spdx.{name}")])
    shortest = min(len(s) for _, s in sentences)
    nothing = F.array().cast("array<string>")

    def told(n: Column) -> Column:
        out = F.element_at(known, n)
        for ident, start, end in frames:
            out = F.coalesce(out, F.when(n.startswith(start) & n.endswith(end) & (F.length(n) >= len(start) + len(end)), F.lit(ident)))
        return out

    def looked_up(s: Column) -> Column:
        lines = F.filter(F.transform(F.split(s, "\n"), lambda x: told(normalised(x))), lambda x: x.isNotNull())
        names = F.split(F.translate(F.substring(s, 2, 2**31 - 1), "()" + UPPER, "  " + LOWER), "[ \t\n]")
        spdx = F.filter(F.transform(names, lambda x: F.element_at(expression, x)), lambda x: x.isNotNull())
        whole = F.filter(F.array(told(normalised(s))), lambda x: x.isNotNull())
        by_line = F.when(F.contains(s, F.lit("\n")), lines).otherwise(nothing)
        return F.when(s.startswith(EXPRESSION), spdx).otherwise(F.when(F.size(whole) > 0, whole).otherwise(by_line))

    parts = F.filter(sentences_of(F.col("text")), lambda s: (F.length(s) >= shortest) | s.startswith(EXPRESSION))
    step = docs.withColumn("parts", parts).select("doc_id", F.flatten(F.transform("parts", looked_up)).alias("sentence_ids"))
    rest = F.concat(F.lit("|"), F.array_join("sentence_ids", "||"), F.lit("|"))
    # only texts with known sentences walk the rules; the rest keep the empty list
    walked = F.aggregate(
        F.array(*[F.struct(F.lit(n).alias("name"), F.lit("".join(f"|{x}|" for x in ids)).alias("run")) for n, ids in rules]),
        F.struct(rest.alias("rest"), nothing.alias("names")),
        lambda acc, r: F.when(F.contains(acc["rest"], r["run"]), F.struct(F.replace(acc["rest"], r["run"], F.lit("||")).alias("rest"), F.array_append(acc["names"], r["name"]).alias("names"))).otherwise(acc),
        lambda acc: F.array_distinct(acc["names"]),
    )
    step = step.withColumn("licenses", F.when(F.size("sentence_ids") > 0, walked).otherwise(nothing))
    return step.select("doc_id", "sentence_ids", "licenses", F.when(F.size("licenses") > 0, F.element_at("licenses", 1)).alias("license"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"), "license")


def _sql() -> str:
    """The same for DuckDB: sentences as rows, joined to the lists; the rules as a chain of steps."""
    values = lambda rows: ", ".join("(" + ", ".join("'" + x + "'" for x in r) + ")" for r in rows)
    norm = f"trim(regexp_replace(translate(%s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    steps = ["w0 AS MATERIALIZED (SELECT k, '|' || array_to_string(ids, '||') || '|' AS rest, CAST([] AS VARCHAR[]) AS names FROM f)"]
    for i, (name, ids) in enumerate(RULES):
        run = "".join(f"|{x}|" for x in ids)
        steps.append(f"w{i + 1} AS MATERIALIZED (SELECT k, replace(rest, '{run}', '||') AS rest, CASE WHEN contains(rest, '{run}') AND NOT list_contains(names, '{name}') THEN list_append(names, '{name}') ELSE names END AS names FROM w{i})")
    return rf"""
WITH s(ident, n) AS (VALUES {values(SENTENCES)}), fr(ident, a, b) AS (VALUES {values(FRAMES)}), sp(ident, n) AS (VALUES {values((f"spdx.{x}", x.lower()) for x in SPDX)}),
t AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id,
    string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(coalesce(text, ''), chr(1) || chr(2), '  '), '\r\n?', chr(10), 'g'),
      '{SPDX_LINE}', chr(10) || chr(10) || chr(2) || '\1' || chr(10) || chr(10), 'g'), '{INITIAL}', '\1', 'g'), '{BLANK_LINE}', chr(1), 'g'), '{STOP}', chr(1), 'g'), chr(1)) AS parts
  FROM documents
), p AS (SELECT k, unnest(parts) AS p, generate_subscripts(parts, 1) AS i FROM t),
n AS MATERIALIZED (SELECT k, i, p, {norm % "p"} AS n FROM p),
e AS (SELECT k, i, unnest(x) AS x, generate_subscripts(x, 1) AS j FROM (SELECT k, i, regexp_split_to_array(translate(substr(p, 2), '()' || '{UPPER}', '  ' || '{LOWER}'), '[ \t\n]') AS x FROM n WHERE starts_with(p, chr(2)))),
whole AS MATERIALIZED (
  SELECT k, i, p, coalesce(s.ident, fr.ident) AS ident FROM n LEFT JOIN s ON n.n = s.n LEFT JOIN fr ON starts_with(n.n, a) AND ends_with(n.n, b) AND length(n.n) >= length(a) + length(b)
  WHERE NOT starts_with(p, chr(2))
), l AS (SELECT k, i, unnest(x) AS x, generate_subscripts(x, 1) AS j FROM (SELECT k, i, string_split(p, chr(10)) AS x FROM whole WHERE ident IS NULL AND contains(p, chr(10)))),
lines AS (
  SELECT k, i, j, coalesce(s.ident, fr.ident) AS ident FROM (SELECT k, i, j, {norm % "x"} AS n FROM l) AS q LEFT JOIN s ON q.n = s.n
  LEFT JOIN fr ON starts_with(q.n, a) AND ends_with(q.n, b) AND length(q.n) >= length(a) + length(b)
), f AS MATERIALIZED (
  SELECT k, list(ident ORDER BY i, j) AS ids FROM (
    SELECT k, i, 0 AS j, ident FROM whole UNION ALL SELECT k, i, j, ident FROM lines UNION ALL SELECT k, i, j, sp.ident FROM e JOIN sp ON e.x = sp.n
  ) WHERE ident IS NOT NULL GROUP BY k
), {", ".join(steps)}
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(array_to_string(names, ','), '') AS licenses, names[1] AS license
FROM t LEFT JOIN f ON t.k = f.k LEFT JOIN w{len(RULES)} AS w ON t.k = w.k
"""


OP7_SQL = _sql()
