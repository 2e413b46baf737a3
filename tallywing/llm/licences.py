"""Licence scan by sentence rules.

A text is normalised (lower case, runs of other characters than letters and digits become one blank, so
comment marks go, too) and cut into sentences, which are mapped to identifiers of known licence sentences.
Sentences end at final punctuation; at a line's end or a semicolon one may end or go on: the longest known
wording that starts and ends at such places counts, however it is wrapped, and lines between that are in none
are one unknown sentence up to a blank line. The sequence of identifiers is then matched from left to right against the licence rules; where several fit, the first
rule of the list wins, and at most ``GAP`` unknown sentences may stand between two of a rule.

Everything happens inside the row, with built-in expressions. Defined results: null text is empty; a text
without a known sentence has no licences; repeated rows are scanned each; a licence found twice is listed
twice, in the order of the text; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywing.llm.common import free

#: Known sentences in normal form. Wording of the licences and of usual notices.
SENTENCES = {
    "apache_under": "licensed under the apache license version 2 0",
    "apache_under_the": "licensed under the apache license version 2 0 the license",
    "apache_use": "you may not use this file except in compliance with the license",
    "apache_use_the": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache_warranty": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "mit_under": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl3_under": "this work is licensed under the gnu general public license version 3",
    "gpl3_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_see": "see the gnu general public license for more details",
    "bsd_use": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc_by_nc_4": "licensed under cc by nc 4 0",
    "cc_by_sa_4": "licensed under cc by sa 4 0",
    "cc_by_4": "licensed under cc by 4 0",
    "cc_by_4_long": "this work is licensed under a creative commons attribution 4 0 international license",
    "spdx_mit": "spdx license identifier mit",
    "spdx_apache": "spdx license identifier apache 2 0",
    "spdx_gpl3": "spdx license identifier gpl 3 0 or later",
    "spdx_bsd3": "spdx license identifier bsd 3 clause",
}
#: Rules in their order: the licence and its sentences. A longer rule stands before those it contains.
RULES = (
    ("BSD-3-Clause", ("bsd_use", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-2-Clause", ("bsd_use", "bsd_source", "bsd_binary")),
    ("MIT", ("mit_grant", "mit_notice", "mit_warranty")),
    ("MIT-grant", ("mit_grant", "mit_notice")),
    ("Apache-2.0", ("apache_under_the", "apache_use", "apache_copy", "apache_warranty", "apache_see")),
    ("Apache-2.0", ("apache_under_the", "apache_use_the", "apache_warranty", "apache_see")),
    ("GPL-3.0-or-later", ("gpl3_free", "gpl_warranty", "gpl_see")),
    ("GPL-3.0-or-later", ("gpl3_free",)),
    ("GPL-2.0-or-later", ("gpl2_free", "gpl_warranty", "gpl_see")),
    ("GPL-2.0-or-later", ("gpl2_free",)),
    ("GPL-3.0-only", ("gpl3_under",)),
    ("Apache-2.0", ("apache_under_the",)),
    ("Apache-2.0", ("apache_under",)),
    ("MIT", ("mit_under",)),
    ("MIT", ("mit_licensed",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_4",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_4",)),
    ("CC-BY-4.0", ("cc_by_4",)),
    ("CC-BY-4.0", ("cc_by_4_long",)),
    ("MIT", ("spdx_mit",)),
    ("Apache-2.0", ("spdx_apache",)),
    ("GPL-3.0-or-later", ("spdx_gpl3",)),
    ("BSD-3-Clause", ("spdx_bsd3",)),
)
GAP = 2
#: Every known sentence has one of these words, so texts without any are not cut into sentences.
MARKS = "(?i)licen[sc]e|permission|redistribut|software|warrant"
BREAK = r"[.;!?]+(?:\s+|$)|\n"
#: Where a sentence ends, and where it may end, in the operator. ``BREAK`` is what the SQL ends sentences at.
HARD, SOFT = r"[.!?]+(?:\s+|$)", r";+(?:\s+|$)"
UNKNOWN = "-"


def rule_pattern() -> str:
    """One pattern over identifiers, each followed by a blank; alternatives stand in the order of the rules."""
    gap = f"(?:{UNKNOWN} ){{0,{GAP}}}"
    return "|".join(gap.join(f"\\b{s} " for s in sequence) for _, sequence in RULES)


def sentence_pattern() -> str:
    """One pattern over normal text in which ``\\n`` may end a sentence and ``\\x01`` does; longer wordings first.

    Possessive repeats, so that the length of a text does not matter to the matcher's stack.
    """
    known = "|".join(w.replace(" ", r"[ \n]+") for w in sorted(SENTENCES.values(), key=len, reverse=True))
    start, end, line = r"(?<![^\n\x01])", r"(?![^\n\x01])", r"[^\n\x01]++"
    return f"{start}(?:(?:{known}){end}|{line}(?:\\n(?!(?:{known}){end}){line})*+)"


def _sequence_of(match: str) -> str:
    """SQL: a match without the marks of unknown sentences."""
    return f"replace({match}, '{UNKNOWN} ', '')"


def scan_licences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_licence_sentences`` and ``licences`` (array in the order of the text) to every row."""
    text, ids = free(docs, "t_", "ids_")
    names, wordings = (", ".join(f"'{x}'" for x in xs) for xs in (SENTENCES, SENTENCES.values()))
    rules = "case " + " ".join(f"when {{0}} = '{' '.join(s)} ' then '{licence}'" for licence, s in RULES) + " end"
    df = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    plain = f"lower(translate({text}, '\\u0001', ' '))"
    for cut, mark in ((HARD, "\\u0001"), (SOFT, "\\n"), (r"[^\p{L}\p{N}\n\x01]+", " "), (r" ?([\n\x01]) ?", "$1"), (r"^ | $", "")):
        plain = f"regexp_replace({plain}, '{cut.replace(chr(92), chr(92) * 2)}', '{mark}')"
    plain = f"regexp_extract_all({plain}, '{sentence_pattern().replace(chr(92), chr(92) * 2)}', 0)"
    plain = f"transform({plain}, s -> regexp_replace(s, '\\\\n+', ' '))"
    known = f"transform({plain}, s -> coalesce(get(array({names}), cast(array_position(array({wordings}), s) as int) - 1), '{UNKNOWN}'))"
    df = df.withColumn(ids, F.expr(f"if({text} rlike '{MARKS}', {known}, cast(array() as array<string>))"))
    pattern = rule_pattern().replace("\\", "\\\\")
    found = f"regexp_extract_all(concat(array_join({ids}, ' '), ' '), '{pattern}', 0)"
    return df.withColumns({
        "n_licence_sentences": F.expr(f"cast(size(filter({ids}, i -> i != '{UNKNOWN}')) as bigint)"),
        "licences": F.expr(f"transform({found}, m -> {rules.format(_sequence_of('m'))})"),
    }).drop(text, ids)
