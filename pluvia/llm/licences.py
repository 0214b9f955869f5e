"""Licence scans by sentence rules; DataFrame functions only.

Signs at the start of a line (comment and list markers) go first, so that a line of nothing else is an empty line, and
line ends become line feeds; a line's SPDX identifier becomes a sentence of its own.  A text is cut into sentences, each is
normalised to lower-case words of ASCII letters and digits, and known licence sentences become numbers (a line of a longer
sentence counts if the sentence as a whole is not known, so that both a wrapped notice and a notice on a line of its own
are found).  Where the notices name a holder, a form with a slot takes any name of up to ``SLOT`` characters.  What else the
text says, list numbers and addresses too, becomes 0; pieces without letters and digits count for nothing.

Then the rules are applied in order to the sequence of numbers, long ones before the short ones they contain; a rule
matches numbers with at most ``GAP`` zeros in a row between them, takes them away and leaves the licence's name, so that no
sentence counts twice.  Known sentences that no rule takes, as those further apart, are reported as ``incomplete``.

Sentences, forms and rules are parameters; the tables below are sent to the tasks as part of the plan and do not grow with
the data.  Every row is scanned whole where it is read: no shuffle.

Defined cases: null and empty texts have no sentences and no licence; licences are listed in the order of the text,
repeated ones each time; an SPDX expression of several licences, or of one without a rule, is incomplete; repeated rows are
scanned each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# --- fixed values: sentences of public licence notices, by number, and the rules in order of precedence -------------
SENTENCES = {
    1: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    2: "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software.",
    3: 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    4: "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    5: 'Licensed under the Apache License, Version 2.0 (the "License");',
    6: "you may not use this file except in compliance with the License.",
    7: "You may obtain a copy of the License at",
    8: 'Unless required by applicable law or agreed to in writing, software distributed under the License is '
    'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    9: "See the License for the specific language governing permissions and limitations under the License.",
    10: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:",
    11: "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.",
    12: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    13: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
    14: "This program is free software:",
    15: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    16: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation;",
    17: "either version 2 of the License, or (at your option) any later version.",
    18: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    19: "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    20: "See the GNU General Public License for more details.",
    21: "Released under the MIT License.",
    22: "Licensed under the Apache License, Version 2.0.",
    23: "This work is licensed under the GNU General Public License, version 3.",
    24: "Licensed under CC BY-NC 4.0.",
    25: "Licensed under CC BY 4.0.",
    26: "Licensed under CC BY-SA 4.0.",
    27: "This is free and unencumbered software released into the public domain.",
    28: "All rights reserved.",
    29: "it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    30: "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published "
    "by the Free Software Foundation.",
    31: "This library is free software;",
    32: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
    "by the Free Software Foundation;",
    33: "either version 2.1 of the License, or (at your option) any later version.",
    34: "either version 3 of the License, or (at your option) any later version.",
    35: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    36: "See the GNU Lesser General Public License for more details.",
    37: "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    38: "See the GNU Affero General Public License for more details.",
    39: "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    40: "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    41: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    42: 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    43: "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
    "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    44: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted.",
    45: "This software is provided 'as-is', without any express or implied warranty.",
    46: "In no event will the authors be held liable for any damages arising from the use of this software.",
    47: "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions:",
    48: "The origin of this software must not be misrepresented;",
    49: "you must not claim that you wrote the original software.",
    50: "If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is "
    "not required.",
    51: "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
    "software.",
    52: "This notice may not be removed or altered from any source distribution.",
    53: "Distributed under the Boost Software License, Version 1.0.",
    54: "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    55: "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
    "to this software to the public domain worldwide.",
    56: "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
}
#: The same sentences with a slot for what differs from notice to notice.
FORMS = (
    (2, "The above copyright notice and this permission notice {} shall be included in all copies or substantial portions "
    "of the Software."),
    (4, "IN NO EVENT SHALL {} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
    "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    (13, "{} may be used to endorse or promote products derived from this software without specific prior written "
    "permission."),
    (13, "{} may not be used to endorse or promote products derived from this software without specific prior written "
    "permission."),
    (18, "{} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"),
    (40, "If a copy of the MPL was not distributed with this file, You can obtain one at {}"),
    (42, 'THE SOFTWARE IS PROVIDED "AS IS" AND {} ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    (43, "IN NO EVENT SHALL {} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
    "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    (46, "In no event will {} be held liable for any damages arising from the use of this software."),
    (54, "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
    "which {}"),
    (100, "SPDX-License-Identifier {}"),
)
#: Identifiers that may stand alone behind ``SPDX-License-Identifier:``; they are numbered from 101.
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
SENTENCES |= {101 + i: f"SPDX-License-Identifier {name}" for i, name in enumerate(SPDX)}
RULES = (
    ("MIT", (1, 2, 3, 4)),
    ("Apache-2.0", (5, 6, 7, 8, 9)),
    ("BSD-4-Clause", (10, 11, 12, 56, 13)),
    ("BSD-3-Clause", (10, 11, 12, 13)),
    ("BSD-2-Clause", (10, 11, 12)),
    ("AGPL-3.0-or-later", (14, 37, 18, 19, 38)),
    ("AGPL-3.0-or-later", (37, 18, 19, 38)),
    ("AGPL-3.0-or-later", (14, 37)),
    ("AGPL-3.0-or-later", (37,)),
    ("LGPL-3.0-or-later", (14, 35, 18, 19, 36)),
    ("LGPL-3.0-or-later", (31, 35, 18, 19, 36)),
    ("LGPL-3.0-or-later", (31, 32, 34, 18, 19, 36)),
    ("LGPL-2.1-or-later", (31, 32, 33, 18, 19, 36)),
    ("LGPL-3.0-or-later", (35, 18, 19, 36)),
    ("LGPL-2.1-or-later", (32, 33, 18, 19, 36)),
    ("LGPL-2.1-or-later", (31, 32, 33)),
    ("LGPL-3.0-or-later", (35,)),
    ("GPL-3.0-or-later", (14, 15, 18, 19, 20)),
    ("GPL-3.0-or-later", (14, 16, 34, 18, 19, 20)),
    ("GPL-2.0-or-later", (14, 16, 17, 18, 19, 20)),
    ("GPL-2.0", (14, 30, 18, 19, 20)),
    ("GPL-3.0-or-later", (15, 18, 19, 20)),
    ("GPL-3.0-or-later", (16, 34, 18, 19, 20)),
    ("GPL-2.0-or-later", (16, 17, 18, 19, 20)),
    ("GPL-3.0-or-later", (14, 15)),
    ("GPL-2.0-or-later", (14, 16, 17)),
    ("GPL-2.0", (14, 30)),
    ("GPL-3.0-or-later", (15,)),
    ("GPL-2.0-or-later", (16, 17)),
    ("GPL-2.0", (30,)),
    ("GPL-2.0", (29,)),
    ("MPL-2.0", (39, 40)),
    ("MPL-2.0", (39,)),
    ("ISC", (41, 42, 43)),
    ("0BSD", (44, 42, 43)),
    ("Zlib", (45, 46, 47, 48, 49, 50, 51, 52)),
    ("BSL-1.0", (53,)),
    ("EPL-2.0", (54,)),
    ("CC0-1.0", (55,)),
    ("MIT", (21,)),
    ("Apache-2.0", (22,)),
    ("GPL-3.0", (23,)),
    ("CC-BY-NC-4.0", (24,)),
    ("CC-BY-4.0", (25,)),
    ("CC-BY-SA-4.0", (26,)),
    ("Unlicense", (27,)),
    ("all-rights-reserved", (28,)),
    *((name, (101 + i,)) for i, name in enumerate(SPDX)),
)
# --- end of fixed values --------------------------------------------------------------------------------------------

#: Unknown sentences or lines in a row that a rule passes over.
GAP = 8
#: Characters that a slot may hold.
SLOT = 200

#: Ends of sentences, white space included, and empty lines.
_END = r"[.!?:;]+[\x20\x09-\x0D]+|\x0A[\x20\x09]*\x0A[\x20\x09-\x0D]*"
#: What may stand before the words of a line: white space, signs other than "." and "?", a marker that is a word, "(a)".
_MARKERS = (
    r"^[\x20\x09\x0B\x0C!-\-/:->@\[-`{-~]+(?:(?:dnl|DNL|rem|REM)(?:[\x20\x09]+|$))?"
    r"(?:(?:[0-9]{1,2}|[A-Za-z]|[ivx]{1,4})\)[\x20\x09]+)?"
    r"|^(?:dnl|DNL|rem|REM)(?:[\x20\x09]+|$)"
    r"|^(?:[0-9]{1,2}|[A-Za-z]|[ivx]{1,4})\)[\x20\x09]+"
)
_SPDX = r"SPDX-License-Identifier:[\x20\x09]*([^\x0A]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(sentence: str) -> str:
    lowered = sentence.translate(str.maketrans(_UPPER, _LOWER))
    return re.sub("[^a-z0-9]+", " ", lowered).strip(" ")


def around_slot(form: str) -> tuple[str, str]:
    """What stands before and behind the slot, normalised, with the space at the slot."""
    before, behind = (normalised(part) for part in form.split("{}"))
    return before and f"{before} ", behind and f" {behind}"


def _normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, _UPPER, _LOWER), "[^a-z0-9]+", " "))


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sentence_numbers(text: Column, sentences: dict[int, str] = SENTENCES, forms=FORMS, slot: int = SLOT) -> Column:
    """array<int>: the number of each known sentence, 0 for any other with letters or digits."""
    known = F.create_map(
        *(F.lit(x) for number, sentence in sentences.items() for x in (normalised(sentence), number))
    )

    def number(words):
        found = F.when(words == "", F.lit(None).cast("int"))
        found = found.when(F.try_element_at(known, words) > 0, F.try_element_at(known, words))
        for form_number, form in forms:
            before, behind = around_slot(form)
            fixed = len(before) + len(behind)
            fits = F.length(words).between(fixed + 1, fixed + slot)
            for test in ([words.startswith(before)] if before else []) + ([words.endswith(behind)] if behind else []):
                fits = fits & test
            found = found.when(fits, F.lit(form_number))
        return found.otherwise(F.lit(0))

    def numbers(sentence):
        return _with(
            _with(_normalised(sentence), number),
            lambda whole: F.when((whole > 0) | ~F.contains(sentence, F.lit("\n")), F.array(whole)).otherwise(
                F.transform(F.split(sentence, "\n+"), lambda line: _with(_normalised(line), number))
            ),
        )

    lines = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), f"(?md){_MARKERS}", "")
    lines = F.regexp_replace(lines, _SPDX, "\n\nSPDX-License-Identifier $1\n\n")
    return F.array_compact(F.flatten(F.transform(F.split(F.concat(lines, F.lit(" ")), _END), numbers)))


def _tokens(numbers) -> str:
    return "".join(f"<{number}>" for number in numbers)


def _far(gap: int) -> str:
    return f"(?:<0>){{{gap + 1},}}"


def scan_licences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    sentences: dict[int, str] = SENTENCES,
    rules=RULES,
    forms=FORMS,
    gap: int = GAP,
) -> DataFrame:
    """One row per document: doc_id, known (sentences), licences (names in order, comma-separated), n_licences, incomplete."""
    numbered = docs.select(
        F.col(id_col).alias("doc_id"), sentence_numbers(text_or_empty(text), sentences, forms).alias("numbers")
    )
    sequence = F.array_join(F.transform("numbers", lambda n: F.concat(F.lit("<"), n.cast("string"), F.lit(">"))), "")
    # Too many unknown sentences in a row are a mark that no rule contains; fewer are passed over.
    sequence = F.replace(F.regexp_replace(sequence, _far(gap), "<->"), F.lit("<0>"), F.lit(""))
    for name, numbers in rules:
        sequence = F.replace(sequence, F.lit(_tokens(numbers)), F.lit(f"<={name}>"))
    # The sequence is a column of its own, so that it is computed once.
    return (
        numbered.withColumn("known", F.size(F.filter("numbers", lambda n: n > 0)))
        .withColumn("sequence", sequence)
        .withColumn("names", F.regexp_extract_all("sequence", F.lit("<=([^>]*)>"), F.lit(1)))
        .select(
            "doc_id",
            "known",
            F.array_join("names", ",").alias("licences"),
            F.size("names").alias("n_licences"),
            F.col("sequence").rlike("<[1-9]").alias("incomplete"),
        )
    )


def _sql() -> str:
    known = ", ".join(f"'{normalised(sentence)}': {number}" for number, sentence in SENTENCES.items())

    def clean(column):
        return f"trim(regexp_replace(translate({column}, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g'))"

    forms = ""
    for number, form in FORMS:
        before, behind = around_slot(form)
        fixed = len(before) + len(behind)
        forms += (
            f"\n    WHEN length(w) BETWEEN {fixed + 1} AND {fixed + SLOT} AND starts_with(w, '{before}') "
            f"AND ends_with(w, '{behind}') THEN {number}"
        )
    sequence = "array_to_string(list_transform(numbers, lambda n: '<' || n || '>'), '')"
    sequence = f"replace(regexp_replace({sequence}, '{_far(GAP)}', '<->', 'g'), '<0>', '')"
    for name, numbers in RULES:
        sequence = f"replace({sequence}, '{_tokens(numbers)}', '<={name}>')"
    return f"""
WITH k AS (SELECT MAP {{{known}}} AS known),
lines AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_replace(
    regexp_replace(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), '(?m){_MARKERS}', '', 'g'),
    '{_SPDX}', chr(10) || chr(10) || 'SPDX-License-Identifier \\1' || chr(10) || chr(10), 'g') || ' ' AS t
  FROM documents),
sentences AS (
  SELECT r, generate_subscripts(s, 1) AS i, unnest(s) AS s FROM (SELECT r, regexp_split_to_array(t, '{_END}') AS s FROM lines)),
pieces AS (
  SELECT r, i, 0 AS j, s, {clean('s')} AS w FROM sentences
  UNION ALL
  SELECT r, i, j, s, {clean('s')} FROM (
    SELECT r, i, generate_subscripts(l, 1) AS j, unnest(l) AS s
    FROM (SELECT r, i, regexp_split_to_array(s, '\\n+') AS l FROM sentences WHERE contains(s, chr(10))))),
found AS (
  SELECT r, i, j, contains(s, chr(10)) AS wrapped, CASE WHEN w = '' THEN NULL WHEN known[w] > 0 THEN known[w]{forms}
    ELSE 0 END AS n
  FROM pieces, k),
chosen AS (
  SELECT r, i, j, n FROM (SELECT *, max(CASE WHEN j = 0 THEN n END) OVER (PARTITION BY r, i) AS whole FROM found)
  WHERE n IS NOT NULL AND CASE WHEN j = 0 THEN n > 0 OR NOT wrapped ELSE coalesce(whole, 0) = 0 END),
numbered AS (
  SELECT r, list(n ORDER BY i, j) AS numbers FROM chosen GROUP BY r),
matched AS (
  SELECT doc_id, numbers, coalesce({sequence}, '') AS sequence FROM lines LEFT JOIN numbered USING (r))
SELECT doc_id, coalesce(len(list_filter(numbers, lambda n: n > 0)), 0)::INTEGER AS known,
       coalesce(array_to_string(regexp_extract_all(sequence, '<=([^>]*)>', 1), ','), '') AS licences,
       len(regexp_extract_all(sequence, '<=([^>]*)>', 1))::INTEGER AS n_licences,
       regexp_matches(sequence, '<[1-9]') AS incomplete
FROM matched
"""


#: The same rule on DuckDB.
SQL = _sql()
