"""Licence scans: canonical digests of entire texts, hash-joined to known licences.

A text is made canonical by built-in expressions only: lower case, no copyright lines, one spelling
for equivalent words, single spaces for punctuation. Its SHA-256 is then looked up. Documents, their
lines and the known texts go through the same expression, so the table of known licences is plain
text that a caller may extend.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitview.llm.common import let

#: Public licence texts and the notices that stand for licences, by SPDX id.
_TEXTS: tuple[tuple[str, str], ...] = (
    (
        "MIT",
        """MIT License

Copyright (c) <year> <holder>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """ISC License

Copyright (c) <year> <holder>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    ),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
)
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_NAMES_CLAUSE = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Titles that may stand above a text, or be missing.
_TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD License"),
    "Zlib": ("zlib License", "The zlib License", "The zlib/libpng License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
#: Names that a notice may call a licence, without "the".
_NAMES = {
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License",),
    "0BSD": ("0BSD License", "BSD Zero Clause License"),
    "Zlib": ("zlib License",),
    "Unlicense": ("Unlicense",),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache License v2.0", "Apache 2.0"),
    "MPL-1.1": ("Mozilla Public License, version 1.1", "Mozilla Public License 1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
}
_GNU = {"GPL": ("GNU General Public License", "GNU GPL", "GPL"), "LGPL": ("GNU Lesser General Public License", "GNU LGPL", "LGPL"), "AGPL": ("GNU Affero General Public License", "GNU AGPL", "AGPL")}
_GNU_VERSIONS = {"GPL": ("1.0", "2.0", "3.0"), "LGPL": ("2.1", "3.0"), "AGPL": ("3.0",)}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
_NOTICES = ("Released under {}", "Licensed under {}", "Distributed under {}", "Available under {}", *(f"This {x} is {y} under {{}}" for x in ("work", "project", "software", "program") for y in ("licensed", "released", "distributed")))


def _names() -> list[tuple[str, str]]:
    """(SPDX id, name) of the licences that notices may name."""
    out = [(i, x) for i, names in _NAMES.items() for x in names]
    for family, names in _GNU.items():
        for version in _GNU_VERSIONS[family]:
            for v in {version, version.removesuffix(".0")}:
                for x in (f"{name}{sep}{v}" for name in names for sep in (", version ", " v", " ")):
                    out.append((f"{family}-{version}-only", x))
                    out += [(f"{family}-{version}-or-later", f"{x}{later}") for later in (" or later", ", or (at your option) any later version", " or any later version")]
    for code, words in _CC.items():
        for version, kind in _CC_VERSIONS.items():
            out += [(f"CC-{code}-{version}", x) for x in (f"CC {code} {version}", f"CC {code} {version} License", f"Creative Commons {words} {version}", f"Creative Commons {words} {version} License", f"Creative Commons {words} {version} {kind} License")]
    return out


def _known() -> tuple[tuple[str, str], ...]:
    """Texts, also as titled or not, those of the folder ``licenses`` (by SPDX id), and notices."""
    texts = [*_TEXTS, ("BSD-2-Clause", _BSD + _AS_IS), ("BSD-3-Clause", _BSD + _NAMES_CLAUSE + _AS_IS)]
    texts += [(x.stem, x.read_text()) for x in sorted(Path(__file__).with_name("licenses").glob("*.txt"))]
    for i, text in texts[:]:
        if i in _TITLES and len(text) > 200:
            head, _, rest = text.partition("\n\n")
            body = rest if head in _TITLES[i] else text
            texts += [(i, body), *((i, f"{title}\n\n{body}") for title in _TITLES[i])]
        if "END OF TERMS AND CONDITIONS" in text:  # what follows tells how to apply the licence
            texts += [(i, text[: text.index("END OF TERMS AND CONDITIONS") + n]) for n in (0, len("END OF TERMS AND CONDITIONS"))]
    texts += [(i, notice.format(the + name)) for i, name in _names() for notice in _NOTICES for the in ("", "the ")]
    spdx = {i for i, _ in texts}
    return (*texts, *((i, f"SPDX-License-Identifier: {i}") for i in sorted(spdx)))


KNOWN = _known()

#: Equivalent spellings over lower-case text, as (text that every match holds, pattern, replacement).
SPELLINGS: tuple[tuple[str, str, str], ...] = (
    ("licence", r"\blicence", "license"),
    ("http", r"https?://(www\.)?", ""),
    ("non", r"\bnon[- ](commercial|infringement)", "non$1"),
    ("sub", r"\bsub[- ]licen", "sublicen"),
    ("authoris", r"authoris(e|ing|ation)", "authoriz$1"),
    ("organis", r"organis(e|ing|ation)", "organiz$1"),
    ("merchandis", r"merchandis(e|ing)", "merchandiz$1"),
    ("recognis", r"recognis(e|ing)", "recogniz$1"),
    ("acknowledgement", r"acknowledgement", "acknowledgment"),
    ("judgement", r"judgement", "judgment"),
    ("owner", r"\bowners?\b", "holder"),  # single words: a line may end between them
    ("holders", r"\bholders\b", "holder"),
)
#: A line that only states a copyright: with a mark, a year, or the holder after "by" or "the". Lines
#: such as "copyright notice and this permission notice" are a licence's own, wherever it is wrapped.
COPYRIGHT_LINE = (
    r"(?m)^[ \t]*((copyright[ \t]*(\(c\)|©|[<\[{0-9]|:|by[ \t]|the[ \t])|copyright[ \t][^\n]*\b(19|20)[0-9][0-9]\b"
    r"|\(c\)[ \t]*(copyright|©|[<\[{0-9])|©|(copyright|\(c\))[^\n]*all rights reserved)[^\n]*|all rights reserved[. \t\r]*)$"
)


def _respelled(holds: str, pattern: str, into: str):
    return lambda x: F.when(F.contains(x, F.lit(holds)), F.regexp_replace(x, pattern, into)).otherwise(x)


def canonical(line: Column) -> Column:
    """A line in lower case, empty if it only states a copyright, in one spelling, with runs of other
    characters than letters and digits as one space."""
    out = F.regexp_replace(F.lower(line), COPYRIGHT_LINE, "")
    for holds, pattern, into in SPELLINGS:  # the cheap test spares most lines the pattern
        out = let(out, _respelled(holds, pattern, into))
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def digests(text: Column) -> Column:
    """SHA-256 of the canonical text and then of each canonical line that isn't empty; null for a
    text of which nothing is left. A text's canonical form is its lines' with single spaces between."""
    lines = F.filter(F.transform(F.split(text, "\n"), canonical), lambda x: x != "")
    whole = lambda x: F.when(F.size(x) > 0, F.sha2(F.array_join(x, " "), 256))
    return let(lines, lambda x: F.concat(F.array(whole(x)), F.transform(x, lambda y: F.sha2(y, 256))))


def known_licenses(spark: SparkSession, texts: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``(digest, license_id)`` of known texts, one row for a digest (the first id in order)."""
    listed = json.dumps([{"i": i, "t": t} for i, t in dict.fromkeys(texts)])
    literal = F.explode(F.from_json(F.lit(listed), "array<struct<i:string,t:string>>"))
    rows = spark.range(1).select(literal.alias("x"))
    return rows.select(digests(F.col("x.t"))[0].alias("digest"), F.col("x.i").alias("license_id")).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest, license_id, notices)`` for every row.

    ``license_id`` is the known licence that the entire text is, else null. ``notices`` are the
    licences that entire lines of the text are, sorted, each once (empty if none). A null text, or
    one with nothing but punctuation and copyright lines, has a null digest and matches nothing.
    Repeated rows and null ids come back as they came. ``known`` is broadcast: the built-in list has
    a fixed size; a caller's own is joined as Spark decides.
    """
    spark = docs.sparkSession
    lookup = F.broadcast(known_licenses(spark)) if known is None else known.select("digest", "license_id")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select("id", "row", F.posexplode(digests(F.col("text"))).alias("at", "digest"))
    found = rows.join(lookup, "digest", "left").where("at = 0 or license_id is not null")
    entire = F.col("at") == 0
    return (
        found.groupBy("row", "id")
        .agg(
            F.max(F.when(entire, F.col("digest"))).alias("digest"),
            F.max(F.when(entire, F.col("license_id"))).alias("license_id"),
            F.sort_array(F.collect_set(F.when(~entire, F.col("license_id")))).alias("notices"),
        )
        .drop("row")
    )


def oracle_sql() -> str:
    """The scan of ``documents`` by the built-in list, for DuckDB."""

    def digest_sql(text: str) -> str:
        out = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '', 'g')"
        for _, pattern, into in SPELLINGS:
            out = f"regexp_replace({out}, '{pattern}', '{into.replace('$', chr(92))}', 'g')"
        return f"sha256(nullif(trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ''))"

    listed = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
    return f"""
WITH known AS (SELECT {digest_sql('t')} AS digest, min(i) AS license_id FROM (VALUES {listed}) v(i, t) GROUP BY 1),
whole AS (SELECT doc_id, {digest_sql('text')} AS digest FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
hits AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
         FROM lines JOIN known ON {digest_sql('line')} = known.digest GROUP BY doc_id)
SELECT w.doc_id, w.digest, k.license_id, coalesce(h.notices, '') AS notices
FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN hits h ON h.doc_id = w.doc_id"""
