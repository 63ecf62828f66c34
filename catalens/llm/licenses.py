"""Licence scan: canonical digests of whole texts, joined to those of known licences. DataFrame operations only."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The wording of public licences, and of short notices that stand for one.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so"
)
_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN = (
    ("MIT", f"MIT License\n\n{_MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission "
            f"notice shall be included in all copies or substantial portions of the Software.\n\n{_MIT_WARRANTY}"),
    ("MIT-0", f"MIT No Attribution\n\n{_MIT_GRANT}.\n\n{_MIT_WARRANTY}"),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_THIRD + _BSD_WARRANTY),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
_TEXTS = Path(__file__).with_name("license_texts")
_TITLES = {"MIT": "The MIT License (MIT)", "ISC": "The ISC License", "0BSD": "BSD Zero Clause License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License"}
# Spellings that count as the same word.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("sub licence", "sublicense"), ("sublicence", "sublicense"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("per cent", "percent"), ("organisation", "organization"),
    ("organisations", "organizations"), ("favour", "favor"), ("behaviour", "behavior"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("centre", "center"), ("fulfil", "fulfill"), ("judgement", "judgment"), ("merchantibility", "merchantability"),
    ("whilst", "while"), ("wilful", "willful"), ("authorised", "authorized"), ("recognised", "recognized"),
)
_SIGN = "©"
_COPYRIGHT_LINE = r"(^|\n)[^a-z\n]*(copyright|\(c\))[^\n]*([0-9]{4}|\(c\)|[<\[]year[>\]])[^\n]*"
_RIGHTS_LINE = r"(^|\n)[^a-z\n]*all rights reserved[^a-z\n]*(\n|$)"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one spelling, words parted by one space; null counts as empty."""
    t = F.replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(_SIGN), F.lit("(c)"))
    t = F.regexp_replace(t, _COPYRIGHT_LINE, "\n")
    t = F.regexp_replace(t, _RIGHTS_LINE, "\n")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}]+", "  ")  # a space on either side of each word
    t = F.concat(F.lit("  "), t, F.lit("  "))
    for other, one in SPELLINGS:
        t = F.replace(t, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {one} "))
    return F.trim(F.regexp_replace(t, " +", " "))


def canonical_sql(text: str) -> str:
    """The same in DuckDB SQL."""
    t = f"replace(lower(coalesce({text}, '')), '{_SIGN}', '(c)')"
    t = f"regexp_replace({t}, '{_COPYRIGHT_LINE}', chr(10), 'g')"
    t = f"regexp_replace({t}, '{_RIGHTS_LINE}', chr(10), 'g')"
    t = f"'  ' || regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || '  '"
    for other, one in SPELLINGS:
        t = f"replace({t}, ' {other.replace(' ', '  ')} ', ' {one} ')"
    return f"trim(regexp_replace({t}, ' +', ' ', 'g'))"


def known_texts() -> list[tuple[str, str]]:
    """(license, text): ``KNOWN``, the whole texts in ``license_texts``, and the forms in which both are spread.

    A short body comes without its title or with another one, a long text without what follows its terms,
    and the Apache licence with the line for its holder filled in or left out.
    """
    out = list(KNOWN)
    for name, text in KNOWN[:6]:  # the short bodies
        body = re.sub(r"\A(MIT License|MIT No Attribution|ISC License)\n\n", "", text)
        out += [(name, body)] + ([(name, f"{_TITLES[name]}\n\n{body}")] if name in _TITLES else [])
    for path in sorted(_TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        out += [(path.stem, text), (path.stem, text.replace("   Copyright [yyyy] [name of copyright owner]\n", ""))]
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(path.stem, terms), (path.stem, terms + end)]
        if "Exhibit B" in text and path.stem == "MPL-2.0":
            out.append((path.stem, text[: text.index("\nExhibit A - ")]))
    return sorted(set(out))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license) of the known texts, one row per digest."""
    rows = spark.createDataFrame(list(known), "license string, text string")
    return rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def scan(df: DataFrame, row_id: str = "doc_id", text: str = "text", known=None) -> DataFrame:
    """(row_id, digest, license, license_lines): the licence a whole text is, and those its lines name.

    ``digest``: SHA-256 of the whole text in canonical form; ``license``: the known licence of that digest or
    null; ``license_lines``: distinct licences whose whole known text is one of the text's lines, in order,
    joined by a comma (empty if none). One row per row of ``df``, repeated rows and null ids included; null
    and empty texts have the digest of the empty text and no licence. Only ``known`` (default: ``known_texts``) is
    broadcast: a fixed list that does not grow with the data.
    """
    spark = df.sparkSession
    known = known_texts() if known is None else known
    digests = F.broadcast(known_digests(spark, known))
    own = df.select(row_id, F.col(text).cast("string").alias("_text")).withColumn("digest", F.sha2(canonical(F.col("_text")), 256))
    whole = own.join(digests, "digest", "left")
    # lines of one text: distinct digests, looked up in a map of the known ones (a literal of fixed size)
    names = {r["digest"]: r["license"] for r in known_digests(spark, known).collect()}
    table = F.create_map(*[F.lit(x) for kv in sorted(names.items()) for x in kv])
    found = F.transform(F.split(F.coalesce("_text", F.lit("")), "\n", -1), lambda line: F.try_element_at(table, F.sha2(canonical(line), 256)))
    lines = F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))
    return whole.select(row_id, "digest", "license", F.array_join(lines, ",").alias("license_lines"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def scan_sql(known=KNOWN) -> str:
    values = ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in known)
    return f"""
WITH known AS (
  SELECT sha256({canonical_sql('text')}) AS digest, min(license) AS license FROM (VALUES {values}) AS k(license, text) GROUP BY 1
), whole AS (
  SELECT doc_id, sha256({canonical_sql('text')}) AS digest FROM documents
), lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), named AS (
  SELECT doc_id, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS license_lines
  FROM lines JOIN known k ON k.digest = sha256({canonical_sql('line')}) GROUP BY doc_id
)
SELECT w.doc_id, w.digest, k.license, coalesce(n.license_lines, '') AS license_lines
FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN named n ON n.doc_id = w.doc_id
"""
