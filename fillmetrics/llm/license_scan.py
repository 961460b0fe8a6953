"""License scans by canonical digest.

A text is made canonical (lower case; copyright lines dropped; everything but letters and digits one space; equivalent spellings
made one) and its SHA-256 looked up among digests of known licences and notices, made the same way. What is looked up are
entire texts: the whole document, and each of its lines, since a notice is a line.

Only DataFrame functions run. Known texts are a table of their own, broadcast if counted to be few and joined by shuffle
otherwise. Lines that are as long as no known text cannot match and are not hashed. Only lines found are gathered by document.

A null or empty text has the digest of the empty text and matches nothing. Documents that share an id share the notices found in any of
them. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed

MOST_BROADCAST = 100_000

# Spellings that licence matching treats as equal, the second standing for both.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorise", "authorize"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("copyright owner", "copyright holder"), ("favour", "favor"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("licence", "license"), ("merchantability and fitness", "merchantability or fitness"), ("modelling", "modeling"),
    ("non commercial", "noncommercial"), ("organisation", "organization"), ("per cent", "percent"),
    ("recognise", "recognize"), ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"),
)

# Published licence texts and notices. A larger table can be given instead.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Licensed under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Licensed under the MIT License.",
    "Released-MIT": "Released under the MIT License.",
}

# Headings that files of a licence begin with.
HEADINGS = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License"),
    "ISC": ("ISC License", "The ISC License"),
    "Zlib": ("zlib License", "The zlib/libpng License"),
}

# Digests of the canonical texts of long licences, as operating systems ship them with their headings.
DIGESTS = {
    "Apache-2.0": "4580e5390400d27df89edd0617548ac0e66eaa029f6e07cf98aac9cd100b3a37",
    "Artistic-1.0-Perl": "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702",
    "BSD-3-Clause-UC": "590c3fe9b5ec59bbb3121a366a7c5ecfa0979c0f7ad927635e48dc3c829f8aea",
    "CC0-1.0": "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    "GFDL-1.2": "1c057ea35084eb195331cec1a49fca335c176422a7726a9a23636906fd4e241f",
    "GFDL-1.3": "7e8edd3abe6258bb82bb853d91a0c24fcd9976894fd0592747354cffe1cb18e7",
    "GPL-1.0": "f1c3345cdc4f1104545f175c8b85a87d54270020af14a8acc6eda60261a40abf",
    "GPL-2.0": "fc5e221bb10b5de70c3a1a3158561ed706755320332cd7183576f52137f70421",
    "GPL-3.0": "dc75131ac841785e2eade588116dc725c3d3b971af99b32af54fd1ddbed40cff",
    "LGPL-2.0": "bd20b68c337e8becd19f0dca9942c53bb875c83b54f86af126df7d38f101c2cf",
    "LGPL-2.1": "04fdb40b47edc18f737d656e945146da65b38795d13f9a3691692143c94b58da",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1",
    "MPL-2.0": "9e79a7d513376f6fa1500e4df4f6276c6e7e61c5c3e28dcdb1acee24033acc56",
}

# A notice has a year, a sign or a place for them after the word; "copyright holders be liable" is a line of the licence.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:copyright[^\n]*(?:[0-9]{4}|\(c\)|©|<year>|\[yyyy\]|\[year\])|\(c\)|©|all rights reserved)[^\n]*$"
)
NOT_WORDS = r"[^\p{L}\p{N}\n]+"


def known_rows() -> list[tuple[str, str]]:
    """The known texts, those with headings also below each of them."""
    below = [(name, f"{heading}\n{KNOWN[name]}") for name, headings in HEADINGS.items() for heading in headings]
    return [*KNOWN.items(), *below]


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_rows(), "license_id string, text string")


def texts_of_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Licence texts from files, each named as its licence."""
    files = spark.read.text(folder, wholetext=True)
    return files.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("license_id"), F.col("value").alias("text"))


def canonical_lines(text: Column) -> Column:
    """Canonical words, line by line; lines still end with a line feed."""
    plain = F.regexp_replace(
        F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, ""), NOT_WORDS, " "
    )
    for spelling, standard in SPELLINGS:
        plain = F.replace(plain, F.lit(spelling), F.lit(standard))
    return plain


def canonical(lines: Column) -> Column:
    """The canonical text as a whole, from its canonical lines."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def known_digests(spark: SparkSession) -> DataFrame:
    """``digest``, ``license_id``, ``length`` of all that is known here; long texts have no length and are no line."""
    long = spark.createDataFrame([(value, None, name) for name, value in DIGESTS.items()], "digest string, length int, license_id string")
    return digests(known_texts(spark)).unionByName(long)


def digests(known: DataFrame) -> DataFrame:
    """``digest``, ``license_id`` (the first by name if texts are equal), ``length`` of known texts that have words."""
    text = canonical(canonical_lines(F.col("text").cast("string")))
    return (
        known.select("license_id", text.alias("text"))
        .where(F.col("text") != "")
        .groupBy(digest(F.col("text")).alias("digest"), F.length("text").alias("length"))
        .agg(F.min("license_id").alias("license_id"))
    )


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``text_digest``, ``license_id`` of the whole text, ``notices`` (licences of lines, sorted)."""
    table = checkpointed(known_digests(docs.sparkSession) if known is None else digests(known))
    small = table.count() <= MOST_BROADCAST
    lookup = F.broadcast(table) if small else table
    lengths = sorted(row.length for row in table.where("length IS NOT NULL").select("length").distinct().limit(MOST_BROADCAST).collect())
    plain = docs.select("doc_id", canonical_lines(F.col("text").cast("string")).alias("lines"))
    lines = (
        plain.select("doc_id", F.explode_outer(F.split("lines", "\n")).alias("line"))
        .select("doc_id", F.trim("line").alias("line"))
        .where(F.length("line").isin(lengths) if small else F.col("line") != "")
        .select("doc_id", digest(F.col("line")).alias("digest"))
    )
    notices = (
        lines.join(lookup.select("digest", "license_id"), "digest")
        .groupBy(F.col("doc_id").alias("its_id"))
        .agg(F.array_sort(F.collect_set("license_id")).alias("notices"))
    )
    whole = plain.select("doc_id", digest(canonical(F.col("lines"))).alias("text_digest"))
    return (
        whole.join(lookup.select(F.col("digest").alias("text_digest"), "license_id"), "text_digest", "left")
        .join(notices, F.col("doc_id").eqNullSafe(F.col("its_id")), "left")
        .select(
            "doc_id", "text_digest", "license_id", F.coalesce("notices", F.array().cast("array<string>")).alias("notices")
        )
    )


def _sql_canonical() -> str:
    plain = f"regexp_replace(regexp_replace(lower(coalesce(text, '')), '{COPYRIGHT_LINE}', '', 'g'), '{NOT_WORDS}', ' ', 'g')"
    for spelling, standard in SPELLINGS:
        plain = f"replace({plain}, '{spelling}', '{standard}')"
    return plain


def sql() -> str:
    """The query over ``documents`` in another database's SQL."""
    rows = ", ".join("('{}', '{}')".format(key, text.replace("'", "''")) for key, text in known_rows())
    long = ", ".join(f"('{value}', '{key}')" for key, value in DIGESTS.items())
    whole = "trim(regexp_replace(lines, '[ \\n]+', ' ', 'g'))"
    return f"""
WITH known AS (
    SELECT sha256({whole}) AS digest, min(license_id) AS license_id
    FROM (SELECT license_id, {_sql_canonical()} AS lines FROM (VALUES {rows}) AS k(license_id, text)) WHERE {whole} <> '' GROUP BY 1
    UNION ALL SELECT * FROM (VALUES {long}) AS l(digest, license_id)
), plain AS (SELECT doc_id, {_sql_canonical()} AS lines FROM documents), notices AS (
    SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
    FROM (SELECT doc_id, sha256(trim(unnest(string_split(lines, chr(10))))) AS digest FROM plain) JOIN known USING (digest)
    GROUP BY doc_id
)
SELECT p.doc_id, sha256({whole}) AS text_digest, k.license_id, coalesce(n.notices, '') AS notices
FROM plain p LEFT JOIN known k ON k.digest = sha256({whole}) LEFT JOIN notices n ON n.doc_id IS NOT DISTINCT FROM p.doc_id"""
