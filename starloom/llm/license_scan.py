"""Recognise known licence texts by the digest of their canonical form.

The canonical form is lower case, without copyright lines, with equivalent spellings made one
and every run of punctuation or white space made one space. Entire texts are looked up: the
whole document, and each of its lines taken as a text of its own (notices are such lines). Known
texts go through the same function; their digests are a small table, measured before it is
broadcast. ``built_in`` has the short licences and notices below; whole long ones (Apache-2.0, the
GPL and others) come from a table (license, text) or a folder of their texts (``from_folder``).

Defined cases: null text is empty; an empty canonical form matches nothing. Known texts that
become equal report the least id. Repeated documents get a row each. Other columns aren't read,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import join_measured, let, text_of, written

# Equivalent spellings, the left one is read as the right one.
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("organisation", "organization"),
    ("programme", "program"),
    ("sub license", "sublicense"),
    ("per cent", "percent"),
    ("copyright holder", "copyright owner"),
    ("http", "https"),
]

# Notices and short licences as published.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING'
    " BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
    " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,"
    " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING"
    " FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS'
    " SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL"
    " THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY"
    " DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF"
    " CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE"
    " OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided"
    " with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written"
    " permission.\n\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR'
    " IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY"
    " AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER"
    " OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR"
    " CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY"
    " THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR"
    " OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
    " POSSIBILITY OF SUCH DAMAGE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will"
    " the authors be held liable for any damages arising from the use of this software.\n\n"
    "Permission is granted to anyone to use this software for any purpose, including commercial"
    " applications, and to alter it and redistribute it freely, subject to the following"
    " restrictions:\n\n"
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote"
    " the original software. If you use this software in a product, an acknowledgment in the"
    " product documentation would be appreciated but is not required.\n\n"
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as"
    " being the original software.\n\n"
    "3. This notice may not be removed or altered from any source distribution."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,"
    " either in source code form or as a compiled binary, for any purpose, commercial or"
    " non-commercial, and by any means.\n\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software"
    " dedicate any and all copyright interest in the software to the public domain. We make this"
    " dedication for the benefit of the public at large and to the detriment of our heirs and"
    " successors. We intend this dedication to be an overt act of relinquishment in perpetuity of"
    " all present and future rights to this software under copyright law.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING'
    " BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
    " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER"
    " LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN"
    " CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
KNOWN: list[tuple[str, str]] = [
    ("BSD-2-Clause", _BSD_GRANT + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_GRANT + _BSD_END),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_GRANT + _BSD_NAMES + _BSD_END),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org/>"),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a"
        ' copy of this software and associated documentation files (the "Software"), to deal in the'
        " Software without restriction, including without limitation the rights to use, copy,"
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions:\n\nThe above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the Software.\n\n" + _AS_IS,
    ),
    (
        "ISC",
        "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any"
        " purpose with or without fee is hereby granted, provided that the above copyright notice"
        " and this permission notice appear in all copies.\n\n" + _ISC_END,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted.\n\n" + _ISC_END,
    ),
]


def canonical(text: Column) -> Column:
    """The canonical form, its lines kept apart by line feeds."""
    out = F.regexp_replace(F.lower(text), r"(?m)^[ \t#*/;-]*(copyright|\(c\)|©)[^\n]*", "")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    other = "|".join(spelling for spelling, _ in SPELLINGS)

    def spelt(line: Column) -> Column:
        for spelling, usual in SPELLINGS:
            line = F.regexp_replace(line, rf"\b{spelling}\b", usual)
        return line

    # Few texts have any of the spellings; the rest need no pass for each.
    return let(out, lambda x: F.when(x.rlike(other), spelt(x)).otherwise(x))


def one_line(canon: Column) -> Column:
    return F.btrim(F.regexp_replace(canon, r"[ \n]+", " "))


def digest(line: Column) -> Column:
    return F.sha2(line, 256)


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license, length) from known texts (license, text)."""
    line = one_line(canonical(text_of(known)))
    return (
        known.select(known["license"], line.alias("line"))
        .where("line != ''")
        .groupBy(digest(F.col("line")).alias("digest"))
        .agg(F.min("license").alias("license"), F.min(F.length("line")).alias("length"))
    )


def built_in(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license string, text string")


def from_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(license, text) of a folder of entire licence texts, each named by its file."""
    files = spark.read.text(folder, wholetext=True)
    name = F.regexp_extract("_metadata.file_name", r"^(.*?)(\.txt)?$", 1)
    return files.select(name.alias("license"), F.col("value").alias("text"))


def scan(docs: DataFrame, known: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc id, digest, license, n_license_lines, licenses) for every document.

    ``license`` is that of the whole text or null, ``licenses`` all that are found, sorted.
    """
    table = written(known_digests(known), "licenses")
    # Only lines of a length that some known text has can be equal to it.
    lengths = {row["length"] for row in table.select("length").distinct().collect()}
    canon = canonical(text_of(docs, text))
    lines = F.transform(F.split(F.col("canon"), "\n"), lambda x: F.btrim(x))
    wanted = F.filter(lines, lambda x: F.length(x).isin(sorted(lengths) or [-1]))
    scanned = written(
        docs.select(docs[doc_id].alias("doc_id"), canon.alias("canon")).select(
            "doc_id",
            digest(one_line(F.col("canon"))).alias("digest"),
            F.transform(wanted, digest).alias("lines"),
        ),
        "scanned",
    ).withColumn("line_list", F.when(F.size("lines") > 0, F.md5(F.array_join("lines", ","))))
    # Documents with the same list of lines are looked up once.
    lists = scanned.where("line_list is not null").select("line_list", "lines").distinct()
    of_lines = written(
        join_measured(
            lists.select("line_list", F.explode("lines").alias("digest")), table, ["digest"], "inner"
        )
        .groupBy("line_list")
        .agg(F.count("*").alias("n"), F.collect_set("license").alias("of_lines")),
        "found",
    )
    out = join_measured(scanned.drop("lines"), table.drop("length"), ["digest"])
    out = join_measured(out, of_lines, ["line_list"])
    none = F.array().cast("array<string>")
    of_whole = F.when(F.col("license").isNotNull(), F.array("license")).otherwise(none)
    every = F.array_union(F.coalesce("of_lines", none), of_whole)
    return out.select(
        "doc_id",
        "digest",
        "license",
        F.coalesce("n", F.lit(0).cast("long")).alias("n_license_lines"),
        F.array_join(F.array_sort(every), ",").alias("licenses"),
    )
