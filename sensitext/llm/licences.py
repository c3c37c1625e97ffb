"""Licence scan by canonical digests, with DataFrame operations only.

A text is brought to one form: lower case, copyright notices dropped, equivalent spellings
made equal, punctuation and white space reduced to single blanks. The digest of the whole
form, which does not depend on where its lines end, is joined with the digests of known licence
texts, and so is the digest of every line with known notices. Known digests are a fixed small table:
short texts are given here, with the titles that may stand above them; long ones by their digest.

A copyright notice is a line that begins with the word and goes on with a sign, a year, a
placeholder or has a year later on; a line of a licence that begins with "copyright holders" is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensitext.functions.binding import bind

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Spellings that mean the same, after punctuation has become blanks.
SPELLINGS = (
    ("licence", "license"),
    ("copyright holder", "copyright owner"),
    ("non commercial", "noncommercial"),
    ("https", "http"),
    ("organisation", "organization"),
    ("merchantibility", "merchantability"),
    ("whilst", "while"),
    ("per cent", "percent"),
)
# The words for which a line break may stand between two of them.
PHRASES = tuple((old, new) for old, new in SPELLINGS if " " in old)
_MARKS = r"[ \t#*/;-]*"
_YEAR = r"(19|20)[0-9][0-9]"
COPYRIGHT_LINE = (
    rf"(^|\n){_MARKS}("
    rf"copyright[ \t]*\[yyyy\][\n \t#*/;-]*\[name[\n \t#*/;-]*of[\n \t#*/;-]*copyright[\n \t#*/;-]*owner\]"
    rf"|copyright[ \t]*(\(c\)|©|<|\[)|copyright[^\n]*[^0-9a-z]{_YEAR}"
    rf"|(\(c\)|©)[ \t]*(copyright|{_YEAR}|<|\[)|all rights reserved)[^\n]*"
)
PUNCTUATION = r"[\x01-\x09\x0b-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
LINE_BREAKS = r" *\n[\n ]*"

# Licence texts, and one-line notices that name a licence.
LICENCES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no
event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}
LICENCES["BSD-3-Clause"] = LICENCES["BSD-2-Clause"].replace(
    "\n\nTHIS SOFTWARE",
    """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.

THIS SOFTWARE""",
)
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License"),
    "Zlib": ("zlib License", "The zlib/libpng License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License"),
}
# Digests of the normal form of long licence texts, as their publishers give them.
DIGESTS = {
    "77e1a2c8e9671a8095fa8108104daeae": "Apache-2.0",
    "d44d7dd7bb33c43e91c9d5e48b1d489e": "Apache-2.0",
    "b37a688f44419d3168b23775b65749eb": "GPL-1.0",
    "42c3900f3df27526919a45781fcfaa40": "GPL-1.0",
    "422f821c6c0b1812cbde7c1c3be04922": "GPL-2.0",
    "26f606e3d78ac5cd21540a2d8adde537": "GPL-2.0",
    "dd25740036eafeeb440b379ece56a8ae": "GPL-3.0",
    "2048533964f4a556d38eb2de2a0efac8": "GPL-3.0",
    "ebf358251bfe9161668a8c8251261977": "LGPL-2.0",
    "ca1c6e193db1a4bac45393f980357c55": "LGPL-2.0",
    "1ff066c677365f47fea81c911a7c822e": "LGPL-2.1",
    "678176bc76eced93c061414ea9afa263": "LGPL-2.1",
    "b31b7335bc37919e8cdd79154e04d88d": "LGPL-3.0",
    "9fa8ae3e869a929215034d82982372b5": "MPL-1.1",
    "b5b7a0cf4994910cd0204fba4637d6ec": "MPL-2.0",
    "93a180096f6cfcf2c0dd24f75c2eec48": "CC0-1.0",
    "46854b8246da92c7dbbd4e61312d796c": "GFDL-1.2",
    "0910c7ce68a828123e8374e5df51820c": "GFDL-1.3",
    "2fe792d1191a708e71b9beca097682bd": "Artistic-1.0-Perl",
}
NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "This project is licensed under the terms of the MIT license.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under the Apache License, Version 2.0 (the \"License\");": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "SPDX-License-Identifier: MIT": "MIT",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "SPDX-License-Identifier: GPL-3.0-only": "GPL-3.0",
    "SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
}


def canonical(text: Column) -> Column:
    """The text's normal form; lines stay apart."""
    x = F.translate(text, UPPER + "\r", LOWER + "\n")
    x = F.regexp_replace(x, COPYRIGHT_LINE, "$1")
    x = F.regexp_replace(x, PUNCTUATION, " ")
    for old, new in SPELLINGS:
        x = F.replace(x, F.lit(old), F.lit(new))
    return F.btrim(F.regexp_replace(x, LINE_BREAKS, "\n"), F.lit(" \n"))


def whole_digest(form: Column) -> Column:
    """Digest of a normal form, wherever its lines end."""
    flat = F.translate(form, "\n", " ")
    for old, new in PHRASES:
        flat = F.replace(flat, F.lit(old), F.lit(new))
    return F.md5(flat)


def titled(licences: dict[str, str]) -> list[tuple[str, str]]:
    """Texts of licences, bare and under their titles."""
    return [
        (name, title + "\n\n" + text)
        for name, text in licences.items()
        for title in ("", *TITLES.get(name, ()))
    ]


def known_digests(
    spark: SparkSession, licences: dict[str, str], notices: dict[str, str], digests: dict[str, str]
) -> tuple[DataFrame, DataFrame]:
    """``digest, license`` of whole texts and of single lines, by the same normal form."""
    kind = "license string, text string"
    whole = spark.createDataFrame(titled(licences), kind) if licences else spark.createDataFrame([], kind)
    lines = spark.createDataFrame([(n, x) for x, n in notices.items()], kind)
    form = canonical(F.col("text"))
    whole, lines = (
        table.select(whole_digest(form).alias("digest"), "license") for table in (whole, lines)
    )
    if digests:
        whole = whole.unionByName(
            spark.createDataFrame(list(digests.items()), "digest string, license string")
        )
    return tuple(t.groupBy("digest").agg(F.min("license").alias("license")) for t in (whole, lines))


def licence_scan(
    docs: DataFrame,
    licences: dict[str, str] = LICENCES,
    notices: dict[str, str] = NOTICES,
    digests: dict[str, str] = DIGESTS,
) -> DataFrame:
    """``doc_id, digest, license, n_notices, notices`` of every row.

    ``license`` is set if the whole text is a known licence; ``notices`` lists, in order, the
    licences that lines of the text name. A null or blank text has the digest of the
    empty form and no licence; ids may be null or repeat, each row is judged alone.
    """
    whole, lines = known_digests(docs.sparkSession, licences, notices, digests)
    # One entry per notice of the given table, whatever the documents hold.
    named = {r.digest: r.license for r in lines.collect()}
    listed = F.array(*map(F.lit, named)) if named else F.array().cast("array<string>")
    names = F.create_map(*(F.lit(x) for pair in named.items() for x in pair))

    def judged(form: Column) -> Column:
        each = F.transform(F.split(form, "\n"), F.md5)
        hits = F.filter(each, lambda d: F.array_contains(listed, d))
        return F.struct(
            whole_digest(form).alias("digest"),
            hits.alias("hits"),
        )

    form = canonical(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", bind(form, judged).alias("j")).select("doc_id", "j.*")
    found = F.transform("hits", lambda d: names[d]) if named else F.col("hits")
    return rows.join(F.broadcast(whole), "digest", "left").select(
        "doc_id",
        "digest",
        "license",
        F.size("hits").cast("bigint").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("notices"),
    )
