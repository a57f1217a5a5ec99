"""License scans by canonical digest lookup.

A text is put into canonical form - A-Z lower-cased, copyright notices dropped, typographic and ASCII
punctuation and white space to single blanks, equivalent spellings unified - and digested.  The digests are
joined to those of known licence texts, which go through the same steps.  All of it is DataFrame
functions; the licence table is a parameter.

Defined cases: a null text counts as empty; an empty canonical text matches no licence; of two licences
with one canonical text the smaller id is named; repeated rows are judged each for itself; texts of any length
are digested whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed patterns and spellings, also used by the SQL below.  They match within a lower-cased text.
#: The lines that are dropped: those that look like a notice.  A line that begins with the word copyright is text of the
#: licence where one of these follows: punctuation or the line's end, or a word that continues a sentence.
NOTICE_START, NOTICE_WORD, NOTICE_OTHER = r"[ \t*#/>;-]*", "copyright", r"(\(c\)|\u00A9|all rights reserved)"
NO_NOTICE = (r"([a-z]|[ \t]*([,.;)]|\r?$)|[ \t]+(notices?|holders?|owners?|laws?|licen[cs]es?"
             r"|statements?|permissions?|treaty|treaties|disclaimers?|interests?|lines?|protection|infringements?|claims?|on|and"
             r"|or|in|to|the software)([^a-z]|$))")
NOTICE_LINE = (rf"(^|\n){NOTICE_START}({NOTICE_WORD}(?!{NO_NOTICE.replace('$', r'(?=\n)|$')})|{NOTICE_OTHER})[^\n]*")
PUNCTUATION = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\u00A0\u00A7\u00A9\u00AB\u00AE\u00BB\u2013\u2014\u2018\u2019\u201C\u201D\u2022\u2026]+"
SPELLINGS = (("licence", "license"), ("licencing", "licensing"), ("favour", "favor"), ("behaviour", "behavior"),
             ("honour", "honor"), ("labour", "labor"), ("organis", "organiz"), ("recognis", "recogniz"),
             ("authoris", "authoriz"), ("merchantib", "merchantab"), ("whilst", "while"), ("fulfilment", "fulfillment"),
             ("acknowledgement", "acknowledgment"), ("per cent", "percent"), ("sub license", "sublicense"),
             ("non commercial", "noncommercial"), ("copy right", "copyright"), ("http ", "https "))

# Short licence texts as published.
_WARRANTY = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
             "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
             "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
             "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
             "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
LICENSES = {
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all "
           "copies.\n\n" + _WARRANTY,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted.\n\n" + _WARRANTY,
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           'associated documentation files (the "Software"), to deal in the Software without restriction, including '
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions:\n\nThe above copyright notice and this permission notice shall be included in all "
           'copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF '
           "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
           "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
           "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
           "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    # One-line notices that stand for a licence when they are a whole text.
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

#: Titles under which these texts are published, as texts of their own.
TITLES = {"ISC": ("ISC License", "ISC License (ISC)", "The ISC License"),
          "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
          "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD")}
#: Digests of the canonical forms of further texts: those of Debian's common-licenses, and those that common packages carry
#: (Apache-2.0 without its appendix; BSD texts with holder or owner, numbered, titled).
DIGESTS = {
    "62c23944e22c7e1579b00eab372c8062d04f03e360aaab08b4030b71d5eac153": "Apache-2.0",
    "cde7bc24bdbd45dc163ffe3310ac18828bc61ca29d7022e5423fc27c782c807a": "Apache-2.0",
    "46262ed7a2a06fdac885b37f111be9b18bbde572ab1edbd2f416d673551ab967": "Apache-2.0",
    "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2": "Artistic-1.0-Perl",
    "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2": "BSD-2-Clause",
    "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74": "BSD-2-Clause",
    "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30": "BSD-2-Clause",
    "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2": "BSD-3-Clause",
    "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15": "BSD-3-Clause",
    "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651": "BSD-3-Clause",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "1c057ea35084eb195331cec1a49fca335c176422a7726a9a23636906fd4e241f": "GFDL-1.2",
    "7e8edd3abe6258bb82bb853d91a0c24fcd9976894fd0592747354cffe1cb18e7": "GFDL-1.3",
    "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224": "GPL-1.0",
    "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821": "GPL-2.0",
    "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68": "GPL-3.0",
    "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908": "LGPL-2.0",
    "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891": "LGPL-2.1",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0",
    "fbe9a0b96f52e03cb474f9a7083781399c011279e85b548118563ec96e659354": "MPL-1.1",
    "3dacd2c104719e7227969cbdcc7d581518827199e830b9379627eec0a32f8ab7": "MPL-2.0",
}


def canonical(text: Column) -> Column:
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, NOTICE_LINE, "$1")
    out = F.regexp_replace(out, PUNCTUATION, " ")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def known(spark: SparkSession, licenses: dict[str, str] = LICENSES, digests: dict[str, str] | None = None) -> DataFrame:
    """digest, license_id of a licence table and of digests of further texts, one row per digest."""
    titled = {} if licenses is not LICENSES else TITLES
    texts = [*licenses.items(), *((k, f"{t}\n\n{licenses[k]}") for k, titles in titled.items() for t in titles)]
    rows = spark.createDataFrame(sorted(texts), "license_id string, license_text string")
    found = (rows.select("license_id", canonical(F.col("license_text")).alias("form")).where("form <> ''")
             .select(F.sha2("form", 256).alias("digest"), "license_id"))
    if digests:
        found = found.union(spark.createDataFrame(sorted(digests.items()), "digest string, license_id string"))
    return found.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def license_matches(docs: DataFrame, licenses: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, canonical_sha256, license_id (null: no known licence)."""
    if licenses is None:  # a table of fixed length, so it can go to every executor and no document is shuffled
        licenses = F.broadcast(known(docs.sparkSession, digests=DIGESTS))
    digests = docs.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("canonical_sha256"))
    return (digests.join(licenses, digests["canonical_sha256"] == licenses["digest"], "left")
            .select("doc_id", "canonical_sha256", "license_id"))


def oracle() -> str:
    """DuckDB SQL for :func:`license_matches` with the licences above."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"

    def form(column: str) -> str:
        """RE2 looks nowhere ahead, so the SQL judges line by line."""
        out = f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"
        start, other = f"^{NOTICE_START}", quote(_re2(f"^{NOTICE_START}{NOTICE_OTHER}"))
        notice = (f"(regexp_matches(l, {quote(f'{start}{NOTICE_WORD}')}) AND NOT regexp_matches(l, "
                  f"{quote(f'{start}{NOTICE_WORD}{NO_NOTICE}')})) OR regexp_matches(l, {other})")
        out = f"array_to_string(list_filter(string_split({out}, chr(10)), lambda l: NOT ({notice})), chr(10))"
        out = f"regexp_replace({out}, {quote(_re2(PUNCTUATION))}, ' ', 'g')"
        for old, new in SPELLINGS:
            out = f"replace({out}, {quote(old)}, {quote(new)})"
        return f"trim({out}, ' ')"

    texts = [*LICENSES.items(), *((k, f"{t}\n\n{LICENSES[k]}") for k, titles in TITLES.items() for t in titles)]
    values = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in sorted(texts))
    digests = ", ".join(f"('{d}', '{k}')" for d, k in sorted(DIGESTS.items()))
    return f"""
WITH known AS (SELECT digest, min(id) AS license_id FROM (
    SELECT sha256({form('t')}) AS digest, id FROM (VALUES {values}) x(id, t) WHERE {form('t')} <> ''
    UNION ALL SELECT * FROM (VALUES {digests}) y(digest, id)) GROUP BY 1),
digests AS (SELECT doc_id, sha256({form('text')}) AS canonical_sha256 FROM documents)
SELECT doc_id, canonical_sha256, license_id FROM digests LEFT JOIN known ON canonical_sha256 = digest"""


def _re2(pattern: str) -> str:
    """\\uXXXX as \\x{XXXX}."""
    return re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", pattern)
