"""Licence scans: canonical digest lookup (native).

A text becomes canonical by lower-casing, dropping its copyright notices, taking
punctuation for white space and spelling equivalent words one way. Texts with
equal canonical forms have equal SHA-256 digests, so a scan is a hash join of the
digests of entire texts with those of known licences. A document is looked up
as a whole, and each of its lines as an entire text of its own, which is how
notices stand in documents. Known texts are known with their usual titles and
without, the long ones also without what may stand around their terms.
"""
from __future__ import annotations

import pkgutil
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwise.llm import sizes
from rankwise.llm.text import fresh, lines, named

def _other_than(words: str) -> str:
    """A pattern for the start of a word that is none of ``words``, up to where it
    differs from all of them. Without look-ahead, which not every engine has."""
    tree: dict = {}
    for word in words.split():
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def at(node: dict, first: bool) -> str:
        letters = "".join(sorted(c for c in node if c))
        ways = [rf"[^\x00-\x60\x7B-\x7F{letters}]"]
        if not first and "" not in node:
            ways.append(r"[\x00-\x09\x0B-\x60\x7B-\x7F]|$")
        return "(?:" + "|".join(ways + [c + at(node[c], False) for c in letters]) + ")"
    return at(tree, True)


# Words after a mark where a licence speaks of copyright, or lists
# its points (a), (b), (c), and which a line may begin with once it is wrapped.
_NO_NAMES = """act also and applies are as can claim claims disclaimer doctrines exists for holder
holders if in including information infringement interest interests is law laws licence licences
license licenses management material may means must nor not notice notices notification of on or
owner owners ownership permission permissions protection resulting right rights shall similar
statement statements status subsists that the this to treaties treaty under which will with"""
_NO_HOLDERS = """a all an and any are as at by each every for if in is must no not of on or otherwise
provide provided representations such that the this to under use where with you your"""
_YEAR = r"(?:19|20)[0-9]{2}\b"
# A copyright notice is a line that begins, after anything but letters, with a mark
# and a second mark, a year, a blank to fill in or a name.
COPYRIGHT = (
    r"(?m)^[^a-z0-9\n]*(?:©|(?:copyright|\(c\))[ \t:,]*(?:\(c\)|©|copyright[ \t]|[\[<{]|[12][0-9]{3}\b)"
    rf"|(?:copyright[ \t]+the|\(c\))[ \t][^\n]*\b{_YEAR}"
    rf"|copyright[ \t]+(?:by[ \t]+)?{_other_than(_NO_NAMES + ' by')}"
    rf"|\(c\)[ \t]*{_other_than(_NO_HOLDERS)})[^\n]*$")
# ASCII punctuation and white space, and the typographic blocks of Unicode.
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{A0}-\x{BF}\x{2000}-\x{206F}\x{3000}-\x{303F}]+"
# Words of licence texts that count as equal.
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "acknowledgements": "acknowledgments",
    "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber",
    "cancelled": "canceled", "catalogue": "catalog", "categorise": "categorize",
    "centre": "center", "co  operate": "cooperate", "emphasised": "emphasized",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "https": "http", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "licence": "license", "licences": "licenses", "licenced": "licensed",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling",
    "non  commercial": "noncommercial", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "owner": "holder", "per  cent": "percent",
    "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "sub  license": "sublicense",
    "sub  licence": "sublicense", "sublicence": "sublicense", "sub  licensed": "sublicensed",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful", "wilfull": "willful",
}

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so{condition}"""
_MIT_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted{condition}"""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Public licence texts and notices, each under its identifier.
KNOWN = [
    ("MIT", _MIT_GRANT.format(condition=""", subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.
""") + "\n" + _MIT_DISCLAIMER),
    ("MIT-0", _MIT_GRANT.format(condition=".") + "\n" + _MIT_DISCLAIMER),
    ("ISC", _ISC_GRANT.format(condition=""", provided that the above copyright notice and this
permission notice appear in all copies.""") + "\n" + _ISC_DISCLAIMER),
    ("0BSD", _ISC_GRANT.format(condition=".") + "\n" + _ISC_DISCLAIMER),
    ("BSD-2-Clause", _BSD_TERMS + "\n" + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_TERMS + "\n" + _BSD_THIRD + "\n" + _BSD_DISCLAIMER),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
]
# Titles that the short licences have in files of their own.
_TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)",
            "Expat License"],
    "MIT-0": ["MIT No Attribution", "MIT No Attribution License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License",
             "BSD Zero Clause License (0BSD)", "0BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD License",
                     'BSD 2-Clause "Simplified" License', "Simplified BSD License",
                     "FreeBSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "New BSD License",
                     "Modified BSD License", "Revised BSD License"],
}
# For each long text where its head ends, where its terms start and
# where they end. The copyright notice and address of the author lie before the terms.
_LONG = {
    "Apache-2.0": ("TERMS AND CONDITIONS FOR USE", "TERMS AND CONDITIONS FOR USE",
                   ["END OF TERMS AND CONDITIONS", "APPENDIX: How to apply"]),
    "GPL-2.0": ("Copyright (C)", "Everyone is permitted",
                ["END OF TERMS AND CONDITIONS", "How to Apply These Terms"]),
    "GPL-3.0": ("Everyone is permitted", "Everyone is permitted",
                ["END OF TERMS AND CONDITIONS", "How to Apply These Terms"]),
    "LGPL-2.1": ("Copyright (C)", "Everyone is permitted",
                 ["END OF TERMS AND CONDITIONS", "How to Apply These Terms"]),
    "LGPL-3.0": ("Everyone is permitted", "Everyone is permitted", []),
    "MPL-1.1": ("1. Definitions", "1. Definitions", ["EXHIBIT A"]),
    "MPL-2.0": ("1. Definitions", "1. Definitions", []),
    "CC0-1.0": ("CREATIVE COMMONS CORPORATION IS NOT", "Statement of Purpose", []),
    "CC-BY-SA-4.0": ("Creative Commons Corporation", "By exercising the Licensed Rights",
                     ["Creative Commons is not a party to its public"]),
}


def _titled() -> list[tuple[str, str]]:
    out = []
    for name, text in KNOWN:
        if name not in _TITLES or len(text) < 500:
            continue
        bodies = [text]
        if name.startswith("BSD"):
            # Points are numbered or have bullets, and the notice may have a second line.
            bodies.append(re.sub(r"(?m)^[1-3]\. ", "* ", text))
            bodies += ["All rights reserved.\n" + b for b in bodies]
        out += [(name, f"{title}\n\n{b}".lstrip()) for b in bodies for title in ["", *_TITLES[name]]
                if title or b != text]
    return out


def _long_texts() -> list[tuple[str, str]]:
    out = []
    for name, (head_end, start, ends) in _LONG.items():
        text = pkgutil.get_data("rankwise.llm", f"license_texts/{name}.txt").decode()
        head, a = text[:text.index(head_end)], text.index(start)
        # The whole, with the notice or address left out, and without the head.
        for front in dict.fromkeys([text[:a], head, ""]):
            for b in [len(text), *map(text.index, ends)]:
                out.append((name, front + text[a:b]))
    return out


KNOWN += _titled() + _long_texts()


def with_canonical(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the canonical form of ``text``: empty for a null text and for one
    of copyright lines alone. Step by step, so that each is worked out once."""
    low, words = fresh(df, "_low"), fresh(df, "_words")
    out = df.withColumn(low, F.lower(F.coalesce(named(text), F.lit(""))))
    t = F.col(low)
    marked = t.contains("copyright") | t.contains("(c)") | t.contains("©")
    out = out.withColumn(low, F.when(marked, F.regexp_replace(t, COPYRIGHT, " ")).otherwise(t))
    out = out.withColumn(words, F.array_remove(F.split(t, PUNCTUATION, -1), ""))
    # Every word stands between two spaces of its own, so that it can be replaced.
    one_way = F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))
    for word, other in EQUIVALENT.items():
        one_way = F.replace(one_way, F.lit(f" {word} "), F.lit(f" {other} "))
    variants = F.array(*(F.lit(w) for w in sorted({w.split()[0] for w in EQUIVALENT})))
    out = out.withColumn(name, F.when(
        F.arrays_overlap(words, variants), F.trim(F.regexp_replace(one_way, " +", " ")))
        .otherwise(F.array_join(words, " ")))
    return out.drop(low, words)


def digest(form: Column) -> Column:
    """SHA-256 of a canonical form; null where there is nothing to compare."""
    return F.when(form != "", F.sha2(form, 256))


def needles(known: list[tuple[str, str]]) -> str:
    """A pattern that every text equal to a known one matches: of each, its longest
    word that no spelling changes. It spares other texts the work."""
    changed = {w for pair in EQUIVALENT.items() for words in pair for w in words.split()}
    longest = set()
    for _, text in known:
        words = set(re.findall("[a-z0-9]+", text.lower())) - changed
        longest.add(max(words, key=lambda w: (len(w), w), default=""))
    return "|".join(sorted(longest))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license): one row per digest, the least identifier of equal texts."""
    table = spark.createDataFrame(KNOWN if known is None else known, "license string, text string")
    return with_canonical(table, "text", "form").select(digest(F.col("form")).alias("digest"),
                                                        "license") \
        .filter("digest is not null").groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame | None = None, *, doc_id: str = "doc_id",
         text: str = "text", limit: int = sizes.BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, digest and license of the entire text (null
    if it has no words or is not known), n_license_lines (long) and line_licenses:
    the identifiers found in its lines, sorted, joined by commas.

    Null and empty texts have no digest. Repeated rows each give a row, with equal
    results; rows of one id with different texts are told apart by a hash of the
    text. Other columns are not read. ``known`` (digest, license) may have any
    size: it is broadcast only if measured small.
    """
    may_match = needles(KNOWN) if known is None else ""
    known = known_digests(docs.sparkSession) if known is None else known
    known, _ = sizes.hinted(known.select("digest", "license"), limit)
    rows = docs.select(named(doc_id).alias("id"), F.xxhash64(named(text)).alias("row_key"),
                       named(text).alias("text"))
    # The longest words that known texts must have are rare: most documents, and
    # most lines of the others, are out before anything is done to them.
    single = rows.filter(F.lower("text").rlike(may_match)) \
        .select("id", "row_key", F.posexplode(lines(F.col("text")))) \
        .filter(F.lower("col").rlike(may_match))
    in_lines = with_canonical(single, "col", "form") \
        .select("id", "row_key", "pos", digest(F.col("form")).alias("digest")) \
        .join(known, "digest").groupBy("id", "row_key").agg(
            F.count_distinct("pos").alias("n"),
            F.array_join(F.sort_array(F.collect_set("license")), ",").alias("names"))
    in_lines = in_lines.select(F.col("id").alias("l_id"), F.col("row_key").alias("l_key"), "n",
                               "names")
    whole = with_canonical(rows, "text", "form") \
        .select("id", "row_key", digest(F.col("form")).alias("digest")) \
        .join(known, "digest", "left")
    out = whole.join(in_lines, whole["id"].eqNullSafe(in_lines["l_id"])
                     & (whole["row_key"] == in_lines["l_key"]), "left")
    return out.select(F.col("id").alias("doc_id"), "digest", "license",
                      F.coalesce("n", F.lit(0)).alias("n_license_lines"),
                      F.coalesce("names", F.lit("")).alias("line_licenses"))
