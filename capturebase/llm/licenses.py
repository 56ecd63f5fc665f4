"""Whole texts that are known licences, by digest of a canonical form.

Lines that state a copyright go first, the one step that looks at lines; then case, then all that is neither letter nor digit becomes one
space, so that neither wrapping nor punctuation matters; spellings are made one in what is left.
"""

from __future__ import annotations

import re
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_forms import forms

# Spellings that count as the same, in lower case and with single spaces.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorise", "authorize"), ("calibre", "caliber"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"), ("copyright owner", "copyright holder"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("licence", "license"),
    ("maximise", "maximize"), ("minimise", "minimize"), ("modelling", "modeling"), ("non commercial", "noncommercial"), ("organisation", "organization"),
    ("per cent", "percent"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("while", "whilst"), ("wilful", "willful"),
]

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD = 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n'
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
# Public licence texts, and the short notices that stand for some of them.
LICENSES = [
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _AS_IS),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _AS_IS),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n" + _BSD_END),
    ("MIT", 'MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT-notice", "Released under the MIT License."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
]

#: A line that states a copyright: with a sign, a year or a blank for one near its beginning, or "Copyright" and a name and nothing else. A
#: wrapped line that only begins with the word stays.
DATED = r"(?im)^[ \t#*/;%>-]*(copyright[ \t:]*)?(\(c\)|\x{a9})[^\n]*|^[ \t#*/;%>-]*copyright[ \t:]+(by[ \t]+)?([\[<{(]|[12][0-9]{3})[^\n]*"
NAMED = r"(?m)^[ \t#*/;%>-]*Copyright[ \t]+(by[ \t]+)?[A-Z][\w.,&-]*([ \t]+[A-Z][\w.,&-]*){1,5}[ \t.,]*(\n|\z)"
RIGHTS = " all rights reserved "
ENDS = "\r\x0b\x0c\x85\u2028\u2029"  # what else ends a line


def canonical(text: Column) -> Column:
    """The canonical form of a text that isn't null."""
    lines = F.translate(text, ENDS, "\n" * len(ENDS))
    low = F.lower(lines)
    states = F.contains(low, F.lit("copyright")) | F.contains(low, F.lit("(c)")) | F.contains(low, F.lit("\xa9"))
    bare = F.when(states, F.lower(F.regexp_replace(F.regexp_replace(lines, DATED, ""), NAMED, "\n"))).otherwise(low)
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for a, b in [(RIGHTS, " "), *SPELLINGS]:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(out)


def canonical_sql(text: str) -> str:
    """The same in DuckDB SQL."""
    out = f"translate({text}, chr(13) || chr(11) || chr(12) || chr(133) || chr(8232) || chr(8233), repeat(chr(10), 6))"
    out = f"regexp_replace(regexp_replace({out}, '{DATED}', '', 'g'), '{NAMED}', chr(10), 'g')"
    out = f"' ' || trim(regexp_replace(lower({out}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
    for a, b in [(RIGHTS, " "), *SPELLINGS]:
        out = f"replace({out}, '{a}', '{b}')"
    return f"trim({out})"


def canonical_text(text: str) -> str:
    """The same in Python, for the list of known texts."""
    lines = text.translate(str.maketrans(ENDS, "\n" * len(ENDS)))
    bare = re.sub(NAMED.replace("\\z", "\\Z"), "\n", re.sub(DATED.replace("\\x{a9}", "\xa9"), "", lines), flags=re.ASCII)
    out = f" {re.sub(r'[\W_]+', ' ', bare.lower()).strip()} "
    for a, b in [(RIGHTS, " "), *SPELLINGS]:
        out = out.replace(a, b)
    return out.strip()


def known_digests() -> list[tuple[str, str]]:
    """(licence, digest) of every known text; of two licences with one form the first by name."""
    found: dict[str, str] = {}
    for name, text in known_licenses():
        digest = sha256(canonical_text(text).encode()).hexdigest()
        found[digest] = min(name, found.get(digest, name))
    return sorted((name, digest) for digest, name in found.items())


def known_licenses() -> list[tuple[str, str]]:
    """LICENSES, and the usual forms of these and of the full texts beside this module."""
    return [*LICENSES, *forms(LICENSES)]


def scan_licenses(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, canonical_sha256 and license_id, which is null for a text that is no known licence.

    A null or blank text has the digest of the empty text and no licence. Repeated rows stay; an empty table gives no rows. The known
    digests are a fixed list, ``known_licenses()`` or the caller's, a few hundred, so their side of the hash join is broadcast.
    """
    spark = docs.sparkSession
    known = known_licenses() if known is None else known
    if len(known) > 10_000:
        raise ValueError("known is meant for a list of licences, at most 10,000")
    names = spark.createDataFrame(known, "license_id string, text string").select("license_id", F.sha2(canonical(F.col("text")), 256).alias("canonical_sha256")).groupBy("canonical_sha256").agg(F.min("license_id").alias("license_id"))
    digests = docs.select("doc_id", F.sha2(canonical(F.coalesce("text", F.lit(""))), 256).alias("canonical_sha256"))
    return digests.join(F.broadcast(names), "canonical_sha256", "left").select("doc_id", "canonical_sha256", "license_id")
