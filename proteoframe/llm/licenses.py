"""License scans by canonical digest lookup, with DataFrame functions only.

A text is brought to a canonical form: copyright lines go (also behind comment
marks), ASCII letters are folded, every run of punctuation, symbols and blanks,
of ASCII or not, becomes one blank, equivalent spellings are made one. The SHA-256 of the form is joined
with the digests of known texts. Two kinds of whole texts are looked up: the
text of a row, and each of its lines (a line that is a license notice). Nothing
is matched in part.

Null and empty texts, and texts of nothing but punctuation or copyright lines,
have no digest and match nothing. Known texts with one digest are one license,
the smallest identifier. Repeated rows are reported each. An empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Pairs of equivalent spellings of the public license matching guidelines.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("fulfil", "fulfill"), ("fulfilll", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("wilful", "willful"),
    ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("per cent", "percent"), ("https", "http"), ("copyright holder", "copyright owner"),
)

#: Whole texts of public licenses, one file per identifier.
TEXTS = Path(__file__).with_name("license_texts")
# Titles that may stand above a text that has none of its own.
TITLES = {
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "Expat License"),
    "Zlib": ("zlib License", "The zlib/libpng License"),
}
THIRD_CLAUSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.\n\n"""
# The offices that copies of the older GNU texts name.
OFFICES = ("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
           "675 Mass Ave, Cambridge, MA 02139, USA")
OFFICE = r"51 Franklin St(reet)?, Fifth Floor, Boston,? MA\s+02110-1301\s+USA"

# Identifiers and texts of short public licenses and of their usual notices.
KNOWN = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights.",
    "GPL-2.0-only": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-only": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# Lines end at \n alone. A word like "notice" after "copyright" shows a line of the terms, cut there by
# wrapping. "(c)" is the third item of a list in texts that hold "(b)", unless a year or "copyright" follows.
PROSE = (r"(?:notices?|licen[sc]es?|holders?|owners?|ownership|laws?|interests?|statements?|protection|rights?|permission|"
         r"disclaimers?|treat(?:y|ies)|doctrines|status|and|or|resulting|to|in|on|is|as|for|of|the|that|this|which)\b")
SKIPPED = r"[^\p{L}\p{N}\n]"
NOTICE_LINE = (rf"(?md)^{SKIPPED}*(?:portions{SKIPPED}+)?(?:copyright\b(?!{SKIPPED}*{PROSE})"
               rf"|\(c\)%s|©|all rights reserved)[^\n]*$")
NOTICE_LINE, LISTED_NOTICE_LINE = NOTICE_LINE % "", NOTICE_LINE % rf"{SKIPPED}*(?:\d|copyright\b)"
BETWEEN = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x9F\x{200B}\x{FEFF}\p{P}\p{S}\p{Z}]+"
# What the SQL twin takes for the two.
COPYRIGHT_LINE = r"^[ \t]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHER = r"[^a-z0-9\x80-\x{10FFFF}\n]+"


def _spelled(text: Column, phrases: bool) -> Column:
    for old, new in SPELLINGS:
        if (" " in old) == phrases:
            text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _folded(text: Column) -> Column:
    """Canonical but for phrases, lines kept apart."""
    text = F.coalesce(text, F.lit(""))
    listed = F.contains(text, F.lit("(b)")) | F.contains(text, F.lit("(B)"))
    notices = F.when(listed, LISTED_NOTICE_LINE).otherwise(NOTICE_LINE)
    plain = F.regexp_replace(F.regexp_replace(F.translate(text, UPPER, LOWER), notices, F.lit("")), BETWEEN, " ")
    return _spelled(plain, phrases=False)


def _whole(folded: Column) -> Column:
    return _spelled(F.trim(F.regexp_replace(folded, r"[ \n]+", " ")), phrases=True)


def canonical(text: Column) -> Column:
    """The canonical form of a text; null texts have an empty one."""
    return _whole(_folded(text))


def _digest(form: Column) -> Column:
    return F.when(form != "", F.sha2(form, 256))


def whole_texts() -> list[tuple[str, str]]:
    """Identifier and text of the whole licenses, in the forms in which they are handed on.

    With and without a title, list numbers, and what follows the end of the
    terms (how to apply them); with the old offices of the GNU texts.
    """
    texts = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(TEXTS.glob("*.txt"))]
    two = dict(texts)["BSD-2-Clause"]
    texts += [("BSD-3-Clause", two.replace("THIS SOFTWARE IS", THIRD_CLAUSE + "THIS SOFTWARE IS")), ("ISC", KNOWN["ISC"])]
    forms = set()
    for license_id, text in texts:
        for office in OFFICES:
            whole = re.sub(OFFICE, office, text)
            terms, end, _ = whole.partition("END OF TERMS AND CONDITIONS")
            bare = re.sub(r"(?m)^[ \t]*[1-3]\.", "", whole) if license_id in TITLES else whole
            forms |= {(license_id, f) for f in (whole, terms, terms + end, bare)}
            forms |= {(license_id, f"{t}\n\n{f}") for t in TITLES.get(license_id, ()) for f in (whole, bare)}
    return sorted(forms)


def known_licenses(spark: SparkSession) -> DataFrame:
    """The built-in notices and whole texts; a user may pass another table with these columns to ``scan``."""
    return spark.createDataFrame(sorted({*KNOWN.items(), *whole_texts()}), "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its whole text (``line_no`` 0) with ``digest`` and ``license_id``, null where unknown;
    and a row for each of its lines (``line_no`` from 1) that is a known text.

    The text is folded once; lines are cut from the folded text. Rows and lines
    meet the known digests in one hash join whose known side is sized by Spark.
    """
    table = (known.select(_digest(canonical(F.col("text"))).alias("digest"), "license_id")
             .filter("digest is not null").groupBy("digest").agg(F.min("license_id").alias("license_id")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), _folded(F.col(text)).alias("_folded"))
    forms = F.concat(F.array(_whole(F.col("_folded"))),
                     F.transform(F.split(_spelled(F.col("_folded"), phrases=True), "\n"), lambda x: F.trim(x)))
    units = (rows.select("doc_id", F.posexplode(forms).alias("line_no", "_form"))
             .filter("line_no = 0 or _form != ''")
             .select("doc_id", "line_no", _digest(F.col("_form")).alias("digest")))
    return (units.join(table, "digest", "left").filter("line_no = 0 or license_id is not null")
            .select("doc_id", F.col("line_no").cast("long").alias("line_no"), "digest", "license_id"))
