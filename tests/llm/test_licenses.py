from pyspark.sql import functions as F

from proteoframe.llm import licenses


def scan(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license_id", F.lit("clash"))
    return licenses.scan(df, licenses.known_licenses(spark))


def test_variants_have_one_digest(spark):
    isc = licenses.KNOWN["ISC"]
    changed = ("Copyright (c) 2031, Some Body <x@y.org>\n  © all of us\nAll Rights Reserved.\n\n"
               + isc.upper().replace("\n", "   \n  ").replace('"AS IS"', "“AS IS”").replace(", ", " , ").replace("“", "'").replace("”", "'"))
    rows = [(1, isc), (2, changed), (3, isc + " And one more word."), (4, "This work is Licenced under nothing."),
            (5, "licensed under the apache licence -- version 2.0"), (6, isc), (None, isc)]
    got = {(r.doc_id, r.line_no): r.license_id for r in scan(spark, rows).filter("line_no = 0").collect()}
    assert got == {(1, 0): "ISC", (2, 0): "ISC", (3, 0): None, (4, 0): None, (5, 0): "Apache-2.0", (6, 0): "ISC", (None, 0): "ISC"}


def test_lines(spark):
    text = "Some prose.\n  Released under the MIT license!  \nmore\nLicensed under CC-BY NC 4.0\nReleased under the MIT License. Or not."
    got = sorted((r.line_no, r.license_id) for r in scan(spark, [(1, text)]).collect() if r.line_no)
    assert got == [(2, "MIT"), (4, "CC-BY-NC-4.0")]


def test_texts_without_a_digest(spark):
    rows = [(1, None), (2, ""), (3, "...!"), (4, "Copyright 2020 me\n(c) you"), (5, "é"), (6, "word " * 40000)]
    got = {r.doc_id: r.digest is None for r in scan(spark, rows).collect()}
    assert got == {1: True, 2: True, 3: True, 4: True, 5: False, 6: False}
    assert scan(spark, []).count() == 0


def test_users_may_bring_licenses(spark):
    known = spark.createDataFrame([("Z", "My own terms."), ("A", "my OWN terms"), ("E", None)], "license_id string, text string")
    df = spark.createDataFrame([(1, "My own -- TERMS")], "doc_id long, text string")
    assert [(r.line_no, r.license_id) for r in licenses.scan(df, known).collect()] == [(0, "A"), (1, "A")]


def test_whole_licenses(spark):
    def text(name):
        return (licenses.TEXTS / f"{name}.txt").read_text()

    notice = "Copyright (c) 2031 Some Body\nAll rights reserved.\n\n"
    apache, gpl = text("Apache-2.0"), text("GPL-2.0-only")
    two = text("BSD-2-Clause")
    docs = {
        "MIT": ["MIT License\n\n" + notice + text("MIT"), notice + text("MIT").replace("\n", "\r\n"), text("MIT")],
        "Apache-2.0": [apache, apache.split("   APPENDIX")[0], apache.replace("[yyyy] [name of copyright owner]", "2031 Some Body")],
        "BSD-2-Clause": [notice + two, "BSD 2-Clause License\n\n" + notice + two.replace("1. ", "* ").replace("2. ", "* ")],
        "BSD-3-Clause": [text("BSD-3-Clause"), "BSD 3-Clause License\n\n" + notice + two.replace(
            "THIS SOFTWARE IS", licenses.THIRD_CLAUSE + "THIS SOFTWARE IS")],
        "GPL-2.0-only": [gpl, gpl.replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
                                          "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")],
    }
    docs |= {n: [text(n)] for n in ("GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0", "Unlicense", "BSL-1.0", "Zlib")}
    docs[None] = [text("MIT") + "One more word.", text("MIT").replace("free of charge, ", ""), apache.split("   6. Trademarks")[0]]
    rows = [(i, t) for i, t in enumerate(x for v in docs.values() for x in v)]
    want = dict(enumerate(k for k, v in docs.items() for _ in v))
    assert {r.doc_id: r.license_id for r in scan(spark, rows).filter("line_no = 0").collect()} == want


def test_headers_of_source_files_and_other_punctuation(spark):
    mit, isc, apache = (licenses.TEXTS / "MIT.txt").read_text(), licenses.KNOWN["ISC"], (licenses.TEXTS / "Apache-2.0.txt").read_text()
    heads = ["Copyright 2031 Some Body", "(c) 2031 Some Body", "Portions Copyright © Other Body", "All rights reserved."]

    def header(first, mark, last):
        return "\n".join([first, *(mark + x for x in [*heads, "", *mit.split("\n")]), last])

    rows = [(1, mit.replace('"AS IS"', "“AS IS”").replace(" ", "\u00a0")), (2, isc.replace('"', "”").replace(",", " –")),
            (3, header("", "# ", "")), (4, header("/*", " * ", " */")), (5, header("", "// ", "")), (6, "• " + mit + "…"),
            (7, " ".join(isc.split()).replace("the above copyright", "the above\ncopyright")),
            (8, " ".join(apache.split("   APPENDIX")[0].split()).replace(" (c) You", "\n(c) You").replace(" copyright license", "\ncopyright license")),
            (9, "# Copyright holders are many"), (10, "Copyright Some Body\n// (c) you"), (11, "« » – …\u2003")]
    got = {r.doc_id: (r.license_id, r.digest is None) for r in scan(spark, rows).filter("line_no = 0").collect()}
    want = ["MIT", "ISC", "MIT", "MIT", "MIT", "MIT", "ISC", "Apache-2.0", None, None, None]
    assert got == {i: (k, i > 9) for i, k in enumerate(want, 1)}
