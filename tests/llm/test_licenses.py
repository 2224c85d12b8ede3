from __future__ import annotations

from odd_rows import ROWS, empty, frame
from pyspark.sql import functions as F

from reconlake.llm import licenses
from reconlake.llm.queries import op3_licenses

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def test_nearest_directory_speaks(spark):
    files = [
        ("a/LICENSE", MIT, 0),
        ("a/x.txt", "plain words of a text", 1),
        ("a/b/c/y.txt", "plain words of a text", 2),
        ("a/b/COPYING.txt", GPL, 3),
        ("a/bb/z.txt", "plain words", 4),
        ("other/x.txt", "plain words", 5),
        ("a/b/own.txt", "words\n" * 50 + "Licensed under the Apache License, Version 2.0.", 6),
        (None, "plain words", 7),
        ("x.txt", None, 8),
        ("a/b/c/y.txt", "plain words of a text", 9),
    ]
    rows = spark.createDataFrame(files, "path string, text string, n int")
    got = {r.n: (r.license, r.how, r.levels_up) for r in licenses.LicenseScan(rows, keep=("n",)).result().collect()}
    assert got == {
        0: ("MIT", "own", None), 1: ("MIT", "inherited", 0), 2: ("GPL-3.0", "inherited", 1), 3: ("GPL-3.0", "own", None),
        4: ("MIT", "inherited", 1), 5: (None, None, None), 6: ("Apache-2.0", "own", None), 7: (None, None, None),
        8: (None, None, None), 9: ("GPL-3.0", "inherited", 1),
    }


def test_skipping_loses_no_match():
    of = licenses.Matcher.of(licenses.TEMPLATES, {"the": 90, "license": 3}, 100, licenses.LEAST_COSINE)
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            for found in (licenses.words(text), licenses.words(text)[1:], licenses.words(text + " and more")):
                license_id, cosine = of.best(found)
                assert license_id is None or not of.needed.isdisjoint(found)
            assert of.scan(f"first line\n{text}\nlast")[0] is not None, name
    assert of.scan("the license of a driver is in the car") == (None, 0.0, 0.0)
    long = " ".join(["word"] * 100 + licenses.words(MIT) + ["word"] * 100)
    assert of.scan(MIT)[0] == "MIT" and of.scan(long)[0] is None


def test_other_words_on_the_line_weigh_alike_at_every_size():
    # shares of the documents that have a word
    shares = {"released": 0.01, "under": 0.04, "the": 0.6, "mit": 0.1, "license": 0.03, "licensed": 0.03, "apache": 0.02, "version": 0.02}
    of = [
        licenses.Matcher.of(licenses.TEMPLATES, {w: int(n * s) for w, s in shares.items()}, n, licenses.LEAST_COSINE)
        for n in (1_000, 10_000_000)
    ]
    for line, wanted in (
        ("// Acme: Released under the MIT License.", "MIT"),
        ("Acme and Sons: Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("Acme Sons " + licenses.TEMPLATES["Unlicense"][0], "Unlicense"),
    ):
        (small, near), (large, far) = (m.best(licenses.words(line)) for m in of)
        assert small == large == wanted
        assert abs(near - far) < 0.05
    for m in of:
        assert m.best(licenses.words("the driver has a license to drive under the age of nine"))[0] is None


def test_documents_with_a_notice_are_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = op3_licenses(spark, sf_dir).join(docs, "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        assert (r.how == "own") == ("icensed under" in r.text or MIT in r.text)


def test_odd_rows(spark):
    rows = frame(spark).withColumn("path", F.concat("source", F.lit("/x")))
    assert licenses.LicenseScan(rows, keep=("doc_id", "row", "hash")).result().count() == len(ROWS)
    none = empty(spark).withColumn("path", F.col("source"))
    assert licenses.LicenseScan(none).result().collect() == []
