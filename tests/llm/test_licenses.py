import re

import duckdb

from gridmix.llm import licenses
from gridmix.llm.license_texts import MIT, TEXTS

from .helpers import documents


def scanned(spark, texts):
    rows = licenses.scan(documents(spark, texts)).collect()
    return {r.doc_id: (r.license_id, r.notices) for r in rows}


def test_variants_of_a_known_text(spark):
    filled = MIT.replace("<year> <copyright holders>", "2024 Some Body")
    variants = [
        MIT, filled, filled.upper(), re.sub(r"\s+", "  ", filled.split("\n\n", 2)[2]),
        filled.replace('"', "“").replace("-", "–"), filled.replace("sublicense", "sublicence"),
        filled.replace("COPYRIGHT HOLDERS BE", "COPYRIGHT OWNERS BE"),
        "\n".join(" * " + line for line in filled.split("\n")),
        "© 2024 Some Body\n(c) Other\nCOPYRIGHT 2023 x\n" + filled,
    ]
    got = scanned(spark, variants)
    assert {i: lic for i, (lic, _) in got.items()} == {i: "MIT" for i in range(len(variants))}


def test_other_texts(spark):
    texts = [MIT + " extra", MIT[:-1] + ", too.", None, "", " \n", "Copyright 2024 only", "prose about a license"]
    assert scanned(spark, texts) == {i: (None, None) for i in range(len(texts))}


def test_every_known_text_is_found(spark):
    texts = [(name, t) for name, some in TEXTS.items() for t in some]
    got = scanned(spark, [t for _, t in texts])
    assert [got[i][0] for i in range(len(texts))] == [name for name, _ in texts]


def test_notice_lines_repeated_rows_and_empty_table(spark):
    text = "Long prose.\nReleased under the MIT licence.\nmore\nLicensed under CC BY-NC 4.0\nReleased under the MIT License."
    docs = documents(spark, [text, text, "w " * 50000 + "\nReleased under the MIT License."], ids=[1, 1, None])
    rows = sorted((r.doc_id or 0, r.license_id, r.notices) for r in licenses.scan(docs).collect())
    assert rows == [(0, None, "MIT"), (1, None, "CC-BY-NC-4.0,MIT"), (1, None, "CC-BY-NC-4.0,MIT")]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_no_python_runs(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    plan = licenses.scan(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().executedPlan().toString()
    assert "MapIn" not in plan and "EvalPython" not in plan and "CartesianProduct" not in plan


def test_full_texts_and_reserved_rights(spark):
    full = licenses.full_texts()
    assert {"Apache-2.0", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0",
            "Unlicense"} <= set(full)
    texts = [(name, some[0]) for name, some in full.items()]
    mit, bsd = TEXTS["MIT"][0], TEXTS["BSD-2-Clause"][0]
    texts += [("BSD-2-Clause", bsd.replace("<owner>", "<owner>\nAll rights reserved.")),
              ("MIT", mit.replace("\n\nPermission", "\n * ALL RIGHTS RESERVED\n\nPermission")),
              ("GPL-3.0", full["GPL-3.0"][1])]
    got = scanned(spark, [t for _, t in texts])
    assert [got[i][0] for i in range(len(texts))] == [name for name, _ in texts]
    # a text of one line without the letters of "licen"
    isc = "prose\n" + " ".join(TEXTS["ISC"][1].partition("\n\n")[2].split()) + "\nprose"
    assert scanned(spark, [isc])[0] == (None, "ISC")


def test_sql_knows_what_the_scan_knows(spark):
    full = licenses.full_texts()
    texts = [t for some in full.values() for t in some] + [t for some in TEXTS.values() for t in some]
    texts += ["x\n" + " ".join(t.split()) for t in texts] + [t + "\nmore" for t in texts] + [None, "", "\n"]
    texts += [TEXTS["MIT"][0].replace("\n\nPermission", "\n * ALL RIGHTS RESERVED\n\nPermission"),
              "All rights reserved.", "a\n -- all Rights reserved --\nb\nLicensed under the MIT License"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = sorted(con.execute(licenses.SQL).fetchall())
    got = sorted((r.doc_id, r.digest, r.license_id, r.notices) for r in licenses.scan(documents(spark, texts)).collect())
    assert got == want
    assert {name for _, _, name, _ in got} >= set(full)
