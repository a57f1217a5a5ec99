"""The queries that have SQL, against DuckDB on whole tables and on awkward rows."""

import duckdb
import pytest
from tests.llm.conftest import same

from ledgerloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    with duckdb.connect() as db:
        for t in ("documents", "embeddings", "pages", "benchmark"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        cursor = db.execute(queries.ORACLE[name])
        columns = [c[0] for c in cursor.description]
        expected = cursor.fetchall()
    found = queries.QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(columns)
    same(found.select(*columns).collect(), expected)


def test_licence_sql_finds_what_the_query_finds(spark, tmp_path):
    """A table that holds matches: plain, titled, with notices, wrapped, in other spellings, by digest, and near misses."""
    import textwrap
    from pyspark.sql import functions as F
    from ledgerloom.llm import license_scan
    wrap = lambda x, n: "\n\n".join(textwrap.fill(p, n) for p in x.split("\n\n"))
    texts = []
    for name, text in license_scan.LICENSES.items():
        titles = ["", *(f"{t}\n\n" for t in license_scan.TITLES.get(name, ()))]
        texts += [title + notice + wrap(text, n) for title in titles for notice in ("", "Copyright (c) 2020 A, B\n\n", "(C) 2001 Me\nAll rights reserved.\n")
                  for n in (40, 60, 72, 79)]
    texts += [t.replace("license", "licence").replace('"', "\u201c") for t in texts[:4]] + [t[:-5] for t in texts[:4]]
    texts += ["copyright notice", "Copyright", "copyright\r\nx", "copyrights reserved", "  * Copyright 2020\n", "\u00a9 x\ny", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = license_scan.license_matches(docs).collect()
    assert sum(r.license_id is not None for r in found) >= len(texts) - 16 and len({r.license_id for r in found}) == 8
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        same(found, db.execute(license_scan.oracle()).fetchall())
