"""Queries beside their SQL twins, on texts that reach the rules which the tables do not."""

import duckdb
import pytest
from pyspark.sql import functions as F

from riskloom.llm.oracles import oracles
from riskloom.llm.queries import queries
from tests.check_oracles import rows_of
from tests.llm.conftest import EDGE

PROSE = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [
    f"{PROSE}\nPrivacy policy",
    f"Our privacy policy says that {PROSE}",
    f"{PROSE}\nprivacy policy cookie policy terms of use back to top and one word more than eight",
    f"Why? {PROSE}!\nWhat?!\nNo!!! No!!!\nx = {{a: 1}}\nE = mc^2 & a < b",
    f"{PROSE}\nHome | News | Sport | More\na·b·c·d\n» one » two » three",
    "| a | b |\n" * 30 + PROSE,
    "x %" * 20 + "\n" + PROSE,
    "Released under the MIT license.",
    "Released\n\nunder the\nMIT\nlicense",
    "released under the mit",
    "Dieses Werk ist mit Bildern under the license released",
    "Code is licensed under the Apache License, Version 2.0 and this work is licensed under a "
    "Creative Commons Attribution 4.0 license",
    "Licensed under CC BY NC 4.0, all rights reserved. General Public License",
    "licensed under cc by 4 0 " * 3,
    "redistribution and use in source and binary forms with or without modification are "
    + "filler " * 40
    + "permitted provided that the following conditions are met",
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts"))
    rows = [(i, t) for i, t, _ in EDGE if i != 4] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    docs.write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize(
    "name", ["op1_line_dedup", "op3_license_scan", "op8_source_mixing", "op9_quality_rules", "op13_source_divergence"]
)
def test_query_equals_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    result = con.execute(oracles()[name])
    columns = [c[0] for c in result.description]
    df = queries()[name](spark, folder)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())
