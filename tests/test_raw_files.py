"""Raw CSV files: quoting, line breaks, malformed records and their quarantine."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyroom.schemas import RAW
from tallyroom.sources import readers

HEADER = ",".join(RAW["products"].fieldNames())
PLAIN = [
    '1,Pipe,Tools,T-1,1.5,2.5,Acme',
    '2,"Pipe 5"", red",Tools,T-1,1.5,2.5,Acme',
    '3,"a, b",Tools,"T,1",1.5,2.5,"Ac""me"',
    '4,"","NA",T-1,,2.5,Acme',
    '5,back\\slash,"end\\",T-1,1.5,2.5,Acme',
    '6," spaced ",Tools,T-1,1.5,2.5,Acme',
    '7,"""quoted""",Tools,T-1,1.5,2.5,Acme',
]
SHORT = ["8,short,Tools", "9"]
SURPLUS = ["10,Pipe,Tools,T-1,1.5,2.5,Acme,extra", '11,"a",b,c,T,T-1,1.5,2.5,Acme', "12,Pipe,Tools,T-1,1.5,2.5,Acme,"]
BREAK = '13,"two\nlines ""both""",Tools,T-1,1.5,2.5,Acme'
OPEN = '14,"never closed,Tools,T-1,1.5,2.5,Acme'


def folder_of(tmp_path, *files):
    (tmp_path / "products").mkdir()
    for i, lines in enumerate(files):
        (tmp_path / "products" / f"part-{i}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return str(tmp_path)


def rows(df):
    return sorted((tuple(r) for r in df.select(*RAW["products"].fieldNames()).collect()), key=lambda r: int(r[0]))


def as_pandas(folder):
    df = pd.read_csv(f"{folder}/products/part-0.csv", dtype=str).astype(object)
    return sorted((tuple(None if pd.isna(x) else x for x in r) for r in df.itertuples(index=False)), key=lambda r: int(r[0]))


@pytest.mark.parametrize("multi_line", [False, True])
def test_quoting_and_short_rows_equal_pandas(spark, tmp_path, multi_line):
    folder = folder_of(tmp_path, PLAIN + SHORT)
    assert rows(readers.read_raw(spark, folder, "products", multi_line=multi_line)) == as_pandas(folder)
    assert readers.read_quarantine(spark, folder, "products", multi_line=multi_line).count() == 0


def test_line_breaks_inside_quotes_equal_pandas(spark, tmp_path):
    folder = folder_of(tmp_path, [*PLAIN, BREAK, *SHORT])
    assert rows(readers.read_raw(spark, folder, "products", multi_line=True)) == as_pandas(folder)
    # without multi_line the halves are not taken for records
    assert rows(readers.read_raw(spark, folder, "products")) == [r for r in as_pandas(folder) if r[0] != "13"]
    halves = readers.read_quarantine(spark, folder, "products").collect()
    assert {r.reason for r in halves} == {readers.OPEN_QUOTE} and "\n".join(r.record for r in halves if r.record[:2] == "13") in BREAK


@pytest.mark.parametrize("multi_line", [False, True])
def test_malformed_records_are_set_aside_and_counted(spark, tmp_path, multi_line):
    folder = folder_of(tmp_path, PLAIN + SURPLUS, [*PLAIN[:1], OPEN])
    good = readers.read_raw(spark, folder, "products", ingest_order=True, multi_line=multi_line)
    bad = readers.read_quarantine(spark, folder, "products", multi_line=multi_line).collect()
    assert [r.product_id for r in good.orderBy("ingest_seq").collect()] == ["1", "2", "3", "4", "5", "6", "7", "1"]
    assert sorted((r.first_field, r.reason) for r in bad) == [
        ("10", readers.SURPLUS), ("11", readers.SURPLUS), ("12", readers.SURPLUS), ("14", readers.OPEN_QUOTE),
    ]
    assert sorted(r.record.strip() for r in bad) == sorted([*SURPLUS, OPEN])
    assert {r.file.rsplit("/", 1)[1] for r in bad} == {"part-0.csv", "part-1.csv"}


def test_narrow_reads_see_malformed_records_too(spark, tmp_path):
    folder = folder_of(tmp_path, PLAIN + SURPLUS)
    good = readers.read_raw(spark, folder, "products")
    assert good.count() == len(PLAIN) and good.select("brand").where("brand is not null").count() == len(PLAIN)
    assert readers.read_quarantine(spark, folder, "products").count() == len(SURPLUS)


def test_split_stores_both_sides_of_one_pass(spark, tmp_path):
    folder = folder_of(tmp_path, PLAIN + SURPLUS + SHORT, [OPEN])
    good, bad = readers.split_raw(spark, folder, "products")
    want = readers.read_raw(spark, folder, "products")
    assert rows(good) == rows(want) and "ingest_seq" in good.columns
    assert sorted(map(tuple, bad.collect())) == sorted(map(tuple, readers.read_quarantine(spark, folder, "products").collect()))
    assert [r.product_id for r in good.orderBy("ingest_seq").collect()][:3] == ["1", "2", "3"]
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "csv" not in plan.lower()


def test_a_wrong_header_is_an_error(spark, tmp_path):
    (tmp_path / "products").mkdir()
    (tmp_path / "products" / "x.csv").write_text("id,name\n1,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_raw(spark, str(tmp_path), "products").collect()


def test_without_header(spark, tmp_path):
    (tmp_path / "products").mkdir()
    (tmp_path / "products" / "x.csv").write_text("\n".join(PLAIN[:2]))
    made = readers.read_raw(spark, str(tmp_path), "products", header=False)
    assert [r.product_name for r in made.orderBy(F.col("product_id")).collect()] == ["Pipe", 'Pipe 5", red']
