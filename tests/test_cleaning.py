from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions import loans as L
from vintara.functions.nullsafe import clip, narrow, ratio, to_month, to_number
from vintara.operators import cleaning as C
from vintara.plans import outcomes
from vintara.sources import driver_tables as D
from vintara.sources import loan_files, tables
from vintara.streaming import servicing as stream


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def values(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def cleaned(spark, name, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {name} string")
    return [r[name] for r in C.clean_codes(rows, (name,)).orderBy("i").collect()]


def test_loan_purpose_keeps_nine(spark):
    assert cleaned(spark, "LOAN_PURPOSE", ["P", "C", "9", " 9 ", ""]) == ["P", "C", "9", "9", None]


def test_loan_purpose_blanks_are_missing(spark):
    assert cleaned(spark, "LOAN_PURPOSE", ["", "   "]) == [None, None]


def test_other_codes_drop_nine(spark):
    assert cleaned(spark, "OCC_STATUS", ["P", "9", "99", "S", ""]) == ["P", None, None, "S", None]


def test_absent_code_column_is_skipped(spark):
    rows = spark.createDataFrame([("P",)], "LOAN_PURPOSE string")
    assert C.clean_codes(rows, ("LOAN_PURPOSE", "NOT_PRESENT")).collect()[0][0] == "P"


def test_codes_are_cleaned_independently(spark):
    rows = spark.createDataFrame([(0, "9", "9"), (1, "P", "S")], "i int, LOAN_PURPOSE string, OCC_STATUS string")
    out = C.clean_codes(rows, ("LOAN_PURPOSE", "OCC_STATUS")).orderBy("i").collect()
    assert [(r[1], r[2]) for r in out] == [("9", None), ("P", "S")]


def test_serious_delinquency(spark):
    statuses = ["0", "1", "2", "3", "4", "9", "10", "11", "24", "99", "XX", "RA", "", None, "C"]
    expected = [False] * 3 + [True] * 9 + [False] * 3
    assert values(column(spark, statuses), L.is_seriously_delinquent(F.col("v"))) == expected


def test_zero_balance_flags(spark):
    rows = column(spark, ["01", "03 ", "96", "  ", "", None, "09"])
    assert values(rows, L.is_zero_balance(F.col("v"))) == [True, True, True, False, False, False, True]
    assert values(rows, L.is_prepaid(F.col("v"))) == [True] + [False] * 6
    assert values(rows, L.is_liquidated(F.col("v"))) == [False, True, False, False, False, False, True]


def test_numbers(spark):
    texts = ["7", " 3 ", "3.0", "-1.5", ".5", "5.", "1e3", "+2", "", " ", "1d", "2F", "nan", "inf", "0x1p3", "1,5", "abc", None]
    expected = [7.0, 3.0, 3.0, -1.5, 0.5, 5.0, 1000.0, 2.0] + [None] * 10
    assert values(column(spark, texts), to_number(F.col("v"))) == expected


def test_narrow_integers(spark):
    rows = column(spark, [3.0, 3.5, 40000.0, -1.0, None], "double")
    assert values(rows, narrow(F.col("v"), "short")) == [3, None, None, -1, None]


def test_months(spark):
    rows = column(spark, ["201002", " 201012 ", "201013", "2010", "", None])
    found = values(rows, to_month(F.col("v")).cast("string"))
    assert found == ["2010-02-01", "2010-12-01", None, None, None, None]


def test_clip_and_ratio_keep_nulls(spark):
    rows = column(spark, [-1.0, 0.5, 2.0, None], "double")
    assert values(rows, clip(F.col("v"), 0.0, 1.0)) == [0.0, 0.5, 1.0, None]
    assert values(rows, ratio(F.col("v"), F.lit(0.0))) == [None] * 4


def test_delinquency_as_int(spark):
    rows = column(spark, ["0", "3", "24", "XX", "RA", "C", None])
    assert values(rows, L.delinquency_as_int(F.col("v"))) == [0, 3, 24, 999, 998, 0, 0]


def test_keep_first_takes_first_position_even_for_hot_and_null_keys(spark):
    hot = [(2010, "A", i) for i in range(500, 0, -1)]
    rows = [*hot, (2010, None, 7), (2010, None, 3), (2011, "A", 9)]
    df = spark.createDataFrame(rows, "VINTAGE_YEAR int, LOAN_SEQUENCE_NUMBER string, ROW_SEQ long")
    kept = C.keep_first(df.repartition(8), ["VINTAGE_YEAR", S.LOAN], "ROW_SEQ").collect()
    assert sorted((r[0], r[1] or "", r[2]) for r in kept) == [(2010, "", 3), (2010, "A", 1), (2011, "A", 9)]


def test_load_audit(spark):
    rows = [(2010, "A"), (2010, "A"), (2010, "B"), (2010, None), (2010, None), (2011, "A")]
    df = spark.createDataFrame(rows, "VINTAGE_YEAR int, LOAN_SEQUENCE_NUMBER string")
    audit = {r["VINTAGE_YEAR"]: tuple(r)[1:] for r in C.load_audit(df).collect()}
    assert audit == {2010: (5, 2, 3), 2011: (1, 0, 1)}


# ---------------------------------------------------------------- files


def write_file(path, lines):
    path.write_text("\n".join(lines) + "\n")


def servicing_line(loan, period, age="1", status="0", code=""):
    fields = [""] * len(S.SERVICING_COLUMNS)
    fields[0], fields[1], fields[2], fields[3], fields[4], fields[8] = loan, period, "100.5", status, age, code
    return "|".join(fields)


def test_read_servicing_files(spark, tmp_path):
    write_file(tmp_path / "sample_svcg_2010.txt", [servicing_line("A", "201003", "2", " xx"), "A|201004"])
    write_file(tmp_path / "sample_svcg_2011.txt", [servicing_line("B", "201103", code="01")])
    raw = loan_files.read_servicing(spark, str(tmp_path), (2010, 2011))
    rows = C.clean_servicing(raw).orderBy("LOAN_SEQUENCE_NUMBER", "ROW_SEQ").collect()
    assert [(r["LOAN_SEQUENCE_NUMBER"], r["VINTAGE_YEAR"], str(r["REPORTING_DATE"])) for r in rows] == [
        ("A", 2010, "2010-03-01"), ("A", 2010, "2010-04-01"), ("B", 2011, "2011-03-01"),
    ]
    assert (rows[0]["LOAN_AGE"], rows[0]["IS_DEFAULTED"], rows[2]["IS_PREPAID"]) == (2, True, True)
    found = loan_files.malformed_lines(
        spark, str(tmp_path), loan_files.SERVICING_NAME, S.SERVICING_COLUMNS, (2010, 2011)
    )
    broken = {r[0]: (r[1], r[2]) for r in found.collect()}
    assert broken == {2010: (2, 1), 2011: (1, 0)}


def test_missing_year_fails(spark, tmp_path):
    write_file(tmp_path / "sample_svcg_2010.txt", [servicing_line("A", "201003")])
    with pytest.raises(AnalysisException):
        loan_files.read_servicing(spark, str(tmp_path), (2010, 2011)).count()


def test_row_sequence_follows_the_file_across_splits(spark, tmp_path):
    """A file cut into many splits, packed into tasks in any order, still orders by position."""
    lines = [servicing_line(f"L{i:07d}", "201003") for i in range(60000)]
    write_file(tmp_path / "sample_svcg_2010.txt", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = loan_files.read_servicing(spark, str(tmp_path), (2010,))
        assert raw.rdd.getNumPartitions() > 2
        got = [r[0] for r in raw.orderBy("ROW_SEQ").select(S.LOAN).collect()]
        assert got == sorted(got) and len(got) == 60000
        assert raw.where((F.col("ROW_SEQ") < 0) | F.col("ROW_SEQ").isNull()).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_vintage_tables(spark, sf_dir, tmp_path):
    path = str(tmp_path / "orig")
    orig = D.origination(spark, sf_dir)
    tables.write_by_vintage(orig, path, sort_by=(S.LOAN,))
    assert tables.read_vintages(spark, path).count() == orig.count()
    some = tables.read_vintages(spark, path, (2011, 2012))
    assert {r[0] for r in some.select("VINTAGE_YEAR").distinct().collect()} == {2011, 2012}
    with pytest.raises(FileNotFoundError):
        tables.read_vintages(spark, path, (2011, 1999))
    # Rerunning one year replaces that year only.
    tables.write_by_vintage(orig.where("VINTAGE_YEAR = 2011").limit(3), path)
    counts = {r[0]: r[1] for r in tables.read_vintages(spark, path).groupBy("VINTAGE_YEAR").count().collect()}
    assert counts[2011] == 3 and sum(counts.values()) > 1000


def test_stream_matches_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [servicing_line(f"L{i % 7}", "201003", str(i % 40), str(i % 5), "01" if i % 9 == 0 else "") for i in range(300)]
    write_file(folder / "sample_svcg_2010.txt", lines[:200])
    write_file(folder / "sample_svcg_2012.txt", lines[200:])
    out = str(tmp_path / "out")

    def drain():
        cleaned = stream.servicing_stream(spark, str(folder))
        stream.append_servicing(cleaned, out, str(tmp_path / "state")).awaitTermination()

    drain()
    drain()  # nothing new: files are taken once
    batch = C.clean_servicing(loan_files.read_servicing(spark, str(folder), (2010, 2012)))
    columns = [S.LOAN, "LOAN_AGE", "IS_DEFAULTED", "IS_PREPAID", "VINTAGE_YEAR"]
    left = sorted(map(tuple, spark.read.parquet(out).select(*columns).collect()))
    assert left == sorted(map(tuple, batch.select(*columns).collect())) and len(left) == 300
    orig = spark.createDataFrame([(f"L{i}", 2010) for i in range(7)], f"{S.LOAN} string, VINTAGE_YEAR int").withColumns(
        {"ORIGINATION_DATE": F.lit("2009-12-01").cast("date"), "ORIGINAL_UPB": F.lit(1.0)}
    )
    streamed = outcomes.loan_outcomes(spark.read.parquet(out), orig)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, outcomes.loan_outcomes(batch, orig).collect()))


def test_micro_batches_are_cut_finer_than_the_cores(spark, tmp_path):
    """A batch makes several tasks for each core, so that its last round keeps few cores waiting."""
    folder = tmp_path / "in"
    folder.mkdir()
    line = servicing_line("L1", "201003", "1", "0", "")
    write_file(folder / "sample_svcg_2010.txt", [line] * 4000)
    tasks, old = [], spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        cleaned = stream.servicing_stream(spark, str(folder))
        query = cleaned.writeStream.foreachBatch(lambda batch, _: tasks.append(batch.rdd.getNumPartitions()))
        query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    assert tasks and tasks[0] > 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(stream.MIN_TASKS, None) is None


def test_order_keys_have_no_bounds(spark):
    """Months of any century order by time, positions of any size by file, undated records last."""
    seqs = [(1 << 53) + 5, (1 << 53) + 4, 10**25, 0]
    rows = [(m, Decimal(s)) for m in ("1900-01-01", "1904-05-01", "2076-01-01", "2080-01-01", "9999-12-01", None) for s in sorted(seqs)]
    df = spark.createDataFrame(rows, "m string, s decimal(30,0)").withColumn("o", L.event_order(F.col("m").cast("date"), F.col("s")))
    assert [(r["m"], r["s"]) for r in df.orderBy("o").collect()] == rows
    assert df.select("o").distinct().count() == len(rows)


def test_combine_years_fills_missing_columns(spark):
    a = spark.createDataFrame([("A", 1)], "k string, x int")
    b = spark.createDataFrame([("B",)], "k string")
    assert sorted(map(tuple, tables.combine_years([a, b]).collect())) == [("A", 1), ("B", None)]
