import datetime
import json

import pytest
from pyspark.sql import functions as F, types as T

from riskloom import session
from riskloom.sources.csv_files import MissingInput, join_by_position, read_csv, write_csv
from riskloom.sources.documents import read_document, write_document


def test_missing_texts_and_types(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        "id,rate,years,flag,none,amount\n"
        "1,5.5,10+ years,True,NA,1e3\n"
        "2,NaN,n/a,False,,-.5\n"
        "3,null,NULL,True,NULL,inf\n"
        '4, 7 ,"< 1, year",,<NA>,12\n'
    )
    df = read_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema] == [
        "bigint", "double", "string", "boolean", "double", "double",
    ]
    rows = [tuple(r) for r in df.orderBy("id").collect()]
    assert rows == [
        (1, 5.5, "10+ years", True, None, 1000.0),
        (2, None, None, False, None, -0.5),
        (3, None, None, True, None, None),
        (4, 7.0, "< 1, year", None, None, 12.0),
    ]


def test_given_schema(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b\n1,x\nNA,y\n")
    schema = T.StructType().add("b", T.StringType()).add("a", T.IntegerType())
    assert [tuple(r) for r in read_csv(spark, str(path), schema).collect()] == [("x", 1), ("y", None)]
    with pytest.raises(ValueError, match="no column z"):
        read_csv(spark, str(path), T.StructType().add("z", T.StringType()))
    path.write_text("a,b\n1,x\noops,y\n")
    with pytest.raises(Exception, match="oops"):
        read_csv(spark, str(path), schema).collect()


def test_missing_input(spark, tmp_path):
    with pytest.raises(MissingInput, match="prepare"):
        read_csv(spark, str(tmp_path / "none.csv"), hint="Run prepare first.")


def test_round_trip(spark, tmp_path, ten_loans):
    write_csv(ten_loans, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), ten_loans.schema)
    assert back.exceptAll(ten_loans).count() == 0 and back.count() == 10


def test_rows_side_by_side(spark, tmp_path):
    # Several files of unequal size: Spark reads the largest first, the order of names counts.
    df = spark.range(5000).select("id", F.md5(F.col("id").cast("string")).alias("h"))
    x = tmp_path / "x"
    x.mkdir()
    y = tmp_path / "y.csv"
    rows = df.orderBy("id").collect()
    start = 0
    for i, n in enumerate((10, 3000, 1, 1989)):
        part = rows[start : start + n]
        (x / f"part-{i}.csv").write_text("id,h\n" + "".join(f"{r['id']},{r['h']}\n" for r in part))
        start += n
    y.write_text("y\n" + "".join(f"{r['id']}\n" for r in rows[:4998]))
    left = read_csv(spark, str(x), positions=True)
    right = read_csv(spark, str(y), positions=True)
    both = join_by_position(left, right)
    assert both.count() == 5000
    assert both.filter("y is null").count() == 2
    assert both.filter("id = y and id = row_position").count() == 4998
    with pytest.raises(ValueError):
        join_by_position(left, right, strict=True)


def test_blocks_of_one_file_are_in_order(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("id,pad\n" + "".join(f"{i},{'x' * 40}\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = read_csv(spark, str(path), positions=True)
        assert df.select("_block").distinct().count() > 3
        joined = join_by_position(df, read_csv(spark, str(path), positions=True).select("pad", "_file", "_block", "_local"))
        assert joined.filter("id = row_position").count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_document(spark, tmp_path):
    df = spark.sql("select 'a' as model, cast(null as double) as auc, named_struct('depth', 3) as params")
    write_document(df, str(tmp_path / "doc"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*")))
    assert json.loads(text) == {"model": "a", "auc": None, "params": {"depth": 3}}
    assert text.startswith("{\n  ")
    assert read_document(spark, str(tmp_path / "doc")).first()["params"]["depth"] == 3


def test_stage_reads_back_what_was_written(spark, ten_loans):
    staged = session.stage(ten_loans, "t")
    assert staged.schema == ten_loans.schema and staged.exceptAll(ten_loans).count() == 0
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]


class Unset:
    """A session without spark.checkpoint.dir."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master, self.folder = master, None

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_a_local_session_makes_its_own_folder(spark):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Unset("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Unset("local-cluster[3,2,1000]"))
    local = Unset("local[4]")
    assert session.scratch_dir(local) == session.scratch_dir(local) == local.folder


def test_month_text(spark):
    month = spark.sql("select date_format(current_date(), 'yyyy-MM')").first()[0]
    assert datetime.datetime.strptime(month, "%Y-%m")


def test_cells_as_other_tools_write_them(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,title,n\n1,"say ""hi"", now",9223372036854775806\n2,"  lead ",-9223372036854775808\n')
    rows = [tuple(r) for r in read_csv(spark, str(path)).orderBy("id").collect()]
    assert rows == [(1, 'say "hi", now', 9223372036854775806), (2, "  lead ", -9223372036854775808)]
    path.write_text("id\n9223372036854775807\n9223372036854775808\n")
    assert [r["id"] for r in read_csv(spark, str(path)).orderBy("id").collect()] == [
        "9223372036854775807", "9223372036854775808",
    ]
    path.write_text('id,title\n1,"two\nlines"\n2,one\n')
    rows = read_csv(spark, str(path), multi_line=True).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines"), (2, "one")]


def test_sink_doubles_quotes_and_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([(1, ' q"x '), (2, 'a, "b"')], "id bigint, t string")
    write_csv(df.coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert '" q""x "' in text and '"a, ""b"""' in text and "\\" not in text
    assert read_csv(spark, str(tmp_path / "out")).exceptAll(df).count() == 0


def test_parts_are_ordered_by_number(spark):
    from riskloom.sources.csv_files import natural_order

    names = [f"file:/x/d2/part-{n}-c000.csv" for n in ("00009", "00010", "99999", "100000", "1000000")]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "f string")
    assert [r["f"] for r in df.orderBy(natural_order(F.col("f"))).collect()] == names


def test_staging_removes_its_folders(spark, ten_loans):
    from pathlib import Path

    kept = session.stage(ten_loans, "kept")
    with session.staging(spark):
        gone = session.stage(ten_loans, "gone")
        with session.staging(spark):
            inner = session.stage(ten_loans, "inner").inputFiles()
        assert not Path(inner[0].removeprefix("file://")).exists()
        files = gone.inputFiles()
    assert not Path(files[0].removeprefix("file://")).exists()
    assert kept.count() == 10


def test_loan_view_keeps_the_rows_of_the_orders(spark):
    from compare import TABLES

    from riskloom.sources.tables import raw_loans

    whole = raw_loans(spark, TABLES)
    narrow = raw_loans(spark, TABLES, ["loan_id", "y", "purpose"])
    assert narrow.exceptAll(whole.select("loan_id", "y", "purpose")).count() == 0
    assert raw_loans(spark, TABLES, ["funded_amnt"]).count() == whole.count()
