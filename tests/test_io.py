import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.plans.assemble import check_aligned
from tidemark.sources import io
from tidemark.sources.checks import checked


def test_csv_to_parquet_keeps_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ticker,date,codes,close\nTRUE,2015-01-02,"13,21,52",1.5\nAB,2015-01-01,7,\n')
    spec = io.TableSpec("t", {"ticker": "string", "date": "date", "codes": "string", "absent": "string"}, ("ticker", "date"))
    n = io.csv_to_parquet(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"), spec)
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("ticker").collect()
    assert n == 2 and rows[1].ticker == "TRUE" and rows[1].codes == "13,21,52" and rows[0].close is None
    with pytest.raises(ValueError):
        io.require_columns(spark.read.parquet(str(tmp_path / "out")), ["nothing"])


def test_version_is_written_once_and_gated(spark, tmp_path):
    df = spark.range(10).selectExpr("id as entity", "0.5D as weight")
    path = io.write_version(df, str(tmp_path), "1.0", ["entity"], "entity", ["weight"])
    m = spark.read.json(f"{path}/manifest").first()
    assert m.n_rows == 10 and m.effective_weight == 5.0 and m.version == "1.0"
    with pytest.raises(FileExistsError):
        io.write_version(df, str(tmp_path), "1.0", ["entity"], "entity", ["weight"])
    with pytest.raises(ValueError):
        io.write_version(df, str(tmp_path), "2.0", ["entity"], "entity", ["weight"], gate=spark.range(1).select(F.lit(True).alias("flagged")))


def test_alignment(spark):
    a = spark.range(3).selectExpr("id as entity", "1 as quarter", "'x' as kind")
    check_aligned(a, a)
    with pytest.raises(ValueError):
        check_aligned(a, a.limit(2))


def test_forced_version_replaces_the_old_one(spark, tmp_path):
    df = spark.range(10).selectExpr("id as entity", "0.5D as weight")
    path = io.write_version(df, str(tmp_path), "1.0", ["entity"], "entity", ["weight"])
    io.write_version(df.limit(4), str(tmp_path), "1.0", ["entity"], "entity", ["weight"], force=True)
    assert spark.read.parquet(f"{path}/dataset").count() == 4 and not (tmp_path / ".replaced_v1.0").exists()


def test_relation_and_inference_writers(spark, tmp_path):
    df = spark.range(5).selectExpr("id as entity", "cast(id % 2 as int) as age")
    assert io.write_relation(df, "t", str(tmp_path), ["entity"], str(tmp_path / "csv")) == 5
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "t")).count() == 5
    path = io.write_inference(df, str(tmp_path), "2000-06-30", ["entity", "age"], ["entity"], "age")
    m = spark.read.json(f"{path}/manifest").first()
    assert (m.as_of, m.n_rows, m.n_stale, m.columns) == ("2000-06-30", 5, 2, ["entity", "age"])
    with pytest.raises(FileExistsError):
        io.write_inference(df, str(tmp_path), "2000-06-30", ["entity", "age"], ["entity"], "age")
    with pytest.raises(ValueError):
        io.write_inference(df, str(tmp_path), "2000-07-01", ["age", "entity"], ["entity"], "age")


def test_splits_table(spark, tmp_path):
    from tidemark.operators import panel as pn

    tags = spark.createDataFrame([("holdout", 1999, 1, 5, "train"), ("holdout", 1999, 1, 6, "test")], "scheme string, fold int, h int, entity int, role string")
    more = spark.createDataFrame([("random_kfold", 0, 2, 5, "test")], "scheme string, fold int, h int, entity int, role string")
    pn.write_splits([tags, more], str(tmp_path / "splits"), ["entity"])
    back = spark.read.parquet(str(tmp_path / "splits"))
    assert back.count() == 3 and {(r.scheme, r.h, r.role, r.n) for r in pn.role_summary(back).collect()} == {("holdout", 1, "train", 1), ("holdout", 1, "test", 1), ("random_kfold", 2, "test", 1)}
    folds = pn.diagnostic_folds((1, 5), tags)
    assert folds.count() == 12 and folds.where("test_start is not null").count() == 0


def csv_of(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


SPEC = io.TableSpec("t", {"id": "bigint", "day": "date", "gone": "string"}, ("id",))


def test_bad_records_are_kept_apart(spark, tmp_path):
    src = csv_of(tmp_path, "a.csv", "id,day,x,more\n3,2001-02-03,1.5,2\nnot a number,2001-01-01,1,2\n2,2001-13-45,1,2\n1,,,\n4,2001-01-01,1\n5,2001-01-01,1,2,9\n")
    good, bad = io.read_csv_checked(spark, src, SPEC)
    assert [r.id for r in good.orderBy("id").collect()] == [1, 3] and good.columns == ["id", "day", "x", "more"]
    assert sorted(r[io.REJECTED] for r in bad.collect()) == ["2,2001-13-45,1,2", "4,2001-01-01,1", "5,2001-01-01,1,2,9", "not a number,2001-01-01,1,2"]
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="4 lines"):
        io.ingest_csv(spark, src, out, SPEC, most_rejected=3)
    assert not (tmp_path / "out").exists() and spark.read.parquet(out + ".rejected").count() == 4
    got = io.ingest_csv(spark, src, out, SPEC, most_rejected=4)
    assert got == {"n_rows": 2, "n_rejected": 4, "drift": {"absent": ["gone"], "unsorted": [], "twice": []}}
    assert [r.id for r in spark.read.parquet(out).collect()] == [1, 3]


def test_a_failed_ingest_leaves_the_old_table(spark, tmp_path):
    out = str(tmp_path / "t")
    io.ingest_csv(spark, csv_of(tmp_path, "a.csv", "id,day,x\n7,2001-01-01,1\n"), out, SPEC)
    for i, (text, why) in enumerate([("day,x\n2001-01-01,1\n", "no id"), ("id,x,x\n1,2,3\n", "twice x"), ("id,x\nz,1\n", "1 lines")]):
        with pytest.raises(ValueError, match=why):
            io.ingest_csv(spark, csv_of(tmp_path, f"b{i}.csv", text), out, SPEC)
        assert [r.id for r in spark.read.parquet(out).collect()] == [7]
    assert io.ingest_csv(spark, csv_of(tmp_path, "c.csv", "id,extra\n8,2\n9,\n"), out, SPEC)["n_rows"] == 2
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [8, 9] and not (tmp_path / "t.staging").exists() and not (tmp_path / "t.replaced").exists()


def test_needs_fail_the_job_that_reads_the_row(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, -1.0, "b"), (None, 3.0, "c")], "k int, v double, t string")
    with pytest.raises(ValueError, match="prices lacks day"):
        checked(df, "prices", ["k", "day"])
    ok = checked(df.where("k = 1"), "prices", ["k", "t"], {"v above 0": F.col("v") > 0})
    assert ok.columns == df.columns and [tuple(r) for r in ok.collect()] == [(1, 2.0, "a")]
    for rows, why in ((df.where("k is null"), "prices: k is null"), (df.where("k = 2"), "prices: not so: v above 0")):
        with pytest.raises(PySparkException, match=why):
            checked(rows, "prices", ["k"], {"v above 0": F.col("v") > 0}).select("k").collect()
