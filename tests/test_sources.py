"""File sources and sinks: format loads, leading-row skipping, layouts,
export/read-back and scanned bytes."""

import hashlib
import os

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paritylake.session import scratch_dir
from paritylake.sources import files as FS


def _orders(spark):
    return spark.createDataFrame([(i, i % 7, Decimal(f"{i}.25"), f"s{i % 3}") for i in range(1, 201)],
                                 "k long, c long, amount decimal(12,2), s string")


def test_load_formats_counts_and_avro_error(spark):
    got = {r["format"]: (r["landed"], r["status"]) for r in FS.load_formats(spark, _orders(spark), "t").collect()}
    assert got["parquet"] == (200, "PASS") and got["csv"] == (200, "PASS") and got["json"] == (200, "PASS")
    assert got["avro"][1] in ("UNSUPPORTED", "PASS")        # ERROR without the external Avro package


def test_banner_rows_are_skipped_per_file(spark):
    df = _orders(spark).select("k", "c", "s")
    path = scratch_dir(spark, "banner_test")
    FS.write_with_banner(df, path, 3, ["# one", "# two"])
    back = FS.skip_leading_rows(spark, path, 3, schema=df.schema)
    assert back.count() == 200
    assert back.exceptAll(df).count() == 0


def test_export_readback_keeps_decimals(spark):
    df = _orders(spark)
    path = scratch_dir(spark, "export_test")
    FS.export_json(df, path)
    back = FS.readback_json(spark, path, df.schema)
    assert back.schema["amount"].dataType.simpleString() == "decimal(12,2)"
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_stage_layouts_all_fingerprints_equal(spark):
    df = spark.range(1, 300).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int"))
                                    .cast("timestamp").alias("ts"), (F.col("id") * 1.5).alias("x"))
    r = FS.stage_layouts(spark, df, "ts", "layout_test").collect()
    assert len({(x["n"], x["s1"], x["s2"], x["x"]) for x in r}) == 1


def test_scan_bytes_pruned_not_above_full(spark):
    df = _orders(spark)
    path = scratch_dir(spark, "bytes_test")
    df.write.mode("overwrite").partitionBy("s").parquet(path)
    part = spark.read.parquet(path)
    full = FS.scan_bytes(part).first()
    pruned = FS.scan_bytes(part.where(F.col("s") == "s1")).first()
    assert 0 < pruned["bytes_scanned"] < full["bytes_scanned"] and pruned["files"] < full["files"]


def test_header_drift(spark):
    df = _orders(spark).select("k", "c")
    good, bad = scratch_dir(spark, "hdr_good"), scratch_dir(spark, "hdr_bad")
    df.write.mode("overwrite").option("header", "true").csv(good)
    df.withColumnRenamed("c", "cc").write.mode("overwrite").option("header", "true").csv(bad)
    assert {r["status"] for r in FS.header_drift(spark, good, "k,c").collect()} == {"PASS"}
    assert {r["status"] for r in FS.header_drift(spark, bad, "k,c").collect()} == {"FAIL"}


def test_table_metadata_golden_and_twin(spark, sf0001):
    import __spark_entry__ as E
    got = {r["target"]: r["status"] for r in E.queries()["table_metadata_conformance"](spark, sf0001).collect()}
    assert {v for k, v in got.items() if k.startswith("golden:")} == {"PASS"}
    assert {v for k, v in got.items() if k.startswith("twin:") and k != "twin:exists"} == {"FAIL"} and got["gone:exists"] == "FAIL"


def test_readback_raises_on_a_broken_line_and_keeps_null_rows(spark, tmp_path):
    from pyspark.sql import types as T
    from paritylake.sources import files as FS
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    (good / "x.json").write_text('{"a": 1, "b": "x"}\n\n   \n{"a": null, "b": null}\n')
    (bad / "x.json").write_text('{"a": 1}\nnot json\n')
    assert FS.readback_json(spark, str(good), schema).count() == 2
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        FS.readback_json(spark, str(bad), schema).collect()


def test_an_unset_shared_folder_is_an_error_on_a_cluster():
    from paritylake import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
    assert session._in_one_process("local[4]") and not session._in_one_process("local-cluster[2,1,1024]")


def test_csv_values_survive_quotes_and_separators(spark, tmp_path):
    from paritylake.sources import files as FS
    df = spark.createDataFrame([(i, v) for i, v in enumerate(['a|b', 'say "hi"', "", None, "x\\y", "plain"])], "k long, v string")
    path = str(tmp_path / "banner")
    FS.write_with_banner(df, path, 2, ["# one", "# two"])
    back = {r["k"]: r["v"] for r in FS.skip_leading_rows(spark, path, 3, schema=df.schema).collect()}
    assert back[0] == "a|b" and back[1] == 'say "hi"' and back[4] == "x\\y" and back[5] == "plain" and len(back) == 6


def test_checksums_of_delivered_files(spark):
    import gzip
    from paritylake.session import scratch_dir
    from paritylake.sources import files as FS
    df = spark.createDataFrame([(i, f"{i}.50", str(i % 3)) for i in range(60)], "k int, amount string, part string").selectExpr("k", "cast(amount as decimal(12,2)) amount", "part")
    path = scratch_dir(spark, "delivery").removeprefix("file://")
    FS.by_date(df, "part").write.partitionBy("part").option("sep", FS.CSV_SEP).option("compression", "gzip").csv(path)
    manifest = df.groupBy("part").agg(F.count("*").alias("rows"), F.sum("amount").alias("total"))
    digests = spark.createDataFrame([tuple(r) for r in FS.file_digests(spark, path, "part").collect()], "part string, bytes long, sha256 string, plain_sha256 string")
    schema = df.drop("part").schema
    check = lambda **kw: {r["part"]: r["reason"] for r in FS.intake(spark, path, schema, "part", "amount", manifest, digests, **kw).collect()}
    assert check() == {"0": None, "1": None, "2": None}
    assert set(check(max_bytes=10).values()) == {"too large"}

    def rewrite(part, change, level):
        for f in os.listdir(f"{path}/part={part}"):
            if f.startswith("part-"):
                with gzip.open(f"{path}/part={part}/{f}") as g:
                    text = g.read()
                with gzip.open(f"{path}/part={part}/{f}", "wb", level) as g:
                    g.write(change(text))
                crc = f"{path}/part={part}/.{f}.crc"
                if os.path.exists(crc):
                    os.remove(crc)

    rewrite(1, lambda t: t.replace(b"1|1.50", b"2|1.50", 1), 9)  # one byte, equal rows and totals
    rewrite(2, lambda t: t, 1)                                   # packed anew: the plain text is the same
    assert check() == {"0": None, "1": "checksum", "2": None}
    assert FS._unpacked_sha256(b"no archive") is None
    assert FS._unpacked_sha256(gzip.compress(b"a" * 5_000_000) + gzip.compress(b"b"), 1000) == hashlib.sha256(b"a" * 5_000_000 + b"b").hexdigest()
    assert FS._unpacked_sha256(gzip.compress(b"abc")[:-3]) is None
