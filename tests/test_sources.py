import datetime as dt
import io
import json
import struct
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketloom.sources import bar_files, block_files, config_files, files, finance_files, sinks, texts


def write(folder, name, data):
    target = folder / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(data)
    return target


def test_daily_files_from_disk(spark, tmp_path):
    one = struct.pack("<IIIIIfII", 20260910, 1234, 1300, 1200, 1250, 5.5, 700, 0)
    write(tmp_path, "sh/lday/sh600000.day", one + struct.pack("<IIIIIfII", 20261399, 1, 1, 1, 1, 0, 1, 0))
    write(tmp_path, "sh/lday/sh510300.day", one)
    found = files.read_files(spark, str(tmp_path), "*.day")
    out = {(r["path"][-12:], r["position"]): r for r in bar_files.daily_bars(found).collect()}
    stock, bad, fund = out["sh600000.day", 0], out["sh600000.day", 1], out["sh510300.day", 0]
    assert (stock["date"], stock["open"], stock["amount"], stock["volume"]) == (dt.date(2026, 9, 10), 12.34, 5.5, 7.0)
    assert bad["date"] is None
    assert (fund["open"], fund["volume"]) == (pytest.approx(1.234), 700.0)
    write(tmp_path, "sh/lday/sh400000.day", one)
    found = files.read_files(spark, str(tmp_path), "*.day")
    with pytest.raises(PySparkException, match="unknown security type"):
        bar_files.daily_bars(found).collect()
    lenient = bar_files.daily_bars(found, strict=False).where("security_type = 'SH_OTHER'").first()
    assert lenient["open"] is None


def content(spark, path, data):
    return spark.createDataFrame([(path, bytearray(data))], "path string, content binary")


def test_minute_and_extended_records(spark):
    day = (2026 - 2004) * 2048 + 910
    legacy = content(spark, "/sz000001.1", struct.pack("<HHIIIIfII", day, 571, 1010, 1020, 1000, 1015, 2.5, 300, 0))
    row = bar_files.minute_bars_legacy(legacy).first()
    assert (row["ts"], row["open"], row["close"], row["volume"]) == (dt.datetime(2026, 9, 10, 9, 31), 10.1, 10.15, 300.0)
    lc = content(spark, "/sz000001.lc1", struct.pack("<HHfffffII", day, 900, 1.5, 2.5, 0.5, 2.25, 4.0, 7, 0))
    row = bar_files.minute_bars_lc(lc).first()
    assert (row["ts"].hour, row["high"], row["amount"]) == (15, 2.5, 4.0)
    bits = struct.unpack("<I", struct.pack("<f", -12.375))[0]
    ext = content(spark, "/47#IFL0.day", struct.pack("<IffffIIf", 20260910, 1.5, 2.5, 0.5, 2.0, bits, 9, 1.25))
    row = bar_files.extended_daily_bars(ext).first()
    assert (row["amount"], row["hk_stock_amount"], row["settlement"]) == (bits, -12.375, 1.25)


def test_delisted_header_is_checked(spark):
    record = struct.pack("<I5fI4x", 20200102, 1.0, 2.0, 0.5, 1.5, 9.0, 250)
    good = content(spark, "/T600001.~~~day", b"\0" * 10 + struct.pack("<I", 1) + record)
    row = bar_files.delisted_bars(good).first()
    assert (row["date"], row["volume"]) == (dt.date(2020, 1, 2), 2.5)
    for data in (b"\0" * 5, b"\0" * 10 + struct.pack("<I", 2) + record):
        bad = content(spark, "/x.~~~day", data)
        with pytest.raises(PySparkException):
            bar_files.delisted_bars(bad).collect()
        assert bar_files.delisted_bars(bad, strict=False).first()["error"]


def test_blocks_and_watchlists(spark, tmp_path):
    codes = b"".join(c.ljust(7, b"\0") for c in (b"600000", b"000001"))
    data = b"\0" * 384 + struct.pack("<H", 1) + "白酒".encode("gbk").ljust(9, b"\0") + struct.pack("<HH", 2, 3) + codes.ljust(2800, b"\0")
    out = block_files.block_members(content(spark, "/block.dat", data)).orderBy("code_index").collect()
    assert [(r["blockname"], r["block_type"], r["code"]) for r in out] == [("白酒", 3, "600000"), ("白酒", 3, "000001")]
    entry = "自选".encode("gbk").ljust(50, b"\0") + b"ZX".ljust(70, b"\0")
    write(tmp_path, "blocknew.cfg", entry)
    write(tmp_path, "ZX.blk", b"1600000\r\n\r\n0000001\r\n")
    out = block_files.watchlist_members(files.read_files(spark, str(tmp_path))).orderBy("code_index").collect()
    assert [(r["blockname"], r["code_index"], r["code"]) for r in out] == [("自选", 0, "600000"), ("自选", 2, "000001")]
    (tmp_path / "ZX.blk").unlink()
    with pytest.raises(PySparkException, match="missing"):
        block_files.watchlist_members(files.read_files(spark, str(tmp_path))).collect()


def test_config_text_in_either_charset(spark):
    text = "#注释\n1|600000|T0101|||X500102\n\x00\n0|000001|T02|银行\n|x|y\n"
    for data in (text.encode("gb18030"), b"\xef\xbb\xbf" + text.encode("utf-8")):
        out = config_files.parse_config(content(spark, "/T0002/tdxhy.cfg", data), "tdxhy.cfg").orderBy("line_no").collect()
        assert [(r["market"], r["code"], r["tdx_industry_code"], r["sw_industry_code"], r["source"]) for r in out] == [
            ("sh", "600000", "T0101", "X500102", "tdxhy.cfg"), ("sz", "000001", "T02", "银行", "tdxhy.cfg"),
        ]
    with pytest.raises(ValueError):
        config_files.parse_config(content(spark, "/x", b""), "nope.cfg")


def test_config_headers_and_sections(spark):
    blocks = content(spark, "/spblock.dat", "1600000\n#甲\n1600000\n12345\n#乙\n 0000001 \n".encode("gbk"))
    out = config_files.parse_config(blocks, "spblock").orderBy("line_no").collect()
    assert [(r["block_name"], r["market"], r["code"], r["raw_code"]) for r in out] == [("甲", "sh", "600000", "1600000"), ("乙", "sz", "000001", "0000001")]
    dictionary = content(spark, "/incon.dat", "#TDXNHY\nT01|银行\n#skip|x\nT02|\n######\n######\nSWHY\n480000|银行业|z\n".encode())
    out = config_files.parse_config(dictionary, "incon").orderBy("line_no").collect()
    assert [(r["source"], r["code"], r["name"]) for r in out] == [("TDXNHY", "T01", "银行"), ("SWHY", "480000", "银行业")]


def dat(records, width, date=20260630):
    end = 20 + len(records) * 11
    index = b"".join(struct.pack("<6scL", c.encode(), b"\1", end + i * width * 4) for i, (c, _) in enumerate(records))
    return struct.pack("<hIH3L", 1, date, len(records), 0, width * 4, 0) + index + b"".join(struct.pack(f"<{width}f", *v) for _, v in records)


def test_financial_archives(spark, tmp_path):
    data = dat([("600000", (1.5, float("nan"))), ("600000", (1.5, float("nan"))), ("000001", (2.0, 3.0))], 2)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr("gpcw.DAT", data)
    write(tmp_path, "gpcw20260630.zip", packed.getvalue())
    write(tmp_path, "gpcw20260331.dat", dat([("600000", (7.0, 8.0))], 2, 20260331))
    source = files.read_files(spark, str(tmp_path))
    out = finance_files.read_finance(source, 2, ["报告期", "每股收益"]).orderBy("code", "报告期").collect()
    assert [tuple(r) for r in out] == [("000001", 20260630, 2.0, 3.0), ("600000", 20260331, 7.0, 8.0), ("600000", 20260630, 1.5, None)]
    with pytest.raises(ValueError, match="unique"):
        finance_files.read_finance(source, 2, ["a", "b", "a"])
    for broken in (data[:10], data[:-1], struct.pack("<hIH3L", 1, 1, 1, 0, 6, 0)):
        bad = content(spark, "/x.dat", broken)
        with pytest.raises(PySparkException):
            finance_files.financial_records(bad).collect()
        assert finance_files.financial_records(bad, strict=False).first()["error"]
    conflict = content(spark, "/x.dat", dat([("600000", (1.0,)), ("600000", (2.0,))], 1))
    with pytest.raises(PySparkException, match="conflicting"):
        finance_files.read_finance(conflict, 1).collect()


def test_exports_and_factor_payloads(spark):
    body = "标题\r\n单位\r\n日期,a,b\r\n2026/09/10,1,2,0.5,1.5,100,150\r\n2026/09/11,2,3,1,2,x,4\r\n数据来源\r\n"
    out = texts.exported_bars(content(spark, "/a.txt", body.encode("gbk"))).orderBy("position").collect()
    assert [(str(r["date"]), r["close"], r["volume"]) for r in out] == [("2026-09-10", 1.5, 100.0), ("2026-09-11", 2.0, None)]
    payload = spark.createDataFrame([('var sh600000qfq={"total":1,"data":[{"d":"2026-01-02","f":"1.5"}]};\n',)], "text string")
    assert [tuple(r) for r in texts.adjustment_payloads(payload).collect()] == [(dt.date(2026, 1, 2), 1.5)]
    empty = spark.createDataFrame([('x={"data":[]};',), ("nothing",)], "text string")
    assert texts.adjustment_payloads(empty, strict=False).count() == 0
    with pytest.raises(PySparkException, match="no factors"):
        texts.adjustment_payloads(empty).collect()


def test_manifest(spark):
    import hashlib

    data = b"hello"
    manifest = spark.createDataFrame([("A.zip", 5, hashlib.md5(data).hexdigest().upper()), ("b.zip", 1, "0" * 32)], "filename string, filesize int, hash string")
    held = content(spark, "/d/a.ZIP", data)
    out = {r["filename"]: r["status"] for r in texts.verify_files(held, manifest.unionByName(manifest)).collect()}
    assert out == {"A.zip": "ok", "b.zip": "missing"}
    clash = manifest.unionByName(manifest.withColumn("filesize", F.lit(9)))
    with pytest.raises(PySparkException, match="conflicting"):
        texts.verify_files(held, clash).collect()
    assert {r["status"] for r in texts.verify_files(held, clash, strict=False).collect()} == {"conflict"}


def test_locating_files(spark):
    paths = spark.createDataFrame([("/v/sh/minline/sh600000.1",), ("/v/sh/minline/SH600000.LC1",), ("/v/ds/minline/47#IFL0.lc1",), ("/T0002/ds_cache/x#T600001.~~~day",)], "path string")
    asked = spark.createDataFrame([("600000",), ("47#ifl0",), ("sz000001",)], "symbol string")
    out = {r["symbol"]: r["path"] for r in files.locate(paths, asked, "minline", ["lc1", "1"]).collect()}
    assert out == {"600000": "/v/sh/minline/SH600000.LC1", "47#ifl0": "/v/ds/minline/47#IFL0.lc1"}
    gone = spark.createDataFrame([("sh600001",)], "symbol string")
    assert files.locate(paths, gone, "ds_cache", ["~~~day"]).first()["path"].endswith("T600001.~~~day")


def test_records_are_json_safe(spark):
    frame = spark.createDataFrame(
        [(float("nan"), dt.datetime(2026, 9, 10, 9, 30), dt.datetime(2026, 9, 10, 9, 30, 0, 5), dt.date(2026, 9, 10), bytearray(b"hi"), [1.0, float("inf")], {"k": float("nan")})],
        "a double, b timestamp_ntz, c timestamp_ntz, d date, e binary, f array<double>, g map<string,double>",
    )
    assert json.loads(sinks.to_records(frame).first()["record"]) == {
        "a": None, "b": "2026-09-10T09:30:00+08:00", "c": "2026-09-10T09:30:00.000005+08:00", "d": "2026-09-10", "e": "aGk=", "f": [1.0, None], "g": {"k": None},
    }


def test_export_bundle(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "code string, v int")
    sinks.export(frame, str(tmp_path / "out"), "csv", by=["code"])
    assert sorted(p.name for p in (tmp_path / "out").glob("code=*")) == ["code=a", "code=b"]
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2
    with pytest.raises(ValueError):
        sinks.export(frame, str(tmp_path / "x"), "xlsx")


def test_text_bundles_equal_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    """Folders, escapes, quotes, NULL and empty keys; a file has its name only when whole."""
    day = dt.date(2020, 1, 1)
    values = [("a", 1, 1.5, 'x,"y"', day), ("a", 1, None, "", None), ("", 2, 2.0, "line\nbreak é", day), (None, 2, 1e-10, None, None), ("q/%=1 é{}^", 3, 1e20, "  s ", None)]
    frame = spark.createDataFrame(values, "code string, n int, v double, `t,x` string, d date")

    def state(folder):
        found = {}
        for file in folder.rglob("part-*"):
            found.setdefault(str(file.parent.relative_to(folder)), []).append(sorted(file.read_bytes().splitlines()))
        return found

    for fmt, option in (("csv", ("header", "true")), ("json", ("ignoreNullFields", "false"))):
        for by in (["code"], ["code", "n"]):
            mine, sparks = (tmp_path / f"{who}-{fmt}-{len(by)}" for who in ("mine", "sparks"))
            sinks.export(frame, str(mine), fmt, by)
            frame.hint("rebalance", *by).write.partitionBy(*by).option(*option).format(fmt).save(str(sparks))
            assert state(mine) == state(sparks) and (mine / "_SUCCESS").exists()
            # No checksum file beside each file: the tasks wrote them, not Spark's local file system.
            assert not list(mine.rglob("*=*/.*.crc"))
            with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS"):
                sinks.export(frame, str(mine), fmt, by)
            sinks.export(frame, str(mine), fmt, by, mode="append")
            assert sum(len(files) for files in state(mine).values()) == 2 * len(state(sparks))
    failing = frame.withColumn("v", F.when(F.col("n") == 3, F.raise_error("boom")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="boom"):
        sinks.export(failing, str(tmp_path / "broken"), "csv", ["code"])
    assert not (tmp_path / "broken/_SUCCESS").exists()
    # Where pyarrow does not know the file system, Spark writes.
    monkeypatch.setattr(sinks, "_arrow_path", lambda frame, path: None)
    sinks.export(frame, str(tmp_path / "elsewhere"), "csv", ["code"])
    assert list((tmp_path / "elsewhere").rglob("*=*/.*.crc"))


# -- split scan of fixed records ------------------------------------------------------------------
def daily_content(first, count):
    import numpy as np
    from marketloom.sources import bar_files

    records = np.zeros(count, dtype=bar_files.DAILY.dtype)
    for k, name in enumerate(("day", "open", "high", "low", "close", "amount", "volume")):
        records[name] = np.arange(first, first + count) * (k + 1) if name != "day" else 20310101 + np.arange(first, first + count) % 28
    return records.tobytes()


def test_split_scan_equals_whole_files(spark, tmp_path, rows):
    from marketloom.sources import bar_files, files
    from marketloom.sources.record_source import scan_records
    from marketloom.sources.sinks import write_files

    contents = [(f"/sz/lday/sz00000{k}.day", daily_content(k, n)) for k, n in ((1, 1000), (2, 3), (3, 0), (4, 250))]
    made = spark.createDataFrame([(p, bytearray(c)) for p, c in contents], "path string, content binary")
    assert write_files(made, str(tmp_path)) == 4
    whole = bar_files.decode_records(files.read_files(spark, str(tmp_path), "*.day"), bar_files.DAILY)
    split = scan_records(spark, str(tmp_path), "daily", split_bytes=3200, suffix=".day")
    assert split.rdd.getNumPartitions() >= 10 and rows(split) == rows(whole)
    assert scan_records(spark, str(tmp_path), "daily", suffix=".day").rdd.getNumPartitions() == 1
    # The scan takes the place of files; columns and conditions on the day reach the reader.
    assert rows(bar_files.daily_bars(split)) == rows(bar_files.daily_bars(files.read_files(spark, str(tmp_path), "*.day")))
    some = scan_records(spark, str(tmp_path), "daily", columns=["path", "day", "close"], split_bytes=3200)
    assert some.columns == ["path", "day", "close"]
    late = lambda frame: frame.where("day >= 20310115 and day < 20310120").select("path", "day", "close")
    assert rows(late(some)) == rows(late(whole)) and late(some).count() > 100


def test_day_conditions_are_applied_in_the_reader(tmp_path):
    from marketloom.sources.record_source import FixedRecords, RecordReader
    from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

    (tmp_path / "sz000001.day").write_bytes(daily_content(0, 280))
    options = {"path": f"file:{tmp_path}", "layout": "daily", "splitbytes": "640"}
    reader = RecordReader(FixedRecords(options).schema(), options)
    assert len(list(reader.pushFilters([GreaterThanOrEqual(("day",), 20310103), LessThan(("day",), 20310105), LessThan(("close",), 9)]))) == 3
    parts = reader.partitions()
    assert len(parts) == 14 and sum(n for p in parts for *_, n in p.parts) == 280
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 20


def test_split_scan_of_broken_and_counted_files(spark, tmp_path, rows):
    import numpy as np
    from marketloom.sources import bar_files, files
    from marketloom.sources.record_source import scan_records

    body = np.zeros(100, dtype=bar_files.DELISTED.dtype)
    body["day"], body["volume"] = 20310101, np.arange(100)
    good = b"\0" * 10 + np.uint32(70).tobytes() + body.tobytes()  # fewer than there is room for
    (tmp_path / "sz1.x").write_bytes(good)
    (tmp_path / "sz2.x").write_bytes(good[:500])
    (tmp_path / "sz3.x").write_bytes(b"short")
    whole = bar_files.decode_records(files.read_files(spark, str(tmp_path)), bar_files.DELISTED, strict=False)
    split = scan_records(spark, str(tmp_path), "delisted", strict=False, split_bytes=640)
    assert rows(split) == rows(whole) and split.where("error is not null").count() == 2 and split.count() == 72
    with pytest.raises(Exception, match="exceed the file size|shorter than its header"):
        scan_records(spark, str(tmp_path), "delisted").count()


def test_files_are_written_while_rows_arrive():
    """Files may span batches; content leaves before all rows are in, so a task holds one file."""
    import numpy as np
    import pyarrow as pa

    from marketloom.plans import source_queries

    rows = [(f"/f{n}", i) for n, count in enumerate([3, 1, 5, 2]) for i in range(count)]
    batches = [
        pa.RecordBatch.from_pydict({"path": [p for p, _ in rows[k : k + 4]], "_o": [i for _, i in rows[k : k + 4]]})
        for k in range(0, len(rows), 4)
    ]
    write = source_queries._file_writer(lambda table: bytes(table["_o"].to_pylist()))
    out = [(r["path"], r["content"]) for b in write(iter(batches)) for r in b.to_pylist()]
    assert out == [("/f0", b"\0\1\2"), ("/f1", b"\0"), ("/f2", b"\0\1\2\3\4"), ("/f3", b"\0\1")]

    read = []

    def many():
        for n in range(64):
            read.append(n)
            yield pa.RecordBatch.from_arrays([pa.array([f"/{n}"] * 1000), pa.array(np.arange(1000))], ["path", "_o"])

    next(source_queries._file_writer(lambda table: b"\0" * (1 << 20))(many()))
    assert len(read) < 10


def test_decoded_files_share_batches_and_large_ones_are_split(spark):
    record = struct.pack("<IIIIIfII", 20260910, 1234, 1300, 1200, 1250, float("nan"), 700, 0)
    rows = [(f"/sz/lday/sz{n:06d}.day", bytearray(record * count)) for n, count in [(1, 2), (2, 0), (3, 70_000), (4, 1)]]
    found = bar_files.daily_bars(spark.createDataFrame(rows, "path string, content binary").coalesce(1))
    out = found.groupBy("path").agg(F.count("*"), F.count_distinct("position"), F.max("position"), F.count("amount")).collect()
    assert sorted(tuple(r)[1:] for r in out) == [(1, 1, 0, 0), (2, 2, 1, 0), (70_000, 70_000, 69_999, 0)]


def test_queries_do_not_collect_the_rows_of_a_file(spark):
    from marketloom.plans.registry import QUERIES

    for name in ("daily_files", "minute_files", "finance_files"):
        plan = QUERIES[name].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan, name
