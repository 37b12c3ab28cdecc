import pytest
from pyspark.sql import functions as F

from hostpulse.config import LOG_COLUMNS, RAW_HEADER
from hostpulse.operators.cleaning import clean
from hostpulse.session import materialise
from hostpulse.sources import csv_logs
from hostpulse.sources.csv_logs import FILE_ORDER, detect_dialects, read_log_folder, rejected_files, scan_files, scan_lines

ROW = ["1.1.1.1", "05/Feb/2018 06:25:05", "GET", "/", "HTTP/1.1", "200", "7", "-", "Mozilla"]


def text(separator, *rows, end="\n", header=RAW_HEADER):
    return end.join(separator.join(r) for r in [header, *rows]) + end


def with_(**changes):
    return [changes.get(c, v) for c, v in zip(LOG_COLUMNS, ROW)]


@pytest.fixture
def folder(tmp_path):
    files = {
        "comma.csv": text(",", with_(referrer='"a,b ""q"""')).encode(),
        "tab_crlf.csv": text("\t", with_(host="2.2.2.2"), end="\r\n").encode(),
        "semi_bom.csv": b"\xef\xbb\xbf" + text(";", with_(host="3.3.3.3")).encode(),
        "pipe_1250.csv": text("|", with_(resource="/żółw")).encode("cp1250"),
        "latin.csv": text(",", with_(resource="/é\x81")).encode("latin-1"),
        "blank_first.csv": b"\n  \n" + text(",", with_(host="4.4.4.4")).encode(),
        "ragged.csv": (text(",", with_(host="5.5.5.5")) + ",".join(with_(host="6.6.6.6")) + ",extra\n" + "7.7.7.7,x\n").encode(),
        "other_names.csv": text(",", with_(host="8.8.8.8"), header=[f"c{i}" for i in range(9)]).encode(),
        "eight.csv": "\n".join([",".join(RAW_HEADER[:8]), ",".join(ROW[:8])]).encode(),
        "empty.csv": b"",
        "notes.txt": text(",", with_(host="9.9.9.9")).encode(),
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    return str(tmp_path)


def test_dialects(spark, folder):
    found = {r.file: (r.separator, r.encoding) for r in detect_dialects(spark, folder).collect()}
    assert found == {
        "comma.csv": (",", "utf-8"), "tab_crlf.csv": ("\t", "utf-8"), "semi_bom.csv": (";", "utf-8-sig"),
        "pipe_1250.csv": ("|", "windows-1250"), "latin.csv": (",", "latin-1"), "blank_first.csv": (",", "utf-8"),
        "ragged.csv": (",", "utf-8"), "other_names.csv": (",", "utf-8"),
    }


def test_rows(spark, folder):
    raw = read_log_folder(spark, folder)
    assert raw.columns == [*LOG_COLUMNS, *FILE_ORDER]
    rows = {(r._source_file, r.host): r for r in raw.collect()}
    assert {k[1] for k in rows} == {f"{i}.{i}.{i}.{i}" for i in range(1, 9)}
    assert rows["comma.csv", "1.1.1.1"].referrer == 'a,b "q"'
    assert rows["tab_crlf.csv", "2.2.2.2"].user_agent == "Mozilla"
    assert rows["pipe_1250.csv", "1.1.1.1"].resource == "/żółw"
    assert rows["latin.csv", "1.1.1.1"].resource == "/é\x81"
    assert rows["ragged.csv", "6.6.6.6"].user_agent == "Mozilla"
    assert rows["ragged.csv", "7.7.7.7"].user_agent is None


def test_first_file_wins_among_copies(spark, tmp_path):
    (tmp_path / "b.csv").write_text(text(",", with_(bytes="2")))
    (tmp_path / "a.csv").write_text(text(",", with_(bytes="1"), with_(bytes="3")))
    assert [r.bytes for r in clean(read_log_folder(spark, str(tmp_path)), FILE_ORDER).collect()] == [1]


def test_small_splits_keep_the_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text(text(",", *[with_(bytes=str(i), resource=f"/{i % 50}") for i in range(2000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        raw = read_log_folder(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 5
        kept = {r.resource: r.bytes for r in clean(raw, FILE_ORDER).collect()}
        assert raw.count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert kept == {f"/{i}": i for i in range(50)}


def test_missing_and_unusable_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_log_folder(spark, str(tmp_path))
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(RuntimeError):
        read_log_folder(spark, str(tmp_path))


def test_quoted_line_breaks_and_white_first_lines_lose_nothing(spark, tmp_path):
    (tmp_path / "broken.csv").write_text(text(",", with_(user_agent='"Moz\nilla"'), with_(host="2.2.2.2")))
    (tmp_path / "tab.csv").write_text("\t\n" + text(",", with_(host="3.3.3.3")))
    (tmp_path / "nbsp.csv").write_text(" \n" + text(";", with_(host="4.4.4.4")))
    rows = {(r.host, r.user_agent) for r in read_log_folder(spark, str(tmp_path)).collect()}
    assert {("1.1.1.1", "Moz\nilla"), ("2.2.2.2", "Mozilla")} <= rows
    assert {r[0] for r in rows} >= {"3.3.3.3", "4.4.4.4"} and 'illa"' not in {r[0] for r in rows}


def test_rejected_files_are_listed_with_their_reason(spark, folder):
    found = {r.file: (r.lines, r.reason) for r in rejected_files(spark, folder).collect()}
    assert found == {"eight.csv": (2, "no header of 9 fields")}


def test_quoted_breaks_on_split_borders_equal_the_unsplit_read(spark, tmp_path):
    """Every row has a quoted break and splits are shorter than a record, so that breaks and whole splits lie inside quotes."""
    rows = []
    for i in range(60):
        agent = f'"{"x" * (i % 90)}\n\n{"y" * (i % 37)} ""{i}""\r\n, end"' if i % 3 else f'"{"long " * 60}\n{i}"'
        rows.append(with_(host=f"h{i}", user_agent=agent, resource=f"/{i}" if i % 5 else '"/a\n/b"'))
    (tmp_path / "big.csv").write_text(text(",", *rows), newline="")
    (tmp_path / "calm.csv").write_text(text(",", *[with_(host=f"c{i}") for i in range(20)]))
    (tmp_path / "lone.csv").write_text(text(",", with_(host="l1", user_agent='Mozilla "x'), with_(host="l2")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200)
    try:
        lines = scan_lines(spark, str(tmp_path))
        assert lines.select("path", "block").distinct().count() > 40
        files = {r.file: r.multi_line for r in scan_files(spark, str(tmp_path), lines).collect()}
        raw = read_log_folder(spark, str(tmp_path))
        assert "Format: Text" not in raw._jdf.queryExecution().toString()  # raw files are not read again
        got = sorted(tuple(r[c] for c in LOG_COLUMNS) for r in raw.where("_source_file = 'big.csv'").collect())
        order = [r.host for r in raw.where("_source_file = 'big.csv'").orderBy(*FILE_ORDER).collect()]
        rest = {r.host for r in raw.where("_source_file <> 'big.csv'").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert files == {"big.csv": True, "calm.csv": False, "lone.csv": False}
    reader = spark.read.schema(", ".join(f"{c} string" for c in LOG_COLUMNS)).option("multiLine", True).option("header", True)
    unsplit = reader.option("escape", '"').csv(str(tmp_path / "big.csv"))
    assert got == sorted(tuple(r) for r in unsplit.collect()) and len(got) == 60
    assert order == [f"h{i}" for i in range(60)]
    assert rest == {f"c{i}" for i in range(20)} | {"l1", "l2"}


def test_a_file_that_breaks_while_read_is_listed_and_the_rest_is_read(spark, tmp_path):
    good = text(",", *[with_(host=f"g{i}") for i in range(50)])
    (tmp_path / "good.csv").write_text(good)
    path = str(tmp_path / "bad.csv")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(hadoop)
    stream.write(bytearray(text(",", *[with_(host=f"b{i}") for i in range(2000)]).encode()))
    stream.close()  # beside it lies a file of checksums
    with open(path, "r+b") as f:
        f.seek(100_000)
        f.write(b"#")
    (tmp_path / "gone.csv").write_text(good)
    raw = read_log_folder(spark, str(tmp_path))
    assert {r._source_file for r in raw.select("_source_file").distinct().collect()} == {"good.csv", "gone.csv"}
    found = rejected_files(spark, str(tmp_path)).collect()
    assert [r.file for r in found] == ["bad.csv"] and "broke off after" in found[0].reason and 0 < found[0].lines < 2000


def test_encodings_by_likelihood(spark, tmp_path):
    cases = {
        "polish.csv": ("Zażółć gęślą jaźń", "cp1250", "windows-1250"), "czech.csv": ("Příliš žluťoučký kůň", "cp1250", "windows-1250"),
        "french.csv": ("“Où est l’été”, dit-elle — à Noël", "cp1252", "cp1252"), "german.csv": ("Größe über Maß", "latin-1", "latin-1"),
        "plain.csv": ("ascii only", "ascii", "utf-8"), "mark.csv": ("żółw “é”", "utf-8-sig", "utf-8-sig"), "utf.csv": ("żółw “é”", "utf-8", "utf-8"),
        "euro.csv": ("prix 5 € – naïve", "cp1252", "cp1252"),
    }
    for name, (words, codec, _) in cases.items():
        body = text(";", *[with_(host=name, resource=words)] * 3)
        (tmp_path / name).write_bytes(body.encode(codec) if name != "utf.csv" else body.rstrip("\n").encode())
    found = {r.file: r.encoding for r in detect_dialects(spark, str(tmp_path)).collect()}
    assert found == {name: encoding for name, (_, _, encoding) in cases.items()}
    rows = {(r.host, r.resource) for r in read_log_folder(spark, str(tmp_path)).collect()}
    assert rows == {(name, words) for name, (words, _, _) in cases.items()}


def test_records_cut_by_runs_and_batches_are_whole_and_the_others_are_not_gathered(spark, tmp_path, monkeypatch):
    rows = [with_(host=f"h{i}", user_agent='"' + "\n\n x\n" * (i % 9) + f'end {i}"', referrer="-" if i % 4 else '"a\nb"') for i in range(300)]
    (tmp_path / "big.csv").write_text(text(";", *rows), newline="")
    (tmp_path / "cp.csv").write_bytes(text("|", *[with_(host=f"p{i}", user_agent='"żółw\nźrebię"') for i in range(40)]).encode("cp1250"))
    read = []
    for bits, batch, split in ((15, 10_000, 2**27), (3, 5, 2**27), (4, 7, 700)):
        monkeypatch.setattr(csv_logs, "RUN_BITS", bits)
        written = {}
        monkeypatch.setattr(csv_logs, "materialise", lambda df, name, kept=written: kept.setdefault(name, materialise(df, name)))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            raw = read_log_folder(spark, str(tmp_path))
            read.append([tuple(r[c] for c in LOG_COLUMNS) for r in raw.orderBy(*FILE_ORDER).collect()])
            parts = written["quoted-records"].where("part").count()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        # Lines within a run are put together where they are: only what a border cuts is gathered.
        assert parts == 0 if bits == 15 else 0 < parts
    reader = spark.read.schema(", ".join(f"{c} string" for c in LOG_COLUMNS)).option("multiLine", True).option("header", True)
    plain = reader.option("escape", '"').option("sep", ";").csv(str(tmp_path / "big.csv")).collect()
    assert read[0] == read[1] == read[2] and read[0][:300] == [tuple(r) for r in plain] and len(read[0]) == 340
    assert {r[-1] for r in read[0][300:]} == {"żółw\nźrebię"}


def test_cut_records_equal_parsed_ones(spark):
    texts = [",".join(ROW), "a,,c, ,e,\t,g,h,", ",,,,,,,,", "a,b", "a,b,c,d,e,f,g,h,i,j,k", 'a,"b,c",d,e,f,g,h,i,j', 'a,b "q",c,d,e,f,g,h,i',
             "a,b,c,d,e,f,g,h,i\r\r", "a,b\r,c,d,e,f,g,h,i", "\0a,b,c,d,e,f,g,h,i", "é,ü,\\,d|e,f;,#,g,h,i", " a , b ,c,d,e,f,g,h, i "]
    for code, separator in enumerate(csv_logs.SEPARATORS):
        records = spark.createDataFrame(
            [("f", code, 0, i, t.replace("\t", "~").replace(separator, "~").replace(",", separator)) for i, t in enumerate(texts)],
            "file string, code int, block long, row long, text string",
        )
        schema = ", ".join(f"{c} string" for c in LOG_COLUMNS)
        options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": "true", "sep": separator}
        want = records.select("row", F.from_csv(F.rtrim("text", F.lit("\r")), schema, options).alias("x")).select("row", "x.*")
        parsed = csv_logs._parsed(records)
        assert [tuple(r) for r in parsed.select("_row_id", *LOG_COLUMNS).orderBy("_row_id").collect()] == [
            tuple(r) for r in want.orderBy("row").collect()
        ]
        assert "split(" in parsed._jdf.queryExecution().toString()
