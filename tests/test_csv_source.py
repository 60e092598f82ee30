import csv
import os
import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from shiftledger.schemas import RAW_SCHEMA, SOURCE_COLUMNS
from shiftledger.sources import shift_csv
from shiftledger.sources.files import check_header, input_files
from shiftledger.sources.shift_csv import make_run_id, read_shift_logs, scan_shift_logs

from .logs import NAMESPACE

HEADER = ",".join(SOURCE_COLUMNS)
REQUIRED = "date,shift,line,planned_output,actual_output,defect_qty,downtime_min"


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def expected(*paths):
    rows = []
    for path in paths:
        with open(path, encoding="utf-8-sig", newline="") as f:
            for number, row in enumerate(csv.DictReader(f), start=1):
                values = [row.get(c) for c in SOURCE_COLUMNS]
                rows.append((os.path.basename(path), number, *values))
    return sorted(rows, key=repr)


def scanned(spark, paths):
    df = scan_shift_logs(spark, paths).select("name", "row_number", *SOURCE_COLUMNS)
    return sorted(map(tuple, df.collect()), key=repr)


def messy_rows(n):
    for i in range(n):
        kind = i % 13
        if kind == 3:
            yield f'd{i},A,"Li\nne,""q"" {i}",1,2,3,4,reason,op,sys\r\n'
        elif kind == 5:
            yield f'd{i},A,5" pipe,1,2,3,4,"multi\n\nline,\n""x""",op,sys\n'
        elif kind == 7:
            yield "\n"
        elif kind == 8:
            yield "   \n"
        elif kind == 9:
            yield f"d{i},A,,1\n"
        elif kind == 10:
            yield f'd{i},"",x,1,"2","a,b",4,,,\n'
        elif kind == 11:
            yield f'"d{i}",A,x,1,2,3,4,r,o,"last\nfield"\n'
        else:
            yield f"d{i},A,Line{i % 4},1,2,3,4,reason {i},op,sys\n"


@pytest.fixture(params=["134217728", "300"])
def split_size(spark, request):
    """Whole files, or blocks so small that records run over their borders."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], request.param)
    spark.conf.set(names[1], "10")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_against_the_csv_module(spark, tmp_path, split_size):
    paths = [
        write(tmp_path, "messy.csv", HEADER + "\n" + "".join(messy_rows(150))),
        write(tmp_path, "plain.csv", HEADER + "\n" + "".join(f"d{i},A,L,1,2,3,4,r,o,s\n" for i in range(300))),
        write(tmp_path, "short.csv", REQUIRED + "\r\n" + "".join(f"d{i},A,L,1,2,3,4\r\n" for i in range(50))),
        write(tmp_path, "header_only.csv", HEADER + "\n"),
    ]
    assert scanned(spark, paths) == expected(*paths)


def random_file(rnd):
    """Well-formed CSV text with quotes, commas and line breaks in odd places."""

    def field():
        text = "".join(rnd.choice("ab ,\"\n\té'#\\\\") for _ in range(rnd.choice([0, 0, 1, 2, 5])))
        if rnd.random() < 0.3 or text[:1] == '"' or "," in text or "\n" in text:
            return '"' + text.replace('"', '""') + '"'
        return text

    columns = list(SOURCE_COLUMNS)
    rnd.shuffle(columns)
    lines = [",".join(columns)]
    for _ in range(rnd.randint(0, 40)):
        width = rnd.choice([10, 10, 10, rnd.randint(1, 10)])
        lines.append(rnd.choice([",".join(field() for _ in range(width))] * 12 + ["", "  "]))
    end = rnd.choice(["\n", "\r\n"])
    return end.join(lines) + rnd.choice([end, ""])


def test_random_files(spark, tmp_path):
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "10"}
    before = {n: spark.conf.get(n) for n in names}
    rnd = random.Random(11)
    paths = [write(tmp_path, f"f{i}.csv", random_file(rnd)) for i in range(10)]
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        assert scanned(spark, paths) == expected(*paths)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def broken_file(rnd):
    """Text with every kind of line break, quotes anywhere, text behind quotes and open ends."""
    signs = ["a", "b", " ", ",", ",", '"', '"', '""', "\n", "\r", "\r\n", "\n\n", "é", "\t", '",', ',"', '"\r']
    body = "".join(rnd.choice(signs) for _ in range(rnd.choice([0, 5, 40, 300])))
    # fewer commas than header fields in a record, or it would be refused
    text = re.sub(r"((?:[^,]*,){9}[^,]*),[^\n]*", r"\1\n", body)
    return HEADER + rnd.choice(["\n", "\r\n", "\r"]) + text


def fits(path):
    """Whether no record has more fields than the header."""
    with open(path, encoding="utf-8", newline="") as f:
        return all(None not in row for row in csv.DictReader(f))


@pytest.mark.parametrize("run", [1_000, 1])
def test_any_text_as_the_csv_module_reads_it(spark, tmp_path, split_size, monkeypatch, run):
    """Lone CR, text behind quotes, quotes never closed; cut at LF or, with a run of one, at CR."""
    monkeypatch.setattr(shift_csv, "CR_RUN", run)
    rnd = random.Random(29)
    paths = [write(tmp_path, f"f{i}.csv", broken_file(rnd)) for i in range(60)]
    kept = [p for p in paths if fits(p)]
    assert len(kept) > 40
    assert scanned(spark, kept) == expected(*kept)


def test_records_that_end_in_cr(spark, tmp_path, split_size):
    rows = [f'd{i},A,"L\r{i}",1,2,3,4,r,o,s' for i in range(1500)]
    paths = [
        write(tmp_path, "old.csv", "\r".join([HEADER, *rows]) + "\r"),
        write(tmp_path, "new.csv", "\n".join([HEADER, *rows]) + "\n"),
        write(tmp_path, "both.csv", "\r\n".join([HEADER, *rows])),
        write(tmp_path, "lines [1].csv", "\r".join([HEADER, *(r.replace("L\r", "L") for r in rows)])),
    ]
    assert scanned(spark, paths) == expected(*paths)


def test_task_of_pieces_is_bounded(spark, tmp_path, monkeypatch):
    """More text is dealt to more tasks than the session's 8 shuffle partitions, without its files' paths."""
    staged = {}

    def stage(df, name):
        staged[name] = before(df, name)
        return staged[name]

    before = shift_csv.stage
    monkeypatch.setattr(shift_csv, "stage", stage)
    monkeypatch.setattr(shift_csv, "TASK_BYTES", 20_000)
    paths = [write(tmp_path, f"f{i}.csv", HEADER + "\n" + "".join(messy_rows(40))) for i in range(60)]
    assert scanned(spark, paths) == expected(*paths)
    pieces = staged["csv-pieces"]
    assert not {"path", "name"} & set(pieces.columns)
    assert pieces.select("_metadata.file_path").distinct().count() > 15
    assert pieces.groupBy("file", "block").agg(F.count_distinct("_metadata.file_path").alias("n")).where("n > 1").isEmpty()


def test_open_quote_keeps_its_last_line_break(spark, tmp_path):
    for i, end in enumerate(["", "\n", "\r\n", "\r"]):
        path = write(tmp_path, f"open{i}.csv", HEADER + '\nd,A,L,1,2,3,4,"left open' + end)
        assert scanned(spark, path) == expected(path)
        marked = write(tmp_path, f"mark{i}.csv", "\ufeff" + HEADER + '\nd,A,L,1,2,3,4,"left open' + end)
        assert scanned(spark, marked) == expected(marked)


def test_field_limit_of_every_field(spark, tmp_path):
    def file(i, field):
        return write(tmp_path, f"f{i}.csv", HEADER + f"\nd,A,L,1,2,3,4,{field},o,s\n")

    fine = ["x" * 40, '"' + "x" * 40 + '"', '"' + '""' * 40 + '"', '"' + "x\n" * 20 + '"', '"' + "é" * 39 + '"x']
    for i, field in enumerate(fine):
        assert len(scan_shift_logs(spark, file(i, field), field_limit=40).first()["downtime_reason"]) == 40
    for i, field in enumerate(["x" * 41, '"' + '""' * 41 + '"', '"' + "x\n" * 21 + '"', '"' + "x" * 40 + '"x']):
        with pytest.raises(Exception, match=r"field larger than field limit \(40\)"):
            scan_shift_logs(spark, file(10 + i, field), field_limit=40).collect()


def above(plan, leaf):
    """Operators over a leaf of a plan in writing, where deeper ones stand further right."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line)
    depth, found = len(lines[at]), []
    for line in reversed(lines[: at + 1]):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            depth = here
            found.append(line.lstrip(" :+-"))
    return found


def test_blank_lines_move_no_rows(spark, tmp_path):
    """Blank lines without quotes: blocks are exchanged, lines never."""
    path = write(tmp_path, "gaps.csv", HEADER + "\n" + "\n\nd,A,L,1,2,3,4,r,o,s\r\n" * 50)
    df = scan_shift_logs(spark, path)
    assert scanned(spark, path) == expected(path)
    operators = above(df._jdf.queryExecution().sparkPlan().toString(), "FileScan text")
    assert operators and not any(o.startswith(("Exchange", "Sort", "Window")) for o in operators)
    assert "csv-pieces" not in df._jdf.queryExecution().sparkPlan().toString()


def test_mixed_headers_bom_and_repeated_names(spark, tmp_path):
    turned = ",".join(reversed(SOURCE_COLUMNS))
    paths = [
        write(tmp_path, "a.csv", HEADER + "\nd,A,L,1,2,3,4,r,o,s\n"),
        write(tmp_path, "b.csv", "﻿" + turned + "\ns,o,r,4,3,2,1,L,A,d\n"),
        write(tmp_path, "c.csv", "date," + HEADER + "\nold,d,A,L,1,2,3,4,r,o,s"),
    ]
    assert scanned(spark, paths) == expected(*paths)


def test_unexpected_column_is_dropped_with_a_warning(spark, tmp_path):
    path = write(tmp_path, "note.csv", HEADER + ",note\nd,A,L,1,2,3,4,r,o,s,hello\n")
    with pytest.warns(UserWarning, match="note"):
        df = scan_shift_logs(spark, path)
    assert df.columns == ["path", "name", "row_number", *SOURCE_COLUMNS]
    assert df.first()["source_system"] == "s"


def test_full_row_with_metadata(spark, tmp_path):
    path = write(tmp_path, "mill.csv", HEADER + "\n07.11.2031,c,Saw 4,640,512,7,33,Blade change,Okafor,Tablet\n")
    at = datetime(2026, 2, 3, 4, 5, 6, 789, tzinfo=timezone.utc)
    df = read_shift_logs(spark, path, NAMESPACE, run_id="night-7", ingested_at=at)
    assert df.columns == RAW_SCHEMA.names
    row, again = df.first(), df.first()
    assert (row.date, row.shift, row.run_id) == ("07.11.2031", "c", "night-7")
    assert (row.source_file, row.row_number) == ("mill.csv", 1)
    assert row.ingested_at.replace(tzinfo=timezone.utc) == at.replace(microsecond=0)
    assert len(row.row_id) == 36 and row.row_id == again.row_id
    other = read_shift_logs(spark, path, NAMESPACE, run_id="other", ingested_at=at).first()
    assert other.row_id != row.row_id


def test_missing_optional_columns_are_null(spark, tmp_path):
    path = write(tmp_path, "bare.csv", REQUIRED + "\n08.11.2031,b,Saw 5,410,377,4,0\n")
    row = scan_shift_logs(spark, path).first()
    assert (row.downtime_reason, row.operator, row.source_system) == (None, None, None)


def test_missing_required_column(spark, tmp_path):
    path = write(tmp_path, "cut.csv", REQUIRED.rsplit(",", 1)[0] + "\n08.11.2031,b,Saw 5,410,377,4\n")
    with pytest.raises(ValueError, match=r"missing required columns: \['downtime_min'\]"):
        scan_shift_logs(spark, path)


def test_header_names_are_exact(spark, tmp_path):
    path = write(tmp_path, "upper.csv", HEADER.replace("date", "Date") + "\nd,A,L,1,2,3,4,r,o,s\n")
    with pytest.raises(ValueError, match=r"\['date'\]"):
        scan_shift_logs(spark, path)


@pytest.mark.parametrize("text", ["", "\n", "\n" + HEADER + "\n"])
def test_no_header(spark, tmp_path, text):
    with pytest.raises(ValueError, match="header row is missing or empty"):
        scan_shift_logs(spark, write(tmp_path, "none.csv", text))


def test_long_row(spark, tmp_path):
    path = write(tmp_path, "long.csv", HEADER + "\nd,A,L,1,2,3,4,r,o,s\nd,A,L,1,2,3,4,r,o,s,\n")
    with pytest.raises(Exception, match="more fields than the header: row 2"):
        scan_shift_logs(spark, path).collect()


def test_lone_quote_does_not_collect_the_rest_of_the_file(spark, tmp_path):
    text = HEADER + '\nd,"A,L,1,2,3,4,r,o,s\n' + "d,A,L,1,2,3,4,r,o,s\n" * 80_000
    with pytest.raises(ValueError, match="field limit"):
        scan_shift_logs(spark, write(tmp_path, "open.csv", text))


def test_path_guard(spark, tmp_path):
    with pytest.raises(ValueError, match="does not end in .csv"):
        scan_shift_logs(spark, str(tmp_path / "x.txt"))
    with pytest.raises(ValueError, match="nothing found"):
        scan_shift_logs(spark, str(tmp_path / "x.csv"))
    (tmp_path / "dir.csv").mkdir()
    with pytest.raises(ValueError, match="is a folder"):
        scan_shift_logs(spark, str(tmp_path / "dir.csv"))
    upper = write(tmp_path, "UPPER.CSV", HEADER + "\nd,A,L,1,2,3,4,r,o,s\n")
    assert scan_shift_logs(spark, upper).count() == 1


def test_listing_names_what_is_no_file(spark, tmp_path):
    """Folders and hidden files among the matches of a pattern, empty files, nothing at all."""
    write(tmp_path, "a.csv", HEADER + "\nd,A,L,1,2,3,4,r,o,s\n")
    pattern = f"{tmp_path}/*.csv"
    assert input_files(spark, [pattern]).patterns == [pattern]
    for i in range(2):  # a folder with one file counts like a file
        (tmp_path / "dir.csv").mkdir(exist_ok=True)
        if i:
            write(tmp_path / "dir.csv", "part.csv", HEADER + "\n")
        with pytest.raises(ValueError, match="dir.csv is a folder"):
            input_files(spark, [pattern])
    other = tmp_path / "other"
    other.mkdir()
    write(other, "b.csv", HEADER + "\n")
    write(other, "_b.csv", HEADER + "\n")
    with pytest.raises(ValueError, match="does not read files named like .*_b.csv"):
        input_files(spark, [f"{other}/*.csv"])
    with pytest.raises(ValueError, match="nothing found at .*gone"):
        input_files(spark, [f"{other}/gone*.csv"])
    with pytest.raises(ValueError, match="header row is missing or empty. .*/empty.csv"):
        input_files(spark, [write(tmp_path, "empty.csv", "")])
    assert len(input_files(spark, [f"{other}/{{b,c}}.csv", f"{other}/[a-b].csv", f"{other}/?.csv"]).files()) == 1


def test_many_files_are_listed_without_a_call_for_each(spark, tmp_path):
    for i in range(3_000):
        (tmp_path / f"log{i}.csv").write_text("x")
    calls = []
    gateway = spark.sparkContext._gateway._gateway_client
    send = gateway.send_command
    gateway.send_command = lambda *a, **k: calls.append(a) or send(*a, **k)
    try:
        found = input_files(spark, [f"{tmp_path}/*.csv"])
    finally:
        gateway.send_command = send
    assert found.listing.count() == 3_000 and len(calls) < 500


def test_same_base_name_needs_the_path(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder, "log.csv", HEADER + "\nd,A,L,1,2,3,4,r,o,s\n")
    pattern = str(tmp_path / "*" / "log.csv")
    with pytest.raises(ValueError, match="several input files"):
        read_shift_logs(spark, pattern, NAMESPACE)
    df = read_shift_logs(spark, pattern, NAMESPACE, source_file="path")
    assert df.select("row_id").distinct().count() == 2


def test_check_header():
    assert check_header(REQUIRED.split(",")) == {"downtime_reason", "operator", "source_system"}
    with pytest.raises(ValueError, match="missing or empty"):
        check_header([])


def test_run_id():
    now = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    assert re.fullmatch(r"records_20260102T030405Z_[0-9a-f]{8}", make_run_id(now=now))
    assert make_run_id("x", now).startswith("x_2026")


def test_names_are_not_encoded(spark, tmp_path):
    name = "shift logs é 50%25+#1.csv"
    (tmp_path / name).write_text(
        "date,shift,line,planned_output,actual_output,defect_qty,downtime_min\n2026-03-04,B,Line9,7,6,0,3\n"
    )
    rows = read_shift_logs(spark, str(tmp_path / "*.csv"), "7c1c2a56-6d0e-4e39-9d37-0d8f6a8c2f11", "r").collect()
    assert [r.source_file for r in rows] == [name]


def test_brackets_and_repeated_files(spark, tmp_path):
    """A name with brackets is itself, not a pattern; a file named twice is read once."""
    odd = write(tmp_path, "log[1].csv", HEADER + "\nd,A,L,1,2,3,4,r,o,s\n")
    write(tmp_path, "log1.csv", HEADER + "\ne,A,L,1,2,3,4,r,o,s\n")
    assert [r.date for r in scan_shift_logs(spark, odd).collect()] == ["d"]
    both = [odd, odd, f"{tmp_path}/log*.csv", f"{tmp_path}/log1.csv"]
    assert sorted((r.name, r.date) for r in scan_shift_logs(spark, both).collect()) == [("log1.csv", "e"), ("log[1].csv", "d")]
