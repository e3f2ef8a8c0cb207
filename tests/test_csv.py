import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from stratafold.session import new_folder
from stratafold.sources.sinks import write_csv
from stratafold.sources import tables
from stratafold.sources.tables import read_csv, read_csv_folder, read_csv_ranges

HARD = [(1, 'say "hi" now'), (2, "two\nlines, one comma"), (3, "  spaces  "), (4, None), (5, "\\ back")]


def test_quotes_and_line_breaks_survive(spark, frame, rows):
    place = new_folder(spark, "csv")
    write_csv(frame(HARD, "k int, t string"), f"{place}/t.csv")
    found = read_csv(spark, f"{place}/t.csv", frame(HARD, "k int, t string").schema, multiline=True)
    assert rows(found) == HARD


def test_doubled_quotes_of_other_writers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('K,T\n1,"say ""hi"" now"\n')
    assert read_csv(spark, str(tmp_path / "a.csv")).first().t == 'say "hi" now'


def test_nested_files_are_read_where_they_are(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.csv").write_text("a\n1\n")
    (tmp_path / "y.csv").write_text("b\n2\n3\n")
    found = read_csv_folder(spark, str(tmp_path))
    assert {name: df.count() for name, df in found.items()} == {"x": 1, "y": 2}


def test_two_files_of_one_name_are_refused(spark, tmp_path):
    (tmp_path / "Client.csv").write_text("a\n1\n2\n")
    (tmp_path / "client.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="both table 'client'"):
        read_csv_folder(spark, str(tmp_path))


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_byte_ranges_read_what_one_task_reads(spark, tmp_path, frame, rows, monkeypatch, size, end):
    monkeypatch.setattr(tables, "_MORE_BYTES", 5)
    pick = random.Random(size)
    texts = ["".join(pick.choices(['""', "\n", "\r\n", ",", "é", "a", " ", "\\", "long\n\n\nvalue"], k=pick.randrange(12)))
             for _ in range(20)]
    body = end.join(['K,"T, two\nlines"', *(f'{i},"{t}"' for i, t in enumerate(texts)), "", "98,plain", "99,"])
    schema = frame([], "K int, T string").schema
    for n, tail in enumerate((end, "")):
        place = tmp_path / f"t{n}.csv"
        place.write_bytes((body + tail).encode())
        found = read_csv_ranges(spark, str(place), schema, range_bytes=size)
        assert found.columns == ["k", "t"]
        plain = [r for r in csv.reader(io.StringIO(body + tail, newline="")) if r][1:]
        want = sorted((int(k), t or None) for k, t in plain)
        assert rows(found) == want and len(want) == 22
        if end == "\n":  # with the other end the one-task reader keeps the last record's return
            assert rows(read_csv(spark, str(place), schema, multiline=True)) == want


def test_each_byte_range_may_have_a_task(spark, tmp_path, frame):
    (tmp_path / "a.csv").write_text("k\n" + "".join(f"{i}\n" for i in range(500)))
    found = read_csv_ranges(spark, str(tmp_path / "a.csv"), frame([], "k int").schema, range_bytes=100)
    tasks = found.select("k", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.k for r in tasks) == list(range(500)) and len({r.task for r in tasks}) > 5


def test_byte_ranges_over_a_written_folder(spark, frame, rows):
    place = new_folder(spark, "csv") + "/t.csv"
    write_csv(frame(HARD, "k int, t string").repartition(3), place)
    assert rows(read_csv_ranges(spark, place, frame(HARD, "k int, t string").schema, range_bytes=4)) == HARD
    write_csv(frame([], "k int, t string"), place + "e")
    assert read_csv_ranges(spark, place + "e", frame(HARD, "k int, t string").schema).count() == 0


def test_compressed_files_are_refused_by_ranges(spark, tmp_path, frame):
    (tmp_path / "a.csv.gz").write_bytes(b"x")
    with pytest.raises(Exception, match="compressed"):
        read_csv_ranges(spark, str(tmp_path / "a.csv.gz"), frame([], "k int").schema).count()
