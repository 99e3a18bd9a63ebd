"""Split CSV reading against Spark's whole-file reading."""

import random

import pytest

from lexigrain.sources import quoted_csv
from lexigrain.sources.corpus import CORPUS_SCHEMA, read_corpus_csv
from lexigrain.sources.quoted_csv import ends_inside, read_quoted_csv

OPTIONS = {"mode": "FAILFAST", "nullValue": ""}
SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")


@pytest.fixture
def split_size(spark):
    before = {name: spark.conf.get(name, None) for name in SIZES}

    def set_size(size):
        for name, value in zip(SIZES, (size, 1, 1)):
            spark.conf.set(name, value)

    yield set_size
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def whole_file(spark, path):
    reader = spark.read.schema(CORPUS_SCHEMA).option("header", True).option("multiLine", True).option("escape", '"')
    return reader.options(**OPTIONS).csv(path)


def field(draw):
    kind = draw.random()
    text = "".join(draw.choices(["a", "bé", " ", ",", '"', "\n", "\n\n", '","', "x" * 30, '"\n', "1"], k=draw.randint(0, 12)))
    if kind < 0.4:
        return '"' + text.replace('"', '""') + '"'
    if kind < 0.5:
        return 'say "hi" or 5"'  # quotes that open nothing
    return "".join(c for c in text if c not in ',"\n')


def corpus_text(seed, rows, end="\n", last=True):
    draw = random.Random(seed)
    lines = ["id,keyword,location,text,target"]
    for at in range(rows):
        lines.append(",".join([str(at), field(draw), field(draw), field(draw), str(at % 2)]))
        if draw.random() < 0.05:
            lines.append("")
    return end.join(lines) + (end if last else "")


def sorted_rows(frame):
    return sorted(map(tuple, frame.collect()), key=lambda row: row[0])


@pytest.mark.parametrize(("seed", "size", "end", "last"), [(1, 37, "\n", True), (2, 150, "\n", False), (3, 4000, "\n", True), (4, 400, "\r\n", True)])
def test_many_splits_equal_whole_files(spark, tmp_path, split_size, seed, size, end, last):
    folder = tmp_path / "in"
    folder.mkdir()
    for file in range(3):
        (folder / f"{file}.csv").write_bytes(corpus_text(10 * seed + file, 60, end, last).encode())
    wanted = sorted(map(tuple, whole_file(spark, str(folder)).collect()), key=str)
    split_size(size)
    found = sorted(map(tuple, read_quoted_csv(spark, str(folder), CORPUS_SCHEMA, OPTIONS).collect()), key=str)
    assert found == wanted and len(found) == 180


def test_record_over_many_splits_and_list_beyond_broadcast(spark, tmp_path, split_size, monkeypatch):
    body = "\n".join(f'line {at} with "" quotes, and' for at in range(400))
    (tmp_path / "long.csv").write_text(f'id,keyword,location,text,target\n1,a,,"{body}",1\n2,b,,"x\ny",0\n3,,,"{body}",1\n', encoding="utf-8")
    wanted = sorted_rows(whole_file(spark, str(tmp_path / "long.csv")))
    split_size(300)
    assert sorted_rows(read_quoted_csv(spark, str(tmp_path / "long.csv"), CORPUS_SCHEMA, OPTIONS)) == wanted
    monkeypatch.setattr(quoted_csv, "BROADCAST_SPLITS", 0)
    assert sorted_rows(read_quoted_csv(spark, str(tmp_path / "long.csv"), CORPUS_SCHEMA, OPTIONS)) == wanted


def test_one_file_is_read_by_many_tasks(spark, tmp_path, split_size):
    rows = "".join(f'{at},key,"place\nof {at}","{"word " * 50}\n""end""",{at % 2}\n' for at in range(4000))
    (tmp_path / "big.csv").write_text("id,keyword,location,text,target\n" + rows, encoding="utf-8")
    split_size(64 << 10)
    frame = read_corpus_csv(spark, str(tmp_path / "big.csv"))
    assert frame.count() == 4000 and frame.where("location IS NULL").isEmpty()
    assert spark.read.option("lineSep", "\n").text(str(tmp_path / "big.csv")).rdd.getNumPartitions() > 10


def test_malformed_rows_fail(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,keyword,location,text,target\n1,a,b,c\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_quoted_csv(spark, str(tmp_path / "bad.csv"), CORPUS_SCHEMA, OPTIONS).collect()
    (tmp_path / "none.csv").write_text("id,keyword,location,text,target\n", encoding="utf-8")
    assert read_corpus_csv(spark, str(tmp_path / "none.csv")).count() == 0


def test_line_states():
    for line, outside, inside in [
        ("a,b", False, True), ('"a', True, False), ('"a"', False, False), ('a,"b', True, False), ('a"b', False, False),
        ('"a""', True, False), ('x","y', True, True), ('"a"b,"c', True, True), ('""', False, True), ("", False, True),
    ]:
        assert (ends_inside(line, False), ends_inside(line, True)) == (outside, inside), line
