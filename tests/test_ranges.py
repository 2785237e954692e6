"""Large files cut into byte ranges against plain readers."""

import json

import pytest

from galecast.sources.files import read_raw_cities
from galecast.sources.ranges import read_array_records, read_csv_records

NOTES = ["", "}", "{[", '"', '\\', '\\"}', 'a"}],[{"b":"', "\\\\", "é}\n{", "]}]", 'x\\"', " }"]


@pytest.fixture
def cut(spark):
    """Sets how many bytes a task reads of a file."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(name) for name in names]

    def to(size):
        for name, value in zip(names, (size, 1, 2)):
            spark.conf.set(name, str(value))

    yield to
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def texts(records):
    return [r["text"] for r in records.orderBy("source_split", "source_row").collect()]


RECORDS = [{"city": note, "x": {"y": [i, {"z": note}], "w": "}" * (i % 3)}} for i, note in enumerate(NOTES)]


@pytest.mark.parametrize("size", [1, 3, 31, 1 << 20])
@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_an_array_cut_anywhere_gives_its_records(spark, tmp_path, cut, size, style):
    path = tmp_path / "meteo_20260103_060000.json"
    path.write_text(json.dumps(RECORDS[:5] if size < 3 else RECORDS, **style), encoding="utf-8")
    cut(size)
    records = read_array_records(spark, str(path))
    assert [json.loads(t) for t in texts(records)] == (RECORDS[:5] if size < 3 else RECORDS)
    if size < 200:
        assert spark.read.text(str(path), lineSep="}").rdd.getNumPartitions() > 3


@pytest.mark.parametrize("text, want", [
    ("[]", []), (" [ ]\n", []), ("", []), ('{"a": 1}', ['{"a": 1}']), ('{"a": 1}\n{"b": "}"}\n', ['{"a": 1}', '{"b": "}"}']),
    ('[{"a": 1}, {"b": [2', ['{"a": 1}', '{"b": [2']), ('[{}]', ["{}"]), ("[{} , {}]\n", ["{}", "{}"]), ("[1, {}]", ["1, {}"]),
])
@pytest.mark.parametrize("size", [2, 1 << 20])
def test_odd_documents(spark, tmp_path, cut, text, want, size):
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_text('[{"last": "]"}]')
    cut(size)
    assert texts(read_array_records(spark, str(tmp_path))) == [*want, '{"last": "]"}']


LIST = 'city,lat,lng,admin_name,population\n"A\nB",1,2,"R ""x""",3\n\nC,4,5,,\n"D, ""E""\n\n""",,"6",é,"7\n"\nF,1\nG,1,2,"",4'


@pytest.mark.parametrize("size", [1, 5, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("last", ["", "\n"])
def test_csv_cut_anywhere_equals_the_whole_reader(spark, tmp_path, cut, size, ending, last):
    path = tmp_path / "villes_20260103_060000.csv"
    path.write_bytes((LIST + last).replace("\n", ending).encode())
    whole = read_raw_cities(spark, str(path))
    want = [tuple(r) for r in whole.collect()]
    cut(size)
    got = read_csv_records(spark, str(path), whole.columns).orderBy("source_split", "source_row")
    assert [tuple(r) for r in got.select(*whole.columns).collect()] == want and len(want) == 5
    assert {r["run_ts"] for r in got.collect()} == {"20260103_060000"}


def test_only_narrow_rows_and_one_copy_of_the_text_move(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(RECORDS))
    plan = read_array_records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan
