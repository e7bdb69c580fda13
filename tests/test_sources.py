import pytest

from segmill.sources import read_json_quarantine, read_json_rows

SCHEMA = "a long, `b.c` string, d array<double>, e struct<f: int>"
LINES = [
    '{"a": 1, "b.c": "x", "d": [1.5], "e": {"f": 2}}',
    '{"a": "one"}',
    '{"a": 2',
    "",
    "   ",
    "null",
    "[1, 2]",
    '"text"',
    '{"other": 5}',
    '{"a": null, "e": {"f": "no number"}}',
    '{"a": 3, "d": [1, "x"]}',
    '{"a": 4} trailing',
    "{}",
]


@pytest.fixture()
def path(spark, tmp_path):
    (tmp_path / "rows.json").write_text("\n".join(LINES))
    return str(tmp_path / "rows.json")


def test_bad_lines_are_kept_as_they_are(spark, path):
    good, bad = read_json_quarantine(spark, path, SCHEMA)
    assert good.schema.simpleString() == "struct<a:bigint,b.c:string,d:array<double>,e:struct<f:int>>"
    assert [(r[0], r[1], r[2], r[3] and r[3].f) for r in good.collect()][0] == (1, "x", [1.5], 2)
    lines = {r.value for r in bad.collect()}
    assert {LINES[i] for i in (1, 2, 6, 7, 9, 10)} <= lines
    assert not {LINES[i] for i in (0, 8, 12)} & lines
    assert good.count() + bad.count() == sum(bool(line.strip()) for line in LINES)
    assert {r.file.rsplit("/", 1)[1] for r in bad.select("file").collect()} == {"rows.json"}


def test_narrow_selections_agree(spark, path):
    """A plan that needs few columns must not parse less and call other lines bad."""
    good, bad = read_json_quarantine(spark, path, SCHEMA)
    assert good.select("a").count() == len(good.collect()) and bad.select("file").count() == len(bad.collect())
    assert [r.a for r in good.select("a").collect()] == [r.a for r in good.collect()]


def test_good_rows_are_those_of_the_strict_reader(spark, path, tmp_path):
    (tmp_path / "good.json").write_text("\n".join(LINES[i] for i in (0, 8, 12)))
    good, bad = read_json_quarantine(spark, str(tmp_path / "good.json"), SCHEMA)
    assert good.collect() == read_json_rows(spark, str(tmp_path / "good.json"), SCHEMA).collect() and bad.count() == 0


def test_empty_file(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    assert [t.count() for t in read_json_quarantine(spark, str(tmp_path / "none.json"), SCHEMA)] == [0, 0]
