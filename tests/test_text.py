from segmill.operators.text import word_count
from segmill.sources import read_lines


def counts(df):
    return [tuple(r) for r in df.collect()]


def test_word_count_of_a_text_file(spark, tmp_path):
    (tmp_path / "in.txt").write_text("hello spark\nhello world\nspark world spark\n")
    assert counts(word_count(read_lines(spark, str(tmp_path / "in.txt")))) == [("hello", 2), ("spark", 3), ("world", 2)]


def test_every_kind_of_white_space_separates(spark):
    lines = ["\ta b ", "", "   ", "c d e　f", "g\x1ch\x1di\x1ej\x1fk\x85l\x0bm\x0cn", "o​p", None]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    expected = sorted(w for line in lines if line for w in line.split())
    assert counts(word_count(df)) == [(w, 1) for w in expected]


def test_words_are_in_code_point_order(spark):
    words = ["b", "B", "é", "z", "\U0001f600", "￮", "a"]
    df = spark.createDataFrame([(w,) for w in words], "`my.text` string")
    assert [w for w, _ in counts(word_count(df, "my.text"))] == sorted(words)
