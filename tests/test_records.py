import pytest

from reelkit.sources.records import quoted_records, read_quoted_csv

SCHEMA = "a string, n int, b string"
TEXT = ('a,n,b\n'
        '"x\ny",1,plain\n'
        '\n'
        '"say ""hi""\n\n""\n""there",2,"é,\n"\n'
        ',3,""\n'
        '"""",4,"\n\n"\n'
        'last,bad,"no line feed at the end"')


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def cut(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _spark_reader(spark, path):
    return (spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(path))


def test_equal_to_the_reader_at_every_cut(spark, tmp_path, cut):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_bytes(TEXT.encode())
    want = _rows(_spark_reader(spark, path))
    assert len(want) == 5 and ("x\ny", 1, "plain") in want and ('say "hi"\n\n"\n"there', 2, "é,\n") in want
    size = len(TEXT.encode())
    for n in [1, 2, 3, 5, 7, 11, 13, 17, 23, 29, 37, 41, 53, 67, size - 1, 10 * size]:  # 1: a cut at every byte
        cut(n)
        got = read_quoted_csv(spark, path, SCHEMA)
        assert _rows(got) == want, n
    cut(16)
    assert quoted_records(spark, path).rdd.getNumPartitions() > 1


def test_folders_line_ends_empty_and_open_quotes(spark, tmp_path, cut):
    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "1.csv").write_bytes(b'a,n,b\r\n"x\r\ny",1,z\r\n\r\nq,2,r\r\n')
    (folder / "2.csv").write_bytes(b'\n\na,n,b\nv,3,w\n')
    (folder / "3.csv").write_bytes(b"")
    (folder / "4.csv").write_bytes(b"a,n,b\n")
    for n in (4, 10**6):
        cut(n)
        got = _rows(read_quoted_csv(spark, str(folder), SCHEMA))
        assert got == [("q", 2, "r"), ("v", 3, "w"), ("x\r\ny", 1, "z")], n
        assert len(_rows(read_quoted_csv(spark, str(folder), SCHEMA, header=False))) == 6
    (tmp_path / "open.csv").write_bytes(b'a,n,b\nk,1,l\n"never,2\nclosed,3,x\n')
    cut(5)
    assert [r.record for r in quoted_records(spark, str(tmp_path / "open.csv")).orderBy("record").collect()] == [
        '"never,2\nclosed,3,x', "k,1,l"]


def test_the_readers_take_quoted_lines_apart(spark, tmp_path, cut):
    from reelkit.sources import files
    (tmp_path / "c.csv").write_text('id,cast,crew\n7,"[{\'name\': ""A\nB""}]",[]\n8,"[]","[]"\n')
    cut(9)
    assert _rows(files.read_credits(spark, str(tmp_path / "c.csv")).select("cast", "id")) == [("[]", "8"), ('[{\'name\': "A\nB"}]', "7")]
