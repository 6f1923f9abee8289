import pytest
from pyspark.sql import functions as F

from tallyfield.sources import dialects as d
from tallyfield.sources import rankfiles as rf

TITLES = "\nsite, one; two \ntitle\nsubtitle\n"
NAMES = ["Ana Núñez", "Zoë O’Neil", "Łukasz Ż", "Kim \U0001f3c8 Lee"]


def ranks(delimiter, names, quote=""):
    rows = [delimiter.join((str(i), f"{quote}{n}{quote}", "RB")) for i, n in enumerate(names, 1)]
    return TITLES + delimiter.join(("Rank", "Player Name", "Position")) + "\n" + "\n".join(rows) + "\n"


@pytest.fixture()
def folder(tmp_path):
    files = {
        "2010": ranks("\t", NAMES).encode(),
        "2011": b"\xef\xbb\xbf" + ranks(",", NAMES).encode(),
        "2012": b"\xff\xfe" + ranks("\t", NAMES).replace("\n", "\r\n").encode("utf-16-le"),
        "2013": b"\xfe\xff" + ranks(";", NAMES).encode("utf-16-be"),
        "2014": ranks("|", NAMES[:2]).encode("cp1252"),
        "2015": b"\0\1\2\n\n\n\n\nRank\tPlayer Name\n1\tBinary\n",
        "2016": b"\xff\xfe" + ranks("\t", ["A B"]).encode("utf-16-le") + b"4\x00\t\x00x\x00\xd8\xd8\x00\xdcy\x00\x00\xdc\t\x00K\x00Q",
        "2017": ranks(",", ['Doe, "" Jr', "tab\there"], '"').encode(),
        "2018": b"",
    }
    for year, data in files.items():
        (tmp_path / f"FantasyPros_{year}_a b%20.xls").write_bytes(data)
    return str(tmp_path)


def read(spark, folder):
    out = {}
    for r in rf.read_rankings(spark, folder, sniff=True).orderBy("year", "rank").collect():
        out.setdefault(r.year, []).append(r.player_name)
    return out


WANT = {
    2010: NAMES, 2011: NAMES, 2012: NAMES, 2013: NAMES, 2014: NAMES[:2], 2016: ["A B", "x�y�"], 2017: ['Doe, " Jr', "tab here"],
}


def test_files_of_many_dialects_in_one_folder(spark, folder):
    got = read(spark, folder)
    assert {y: n for y, n in got.items() if y != 2016} == {y: n for y, n in WANT.items() if y != 2016}
    assert got[2016][0] == "A B" and len(got[2016]) == 2


def test_what_each_file_is(spark, folder):
    got = d.sniff(d._lines(spark, rf.FILE_GLOB, [folder])).collect()
    assert {r["file_name"][12:16]: (r["encoding"], r["delimiter"]) for r in got} == {
        "2010": ("UTF-8", "\t"), "2011": ("UTF-8", ","), "2012": ("UTF-16LE", "\t"), "2013": ("UTF-16BE", ";"),
        "2014": ("Windows-1252", "|"), "2015": ("binary", "\t"), "2016": ("UTF-16LE", "\t"), "2017": ("UTF-8", ","),
    }


def test_the_same_in_small_splits(spark, tmp_path):
    names = [f"{NAMES[i % 4]} {i:05d}" for i in range(400)]
    (tmp_path / "FantasyPros_2012_x.xls").write_bytes(b"\xff\xfe" + ranks("\t", names).encode("utf-16-le"))
    (tmp_path / "FantasyPros_2013_x.xls").write_bytes(ranks(",", names).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert read(spark, str(tmp_path)) == {2012: names, 2013: names}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("little", [True, False])
def test_utf16_equals_the_codec(spark, little):
    codec = "utf-16-le" if little else "utf-16-be"
    texts = ["", "a", "é€", "\U0001f3c8x", "D8 DC 0A", "਀ਊ", "\ud800", "a\udc00b", "\ud800𐀀", "\udc00\ud800"]
    datas = [t.encode(codec, "surrogatepass") for t in texts] + ["ab".encode(codec)[:-1], b"\x41"]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(datas)], "i int, b binary")
    got = [r[0] for r in df.orderBy("i").select(d.utf16_text(F.col("b"), little)).collect()]
    want = [b[: len(b) // 2 * 2].decode(codec, "surrogatepass") for b in datas]
    lone = [w.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace") if w else w for w in want]
    assert [g.replace("�", "") for g in got] == [w.replace("�", "") for w in lone]
    assert [g.count("�") for g in got] == [0, 0, 0, 0, 0, 0, 1, 1, 1, 2, 0, 0]


def test_every_byte_of_windows_text(spark):
    df = spark.createDataFrame([(bytearray(range(256)),)], "b binary")
    got = df.select(d.windows_text(F.col("b"))).first()[0]
    want = [bytes([i]).decode("cp1252", "replace") for i in range(256)]
    assert [g if w != "�" else w for g, w in zip(got, want)] == want and len(got) == 256


def test_files_read_without_sniffing_are_as_before(spark, folder):
    assert {r.year for r in rf.read_rankings(spark, folder).select("year").distinct().collect()} >= {2010}
    empty = rf.read_rankings(spark, folder, "FantasyPros_2018*", sniff=True)
    assert empty.isEmpty()
