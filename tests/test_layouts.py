"""Delimited files of several layouts, rejects, and what happens when a column is absent."""

import pytest
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from skyledger.sources import readers
from skyledger.sources.readers import read_delimited, read_rejects

SCHEMA = StructType([StructField("Session ID", LongType()), StructField("Start Date", TimestampNTZType()),
                     StructField("City", StringType()), StructField("Latitude", DoubleType()), StructField("Number", IntegerType())])


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "2020.csv").write_text("Session ID;Start Date;City;Latitude;Number\n1;2020-01-02 03:04:05;Rio;-22.5;7\n")
    (tmp_path / "2021.csv").write_text('User ID;Number;"City";Latitude;Lmg;Start Date;Session ID\nu;x7;"a;""b""";north;6.1;"2021-02-30 00:00:00";2\n')
    (tmp_path / "2022.csv").write_text("City;Session ID;Start Date;Latitude;Number\n Oslo ;3;;60;\n")
    (tmp_path / "_notes.csv").write_text("no data\n")
    return str(tmp_path)


def test_columns_are_found_by_name(spark, folder):
    rows = {r["Session ID"]: r for r in read_delimited(spark, folder, SCHEMA).collect()}
    assert set(rows) == {1, 2, 3}
    assert (rows[1]["City"], rows[1]["Latitude"], rows[1]["Number"], str(rows[1]["Start Date"])) == ("Rio", -22.5, 7, "2020-01-02 03:04:05")
    assert (rows[2]["City"], rows[2]["Latitude"], rows[2]["Number"], rows[2]["Start Date"]) == ('a;"b"', None, None, None)
    assert (rows[3]["Latitude"], rows[3]["Number"], rows[3]["Start Date"]) == (60.0, None, None)


def test_bad_cells_are_listed(spark, folder):
    rejects = read_rejects(spark, folder, SCHEMA).collect()
    got = sorted((r["column"], r["value"], r["row"]["Session ID"]) for r in rejects)
    assert {(r["reason"], r["file"].rsplit("/", 1)[-1], r["block"]) for r in rejects} == {("type", "2021.csv", 0)}
    assert got == [("Latitude", "north", "2"), ("Number", "x7", "2"), ("Start Date", "2021-02-30 00:00:00", "2")]


def test_a_missing_column_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Session ID;City\n1;x\n")
    with pytest.raises(ValueError, match="Start Date"):
        read_delimited(spark, str(tmp_path), SCHEMA)


def test_a_repeated_required_column_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Session ID;City;Start Date;Latitude;Number;City\n1;x;;;;y\n")
    with pytest.raises(ValueError, match="City"):
        read_delimited(spark, str(tmp_path), SCHEMA)


def test_single_file_and_empty_folder(spark, folder, tmp_path):
    assert read_delimited(spark, f"{folder}/2022.csv", SCHEMA).count() == 1
    empty = tmp_path / "empty"
    empty.mkdir()
    assert read_delimited(spark, str(empty), SCHEMA).count() == 0


def test_same_coordinates_written_differently_are_one_place(spark, tmp_path):
    from skyledger.operators.enrich import enrich_locations
    head = "Latitude,Longitude,city,town,village,hamlet,county,state,country,country_code\n"
    (tmp_path / "addresses.csv").write_text(head + "37.9,23.70,Athens,,,,,,Greece,gr\n37.90,23.7,Athens,,,,,,Greece,gr\n")
    (tmp_path / "known.csv").write_text("Latitude,Longitude,City,Village_or_Hamlet,County,State,Country,CountryCode\n")
    sessions = spark.createDataFrame([(37.9, 23.7, 1.0)], "Latitude double, Longitude double, Elevation double")
    out = enrich_locations(sessions, readers.read_locations(spark, str(tmp_path / "known.csv")), readers.read_addresses(spark, str(tmp_path / "addresses.csv")))
    assert out.count() == 1 and out.first()["City"] == "Athens"


ABC = StructType([StructField("a", LongType()), StructField("b", StringType()), StructField("c", StringType())])
LINES = ["1;2;3", "4;5", "6;7;8;9", '7;"open;x', '8;x;"open', '9;"clo"sed;x', '10;"a;b";"say ""hi"""', "11;5\" pipe;in\"ch", "12;;", '13;"";x', "a;b;c", "", "  ", '14;"""x";y', ";;;", "x;y;z", '15;"two', 'lines";z',
         "16;\u00e9;\u2603", "17;a;b\\"]
BROKEN = {"4;5": "short", "6;7;8;9": "long", '7;"open;x': "quote", '8;x;"open': "quote", '9;"clo"sed;x': "quote", ";;;": "long", '15;"two': "quote", 'lines";z': "short"}


@pytest.fixture
def broken(tmp_path):
    (tmp_path / "one.csv").write_text("a;b;c\n" + "\n".join(LINES) + "\n", encoding="utf-8")
    (tmp_path / "two.csv").write_bytes("\ufeffc;x;a;b\r\nC;X;20;B\r\n21\r\n".encode())
    return str(tmp_path)


def test_malformed_records_are_listed_with_file_and_text(spark, broken):
    got = read_rejects(spark, broken, ABC).collect()
    listed = {(r["file"].rsplit("/", 1)[-1], r["line"], r["reason"], r["column"], r["value"]) for r in got}
    assert listed == {("one.csv", line, why, None, None) for line, why in BROKEN.items()} | {("two.csv", "21", "short", None, None), ("one.csv", "x;y;z", "type", "a", "x")}
    assert len(got) == len(listed) and all(r["file"].startswith("file:") and r["block"] == 0 for r in got)


def test_every_record_is_in_the_table_or_listed(spark, broken):
    """Records that are not listed come back cell for cell, as a strict parser of the lines reads them."""
    import csv
    good = {tuple(next(csv.reader([x], delimiter=";", strict=True))) for x in LINES if x.strip() and x not in BROKEN and x != "a;b;c"}
    dropped = {tuple(v or "" for v in r) for r in readers.read_texts(spark, broken, ["a", "b", "c"], malformed="drop").collect()}
    assert dropped == good | {("20", "B", "C")}
    assert len(readers.read_texts(spark, broken, ["a", "b", "c"]).collect()) == len([x for x in LINES if x.strip() and x != "a;b;c"]) + 2
    kept = {r["a"]: (r["b"], r["c"]) for r in read_delimited(spark, broken, ABC).collect() if r["a"]}
    assert kept[4] == ("5", None) and kept[6] == ("7", "8") and kept[10] == ("a;b", 'say "hi"') and kept[11] == ('5" pipe', 'in"ch') and kept[17] == ("a", "b\\")


def test_malformed_can_raise(spark, broken):
    with pytest.raises(Exception, match="malformed record"):
        read_delimited(spark, broken, ABC, malformed="raise").collect()
    with pytest.raises(ValueError, match="malformed"):
        read_delimited(spark, broken, ABC, malformed="skip")


def test_the_block_of_a_record_tells_its_place(spark, tmp_path):
    """A large file is read in parts; each record names the part."""
    lines = [f"{i};{'x' * 90};y" + ";long" * (i % 50 == 0) for i in range(20_000)]
    (tmp_path / "big.csv").write_text("a;b;c\n" + "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))
    try:
        got = read_rejects(spark, str(tmp_path), ABC).collect()
        assert read_delimited(spark, str(tmp_path), ABC).count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(int(r["row"]["a"]) for r in got) == list(range(0, 20_000, 50)) and len({r["block"] for r in got}) > 3
    place = 6
    for i, line in enumerate(lines):
        if i % 50 == 0:
            lines[i] = place
        place += len(line) + 1
    assert all(r["block"] <= lines[int(r["row"]["a"])] for r in got)


def test_a_very_long_cell_and_line(spark, tmp_path):
    long = '"' + 'say ""hi"" ' * 40_000 + '"'
    (tmp_path / "long.csv").write_text(f"a;b;c\n1;{long};{'z' * 200_000}\n2;{long[:-1]};z\n3;x\n")
    assert {r["reason"]: r["line"][0] for r in read_rejects(spark, str(tmp_path), ABC).collect()} == {"quote": "2", "short": "3"}
    assert len(read_delimited(spark, str(tmp_path), ABC).where("a = 1").first()["b"]) == len('say "hi" ') * 40_000


def test_quotes_and_separators_by_brute_force(spark, tmp_path):
    """All lines of up to seven characters of the alphabet against a hand-written grammar."""
    import itertools
    def why(line):
        cells, i = 0, 0
        while True:
            if line[i:i + 1] == '"':
                i += 1
                while True:
                    if i >= len(line):
                        return "quote"
                    if line[i] != '"':
                        i += 1
                    elif line[i + 1:i + 2] == '"':
                        i += 2
                    else:
                        i += 1
                        break
                if line[i:i + 1] not in ("", ";"):
                    return "quote"
            else:
                while line[i:i + 1] not in ("", ";"):
                    i += 1
            cells += 1
            if i >= len(line):
                return {1: "short", 2: None}.get(cells, "long")
            i += 1
    lines = ["".join(x) for n in range(1, 8) for x in itertools.product('x";', repeat=n)]
    (tmp_path / "all.csv").write_text("a;b\n" + "\n".join(lines) + "\n")
    got = {r["line"]: r["broken"] for r in readers.records(spark, str(tmp_path), ["a", "b"]).collect()}
    assert got == {x: why(x) for x in lines}
