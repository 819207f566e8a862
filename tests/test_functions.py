"""Column functions on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.functions import calendar as cal
from skyledger.functions import text as tx
from skyledger.functions.casts import text_to_int
from skyledger.functions.geo import haversine_km


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr(F.col("v")).alias("r")).collect()[0].r


@pytest.mark.parametrize("value,expected", [("61.0", 61), ("4.0", 4), ("3.9", 3), ("abc", None), (None, None)])
def test_text_to_int(spark, value, expected):
    assert one(spark, text_to_int, value) == expected


def test_date_key_and_unknown(spark):
    ts = dt.datetime(2022, 1, 3, 21, 15, 30)
    assert one(spark, cal.date_key, ts, "v timestamp_ntz") == 20220103
    assert one(spark, cal.date_key, None, "v timestamp_ntz") is None
    assert one(spark, cal.date_key_or_unknown, None, "v timestamp_ntz") == -1


def test_key_slices_regex_equals_arithmetic(spark):
    keys = spark.createDataFrame([(k,) for k in [20220115, 20210131, 20220215, 19990101, 20221231, 20230101]], "k int")
    r = keys.select("k", cal.key_matches("k", r"^\d{4}01\d{2}$").alias("rx"), cal.key_in_month("k", 1).alias("ar"),
                    cal.key_matches("k", r"2022\d{4}$").alias("ry"), cal.key_in_year("k", 2022).alias("ay")).collect()
    for row in r:
        assert row.rx == row.ar and row.ry == row.ay, row


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 3),), (dt.date(2000, 2, 29),), (dt.date(1900, 12, 31),)], "d date")
    out = {r.pk_date: r for r in df.select(*[c.alias(n) for n, c in cal.calendar_columns("d").items()]).collect()}
    assert (out[20220103].week_day, out[20220103].week_of_year, out[20220103].month_name) == (0, 1, "Jan")
    assert out[20000229].is_leap_year == 1 and out[19001231].is_leap_year == 0
    assert out[20000229].bimester == 1 and out[19001231].bimester == 6


def test_clock_text(spark):
    df = spark.createDataFrame([(5, 7, 9)], "h int, m int, s int")
    r = df.select(cal.clock_text("h", "m", "s").alias("a"), cal.clock_text("h").alias("b")).collect()[0]
    assert (r.a, r.b) == ("05:07:09", "05:00:00")


@pytest.mark.parametrize("value,expected", [
    ('"2022-01-03 21:15:30"', dt.datetime(2022, 1, 3, 21, 15, 30)),
    ("2000-02-29 05:00:00", dt.datetime(2000, 2, 29, 5, 0, 0)),
    ("2022-13-01 00:00:00", None), ("garbage", None), (None, None)])
def test_parse_timestamp(spark, value, expected):
    assert one(spark, cal.parse_timestamp, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("Ação É", "Acao E"), ("Zoë Ångström", "Zoe Angstrom"), ("ét́e", "ete"), ("Ελλάδα", "Ελλαδα")])
def test_strip_accents(spark, value, expected):
    assert one(spark, tx.strip_accents, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("Groß Ødegaard", "Gross Odegaard"), ("γ-Virginids", "g-Virginids"), ("Ελλάδα", "Ellada"),
    ("Æsir þing", "AEsir thing"), (None, None)])
def test_transliterate(spark, value, expected):
    assert one(spark, tx.transliterate, value) == expected


#: Hand-written: place and person names of other scripts.
SCRIPTS = [("북한산 서울 안녕", "bughansan seoul annyeong"), ("北京 上海市", "Bei Jing  Shang Hai Shi "), ("とうきょう カメラ ふじ", "toukiyou kamera fuji"),
           ("नमस्ते दिल्ली", "namaste dilli"), ("ঢাকা", "dhaka"), ("தமிழ்", "tamil"), ("ગુજરાત", "gujarata"), ("తెలుగు", "telugu"), ("ಕನ್ನಡ", "kannada"), ("ਪੰਜਾਬ", "pamjaba"),
           ("السلام", "alslam"), ("مكتب", "mktb"), ("שלום", "slwm"), ("თბილისი", "tbilisi"), ("Հայաստան", "Hayastan"), ("กรุงเทพ", "krungethph"), ("አዲስ", "adis"),
           ("Ελλάδα Θήρα", "Ellada Thera"), ("Щукин Юрий", "Shchukin Iurii"), ("ＡＢＣ１", "ABC1"), ("№5 ½", "No5  1/2"), ("😀 ok", "😀 ok"), ("Łódź Zürich Groß", "Lodz Zurich Gross")]


@pytest.mark.parametrize("value,expected", SCRIPTS)
def test_scripts(spark, value, expected):
    assert one(spark, tx.transliterate, value) == expected


def test_names_of_other_scripts_are_cleaned(spark):
    assert one(spark, tx.normalize_text_trim, " 北京  ДОМ ") == "Bei Jing Dom"
    assert one(spark, tx.normalize_name, "서울 ÉCOLE") == "Seoul Ecole"


def test_map_is_rule_built_and_ascii(spark):
    from skyledger.functions import romanise
    known = romanise.romanisations()
    assert len(known) > 24_000 and all(v.replace("\ue001", "").isascii() for v in known.values())
    assert all(known[k] == v for k, v in romanise.TRANSLITERATION.items())
    texts = ["".join(chr(c) for c in range(lo, lo + 64)) for lo in (0x400, 0x5d0, 0x620, 0x10d0, 0x3041, 0x4e00, 0x9f00)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.o for r in df.select("i", tx.transliterate("t").alias("o")).collect()}
    accents = dict(zip(tx.ACCENT_SRC, tx.ACCENT_DST + " " * (len(tx.ACCENT_SRC) - len(tx.ACCENT_DST))))
    for i, t in enumerate(texts):
        t = "".join(accents.get(c, c) for c in t)
        assert got[i] == "".join(known.get(c, c) for c in t)


def test_hangul_by_its_letters(spark):
    import unicodedata
    from skyledger.functions.romanise import HANGUL
    assert [len(x) for x in HANGUL] == [19, 21, 28]
    for c in "가힣한글뷁없읽":
        i, v, f = ([ord(x) for x in unicodedata.normalize("NFD", c)] + [0x11A7])[:3]
        assert one(spark, tx.transliterate, c) == HANGUL[0][i - 0x1100] + HANGUL[1][v - 0x1161] + HANGUL[2][f - 0x11A7]


@pytest.mark.parametrize("value,expected", [
    ("JOSÉ  da-silva", "Jose Da-silva"), ("o'neil\tsmith", "O'neil smith"), (None, None)])  # title case runs before the tab is collapsed
def test_normalize_name(spark, value, expected):
    assert one(spark, tx.normalize_name, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("  josé   da-silva  ", "Jose Da-Silva"), ("o'hara  village", "O'Hara Village"), ("1st place", "1St Place"),
    ("ÉCOLE élève", "Ecole Eleve"), (None, "Unknown")])
def test_normalize_text_trim(spark, value, expected):
    assert one(spark, tx.normalize_text_trim, value) == expected


def test_python_title_matches_str_title(spark):
    samples = ["o'neil da-silva", "hello\tworld\nnew  line", "they're here", "a_b c", "x", "", "ǆemal"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r.r for r in df.select(tx.python_title("v").alias("r")).collect()]
    assert got == [s.title() for s in samples]


def test_pieces_defaults_validation(spark):
    df = spark.createDataFrame([("Rio , Centro", "", None, "São Paulo", "123")], "a string, b string, c string, d string, e string")
    r = df.select(tx.nth_piece("a", ",", 0).alias("city"), tx.nth_piece("d", " ", 5).alias("none"),
                  tx.first_present("b", "c", "a").alias("fp"), tx.first_present("b", "c").alias("unk"),
                  tx.default_if_blank("b", "Unknown").alias("blank"), tx.valid_or_unknown("d").alias("ok"),
                  tx.valid_or_unknown("e").alias("bad"), tx.valid_or_unknown("c").alias("null")).collect()[0]
    assert r.city == "Rio " and r.none is None and r.fp == "Rio , Centro" and r.unk == "Unknown"
    assert r.blank == "Unknown" and r.ok == "São Paulo" and r.bad == "Unknown" and r.null == "Unknown"


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (10.0, 10.0, 10.0, 10.0)], "a double, b double, c double, d double")
    r = [x.km for x in df.select(haversine_km("a", "b", "c", "d").alias("km")).collect()]
    assert abs(r[0] - 111.19492664455873) < 1e-9 and r[1] == 0.0


def test_accent_table_is_rule_built():
    assert len(tx.ACCENT_DST) > 250 and all(len(c) == 1 for c in tx.ACCENT_DST)
    assert len(tx.ACCENT_SRC) == len(tx.ACCENT_DST) + 0x70   # plus the combining marks, which are deleted


def test_names_of_one_row_group_are_romanised_in_several_tasks(spark, tmp_path):
    from skyledger.plans.q_functions import romanise_scripts
    names = spark.range(3000).select(F.col("id").alias("c_custkey"), F.format_string("Customer#%09d", "id").alias("c_name"))
    names.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    out = romanise_scripts(spark, str(tmp_path))
    plan = out.select("c_custkey", "han")._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression [c_custkey" in plan and out.count() == 3000
    row = out.where("c_custkey = 27").first()
    assert row.hangul.endswith("ichil")


def test_session_clock_adds_seconds(spark):
    from skyledger.functions.calendar import session_clock
    rows = [("2000-02-28", 86399), ("2000-02-28", 86400), ("1900-12-31", 0), (None, 5), ("2001-01-01", None)]
    df = spark.createDataFrame(rows, "d string, s long").select(session_clock(F.col("d").cast("date"), F.col("s")).cast("string").alias("t"))
    assert [r.t for r in df.collect()] == ["2000-02-28 23:59:59", "2000-02-29 00:00:00", "1900-12-31 00:00:00", None, None]
