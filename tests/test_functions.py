"""Operator goldens of FIXTURES.md section 2 (scalar functions)."""

import datetime as dt

from pyspark.sql import functions as F

from visitwise import functions as V


def col1(spark, values, ddl, expr):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr).collect()]


def test_c01_coord_text(spark):
    assert col1(spark, ["-74,0721234", None], "t string", V.coord_text("t")) == ["-74.0721", None]


def test_c02_to_number(spark):
    got = col1(spark, ["-74.0721", " 4.5", "", "abc", "1e3", "4.6.5", "1.0d"], "t string",
               V.to_number("t"))
    assert got == [-74.0721, 4.5, None, None, 1000.0, None, None]


def test_c04_parse_dmy(spark):
    assert col1(spark, ["1/1/2023", "31/12/2023", "x"], "t string", V.parse_dmy("t")) == [
        dt.date(2023, 1, 1), dt.date(2023, 12, 31), None]


def test_c05_parse_mdy(spark):
    got = col1(spark, ["1/5/2023 8:05", "12/31/2023 23:59"], "t string",
               V.parse_mdy_hm("t").cast("timestamp_ntz"))
    assert got == [dt.datetime(2023, 1, 5, 8, 5), dt.datetime(2023, 12, 31, 23, 59)]


SECS = [3900, 930, None, -3600, 2 * 86400 + 3720]


def test_c10_length_text(spark):
    assert col1(spark, SECS, "s long", V.length_text("s", compat=True)) == [
        "1h:5 min", "0h:15 min", "nanh:nan min", "23h:0 min", "1h:2 min"]
    assert col1(spark, SECS, "s long", V.length_text("s"))[2] is None


def test_c11_time_code(spark):
    assert col1(spark, SECS, "s long", V.time_code("s")) == [15.0, 15.0, None, 230.0, 12.0]


def test_c09_duration_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 2, 8, 0), dt.datetime(2023, 1, 2, 9, 5)),
                                (dt.datetime(2023, 1, 2, 8, 0), None)],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(V.duration_seconds("a", "b")).collect()] == [3900, None]


def test_timedelta_text(spark):
    assert col1(spark, [900, 86400, -3600], "s long", V.timedelta_text("s")) == [
        "0 days 00:15:00", "1 days 00:00:00", "-1 days +23:00:00"]


def test_c13_haversine(spark):
    rows = [(-74.07, 4.71, -74.07, 4.71), (-74.07, 4.71, -74.071, 4.71),
            (-74.07, 4.71, -74.08, 4.71), (-74.07, 4.71, -75.57, 6.24), (0.0, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(F.round(V.haversine_m("a", "b", "c", "d"), 3)).collect()]
    assert got == [0.0, 110.819, 1108.194, 237714.89, 314402.951]


def test_c14_zero_guard(spark):
    rows = [(0.0, 1.0, 2.0, 3.0), (None, 1.0, 2.0, 3.0), (-74.07, 4.71, -74.071, 4.71)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(F.round(V.guarded_distance("a", "b", "c", "d"), 3)).collect()]
    assert got == [0.0, None, 110.819]


def test_c15_range_class(spark):
    got = col1(spark, [0.0, 200.0, 200.1, None], "d double", V.range_class("d"))
    assert got == ["Dentro del Rango", "Dentro del Rango", "Fuera del Rango", ""]
    assert col1(spark, [10.0], "d double", V.range_class_si("d")) == ["Si"]


TEXTS = ["Ñató, Sábado, Nuñez.", "@LICORES.COM", "½ Øß º N° 5–7", "a&b  c", None]
CLEAN = ["Nato Sabado Nunez", "LICORESCOM", "12  o N 57", "ab  c", None]


def test_c19_clean_text_jvm(spark):
    assert col1(spark, TEXTS, "t string", V.clean_text("t")) == CLEAN


SCRIPTS = ["Ñató, Sábado, Nuñez.", "हिन्दी", "Ḃella ﬁn", "２０ ％", "עִבְרִית", "ภาษาไทย", "가각", "e\u0301\u0323", None]


def test_c19_every_script(spark):
    import re
    import unicodedata
    want = [None if s is None else re.sub(r"[^a-zA-Z0-9\s]", "", unicodedata.normalize("NFKD", s)) for s in SCRIPTS]
    assert want[2] == "Bella fin" and want[3] == "20 "
    assert col1(spark, SCRIPTS, "t string", V.clean_text("t")) == want


def test_c20_every_script(spark):
    import unicodedata
    want = [None if s is None else "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))
            for s in SCRIPTS]
    assert want[0] == "Nato, Sabado, Nunez." and want[1] == "हिनदी"
    assert col1(spark, SCRIPTS, "t string", V.strip_marks("t")) == want


def test_marks_are_searched_in_a_tree(spark):
    """No class of the pattern lists more than two ranges (Java tries them one after the other),
    and it matches the marks alone among all characters."""
    import re
    import sys
    import unicodedata
    pattern = V.text.combining_class_pattern()
    assert max(len(re.findall(r"\\x\{\w+\}-\\x", c)) for c in re.findall(r"\[([^\[\]]*)\]", pattern)) <= 2
    chars = [cp for cp in range(1, sys.maxunicode + 1) if not 0xD800 <= cp < 0xE000]
    rows = spark.createDataFrame([("".join(map(chr, chars[i:i + 5000])),) for i in range(0, len(chars), 5000)], "t string")
    from pyspark.sql import functions as F
    left = "".join(r[0] for r in rows.select(F.regexp_replace("t", pattern, "")).collect())
    assert left == "".join(chr(cp) for cp in chars if not unicodedata.combining(chr(cp)))


def test_c19_without_icu_raises(spark, monkeypatch):
    import pytest
    monkeypatch.setattr(V.text, "_ICU_NORMALIZER", "no.such.Normalizer")
    V.text._require_icu.cache_clear()
    with pytest.raises(RuntimeError, match="ICU4J"):
        V.clean_text("t")
    V.text._require_icu.cache_clear()


def test_c21_codes(spark):
    assert col1(spark, [1, 10], "n long", V.code_from_int("n")) == ["001", "0010"]
    assert col1(spark, [1, 10], "n long", V.code_canonical("n")) == ["001", "010"]
    assert col1(spark, ["NaN", "", "5"], "t string", V.code_from_text("t")) == ["", "00", "005"]


def test_c17_c18_flags(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(V.not_null_flag("a")).collect()] == [1, 1, 0]
    assert [r[0] for r in df.select(V.equal_flag("a", "b")).collect()] == [1, 0, 0]


def test_c26_concat_strict(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(V.concat_strict("x", "y", sep="-")).collect()] == ["a-b", None]


def test_c30_month_end(spark):
    got = col1(spark, [dt.date(2023, 1, 31), dt.date(2024, 2, 28), dt.date(2024, 2, 29)],
               "d date", V.month_end_flag("d"))
    assert got == [True, False, True]
    assert col1(spark, [dt.date(2023, 10, 5)], "d date", V.period_yyyymm("d")) == ["202310"]


def test_latin1_safe(spark):
    assert col1(spark, ["añ漢"], "t string", V.latin1_safe("t")) == ["añ"]


def test_c19_python_whitespace_set(spark):
    # Python's \s keeps U+001C..U+001F and U+3000; other symbols go
    import re
    import unicodedata
    s = "a\x1cb\u3000c\u2603d\u2028e\u00a0f"
    exp = re.sub(r"[^a-zA-Z0-9\s]", "", unicodedata.normalize("NFKD", s))
    assert col1(spark, [s], "t string", V.clean_text("t")) == [exp]


def test_durations_ignore_session_time_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 3, 30))],
                                   "a timestamp_ntz, b timestamp_ntz")
        assert df.select(V.duration_seconds("a", "b")).first()[0] == 7200
        yr = df.where(V.year_range_filter("a", 2024)).count()
        assert yr == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_small_helpers(spark):
    df = spark.createDataFrame([(5, [3, 1], "2023-01-05 08:30:00")], "n int, a array<int>, t string")
    r = df.select(V.int_text("n"), V.first_element("a"), V.case_in_list("n", [5, 7]),
                  V.case_in_list(F.lit(6), [5, 7]), V.to_ts("t", "yyyy-MM-dd HH:mm:ss")
                  .cast("timestamp_ntz")).first()
    assert tuple(r) == ("5", 3, 5, 0, dt.datetime(2023, 1, 5, 8, 30))


def test_ascii_and_other_texts_decompose_alike(spark):
    import unicodedata

    from visitwise.functions.text import decompose
    texts = ["", "plain ASCII\t1!", "a\x00b", "caf\u00e9", "cafe\u0301", "\ufb01n \u00bd", "\u1e9b\u0323", "\U0001d400x", "\u212b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for compat, form in ((True, "NFKD"), (False, "NFD")):
        got = [r[0] for r in df.select(decompose("t", compat)).collect()]
        assert got == [None if t is None else unicodedata.normalize(form, t) for t in texts]
