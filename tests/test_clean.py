"""Casts, null tokens, dates and the table loader on literal rows."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarryline.functions import casts, dates, maths, nulls, text
from quarryline.operators import loader
from quarryline.operators.codebook import CodeBook
from quarryline.sources.literal import inline

T = F.col("t")


def test_lenient_dates(values):
    slashed = ["07/06/1998", "7/6/1998", "31/04/1998", "07/06/98", "07/06/1998 ", "29/02/1996", "29/02/1900", "nan", "", None]
    read = [date(1998, 6, 7), None, None, None, None, date(1996, 2, 29), None, None, None, None]
    assert values(slashed, casts.clean_date(T, "%d/%m/%Y")) == read
    for fmt in ("%Y.%m.%d", "yyyy.MM.dd"):
        assert values(["2003.11.05", "2003-11-05", "NONE"], casts.clean_date(T, fmt)) == [date(2003, 11, 5), None, None]


def test_numbers(values):
    texts = ["3", "+3", "-1", " 3 ", "3.5", "99999999999", "", None, "null"]
    assert values(texts, casts.lenient(T, "int")) == [3, 3, -1, None, None, None, None, None, None]
    assert values(["1.5", "1.5d", ".5", "5.", "1e3", " 1"], casts.lenient(T, "double")) == [1.5, None, 0.5, 5.0, 1000.0, None]
    assert values(["7", None], casts.strict(T, "bigint")) == [7, None]


BAD = [("x", "int"), (" 3 ", "int"), ("3.5", "bigint"), ("1.5d", "double"), ("", "float"), ("99999999999", "int"), ("2024-13-01", "date")]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(("bad", "dtype"), BAD)
def test_strict_casts_fail_under_any_setting(spark, values, ansi, bad, dtype):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="not a valid"):
            values([None, bad], casts.strict(T, dtype))
        with pytest.raises(PySparkException, match="not a valid date"):
            values(["2024-13"], casts.strict_date(T, "%Y-%m"))
        assert values(["2024-12", None], casts.strict_date(T, "%Y-%m")) == [date(2024, 12, 1), None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_booleans(values):
    texts = ["true", "False", "1", "0", "2", "null", "None", "NONE", "NaN", "", "-1", None]
    assert values(texts, casts.clean_boolean(T)) == [True, False, True, False, True] + [None] * 7
    with pytest.raises(PySparkException):
        values(["maybe"], casts.clean_boolean(T))


def test_tokens_and_times(values):
    texts = ["null", "NULL", "NONE", "None", "nan", "NaN", "", "-1", "x", " ", "none"]
    assert values(texts, casts.clean_string(T)) == [None] * 8 + ["x", " ", "none"]
    assert values(["10:30", "25:00", "-1", "9:05", None], casts.clean_time(T, "%H:%M")) == ["10:30:00", None, None, None, None]
    assert values(["", "x", None], nulls.empty_flag(T)) == [True, False, None]


# What each way of writing leaves of 9 August 1987.
WRITTEN = [
    ("%Y", 1987, (1987, 1, 1)), ("%Y-%m", "1987-08", (1987, 8, 1)), ("%Y%m%d", 19870809, (1987, 8, 9)), ("%Y-%m-%d", "1987-08-09", (1987, 8, 9)),
]
FORMAT_ONLY = [("%Y%m", 198708, (1987, 8, 1)), ("%d.%m.%Y", "09.08.1987", (1987, 8, 9))]
NO_FORMAT = [(None, date(1987, 8, 9), (1987, 8, 9)), (None, datetime(1987, 8, 9, 23, 59, 58), (1987, 8, 9)), (None, "1987-08-09T23:59", (1987, 8, 9))]


@pytest.mark.parametrize(("fmt", "value", "day"), WRITTEN + FORMAT_ONLY + NO_FORMAT + [(None, v, d) for _, v, d in WRITTEN])
def test_normalised_dates(spark, fmt, value, day):
    texts = [value] if isinstance(value, date) else [value, str(value)]
    for written in texts:
        df = spark.createDataFrame([(written,)], ["t"])
        assert df.select(dates.normalise(T, fmt)).first()[0] == datetime(*day)


def test_unreadable_dates(values):
    assert values(["1987-13", "soon", None], dates.normalise_lenient(T)) == [None] * 3
    assert values([None], dates.normalise(T)) == [None]
    for bad in ("1987-13", "soon", ""):
        with pytest.raises(PySparkException, match="not a date"):
            values([bad], dates.normalise(T))


def test_text_helpers(values):
    assert values(["aXbXc", "abc", "", None], text.replace_first(T, "X", "--")) == ["a--bXc", "abc", "", None]
    assert values(["7", "1234", None], text.zero_pad(T, 3)) == ["007", "1234", None]
    assert values(["  a\t ", " "], text.trim_spaces(T)) == ["a\t", ""]
    assert values(["vehicle-1979-latest", "x"], text.split_head(T, "-")) == ["vehicle", "x"]
    assert values(["a", None], text.concat_all(" - ", T, F.lit("b"))) == ["a - b", None]
    page = """<form><input type="checkbox" name="datatypes" value="ks4"><INPUT value='Abs' name='datatypes'/>
        <input name="other" value="no"><input value="ks4" name="datatypes"><input name="datatypes2" value="no"></form>"""
    found = text.harvest_attribute(T, "input", ("name", "datatypes"), "value")
    assert values([page, "<p>none</p>"], found) == ["ABS,KS4", ""]


def test_header_names():
    assert text.header_names(["a_b c", "Sex_Of"], "title") == {"a_b c": "A B C", "Sex_Of": "Sex Of"}
    assert text.header_names(["A b"], "snake") == {"A b": "a_b"}
    assert text.header_names(["a_b"], "spaces") == {"a_b": "a b"}
    assert text.header_names(["a_b"], "other") == {}


def test_maths(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (1.0,)], "x double")
    log = [r[0] for r in df.select(maths.ln_ieee(F.col("x"))).collect()]
    assert log[0] == float("-inf") and log[1] != log[1] and log[2] == 0.0
    halves = spark.createDataFrame([(65536,), (196608,), (None,)], "b bigint").select(maths.mebibytes(F.col("b")))
    assert [r[0] for r in halves.collect()] == [0.062, 0.188, None]


SHIPS = {"berth": "int", "ship": "string", "draught": "float", "flag": "coded", "sailed": "date"}
TITLES = {c: c.title() for c in SHIPS}


def _ships(**changes):
    columns = {
        "berth": ["12", "-3", "007", "1e2", "", None],
        "ship": ["Alba", "None", "", "none", " Bo ", "41"],
        "draught": ["4.5", ".25", "deep", "NULL", "3", None],
        "flag": ["n", "p", "n", "", "p", None],
        "sailed": ["3 May 2011", "03 May 2011", "31 Jun 2011", "30 Jun 2011", "null", "nan"],
    }
    return {**columns, **changes}


def _nulls(df):
    return loader.null_census(df).first().asDict()


def test_loader_with_junk(spark):
    book = CodeBook(spark.createDataFrame([("t", "flag", "n", "Norway"), ("t", "flag", "p", "Panama")], "table string, field string, code string, label string"))
    df = loader.clean_table(inline(spark, _ships()), SHIPS, formats={"sailed": "%d %b %Y"}, renames=TITLES, codebook=book)
    assert dict(df.dtypes) == {"Berth": "int", "Ship": "string", "Draught": "float", "Flag": "string", "Sailed": "date"}
    assert _nulls(df) == {"Berth": 3, "Ship": 2, "Draught": 3, "Flag": 2, "Sailed": 4}
    assert sorted(r["Flag"] or "" for r in df.collect()) == ["", "", "Norway", "Norway", "Panama", "Panama"]


def test_loader_without_a_book(spark):
    plain = {**SHIPS, "flag": "categorical"}
    df = loader.clean_table(inline(spark, _ships(flag=["x", "y", "NaN", "x", "", None])), plain, formats={"sailed": "%d %b %Y"})
    assert _nulls(df) == {"berth": 3, "ship": 2, "draught": 3, "flag": 3, "sailed": 4}


def test_column_operations_see_the_input(spark):
    df = loader.clean_table(
        inline(spark, {"side": ["2", "7"], "kept": ["u", "v"]}), {"side": "int"}, renames={"side": "Side"},
        column_operations={"side": F.col("side") + 1, "area": F.col("side") * F.col("side")},
    )
    assert df.columns == ["Side", "kept", "area"]
    assert sorted(tuple(r) for r in df.collect()) == [(3, "u", 4), (8, "v", 49)]


def test_frame_operations_run_in_order(spark):
    df = loader.clean_table(
        inline(spark, {"port": ["Oslo", "Bari", "Oslo"], "tons": ["40", "x", "2"]}), {"port": "categorical", "tons": "int"},
        frame_operations=[lambda d: d.na.drop(), lambda d: d.groupBy("port").agg(F.sum("tons").alias("tons"))],
    )
    assert [tuple(r) for r in df.collect()] == [("Oslo", 42)]


def test_loader_rejects(spark):
    df = inline(spark, {"a": [1]})
    with pytest.raises(ValueError, match="column operations"):
        loader.clean_table(df, column_operations={"b": lambda c: c})
    with pytest.raises(ValueError, match="unknown kind"):
        loader.clean_table(df, {"a": "money"})


def test_undeclared_columns_pass(spark):
    df = loader.clean_table(inline(spark, {"a": [1], "b": ["null"]}), {"a": "int"})
    assert tuple(df.first()) == (1, "null")
