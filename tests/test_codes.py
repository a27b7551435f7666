"""Recoding rules: strict, lenient, lookups, fallbacks and domains."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarryline.functions import codes
from quarryline.operators import codebook
from quarryline.plans import sizing

T = F.col("t")


def _lookup(spark, mapping):
    return codebook.literal_lookup(spark, mapping)


def _labels(df, column="label"):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.fixture
def coded(spark):
    return spark.createDataFrame([(0, "a"), (1, "z"), (2, None), (3, "")], "i int, code string")


def test_strict_and_lenient(values):
    mapping = {"a": "Alpha", "b": "Beta", "o'x\\": "quote ' and \\"}
    assert values(["a", "b", None, "o'x\\"], codes.recode_strict(T, mapping)) == ["Alpha", "Beta", None, "quote ' and \\"]
    assert values(["a", "z", None], codes.recode_lenient(T, mapping)) == ["Alpha", None, None]
    with pytest.raises(PySparkException, match="unmapped place: z"):
        values(["a", "z"], codes.recode_strict(T, mapping, "place"))


def test_number_codes(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "t int")
    assert [r[0] for r in df.select(codes.recode_lenient(T, {1: "one"})).collect()] == ["one", None, None]


@pytest.mark.parametrize("n", [64, 65, 20_000])
def test_maps_of_any_length(values, n):
    mapping = {f"c\u00e9{i}": f"L{i}" for i in range(n)}
    texts = ["c\u00e90", f"c\u00e9{n - 1}", f"c\u00e9{n}", None]
    assert values(texts, codes.recode_lenient(T, mapping)) == ["L0", f"L{n - 1}", None, None]
    with pytest.raises(PySparkException, match="unmapped value"):
        values(["z"], codes.recode_strict(T, mapping))


def test_domain_and_order(values):
    domain = ("low", "mid", "high")
    assert values(["high", None, "low"], codes.in_domain_strict(T, domain)) == ["high", None, "low"]
    assert values(["high", "low", None, "no"], codes.ordinal(T, domain)) == [3, 1, None, None]
    with pytest.raises(PySparkException, match="outside its domain"):
        values(["top"], codes.in_domain_strict(T, domain))


def test_lookup_rules(spark, coded):
    lookup = _lookup(spark, {"a": "Alpha", "": "Blank"})
    assert _labels(codebook.apply_lookup(coded, "code", lookup, "label")) == ["Alpha", None, None, "Blank"]
    fallback = codebook.apply_lookup(coded, "code", lookup, "label", strict=True, fallback="Unknown", null_label="None")
    assert _labels(fallback) == ["Alpha", "Unknown", "None", "Blank"]
    replaced = codebook.apply_lookup(coded, "code", lookup, "code")
    assert replaced.columns == ["i", "code"] and _labels(replaced, "code") == ["Alpha", None, None, "Blank"]
    as_map = codebook.apply_lookup(coded, "code", {"a": "Alpha", "": "Blank"}, "label")
    assert _labels(as_map) == ["Alpha", None, None, "Blank"]
    with pytest.raises(PySparkException, match="unmapped code: z"):
        codebook.apply_lookup(coded, "code", lookup, "label", strict=True).collect()


def test_lookup_of_repeated_codes(spark):
    rows = [(1, "a", "first", "x"), (2, "a", "last", "y"), (3, "b", None, "z"), (4, None, "n", "w")]
    df = spark.createDataFrame(rows, "at int, code string, label string, other string").select("code", "label", "other", "at")
    found = codebook.lookup_from_columns(df, 0, 1, F.col("at"))
    assert [tuple(r) for r in found.collect()] == [("a", "last")]
    other = codebook.lookup_from_columns(df, 0, 2, F.col("at"))
    assert sorted(tuple(r) for r in other.collect()) == [("a", "y"), ("b", "z")]
    with pytest.raises(PySparkException, match="two labels for code a"):
        codebook.lookup_from_columns(df, 0, 1).collect()
    same = codebook.lookup_from_columns(df.withColumn("label", F.lit("same")), 0, 1)
    assert sorted(tuple(r) for r in same.collect()) == [("a", "same"), ("b", "same")]


def test_override_and_unmapped(spark, coded):
    merged = codebook.override(_lookup(spark, {"a": "old", "b": "B"}), _lookup(spark, {"a": "new", "c": "C"}))
    assert sorted(tuple(r) for r in merged.collect()) == [("a", "new"), ("b", "B"), ("c", "C")]
    assert sorted(r[0] for r in codebook.unmapped_codes(coded, "code", merged).collect()) == ["", "z"]


def test_check_domain(spark, coded):
    everything = _lookup(spark, {"a": "", "z": "", "": ""})
    assert codebook.check_domain(coded, "code", everything).count() == 4
    with pytest.raises(PySparkException, match="outside its domain: z"):
        codebook.check_domain(coded, "code", _lookup(spark, {"a": "", "": ""})).collect()


def test_codebook(spark):
    rows = [("accident", "enhanced_collision_severity", "1", "Very serious"), ("accident", "kind", "-1", "Missing"), ("accident", "kind", "1", "One")]
    rows += [("accident", "long", str(i), f"L{i}") for i in range(100)]
    raw = spark.createDataFrame(rows, ["table", "field name", "code/format", "label"])
    book = codebook.CodeBook(codebook.read_codebook(raw), drop_missing_code=True)
    assert book.fields == {"enhanced_severity_collision", "kind", "long"}
    assert book.literal("kind") == {"1": "One"} and book.literal("long") is None
    assert book.lookup("long").count() == 100
    assert [tuple(r) for r in book.domain("kind").collect()] == [("One", 1)]
    assert {r["table"] for r in book.book.collect()} == {"collision"}


@pytest.mark.parametrize("n", [3, 100])
def test_codebook_repeated_codes_at_any_length(spark, coded, n):
    rows = [("t", "code", "a", "Zed", 1), ("t", "code", "a", "Alpha", 2)] + [("t", "code", f"x{i}", "x", 3) for i in range(n)]
    table = spark.createDataFrame(rows, "table string, field string, code string, label string, at int")
    book = codebook.CodeBook(table)
    assert book.fields == {"code"} and (book.literal("code") is None) == (n > 64)
    for lookup in (book.lookup("code"), book.literal("code")):
        if lookup is not None:
            assert _labels(codebook.apply_lookup(coded, "code", lookup, "label")) == ["Alpha", None, None, None]
    with pytest.raises(PySparkException, match="two labels for code a"):
        codebook.CodeBook(table.drop("at"))


def test_resolve_lookups(spark):
    short = spark.createDataFrame([("a", "A", 1), ("a", "A2", 2), ("b", None, 3)], "c string, l string, n int")
    long = spark.range(200).selectExpr("CAST(id AS STRING) AS c", "'L' || id AS l")
    rows = short.selectExpr(f"inline(array({codebook.lookup_entry('short', 'c', 'l', 0)}))").union(
        long.selectExpr(f"inline(array({codebook.lookup_entry('it''s long'.replace(chr(39) * 2, chr(39)), 'c', 'l', 0)}))")
    )
    found = codebook.resolve_lookups(rows)
    assert found["short"] == {"a": "A2"}
    assert found["its long"].count() == 200


def test_wide_labels_are_neither_literals_nor_broadcast(spark):
    rows = spark.range(20).selectExpr("CAST(id AS STRING) AS c", "repeat('x', 1000000) || id AS l")
    few = spark.createDataFrame([("a", "A")], "c string, l string")
    entries = rows.selectExpr(f"inline(array({codebook.lookup_entry('wide', 'c', 'l', 0)}))").union(
        few.selectExpr(f"inline(array({codebook.lookup_entry('short', 'c', 'l', 0)}))")
    )
    found = codebook.resolve_lookups(entries)
    assert found["short"] == {"a": "A"}
    plan = found["wide"]._jdf.queryExecution().analyzed().toString()
    assert found["wide"].count() == 20 and "ResolvedHint" not in plan
    book = rows.selectExpr("'t' AS table", "'f' AS field", "c AS code", "l AS label")
    wide = codebook.CodeBook(book)
    assert wide.literal("f") is None and wide.fields == {"f"} and wide.lookup("f").count() == 20


def test_sides_are_measured_in_bytes(spark):
    df = spark.sql("SELECT 1L AS n, 'abc' AS `t.x`, array(1, 2) AS a UNION ALL SELECT null, null, null")
    # Two rows of three columns, three bytes of text and the six of "[1, 2]".
    assert df.agg(F.sum(sizing.row_bytes(df))).first()[0] == 2 * 48 + 3 + 6
    marked = sizing.small_side(df)._jdf.queryExecution().analyzed().toString()
    unmarked = sizing.small_side(df, 104)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in marked and "ResolvedHint" not in unmarked
    assert sizing.together_small({"a": 5, "b": 3, "c": 9}, 8) == {"a", "b"}
    assert sizing.together_small({"a": 9}, 8) == set()
