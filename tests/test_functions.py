from pyspark.ml.feature import RegexTokenizer, Tokenizer
from pyspark.sql import functions as F

from quarry.functions import (
    hash_fraction_threshold,
    java_space_split,
    month_of,
    pattern_count,
    regex_tokens,
    split_keep_empty,
    strip_brackets,
    tolerant_double,
    unit_hash,
    whitespace_tokens,
    year_of,
)


def test_tolerant_double_turns_dirty_text_into_null(spark):
    df = spark.createDataFrame([("0",), ("1",), ("3",), ("No",), ("",), (None,)], "hired string")
    got = [r[0] for r in df.select(tolerant_double("hired")).collect()]
    assert got == [0.0, 1.0, 3.0, None, None, None]
    # the dirty label filter keeps only 0 and 1 (blank, 'No' and 3 dropped)
    kept = df.where((F.col("hired") != "") & (F.col("hired") != "No") & (tolerant_double("hired") != 3))
    assert sorted(r[0] for r in kept.collect()) == ["0", "1"]


def test_split_rules(spark):
    df = spark.createDataFrame([("a  b",), ("",), ("   ",), (" a",), ("a ",)], "line string")
    py = [r[0] for r in df.select(split_keep_empty("line", " ")).collect()]
    assert py == ["a  b".split(" "), [""], ["", "", "", ""], ["", "a"], ["a", ""]]
    java = [r[0] for r in df.select(java_space_split("line")).collect()]
    # java.util.regex.Pattern.split drops trailing empty strings
    assert java == [["a", "", "b"], [""], [], ["", "a"], ["a"]]


def test_tokenizers_match_pyspark_ml(spark):
    rows = [
        (0, "Hello, World! it's  a test"),
        (1, "  leading and trailing  "),
        (2, ""),
        (3, "élan vital_x 42\tTab\nline"),
        (4, "   "),
    ]
    df = spark.createDataFrame(rows, "id int, text string")
    ws = Tokenizer(inputCol="text", outputCol="t").transform(df).orderBy("id").select("t").collect()
    ours = df.orderBy("id").select(whitespace_tokens("text")).collect()
    assert [r[0] for r in ours] == [r[0] for r in ws]
    rt = RegexTokenizer(inputCol="text", outputCol="t", pattern="\\W").transform(df).orderBy("id").select("t").collect()
    ours = df.orderBy("id").select(regex_tokens("text")).collect()
    assert [r[0] for r in ours] == [r[0] for r in rt]


def test_strip_brackets_and_pattern_count(spark):
    df = spark.createDataFrame([("[[[a, b]]]",), ("a",), ("[[[x]]] y]]]",)], "e string")
    assert [r[0] for r in df.select(strip_brackets("e")).collect()] == ["a, b", "a", "x]]] y"]
    h = spark.createDataFrame([("<p>x</p><p>y</p><a>z</a>",), ("none",)], "h string")
    assert [r[0] for r in h.select(pattern_count("h", "</p>")).collect()] == [2, 0]


def test_date_parts_are_bigint(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2016-03-01 10:00:00' AS d")
    row = df.select(month_of("d").alias("m"), year_of("d").alias("y")).first()
    assert (row.m, row.y) == (3, 2016)
    assert dict(df.select(month_of("d").alias("m")).dtypes)["m"] == "bigint"


def test_unit_hash_matches_python_and_never_overflows(spark):
    keys = [0, 1, 2, 115, 65535, 65536, 2**32 - 1, 2**32, 2**40 + 7, 2**62, -1, -(2**40)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = [r[0] for r in df.select(unit_hash("k")).collect()]
    assert got == [(k * 2654435761) % 2**32 for k in keys]
    assert hash_fraction_threshold(0.0) == 0 and hash_fraction_threshold(1.0) == 2**32
