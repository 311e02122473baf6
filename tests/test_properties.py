"""Property tests (hypothesis): split hash and split rules against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.functions import java_space_split, split_keep_empty, unit_hash

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _java_split_space(s: str) -> list[str]:
    """java.util.regex.Pattern.compile(" ").split(s): limit 0 drops trailing empties;
    an input with no match is returned whole."""
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(st.integers(min_value=-(2**63), max_value=2**63 - 1), min_size=1, max_size=50))
def test_unit_hash_matches_big_integer_arithmetic(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = [r[0] for r in df.select(unit_hash("k")).collect()]
    assert got == [(k * 2654435761) % 2**32 for k in keys]


@SETTINGS
@given(st.lists(st.text(alphabet="ab ", max_size=8), min_size=1, max_size=30))
def test_split_rules_match_python_and_java(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    rows = df.select(split_keep_empty("line", " ").alias("py"), java_space_split("line").alias("java")).collect()
    assert [r.py for r in rows] == [x.split(" ") for x in lines]
    assert [r.java for r in rows] == [_java_split_space(x) for x in lines]


@SETTINGS
@given(st.lists(st.text(alphabet=st.sampled_from(list("aZé_9 \t\n.,!İß")), max_size=12), min_size=1, max_size=20))
def test_tokenisers_match_pyspark_ml_on_random_text(spark, texts):
    from pyspark.ml.feature import RegexTokenizer, Tokenizer

    from quarry.functions import regex_tokens, whitespace_tokens

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    ml_ws = Tokenizer(inputCol="text", outputCol="t").transform(df).orderBy("id").select("t").collect()
    ml_rx = RegexTokenizer(inputCol="text", outputCol="t", pattern="\\W").transform(df).orderBy("id").select("t").collect()
    ours = df.orderBy("id").select(whitespace_tokens("text").alias("w"), regex_tokens("text").alias("r")).collect()
    assert [r.w for r in ours] == [r.t for r in ml_ws]
    assert [r.r for r in ours] == [r.t for r in ml_rx]
