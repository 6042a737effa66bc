import pytest
from pyspark.sql import functions as F

from turnmill.functions import text as T

CASES = [
    "",
    "   ",
    " a\r\n\n\nb ",
    " x　y\u001c",
    "中文ab",
    "a" * 200,
    "a" * 201,
    "İΣ ΑΣ Abc ",
    "\x85tab\tand\x0bmore lines ",
    "".join(chr(c) for c in range(0x20, 0x250)),
]


def estimate(s):
    cjk = sum("一" <= c <= "鿿" for c in s)
    return int(cjk / 1.5 + (len(s) - cjk) / 4)


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(CASES)], "i INT, s STRING")
    s = F.col("s")
    return df.select(
        "i",
        T.strip(s).alias("strip"),
        T.normalise(s).alias("norm"),
        T.clean(s).alias("clean"),
        T.truncate(s).alias("cut"),
        T.token_estimate(s).alias("tokens"),
    ).collect()


def test_matches_python(rows):
    for r in rows:
        s = CASES[r.i]
        assert r.strip == s.strip()
        assert r.norm == s.strip().lower()
        assert r.clean == " ".join(s.split())
        assert r.cut == (s if len(s) <= 200 else s[:197] + "...")
        assert r.tokens == estimate(s)


def test_every_python_space_is_known(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert sorted(T.WHITESPACE) == spaces
    others = [chr(c) for c in range(1, 0x3100) if not chr(c).isspace()]
    df = spark.createDataFrame([(c,) for c in others], "s STRING")
    assert df.filter(T.strip(F.col("s")) != F.col("s")).count() == 0


def test_clean_null(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS s")
    assert df.select(T.clean(F.col("s"))).first()[0] == ""
