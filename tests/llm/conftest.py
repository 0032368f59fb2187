import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t ", "word", "12 34", "É ö ñ", "a", "<|endoftext|> x"]


def documents(spark, texts, **more):
    """Documents numbered from 0; ``more`` holds columns by name, as lists."""
    rows = [(i, t, (more.get("lang") or {}).get(i, "en"), (more.get("source") or {}).get(i, f"s{i % 3}"), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def odd(spark):
    """Null, empty, very long and repeated texts, null ids, languages and sources, and columns of clashing names."""
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", 0) for i, t in enumerate([*ODD, *ODD, "long words. " * 20_000, "same text here"])]
    rows += [(None, "no id at all", None, None, 0), (None, "no id at all", None, None, 0), (3, "word", "en", "s", 4), (3, "word", "en", "s", 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    for clash in ("score", "key", "size", "shard", "block", "part", "fp", "n", "lang_pred", "held_out", "sha", "taken", "list", "a"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
