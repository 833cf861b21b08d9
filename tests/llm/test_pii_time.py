"""Personal data in long texts without a place to cut: time in proportion, spans and masks as in short ones."""

import time

import pytest
from pyspark.sql import functions as F

from tilework.llm import pii


@pytest.mark.parametrize("unit", ["A1@B.CO ", "1.2.3.4-", "+1 (23) ", "ABCDEFGH", "12345678", "DE89 3704 0044 0532 0130 00 "])
def test_time_grows_no_faster_than_the_text(spark, unit):
    def seconds(n):
        docs = spark.createDataFrame([(1, unit * (n // len(unit)))], "doc_id long, text string")
        began = time.perf_counter()
        pii.digest(docs).collect()
        return time.perf_counter() - began

    seconds(1 << 10)
    assert seconds(1 << 19) < 5 * seconds(1 << 17) + 5


@pytest.mark.parametrize("unit", ["A1@B.CO ", "1.2.3.4-"])
def test_spans_of_a_text_in_one_piece(spark, unit):
    n, length = 3000, len(unit.strip(" -"))
    docs = spark.createDataFrame([(1, unit * n)], "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    row = pii.digest(docs).collect()[0]
    kind = "email" if "@" in unit else "ip"
    assert row["spans"] == ",".join(f"{kind}:{k * len(unit)}:{k * len(unit) + length}" for k in range(n))
    assert pii.redact(docs).collect()[0]["text"] == (f"[{kind.upper()}]" + unit[length:]) * n
