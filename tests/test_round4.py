"""What findings of the fourth round were about."""

import numpy as np

from veriflume.llm import lm
from veriflume.operators import verify


def test_every_word_is_counted_in_every_table(spark):
    """Words too rare for those that fill the last table once were left out there."""
    words = [(f"{i * 2654435761 % 2**32:08x}", 1 + i % 3) for i in range(90_000)]  # 9 bytes each: over 2^22 bits
    cells = lm.count_cells(spark.createDataFrame(words, "word string, n long"), len(words))
    bits = sum(8 * (len(w) + 1) * n for w, n in words)
    assert [float(c.sum(dtype=np.float64)) for c in cells] == [bits] * lm.HASHED
    assert lm.TABLE_BITS[-1] <= 22 < np.log2(sum(8 * (len(w) + 1) for w, _ in words))


def test_sentences_stay_where_few_quotes_come_to_them(spark):
    """Every token of every sentence was shuffled when Spark could not tell beforehand that few keys are asked for."""
    docs = spark.createDataFrame([("a", ["The reading comprehension test"]), ("b", ["書く漢字を"]), ("c", ["x漢"])], "sha string, sents array<string>")
    quotes = spark.createDataFrame([(1, "ading comprehension tes"), (2, "漢字"), (3, "漢"), (4, "")], "quote_id int, q string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = verify.exact_tier(docs, quotes)
        assert sorted((r.quote_id, r.sha) for r in found.collect()) == [(1, "a"), (2, "b"), (3, "b"), (3, "c")]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set(key, before)
    assert verify.exact_tier(docs, quotes.where("q = ''")).count() == 0
