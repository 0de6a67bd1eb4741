"""Training by one schedule, whatever the size."""

from pyspark import SparkContext

from ledgerloom.llm import lm


def test_training_rounds_are_the_same_at_any_size(spark, monkeypatch):
    seen, real = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: seen.append(value) or real(self, value))
    rates = []
    for docs, words in ((60, 8), (400, 3000)):
        seen.clear()
        rows = [(i, " ".join(f"river mill w{(i * k) % 50}" for k in range(words // 3 + 1))) for i in range(docs)]
        assert lm.score(spark.createDataFrame(rows, "doc_id long, text string")).count() == docs
        rates.append([x[3] for x in seen if isinstance(x, tuple) and len(x) == 4])
    assert rates[0] == rates[1] and rates[0]
