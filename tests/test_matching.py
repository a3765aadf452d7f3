"""Word matching and pairs by shared runs of words, against difflib and plain loops."""

import difflib
import random

from pyspark.sql import functions as F

from tidewright.functions import text as X
from tidewright.functions.matching import matched


def plain(x, y):
    total = lambda p, q: sum(b.size for b in difflib.SequenceMatcher(None, p, q, autojunk=False).get_matching_blocks())
    return total(x, y), total(y, x)


def some(rnd, kinds, most):
    return [f"w{rnd.randrange(kinds)}" for _ in range(rnd.randrange(most))]


def test_matched_words_are_those_of_difflib():
    """Whether a part's runs are held or looked up by ranks."""
    rnd, differ = random.Random(5), 0
    for _ in range(600):
        kinds = rnd.choice([1, 2, 3, 5, 20])
        x, y = some(rnd, kinds, 40), some(rnd, kinds, 40)
        if x and rnd.random() < 0.4:
            y = list(x)
            for _ in range(3):
                y[rnd.randrange(len(y))] = f"w{rnd.randrange(kinds)}"
        want = plain(x, y)
        differ += want[0] != want[1]
        assert matched(x, y) == matched(x, y, 0) == matched(x, y, 30) == want
    assert differ


def test_long_texts_of_few_words_end():
    """20,000 words of eight: 50 million equal places, which aren't walked one by one."""
    rnd = random.Random(6)
    x, y = ([f"w{rnd.randrange(8)}" for _ in range(20_000)] for _ in range(2))
    one, two = matched(x, y), matched(y, x)
    assert one == two[::-1] and 0 < min(one) < 20_000


def test_pairs_by_shared_runs(spark):
    rnd = random.Random(7)
    data = [(i * 3 - 100, some(rnd, 3, 30)) for i in range(60)] + [(500, None), (501, []), (502, ["a"] * 40), (503, ["a", None] * 9), (504, [None, "a"] * 9), (None, ["a"] * 40), (2**40, ["a"] * 9)]
    least, runs = {}, {i: {tuple(w[k : k + 8]) for k in range(len(w or []) - 7)} for i, w in data if i is not None}
    for i in sorted(runs):
        for r in runs[i]:
            least.setdefault(r, i)
    want = sorted({(least[r], i) for i in runs for r in runs[i] if least[r] != i})
    df = spark.createDataFrame(data, "id long, words array<string>").repartition(3)
    assert sorted(tuple(r) for r in X.shingle_pairs(df, 8).collect()) == want and (502, 2**40) in want and (503, 504) in want
    n = {r["id"]: r["n"] for r in df.filter("id is not null").select("id", F.size(X.shingles(F.col("words"), 8)).alias("n")).collect()}
    assert n == {i: len(r) for i, r in runs.items()}


def test_a_text_with_many_partners_is_dealt_out(spark):
    """Partners of one text are compared in several tasks, equal ones once; every pair is there."""
    rnd = random.Random(8)
    texts = [(0, "a b c d e f g h i j")] + [(i, " ".join(some(rnd, 9, 30)).replace("w", "") + " A b, c d e") for i in range(1, 200)] + [(200, ""), (201, "a b c")]
    pairs = spark.createDataFrame([(0, i) for i in range(1, 202)] + [(200, 201)], "a long, b long")
    got = X.similar(pairs, spark.createDataFrame(texts, "id long, text string"))
    words = {i: X._key(t).split() for i, t in texts}
    want = {}
    for a, b in [(0, i) for i in range(1, 202)] + [(200, 201)]:
        x, y = words[a], words[b]
        want[a, b] = int(2.0 * min(plain(x, y)) / (len(x) + len(y)) * 1000 + 0.5) if x and y else 0
    rows = got.withColumn("task", F.spark_partition_id()).collect()
    assert {(r["a"], r["b"]): r["permille"] for r in rows} == want
    assert len({r["task"] for r in rows if r["a"] == 0}) > 1
