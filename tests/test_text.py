import math
import random

from pyspark.sql import functions as F

from acervo.functions import text as tx
from acervo.operators import index as ix


def tokens_of(text, stop):
    """Tokens read off character by character: separators end a token, punctuation is passed over."""
    found, token = [], ""
    for character in text + " ":
        if character in tx.WHITESPACE:
            if token and token not in stop:
                found.append(token)
            token = ""
        elif character not in tx.PUNCTUATION:
            token += character.lower()
    return found


def random_text(rng):
    words = ["Grado", "la", "DOCENCIA", "a.b", "¿Qué", "es?", "x-y", "(uno)", "50%", "él", "ÑANDÚ", "'q'"]
    gaps = [" ", "  ", "\n", "\t\r", " ", " ", "　", "\x1c", "\x0b", "\u0085"]
    return "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 30)))


def test_steps_and_single_scan_agree_with_plain_python(spark):
    rng = random.Random(7)
    texts = [(i, random_text(rng)) for i in range(200)] + [(200, ""), (201, " \n "), (202, "?.!")]
    stop = set(tx.stopwords())
    df = spark.createDataFrame(texts, "doc_id long, text string")
    stepwise = tx.words(
        tx.single_spaced(tx.without_punctuation(tx.spaces_for_split_symbols(F.col("text"))))
    )
    rows = (
        df.withColumn("by_steps", stepwise)
        .withColumn("t5", tx.without_stopwords("by_steps"))
        .withColumn("at_once", tx.index_tokens("text"))
        .withColumn("norm", tx.norm("at_once"))
        .collect()
    )
    for row in rows:
        expected = tokens_of(row["text"], stop)
        assert row["t5"] == expected
        assert row["at_once"] == expected
        squares = sum(expected.count(w) ** 2 for w in set(expected))
        assert row["norm"] == math.sqrt(squares)


def test_single_steps(spark):
    row = (
        spark.createDataFrame([("a\nb\tc\rd",)], "s string")
        .select(
            tx.spaces_for_split_symbols(F.col("s")).alias("t1"),
            tx.without_punctuation(F.lit("<a>.b¿?,;:()[]\"'¡!-/&%")).alias("t2"),
            tx.single_spaced(F.lit("  Una     frase  ")).alias("t3"),
            tx.snippet(F.lit("corto")).alias("short"),
            tx.snippet(F.lit("x" * 300)).alias("long"),
        )
        .first()
    )
    assert row["t1"] == "a b c d"
    assert row["t2"] == "ab-/&%"
    assert row["t3"] == "Una frase"
    assert row["short"] == "corto..."
    assert row["long"] == "x" * 120 + "..."


def test_term_counts_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, "x dos x"), (2, ""), (3, "la")], "doc_id long, text string")
    terms = ix.text_terms(df)
    assert sorted(map(tuple, terms.collect())) == [("dos", 1, 1), ("x", 1, 2)]
    assert "Exchange" not in terms._jdf.queryExecution().executedPlan().toString()


def test_other_stop_list(spark):
    df = spark.createDataFrame([("the la cat",)], "text string")
    english = df.select(tx.index_tokens("text", tx.stopwords("english")).alias("t")).first()["t"]
    none = df.select(tx.index_tokens("text", ()).alias("t")).first()["t"]
    assert english == ["la", "cat"]
    assert none == ["the", "la", "cat"]


def test_posting_lists_come_in_bounded_pieces(spark):
    df = spark.range(1000).select(F.lit("w").alias("term"), F.col("id").alias("doc_id"), F.lit(1).alias("tf"))
    pieces = ix.posting_lists(df, ids_per_list=300).orderBy("list_no").collect()
    assert [len(p["doc_ids"]) for p in pieces] == [300, 300, 300, 100]
    assert [i for p in pieces for i in p["doc_ids"]] == list(range(1000))


def test_dense_ids_follow_the_order(spark):
    urls = [f"u{i % 40:03d}" for i in range(400)] + ["hot"] * 300
    random.Random(1).shuffle(urls)
    rows = ix.with_dense_ids(spark.createDataFrame([(u,) for u in urls], "url string").repartition(7), "url")
    got = sorted((r["doc_id"], r["url"]) for r in rows.collect())
    assert [i for i, _ in got] == list(range(700))
    assert [u for _, u in got] == sorted(urls)
