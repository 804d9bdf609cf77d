import re
from decimal import Decimal

from conftest import SF_SMALL

from courtview.operators.sentiment import label_counts, score_comments, video_sentiment
from courtview.params import FIXTURE_LEXICON
from courtview.sources import bindings as B


def py_score(text, lex):
    if text is None:
        return Decimal(0)
    words = set(re.split(r"[^a-z']+", text.lower()))
    return sum((lex[w] for w in words if w in lex), Decimal(0))


def test_scores_match_plain_python(spark):
    lex = {w: Decimal(v) for w, v in FIXTURE_LEXICON}
    comments = B.content_comments(spark, SF_SMALL)
    got = {(r.video_id, r.comment_id): r.sentiment_score
           for r in score_comments(comments, B.fixture_lexicon(spark)).collect()}
    want = {(r.video_id, r.comment_id): py_score(r.comment_text, lex) for r in comments.collect()}
    assert got == want


def test_repeated_words_count_once(spark):
    c = spark.createDataFrame([("v", "1", "with with WITH, the-the"), ("v", "2", "nothing here"), ("w", "3", None)],
                              "video_id string, comment_id string, comment_text string")
    lex = spark.createDataFrame([("with", Decimal("1")), ("the", Decimal("0.25")), ("the", Decimal("0.05"))],
                                "word string, value decimal(9,4)")
    rows = {r.comment_id: (r.sentiment_score, r.sentiment_label) for r in score_comments(c, lex).collect()}
    assert rows["1"] == (Decimal("1.3000"), "Positive")   # duplicate lexicon words add up
    assert rows["2"] == (Decimal("0.0000"), "Neutral")
    assert rows["3"] == (Decimal("0.0000"), "Neutral")
    summary = {r.video_id: r for r in video_sentiment(c, lex).collect()}
    assert summary["v"].comments_pulled == 2 and summary["v"].positive_comment_pct == 0.5
    assert summary["w"].neutral_comment_pct == 1.0


def test_rollup_equals_comment_level(spark):
    comments = B.content_comments(spark, SF_SMALL)
    lex = B.fixture_lexicon(spark)
    scored = score_comments(comments, lex).collect()
    per = {}
    for r in scored:
        per.setdefault(r.video_id, []).append(r)
    for r in video_sentiment(comments, lex).collect():
        rows = per[r.video_id]
        n = len(rows)
        assert r.comments_pulled == n
        assert r.avg_comment_sentiment == float(sum(x.sentiment_score for x in rows)) / n
        assert abs(r.positive_comment_pct + r.neutral_comment_pct + r.negative_comment_pct - 1) < 1e-12
        assert r.negative_comment_pct == sum(x.sentiment_label == "Negative" for x in rows) / n
    assert sum(r.n for r in label_counts(score_comments(comments, lex)).collect()) == len(scored)


def test_hot_video_rollup_is_exact_and_partial(spark):
    import random
    rnd = random.Random(5)
    words = ["with", "was", "the", "of", "zz", "it", "on", "la"]
    rows = [("hot", f"h{i}", " ".join(rnd.choices(words, k=6))) for i in range(3000)]
    rows += [(f"v{i % 100}", f"c{i}", " ".join(rnd.choices(words, k=6))) for i in range(6000)]
    comments = spark.createDataFrame(rows, "video_id string, comment_id string, comment_text string").repartition(8)
    lex = B.fixture_lexicon(spark)
    lexd = {w: Decimal(v) for w, v in FIXTURE_LEXICON}
    got = {r.video_id: r for r in video_sentiment(comments, lex).collect()}
    per = {}
    for v, _, t in rows:
        per.setdefault(v, []).append(py_score(t, lexd))
    for v, scores in per.items():
        r = got[v]
        assert r.comments_pulled == len(scores)
        assert r.avg_comment_sentiment == float(sum(scores)) / len(scores)
        assert r.positive_comment_pct == sum(s > Decimal("0.15") for s in scores) / len(scores)
    plan = video_sentiment(comments, lex)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_") >= 2   # map-side combine before the exchanges


def test_missing_and_repeated_comment_ids_keep_their_own_scores(spark):
    c = spark.createDataFrame([("v", None, "good"), ("v", None, "good"), ("v", "x", "good"), ("v", "x", "bad"), (None, None, "bad")],
                              "video_id string, comment_id string, comment_text string")
    lex = spark.createDataFrame([("good", Decimal("0.75")), ("bad", Decimal("-0.75"))], "word string, value decimal(9,4)")
    got = sorted((r.comment_text, r.sentiment_label) for r in score_comments(c, lex).collect())
    assert got == [("bad", "Negative")] * 2 + [("good", "Positive")] * 3
    by_video = {r.video_id: r for r in video_sentiment(c, lex).collect()}
    assert by_video["v"].positive_comment_pct == 0.75 and by_video["v"].negative_comment_pct == 0.25
    assert by_video[None].negative_comment_pct == 1.0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lexicon_of(spark, words):
    return spark.createDataFrame([(w, Decimal(v)) for w, v in words], "word string, value decimal(9,4)")


def test_scoring_needs_no_exchange_and_no_copy(spark, monkeypatch):
    from courtview.operators import sentiment
    from courtview.registry import query_table

    def refuse(*_):
        raise AssertionError("scoring must not write")

    monkeypatch.setattr(sentiment, "materialize", refuse)
    for key in ("sent_score", "sent_label"):
        plan = plan_of(query_table()[key](spark, SF_SMALL))
        assert "Exchange" not in plan and "Join" not in plan, plan
    assert plan_of(query_table()["sent_rollup"](spark, SF_SMALL)).count("Exchange") == 1


def test_inline_and_joined_lexicon_agree(spark, monkeypatch):
    """Null and repeated ids, null and empty texts, duplicate words, quotes, words of other scripts, an empty lexicon."""
    import random
    from collections import Counter

    from courtview.operators import sentiment
    rnd = random.Random(9)
    words = [(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}", str(rnd.randint(-9999, 9999) / 10_000)) for i in range(600)] + [("can't", "0.5"), ("the", "0.1"), ("the", "0.1"), ("it", "0")]
    rows = [(rnd.choice(["v", "u", None]), rnd.choice(["1", "2", None]), " ".join(rnd.choice(words)[0].upper() + rnd.choice([" ", "\n", "--", "é"]) for _ in range(rnd.randint(0, 30)))) for _ in range(300)]
    rows += [("v", "1", None), ("v", "1", ""), (None, None, None), ("v", "9", "can't CAN'T the"), ("v", "8", "the " * 100_000)]
    comments = spark.createDataFrame(rows, "video_id string, comment_id string, comment_text string").repartition(3)
    for lex in (lexicon_of(spark, words), lexicon_of(spark, [])):
        values = Counter()
        for r in lex.collect():
            values[r.word] += r.value
        got = score_comments(comments, lex).collect()
        want = Counter((v, c, t, py_score(t, values)) for v, c, t in rows)
        assert Counter((r.video_id, r.comment_id, r.comment_text, r.sentiment_score) for r in got) == want
        summary = Counter(tuple(r) for r in video_sentiment(comments, lex).collect())
        with monkeypatch.context() as m:
            m.setattr(sentiment, "inline_lexicon", lambda *_: None)  # as for a lexicon beyond the bound
            joined = score_comments(comments, lex).collect()
            assert Counter(tuple(r) for r in joined) == Counter(tuple(r) for r in got)
            assert Counter(tuple(r) for r in video_sentiment(comments, lex).collect()) == summary


def test_lexicon_beyond_the_bound_is_not_inlined(spark):
    from courtview.operators.sentiment import inline_lexicon
    lex = lexicon_of(spark, [(f"w{i}", "0.5") for i in range(50)])
    assert inline_lexicon(lex, max_rows=50) is not None
    assert inline_lexicon(lex, max_rows=49) is None and inline_lexicon(lex, max_bytes=100) is None


def test_heavy_words_are_salted(spark, monkeypatch):
    """One word in every comment, no broadcast of the lexicon: no task gets twice the median."""
    import random
    from statistics import median

    from pyspark.sql import functions as F

    from courtview.operators import sentiment
    from courtview.operators.skew import salted_join
    rnd = random.Random(2)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(4000)]
    rows = [(i, " ".join(["the", "and", *rnd.choices(vocab, k=6)])) for i in range(8000)]
    comments = spark.createDataFrame(rows, "comment_id long, comment_text string").repartition(6)
    lex = lexicon_of(spark, [(w, "0.25") for w in {*vocab, "the", "and"}])
    toks = comments.select("comment_id", F.explode(sentiment.tokens(F.col("comment_text"))).alias("word"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def tasks(joined):
            return [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]

        plain, salted = toks.join(sentiment.word_units(lex), "word"), salted_join(toks, sentiment.word_units(lex), "word", F.col("comment_id"))
        assert sum(tasks(plain)) == sum(tasks(salted))
        assert max(tasks(plain)) > 2 * median(tasks(plain))
        assert max(tasks(salted)) < 2 * median(tasks(salted))
        monkeypatch.setattr(sentiment, "fits", lambda *_: False)  # beyond both bounds
        want = {i: py_score(t, {w: Decimal("0.25") for w in {*vocab, "the", "and"}}) for i, t in rows}
        got = sentiment.score_comments(comments, lex)
        assert {r.comment_id: r.sentiment_score for r in got.collect()} == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
