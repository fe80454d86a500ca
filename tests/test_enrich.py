from parley.operators import enrich, evaluate


def _one(spark, text):
    df = spark.createDataFrame([("f", "n", text)], "parent_folder string, filename string, transcription_text string")
    return df


def test_sentiment_whole_words_and_labels(spark):
    rows = [("No, not good. Great!",), ("nothing notable; goodness",), ("PROBLÈME: non, non.",),
            ("thanks thanks thanks, bad",), ("",)]
    df = spark.createDataFrame(rows, "transcription_text string")
    got = [(r.pos_hits, r.neg_hits, r.sentiment) for r in
           enrich.with_sentiment(df, keep_scores=True).collect()]
    assert got[0] == (3, 2, "mixed")           # good 1 + great 2 vs no + not
    assert got[1] == (0, 0, "neutral")         # substrings never count
    assert got[2] == (0, 3, "negative")        # accents and upper case
    assert got[3] == (3, 1, "positive")        # 3 >= 2*1: not mixed
    assert got[4] == (0, 0, "neutral")


def test_summary_topics_speakers_tone(spark):
    text = ("My name is Alice. Alpha alpha beta! This is Bob calling about alpha? "
            "Gamma delta. Alpha beta beta?")
    g = enrich.enrich(_one(spark, text), "2024-01-01 00:00:00").head()
    # sentences: 0 'My name is Alice.' 1 'Alpha alpha beta!' 2 'This is Bob calling about alpha?'
    #            3 'Gamma delta.' 4 'Alpha beta beta?'   (content words: >= 4 letters)
    # tf: alpha 4, beta 3, name/alice/this/calling/about/gamma/delta 1
    # scores: 0: name+alice=2, 1: 4+4+3=11, 2: this+calling+about+alpha=7, 3: 2, 4: 4+3+3=10
    assert g.summary == "Alpha alpha beta! Alpha beta beta?"
    assert g.conversation_summary == "Alpha alpha beta!"
    assert g.main_topics == "alpha, beta, about"
    assert (g.speaker_1, g.speaker_2) == ("Alice", "Bob")
    assert g.conversation_tone == "casual" and g.sentiment == "neutral"


def test_defaults_without_names_and_empty_text(spark):
    df = spark.createDataFrame([("a", "b", "Hmm?? Yes? ok?"), ("c", "d", "..."), ("e", "f", None)],
                               "parent_folder string, filename string, transcription_text string")
    rows = {r.parent_folder: r for r in enrich.enrich(df, "2024-01-01 00:00:00").collect()}
    assert set(rows) == {"a", "c"}                              # NULL text is filtered out
    assert (rows["a"].speaker_1, rows["a"].speaker_2) == ("Speaker 1", "Speaker 2")
    assert rows["a"].conversation_tone == "friendly"            # 'yes' is positive
    assert rows["c"].summary is None and rows["c"].main_topics == ""


def test_scorers(spark):
    df = spark.createDataFrame([("f", "n", "alpha, beta", "Alpha only here."),
                                ("g", "n", "", "you idiot"),
                                ("h", "n", "x, y, z", None)],
                               "parent_folder string, filename string, main_topics string, summary string")
    s = {(r.parent_folder, r.scorer): (r.score, r.passed) for r in evaluate.score(df).collect()}
    assert s[("f", "captures_main_topics")] == (0.5, True)
    assert s[("g", "captures_main_topics")] == (0.0, False)
    assert s[("g", "safety")] == (0.0, False) and s[("f", "safety")] == (1.0, True)
    assert s[("h", "captures_main_topics")] == (0.0, False)
    m = {r.scorer: r for r in evaluate.metrics(evaluate.score(df)).collect()}
    assert m["safety"].n_records == 3 and m["safety"].n_passed == 2


def test_filter_on_enriched_columns_runs_python_once(spark):
    from pyspark.sql import functions as F
    g = enrich.enrich(_one(spark, "Hello there. General words here."), "2024-01-01 00:00:00")
    flt = g.filter(F.col("summary").isNotNull() & (F.col("main_topics") != ""))
    plan = flt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert flt.count() == 1
