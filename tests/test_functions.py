"""Golden rows of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlytics.functions import categories, dates, frames, numbers, odds, sentiment, text


def apply(spark, fn, inputs, kind="string"):
    rows = [(i, x) for i, x in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[1] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "fn, inputs, expected",
    [
        (dates.parse_date, ["2024-04-13", "x 2024-04-13 y", "April 13, 2024", "Apr 3, 2024", "Foo 3, 2024", "", None],
         [dt.date(2024, 4, 13)] * 3 + [dt.date(2024, 4, 3), None, None, None]),
        (dates.parse_date, ["2024-13-45", "May 3, 2024", "Sep 03, 2020"],
         [None, dt.date(2024, 5, 3), dt.date(2020, 9, 3)]),
        (dates.parse_page_date, ["April 13, 2024[1]", "13 April 2024", "2024-04-13", "soon"],
         [dt.date(2024, 4, 13)] * 3 + [None]),
        (dates.parse_birth_date, ["Jul 03, 1983", "Jul 3, 1983", "--", "", None],
         [dt.date(1983, 7, 3)] * 2 + [None] * 3),
        (categories.event_type, ["UFC 300: x", "UFC Fight Night: x", "TUF 1", "Contender x", "UFC on ESPN"],
         ["PPV", "Fight Night", "TUF", "DWCS", "Other"]),
        (categories.base_event_type,
         ["UFC Ultimate Fight Night", "The Ultimate Fighter 5", "UFC on FOX 9", "UFC 12", "Noche!"],
         ["ufc fight night", "the ultimate fighter", "ufc on fox", "ufc", "noche"]),
        (categories.country, ["Las Vegas, Nevada, USA", "London, England", "Toronto, Ontario, Canada", "Berlin"],
         ["USA", "UK", "Canada", None]),
        (categories.city, ["Las Vegas, Nevada, USA", "Berlin"], ["Las Vegas", "Berlin"]),
        (categories.method_category, ["KO/TKO", "Submission", "Decision - Split", "DQ"],
         ["KO/TKO", "Submission", "Decision", "Other"]),
        (categories.bare_class, ["UFC Lightweight Title Bout", "Welterweight Bout"], ["Lightweight", "Welterweight"]),
        (categories.is_title, ["UFC Lightweight Title Bout", "Welterweight Bout"], [True, False]),
        (lambda c: text.id_from_url(c, "event"), ["http://h/event-details/ab1", "http://h/event/ab1", "zzz"],
         ["ab1", "ab1", "zzz"]),
        (numbers.height_inches, ["5' 11\"", "6'", "--"], [71, 72, None]),
        (numbers.leading_int, ["155 lbs.", "72\"", "--", None], [155, 72, None, None]),
        (numbers.record_wins, ["10-2-1", "10-2", ""], [10, 10, None]),
        (numbers.record_losses, ["10-2-1", "10-2", ""], [2, 2, None]),
        (numbers.record_draws, ["10-2-1", "10-2", ""], [1, 0, 0]),
        (text.side_one, ["A vs. B", "A vs B", "A vs. B vs. C", "alone"], ["A", "A", "A", ""]),
        (text.side_two, ["A vs. B", "A vs B", "A vs. B vs. C", "alone"], ["B", "B", "B vs. C", ""]),
        (numbers.landed, ["19 of 32", "0 of 0", "---"], [19, 0, None]),
        (numbers.attempted, ["19 of 32", "0 of 0", "---"], [32, 0, None]),
        (numbers.number, ["2.0", "3", "", "x", None], [2, 3, None, None, None]),
        (text.normalize_name, ["José Aldo-Jr."], ["josaldojr"]),
        (numbers.parse_count, ["~15,128[3]", "99", ",", None], [15128, 99, None, None]),
        (lambda c: numbers.parse_count(c, strict=True), ["99", "100"], [None, 100]),
        (numbers.parse_money, ["$1.5 million", "$2,200,100", "US$ 3", "none"], [1.5e6, 2200100.0, 3.0, None]),
        (numbers.largest_number, ["12,000 / 9,500 (1990)", "none", ",,"], [12000, None, None]),
        (text.contest_number, ["UFC 300: x", "UFC on ESPN"], ["300", ""]),
        (text.strip_label, ["Method: KO", "Time:4:51", "plain"], ["KO", "4:51", "plain"]),
        (text.name_to_url, [" UFC 1: A "], ["https://en.wikipedia.org/wiki/UFC_1%3A_A"]),
        (text.url_to_title, ["/events/ufc-300-x"], ["Ufc 300 X"]),
        (odds.parse_line, ["+150", "-200", "EV", ""], [150, -200, 0, 0]),
    ],
)
def test_text(spark, fn, inputs, expected):
    assert apply(spark, fn, inputs) == expected


def test_numeric(spark):
    assert apply(spark, categories.sentiment_category, [-1.0, -0.2, 0.2, 0.21], "double") == [
        None, "Negative", "Neutral", "Positive"
    ]
    assert apply(spark, odds.implied_probability, [-150, 200, 0], "int") == pytest.approx([0.6, 1 / 3, 0.5])
    assert apply(spark, odds.american_to_decimal, [-150, 200, 0], "int")[:2] == pytest.approx([5 / 3, 3.0])
    assert apply(spark, odds.decimal_to_probability, [2.0, 0.0], "double") == [0.5, 0.0]
    assert apply(spark, categories.stability_class, [0.05, 0.15, 0.3], "double") == ["stable", "moderate", "unstable"]


def test_odds_flags(spark):
    rows = [(0.55, 0.50, 60), (0.75, 0.30, -10)]
    schema = "fighter1_implied_prob double, fighter2_implied_prob double, line_movement_f1 int"
    out = odds.odds_features(spark.createDataFrame(rows, schema)).collect()
    assert [(r.is_competitive_matchup, r.has_heavy_favorite, r.big_line_movement) for r in out] == [(1, 0, 1), (0, 1, 0)]


def test_lexicon(spark):
    rows = [(0, "hype boring"), (1, ""), (2, "hype"), (3, None), (4, "nothing here at all")]
    out = sentiment.score_texts(spark.createDataFrame(rows, "i int, t string"), "t").orderBy("i").collect()
    assert [r.polarity for r in out] == [0.0, 0.0, 1.0, 0.0, 0.0]
    assert [r.subjectivity for r in out] == [1.0, 0.5, 1.0, 0.5, 0.0]


def test_frames(spark):
    df = spark.createDataFrame([(1, 2, None, 4)], "a int, b int, c int, `sig.str.` int")
    assert frames.move_columns(df, ["c"], "a", "before").columns == ["c", "a", "b", "sig.str."]
    assert frames.move_columns(df, ["a"], "b", "after").columns == ["b", "a", "c", "sig.str."]
    assert frames.find_column(df, "sig", "str") == "sig.str."
    assert frames.fill(df.drop("sig.str."), {"c": 7, "z": 1}).first().c == 7
    assert frames.pick_features(df, ["a", "z", "b"]) == (["a", "b"], ["z"])
    out, made = frames.interactions(df, {"ab": ("a", "b"), "az": ("a", "z")})
    assert made == ["ab"] and out.first().ab == 2
    two = frames.two_sided(df, "b", "c", "total", "gap", missing=0).first()
    assert (two.total, two.gap) == (2, 2)
    assert frames.safe_names(df.withColumnRenamed("c", "TD %")).columns == ["a", "b", "td_pct", "sig_str"]


def test_phrases_by_one_pattern(spark):
    """Overlaps, phrases within and at the start of others, and long lists, against plain substring tests."""
    import random
    import re

    rng = random.Random(1)
    many = ["".join(rng.choice("abc. (*\\é") for _ in range(rng.randint(1, 6))) for _ in range(5000)]
    lists = [["ab", "abc", "bca", "a", "c.", "zz", "abcab"], ["(", "\\", "*"], [""], [], list(sentiment.POSITIVE), many]
    texts = ["", "abcabc", "c(.*\\", "aab\nca", None, *["".join(rng.choice("abc. (*\\é\n") for _ in range(n)) for n in (5, 40, 300, 4000)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for phrases in lists:
        got = dict(df.select("i", F.size(sentiment.phrases_found(F.col("t"), phrases))).collect())
        for i, text in enumerate(texts):
            if text is not None:
                assert got[i] == sum(p in text for p in set(phrases))
    hits = df.select("i", sentiment.phrase_hits(F.col("t"), many[:300])).collect()
    assert [h for _, h in hits if h is not None] == [sum(p in t for p in set(many[:300])) for t in texts if t is not None]
    assert re.fullmatch(sentiment.trie_pattern(["go", "gone"]), "gone") and not re.fullmatch(sentiment.trie_pattern(["go", "gone"]), "gon")
