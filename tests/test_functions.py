"""Goldens for the column functions (inputs taken from the reference's own smoke samples)."""
from pyspark.sql import functions as F

from critiq.functions import (clean_text, contradicts, impute_rating, is_meaningless, iso_date,
                              normalize_text, parse_rating, summary_line, week_end)
from critiq.operators.classify import classify_frame
from critiq.operators.validate import reliability


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_normalize_goldens(spark):
    texts = [
        "Coupon SAVE50 failed during checkout. (order #409153)",
        "COUPON SAVE50 failed during checkout. - my sushi order in Bangalore",
        "Coupon SAVE50 failed during checkout. Agent Priya was handling it.!!!!",
        "Items were missing from my delivery, got only half the order (order #133795) "
        "This is the third time.",
        "Thank you to the agent Priya who handled my complaint so well (order #12)",
        None,
        "   ",
    ]
    got = one_col(spark, texts, lambda c: normalize_text(clean_text(c)))
    assert got[:3] == ["coupon save50 failed during checkout."] * 3
    assert got[3] == "items were missing from my delivery, got only half the order"
    assert got[4] == ")"          # step 2 eats the opening bracket first
    assert got[5] == "" and got[6] == ""


def test_meaningless(spark):
    yes = [None, "", "  ", "meh", "ok i guess", "????!!", "aaaaaaa", "\U0001F621" * 4, "Привет мир"]
    no = ["okay", "test", "a1 b", "Please add vegan restaurants"]
    assert all(one_col(spark, yes, is_meaningless))
    assert not any(one_col(spark, no, is_meaningless))


def test_clean_text_python_whitespace(spark):
    got = one_col(spark, ["  a \t\x0b b　", None], clean_text)
    assert got == ["a b", ""]


def test_dates(spark):
    vals = ["05/01/2024", "28/02/2024", "31/04/2024", "2024-13-45", "13/13/2024",
            "2024-03-25 16:31:48", "March 18, 2024", "Jan 18 2024", "02-Feb-24", "2024-03-25",
            ' "2024-03-25" ', "not a date", "", None, "2024-03-25T23:30:00+05:30",
            "Monday, 5 February 2024", "20240105", "5.2.2024"]
    got = one_col(spark, vals, iso_date)
    assert got == ["2024-05-01", "2024-02-28", None, None, None, "2024-03-25", "2024-03-18",
                   "2024-01-18", "2024-02-02", "2024-03-25", "2024-03-25", None, None, None,
                   "2024-03-25", "2024-02-05", "2024-01-05", "2024-02-05"]


def test_ratings(spark):
    assert one_col(spark, ["5", " 4.0 ", "five", None, "1e0", "5d", "inf"], parse_rating) == \
        [5.0, 4.0, None, None, 1.0, None, None]
    df = spark.createDataFrame([(None, "App crashed"), (None, "love it"), (None, "meh text"),
                                ("2", "love it")], "r string, t string")
    got = [r[0] for r in df.select(impute_rating(F.col("r"), F.col("t"))).collect()]
    assert got == [1.0, 5.0, 3.0, 2.0]


def test_contradiction(spark):
    df = spark.createDataFrame([("5", "Crashed again"), ("5", "crash but love it"),
                                ("1", "Priya solved it"), ("x", "crash"), (None, "crash")],
                               "r string, t string")
    assert [r[0] for r in df.select(contradicts(F.col("r"), F.col("t"))).collect()] == \
        [True, False, True, False, False]


def test_classifier_goldens(spark):
    cases = [
        ("Driver was rude and threw the bag on the floor", "1", "Negative", "Delivery", 0.85),
        ("Refund hasn't arrived after 10 days, charging me twice!", "5", "Negative", "Billing", 0.45),
        ("App crashed on loading screen", "2", "Negative", "App Bug", 0.85),
        ("Priya solved my issue quickly", "5", "Positive", "Staff/Support", 0.70),
        ("Mera refund abhi tak nahi aaya, bahut bura service hai", "1", "Negative", "Billing", 0.85),
        ("Random question, who designed your logo", None, "Neutral", "Other", 0.75),
    ]
    df = spark.createDataFrame([(i, t, r) for i, (t, r, *_) in enumerate(cases)],
                               "i int, t string, r string")
    got = classify_frame(df, "t", "r", "c").orderBy("i").select("c.*").collect()
    for row, (_, _, sent, cat, conf) in zip(got, cases):
        assert (row.sentiment, row.category, row.confidence) == (sent, cat, conf)
    assert got[2].summary == "App crashed on loading screen"


def test_summary(spark):
    long = "the delivery was late and the food was cold and the driver was rude to me at the door"
    got = one_col(spark, ["app crashed", "food arrived cold", long], summary_line)
    assert got[0] == "app crashed"            # nothing left after the stock phrase
    assert got[1] == "Food arrived cold"
    assert got[2] == ("T" + long[1:57] + "...") and len(got[2]) == 60


def test_reliability_grid(spark):
    grid = [(80, 0.85, "High"), (79, 0.85, "Medium"), (80, 0.849, "Medium"), (60, 0.70, "Medium"),
            (59, 0.99, "Limited by Source Data Quality"),
            (100, 0.699, "Limited by Source Data Quality")]
    df = spark.createDataFrame([(h, c) for h, c, _ in grid], "h int, c double")
    got = [r[0] for r in df.select(reliability(F.col("h"), F.col("c"))).collect()]
    assert got == [g for *_, g in grid]


def test_week_end_is_sunday(spark):
    df = spark.range(0, 91).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    rows = df.select("d", week_end(F.col("d")).alias("w")).collect()
    for r in rows:
        assert r.w.weekday() == 6 and 0 <= (r.w - r.d).days <= 6
