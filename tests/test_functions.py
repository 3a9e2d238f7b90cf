"""Literal cases for the column functions (year, title, genres, parsing)."""

from pyspark.sql import functions as F

from kinora.functions import display, text
from kinora.functions.rounding import round_even, round_half_up
from kinora.functions.stopwords import ENGLISH_STOP_WORDS


def one(spark, expr, *values, schema="a string, b string"):
    rows = [tuple(v) if isinstance(v, tuple) else (v, None) for v in values]
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_release_year(spark):
    assert one(spark, text.release_year("a"), "Toy Story (1995)", "No Year Here", None,
               "Two (1990) Years (2001)") == [1995, 0, 0, 1990]


def test_year_with_fallback(spark):
    got = one(spark, text.year_with_fallback("a", "b"), ("Toy Story (1995)", None),
              ("GoldenEye (1995)", "01-Jan-1995"), ("Star Wars (1977)", ""),
              ("Untitled", "15-Aug-1980"), ("No Year Here", None))
    assert got == [1995, 1995, 1977, 1980, 0]


def test_clean_title(spark):
    assert one(spark, text.clean_title("a"), "  Toy Story (1995)  ", "", None, " X\t") == [
        "Toy Story (1995)", "", "Untitled", "X"]


def test_feature_text(spark):
    df = spark.createDataFrame([("Toy Story (1995)", "Adventure|Sci-Fi", 1995)], "t string, g string, y int")
    assert df.select(text.feature_text("t", "g", "y")).first()[0] == (
        "toy story adventure sci fi adventure sci fi 1995")


def test_parse_title(spark):
    df = spark.createDataFrame([("Usual Suspects, The (1995)",), ("Seven (Se7en) (1995)",),
                                ("Femme, L' (a.k.a. The Woman) (1990)",), ("Plain",)], "t string")
    rows = df.select(text.parse_title("t").alias("p")).collect()
    assert rows[0].p.year == 1995 and rows[0].p.candidates[0] == "The Usual Suspects"
    assert rows[0].p.candidates == ["The Usual Suspects", "Usual Suspects, The"]
    assert rows[1].p.candidates == ["Seven", "Se7en"]
    assert rows[2].p.candidates == ["L'Femme", "Femme, L'", "The Woman"]
    assert rows[3].p.year is None and rows[3].p.candidates == ["Plain"]


def test_normalise_and_dates(spark):
    assert one(spark, text.normalise_name("a"), "The Usual-Suspects!", None) == ["theusualsuspects", ""]
    assert one(spark, text.year_from_date("a"), "1995-07-19", "19x5-01-01", "", None) == [1995, None, None, None]
    got = one(spark, text.compose_title("a", "b"), ("Dil, Se", "1998-08-21"), ("Lagaan", ""))
    assert got == ["Dil Se (1998)", "Lagaan"]


def test_display(spark):
    assert one(spark, text.display_title("a"), "Usual Suspects, The (1995)",
               "Bourne Identity, The (Identity) (2002)", "Heat (1995)") == [
        "The Usual Suspects", "The Bourne Identity (Identity)", "Heat"]
    df = spark.createDataFrame([(0.876, 3.25, 135, 0, "X (1999)"), (0.0, 0.0, None, 2001, "Y")],
                               "s double, r double, m int, y int, t string")
    out = df.select(display.match_percent("s"), display.rating_text("r"), display.runtime_text("m"),
                    display.year_display("y", "t")).collect()
    assert tuple(out[0]) == (88, "3.3", "2h 15m", 1999)
    assert tuple(out[1]) == (0, "N/A", None, 2001)


def test_rounding(spark):
    df = spark.createDataFrame([(0.285,), (2.5,), (3.5,), (0.125,)], "x double")
    ev = [r[0] for r in df.select(round_even(F.col("x"), 0)).collect()]
    assert ev == [0.0, 2.0, 4.0, 0.0]
    # ties are decided on the binary value: 0.285 is 0.28499999..., 0.125 is exact
    hu = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert hu[0] == 0.28 and hu[3] == 0.13
    assert [r[0] for r in df.select(round_even(F.col("x"), 2)).collect()][3] == 0.12


def test_stop_words():
    assert len(ENGLISH_STOP_WORDS) == 318 and "the" in ENGLISH_STOP_WORDS and "movie" not in ENGLISH_STOP_WORDS
