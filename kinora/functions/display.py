"""Display-side formatting as column expressions (card / detail views)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinora.functions.text import display_title, end_year

# FIXED VALUES: separators and placeholders of the views.
GENRE_SEPARATOR = " • "      # ' • '
LIST_SEPARATOR = ", "
MISSING = "N/A"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def genres_display(genres) -> Column:
    return F.array_join(F.split(F.coalesce(_c(genres), F.lit("")), r"\|"), GENRE_SEPARATOR)


def match_percent(score) -> Column:
    """Math.round(score * 100)."""
    return F.floor(_c(score) * 100 + 0.5).cast("int")


# FIXED VALUE: where the service hands out images.
IMAGE_ROUTE = "/api/media/image"


def image_path(size: str, path: str) -> Column:
    """Where an image of this size is served, null without one."""
    return F.when(F.coalesce(F.col(path), F.lit("")) != "", F.concat(F.lit(f"{IMAGE_ROUTE}/{size}/"), F.ltrim(F.col(path), F.lit("/"))))


def runtime_text(minutes) -> Column:
    m = _c(minutes)
    return F.when(m.isNotNull() & (m != 0),
                  F.concat(F.floor(m / 60).cast("string"), F.lit("h "), (m % 60).cast("string"), F.lit("m")))


def year_display(year, title) -> Column:
    return F.coalesce(F.when(_c(year) != 0, _c(year)), end_year(title))


def rating_text(avg, decimals: int = 1) -> Column:
    """'N/A' when 0/NULL, else the value with ``decimals`` decimals (half up)."""
    scale = float(10 ** decimals)
    rounded = F.floor(_c(avg) * scale + 0.5) / scale
    return F.when(F.coalesce(_c(avg), F.lit(0.0)) == 0, F.lit(MISSING)).otherwise(
        F.format_string(f"%.{decimals}f", rounded))


def card(df, score_col: str = "similarity_score") -> list[Column]:
    return [display_title("title").alias("display_title"),
            genres_display("genres").alias("genres_display"),
            match_percent(score_col).alias("match_pct"),
            rating_text("avg_rating").alias("rating_text"),
            year_display("release_year", "title").alias("year_display")]
