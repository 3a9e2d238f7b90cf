"""Read-side data products over the four serving tables.

Single-request lookups of the reference are re-aimed as batch operators over a
*request table*, so the core is a join, not one job per key.  Page / top-N
reads use ``orderBy().offset().limit()`` which plans as TakeOrderedAndProject:
each partition keeps only its best rows, nothing is globally sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinora.operators.ranking import global_top_n

# FIXED VALUES: request bounds and defaults of the serving API.
PAGE_SIZE_DEFAULT, PAGE_SIZE_MAX = 20, 100
SEARCH_LIMIT_DEFAULT, SEARCH_LIMIT_MAX = 20, 50
POPULAR_LIMIT_DEFAULT, POPULAR_LIMIT_MAX = 20, 50
TOP_K_DEFAULT, TOP_K_MAX = 10, 100
SIMILAR_LIMIT_DEFAULT, SIMILAR_LIMIT_MAX = 5, 20
LEADERBOARD_SIZE = 10
TOP_RATED_MIN_VOTES = 40
PLACEHOLDER_GENRES = ("Unknown", "")
SORT_MODES = ("popularity", "rating", "votes", "title", "year")


class ServingTables:
    """The four serving tables.  Each argument is a DataFrame or a zero-argument
    factory; a factory runs on first use only, so a read that never touches a
    table never builds it.

    * movies:          movie_id, title, genres, release_year
    * ratings_summary: movie_id, rating_count, avg_rating, popularity_score
    * recommendations: movie_id, recommended_movie_id, rank, similarity_score
    * popular_movies:  movie_id, rank, popularity_score
    """

    NAMES = ("movies", "ratings_summary", "recommendations", "popular_movies")

    def __init__(self, movies, ratings_summary, recommendations, popular_movies):
        self._src = dict(zip(self.NAMES, (movies, ratings_summary, recommendations, popular_movies)))

        self._search = None

    def search_index(self, build):
        """The title index: ``build(tables)`` on first use, the stored one afterwards."""
        if self._search is None:
            self._search = build(self)
        return self._search

    def _get(self, name: str) -> DataFrame:
        v = self._src[name]
        if callable(v):
            v = self._src[name] = v()
        return v

    movies = property(lambda self: self._get("movies"))
    ratings_summary = property(lambda self: self._get("ratings_summary"))
    recommendations = property(lambda self: self._get("recommendations"))
    popular_movies = property(lambda self: self._get("popular_movies"))


MOVIE_COLS = ["movie_id", "title", "genres", "release_year"]


def _check(name: str, value: int, lo: int, hi: int | None) -> int:
    if value < lo or (hi is not None and value > hi):
        raise ValueError(f"{name} must be in [{lo}, {hi if hi is not None else 'inf'}], got {value}")
    return value


def catalog_view(t: ServingTables) -> DataFrame:
    """movies LEFT JOIN summary with null defaults (the listing row shape)."""
    s = t.ratings_summary
    return (t.movies.select(*MOVIE_COLS).join(s, "movie_id", "left")
            .select(*MOVIE_COLS,
                    F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
                    F.coalesce("rating_count", F.lit(0).cast("bigint")).alias("rating_count"),
                    F.coalesce("popularity_score", F.lit(0.0)).alias("popularity_score")))


def rated_view(t: ServingTables) -> DataFrame:
    """movies JOIN summary (rated items only)."""
    return t.movies.select(*MOVIE_COLS).join(t.ratings_summary, "movie_id", "inner")


def sort_order(sort_by: str) -> list[Column]:
    """Sort modes; an unknown mode falls back to popularity; movie_id breaks ties."""
    c = F.col
    modes = {
        "popularity": [c("popularity_score").desc(), c("rating_count").desc()],
        "rating": [c("avg_rating").desc(), c("rating_count").desc()],
        "votes": [c("rating_count").desc()],
        "title": [c("title").asc_nulls_last()],
        "year": [c("release_year").desc_nulls_last(), c("popularity_score").desc()],
    }
    return modes.get(sort_by, modes["popularity"]) + [c("movie_id").asc()]


def _plain(pattern: str) -> str:
    """A LIKE pattern without an escape character: a backslash is a character."""
    return pattern.replace("\\", "\\\\")


def genre_predicate(genre: str | None) -> Column | None:
    """Case-insensitive substring on the pipe string; blank/None -> no filter.
    '%' and '_' in the input keep their wildcard meaning, as in the reference."""
    if genre is None or not genre.strip():
        return None
    return F.col("genres").ilike(f"%{_plain(genre.strip())}%")


def list_movies(t: ServingTables, page: int = 1, page_size: int = PAGE_SIZE_DEFAULT,
                genre: str | None = None, sort_by: str = "popularity") -> DataFrame:
    _check("page", page, 1, None)
    _check("page_size", page_size, 1, PAGE_SIZE_MAX)
    view = catalog_view(t)
    pred = genre_predicate(genre)
    if pred is not None:
        view = view.where(pred)
    return view.orderBy(*sort_order(sort_by)).offset((page - 1) * page_size).limit(page_size)


def list_total(t: ServingTables, genre: str | None = None) -> DataFrame:
    movies = t.movies
    pred = genre_predicate(genre)
    if pred is not None:
        movies = movies.where(pred)
    return movies.agg(F.count(F.lit(1)).alias("total"))


def _relevance(query: str) -> Column:
    """1 exact (case-insensitive), 2 prefix, 3 contains."""
    lt = F.lower(F.col("title"))
    return (F.when(lt == F.lower(F.lit(query)), 1)
            .when(lt.like(_plain(query.lower()) + "%"), 2)
            .otherwise(3))


def search_titles(t: ServingTables, query: str, limit: int = SEARCH_LIMIT_DEFAULT) -> DataFrame:
    """Ranked title search: exact, prefix, contains; then popularity (NULL last)."""
    q = (query or "").strip()
    if not q:
        raise ValueError("search query cannot be empty or only whitespace")
    _check("limit", limit, 1, SEARCH_LIMIT_MAX)
    view = t.movies.select(*MOVIE_COLS).join(t.ratings_summary, "movie_id", "left")
    hits = view.where(F.col("title").ilike(f"%{_plain(q)}%")).withColumn("_rel", _relevance(q))
    top = hits.orderBy(F.col("_rel"), F.col("popularity_score").desc_nulls_last(),
                       F.col("movie_id")).limit(limit)
    return top.select(*MOVIE_COLS,
                      F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
                      F.coalesce("rating_count", F.lit(0).cast("bigint")).alias("rating_count"),
                      F.coalesce("popularity_score", F.lit(0.0)).alias("popularity_score"))


def lookup_by_id(t: ServingTables, requests: DataFrame) -> DataFrame:
    """requests(request_id) LEFT JOIN catalogue; ``found`` marks known ids."""
    view = catalog_view(t).withColumn("found", F.lit(True))
    out = requests.select("request_id").join(view, requests.request_id == view.movie_id, "left")
    return out.select("request_id", F.coalesce("found", F.lit(False)).alias("found"),
                      "title", "genres", "release_year", "avg_rating", "rating_count",
                      "popularity_score")


def popular_list(t: ServingTables, limit: int = POPULAR_LIMIT_DEFAULT) -> DataFrame:
    """Stored leaderboard joined with details; unrated entries drop out (rank kept)."""
    _check("limit", limit, 1, POPULAR_LIMIT_MAX)
    p = t.popular_movies.select("movie_id", "rank", "popularity_score")
    s = t.ratings_summary.select("movie_id", "avg_rating", "rating_count")
    joined = p.join(t.movies.select(*MOVIE_COLS), "movie_id").join(s, "movie_id")
    return (joined.orderBy("rank").limit(limit)
            .select("rank", *MOVIE_COLS, "avg_rating", "rating_count", "popularity_score"))


def _genres_exploded(df: DataFrame) -> DataFrame:
    return (df.select(F.explode(F.split(F.col("genres"), r"\|")).alias("genre"), *[
        c for c in df.columns if c != "genres"])
            .where(~F.col("genre").isin(*PLACEHOLDER_GENRES)))


def mean_of_2dp(col: str) -> Column:
    """ROUND(AVG(x), 2) for 2-decimal x, summed exactly in integer cents.

    Means of 2-decimal values often sit exactly on a half cent; a float sum
    would let the summation order decide the rounding.
    """
    cents = F.rint(F.col(col) * 100.0).cast("bigint")
    return F.floor(F.sum(cents) / F.count(cents) + F.lit(0.5)) / F.lit(100.0)


def genre_stats(t: ServingTables) -> DataFrame:
    """Rated items per genre with the rounded mean of item means."""
    g = _genres_exploded(rated_view(t).select("genres", "avg_rating"))
    return g.groupBy("genre").agg(
        F.count(F.lit(1)).alias("count"),
        mean_of_2dp("avg_rating").alias("avg_rating"))


def genre_list(t: ServingTables) -> DataFrame:
    return _genres_exploded(t.movies.select("genres")).select("genre").distinct()


def genre_top6(t: ServingTables) -> DataFrame:
    """First six genres by count with bar ratio to the largest."""
    top = global_top_n(genre_stats(t), [F.col("count").desc(), F.col("genre").asc()], 6, "position")
    biggest = top.agg(F.max("count")).scalar()
    return top.select("position", "genre", "count", (F.col("count") / biggest).alias("ratio_to_max"))


def dataset_summary(t: ServingTables) -> DataFrame:
    """Rated-item count, rating total, unweighted mean of item means (2 dp),
    number of genres, and the full catalogue size for contrast."""
    n_genres = genre_stats(t).agg(F.count(F.lit(1))).scalar()
    catalog = t.movies.agg(F.count(F.lit(1))).scalar()
    return rated_view(t).agg(
        F.count("movie_id").alias("total_movies"),
        F.coalesce(F.sum("rating_count"), F.lit(0)).cast("bigint").alias("total_ratings"),
        mean_of_2dp("avg_rating").alias("average_rating"),
    ).select("*", n_genres.alias("total_genres"), catalog.alias("catalog_count"))


def _leaderboard(t: ServingTables, order: list[Column], min_votes: int | None) -> DataFrame:
    view = rated_view(t)
    if min_votes is not None:
        view = view.where(F.col("rating_count") >= min_votes)
    top = global_top_n(view, order + [F.col("movie_id").asc()], LEADERBOARD_SIZE)
    return top.select("rank", *MOVIE_COLS, "avg_rating", "rating_count", "popularity_score")


def top_rated(t: ServingTables) -> DataFrame:
    return _leaderboard(t, [F.col("popularity_score").desc()], TOP_RATED_MIN_VOTES)


def most_rated(t: ServingTables) -> DataFrame:
    return _leaderboard(t, [F.col("rating_count").desc()], None)


def table_counts(t: ServingTables, minimums: dict[str, int] | None = None) -> DataFrame:
    """Row count per serving table, the expected minimum and whether it holds."""
    minimums = minimums or {}
    parts = []
    for name in ("movies", "ratings_summary", "recommendations", "popular_movies"):
        df = getattr(t, name)
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count",
                             F.lit(int(minimums.get(name, 1))).cast("bigint").alias("min_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.col("row_count") >= F.col("min_rows"))
