"""Lazy wiring of the batch products for one input (raw items + raw ratings).

``CatalogueBuild`` holds DataFrame definitions; every registered query and the
full pipeline share this wiring, so a product is defined exactly once.

With ``store=True`` the two tables everything else derives from - the
item-level rating table and the cleaned catalogue - are written once to the
shared folder on first use.  Summary, global mean, transformed catalogue,
leaderboard and metrics then read those small tables instead of re-running the
rating de-duplication in every job (scalar subqueries and separate actions do
not share shuffles).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinora.operators import catalog, ranking, ratings
from kinora.sources import fixtures

# FIXED VALUES: defaults of the reference pipeline.
DEFAULT_TOP_K = 15        # neighbours per item (function default)
PIPELINE_TOP_K = 100      # neighbours per item passed by the full pipeline run
POPULAR_TOP_N = 50        # size of the popularity leaderboard


class CatalogueBuild:
    def __init__(self, raw_movies: DataFrame, raw_ratings: DataFrame, m: int = catalog.BAYES_M,
                 store: bool = False):
        self.raw_movies = raw_movies
        self.raw_ratings = raw_ratings
        self.m = m
        self.store = store

    def _stored(self, df: DataFrame, purpose: str) -> DataFrame:
        if not self.store:
            return df
        from kinora.session import materialize
        return materialize(df, purpose)

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, **kw) -> "CatalogueBuild":
        return cls(fixtures.raw_movies(spark, sf_dir), fixtures.raw_ratings(spark, sf_dir), **kw)

    # -- cleaning ------------------------------------------------------------
    @cached_property
    def clean_movies(self) -> DataFrame:
        return self._stored(catalog.clean_catalog(self.raw_movies), "clean-movies")

    @cached_property
    def pairs(self) -> DataFrame:
        return ratings.rating_pairs(self.raw_ratings)

    @cached_property
    def item_stats(self) -> DataFrame:
        return self._stored(ratings.item_rating_stats(self.pairs), "item-stats")

    @cached_property
    def known_stats(self) -> DataFrame:
        return ratings.known_item_stats(self.item_stats, self.clean_movies)

    @cached_property
    def clean_ratings(self) -> DataFrame:
        return ratings.clean_ratings(self.pairs, self.clean_movies)

    # -- transform -----------------------------------------------------------
    @property
    def global_mean(self):
        return ratings.global_mean(self.known_stats)

    @cached_property
    def ratings_summary(self) -> DataFrame:
        return catalog.ratings_summary(self.known_stats, self.global_mean, self.m)

    @cached_property
    def transformed(self) -> DataFrame:
        return catalog.transform_catalog(self.clean_movies, self.ratings_summary, self.global_mean)

    # -- leaderboard -----------------------------------------------------------
    def popular_movies(self, top_n: int = POPULAR_TOP_N) -> DataFrame:
        ranked = ranking.global_top_n(
            self.transformed.select("movie_id", "popularity_score"),
            [F.col("popularity_score").desc_nulls_last(), F.col("movie_id").asc()], top_n)
        return ranked.select("movie_id", "rank", "popularity_score")

    # -- serving tables --------------------------------------------------------
    @cached_property
    def feature_items(self) -> DataFrame:
        from kinora.functions import text
        return self.clean_movies.select(
            "movie_id", text.feature_text("title", "genres", "release_year").alias("feature_text"))

    def recommendations(self, k: int = DEFAULT_TOP_K, n_blocks: int | None = None) -> DataFrame:
        from kinora.operators import similarity
        spark = self.raw_movies.sparkSession
        return similarity.content_neighbours(spark, self.feature_items, k, n_blocks=n_blocks)

    def stored_recommendations(self, k: int = DEFAULT_TOP_K) -> DataFrame:
        """The neighbour table as the serving layer sees it: written once as a
        table in the shared folder, then read by every query.  Each reference
        to an ``applyInPandas`` result would otherwise re-run the block
        product, since Python UDF plans are not reused."""
        from kinora.session import materialize
        return materialize(self.recommendations(k), "recommendations")

    def serving(self, k: int = DEFAULT_TOP_K, recommendations: DataFrame | None = None):
        """Serving tables as lazy factories: a read that never touches a table
        never builds it.  The neighbour table is written once to the shared
        folder when first used (``stored_recommendations``); the other three
        derive cheaply from the core tables."""
        from kinora.operators.serving import ServingTables
        return ServingTables(
            lambda: self.clean_movies.select("movie_id", "title", "genres", "release_year"),
            lambda: self.ratings_summary,
            recommendations if recommendations is not None else (lambda: self.stored_recommendations(k)),
            lambda: self.popular_movies(),
        )
