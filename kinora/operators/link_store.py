"""Links that carry on from run to run: only what changed is linked again.

A store holds, for every item linked so far, its link (or that it has none) and a digest
of all that the link follows from: the item's year and search names, and the result list
of each of its searches with everything of a hit that is scored.  ``refresh`` works out
the digests of the items as they are now, links those whose digest is new and appends
them as one commit (``sources.commits``), so a run that ends early leaves the store as it
was, and one that is said again changes nothing.

Scale: a result list has at most ten hits, so its digest is one short row per search; the
lists are written once per run and both the digests and the linking read them.  Items meet
their lists by equi-joins on the search name.  What is linked again is proportional to what
changed, not to the catalogue.

Cases: an item whose searches find nothing has a digest as well and is not tried again
until they do; an item without a name, an id that is null or an empty table gives no link;
of an id that repeats, the links of all its rows compete as in ``link_items``; items that
left the catalogue stay in the store and out of ``links(items)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinora.functions import text
from kinora.operators import linkage
from kinora.session import materialize
from kinora.sources.commits import SnapshotStore

COLUMNS = ["movie_id", "digest", "ext_id", "score", "pass", "run"]


def _text(*cols) -> Column:
    """One string of all values in which a null, an empty one and a border are told apart."""
    return F.to_json(F.array(*[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]))


def hit_digests(hits: DataFrame) -> DataFrame:
    """(ext_id, hit): a digest of what is scored of each hit."""
    has_poster = F.coalesce(F.col("poster_path"), F.lit("")) != ""
    return hits.select("ext_id", F.md5(_text("ext_id", text.link_key("title"), text.link_key("original_title"),
                                             text.year_from_date("release_date"), "vote_count", has_poster)).alias("hit"))


def item_digests(items: DataFrame, hits: DataFrame, results: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(movie_id, digest) of items(movie_id, title, release_year), one row per id."""
    items = items.where("movie_id is not null")
    searches = linkage.searches(items).select("movie_id", "title", "year", "cpos", "key")
    own = hit_digests(hits)

    def listed(result: DataFrame, *keys: str) -> DataFrame:
        return result.join(own, "ext_id").groupBy(*keys).agg(F.md5(F.concat_ws(",", F.sort_array(F.collect_list("hit")))).alias("found"))

    def seen(kind: str, found: DataFrame) -> DataFrame:
        return found.select("movie_id", F.md5(_text(F.lit(kind), "cpos", "key", "found")).alias("part"))
    named = items.select("movie_id", F.md5(_text(F.lit("item"), "title", "release_year")).alias("part"))
    dated = seen("dated", searches.where("year is not null").join(listed(results[0], "key", "year"), ["key", "year"]))
    free = seen("free", searches.where(F.col("cpos") < linkage.SECOND_PASS_CANDIDATES).join(listed(results[1], "key"), "key"))
    return (named.unionByName(dated).unionByName(free).groupBy("movie_id")
            .agg(F.md5(F.concat_ws(",", F.sort_array(F.collect_list("part")))).alias("digest")))


class LinkStore:
    def __init__(self, spark: SparkSession, base: str):
        self.log = SnapshotStore(spark, base)

    def _newest(self, version: int | None = None) -> DataFrame | None:
        """The last row of each item; None while the store is empty."""
        snap = self.log.snapshot(version)
        if not snap.version:
            return None
        rows = snap.read("links")
        if snap.version == 1:
            return rows  # one run has one row per item
        last = F.max_by(F.struct(*COLUMNS[1:]), "run").alias("last")
        return rows.groupBy("movie_id").agg(last).select("movie_id", "last.*")

    def refresh(self, txn: str, items: DataFrame, hits: DataFrame) -> int:
        """Link the items(movie_id, title, release_year) that are new or whose digest has
        changed; the version of the store that holds them."""
        before = self.log.version()
        results = tuple(materialize(linkage.search_results(hits, dated), "search-results") for dated in (True, False))
        digests = item_digests(items, hits, results)
        held = self._newest()
        if held is not None:
            digests = digests.join(held.select("movie_id", "digest"), ["movie_id", "digest"], "left_anti")
        changed = materialize(digests, "link-digests")
        links = linkage.link_items(items.join(changed, "movie_id", "left_semi"), hits, results)
        rows = changed.join(links, "movie_id", "left").select(
            "movie_id", "digest", "ext_id", "score", F.col("pass").cast("int").alias("pass"), F.lit(before + 1).cast("int").alias("run"))
        return self.log.commit(txn, {"links": rows})

    def links(self, items: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """(movie_id, ext_id, score, pass, run) of the items that have a link, of all or of
        those in ``items``; run is the version that linked the item last."""
        rows = self._newest(version)
        if rows is None:
            raise ValueError("nothing has been linked yet")
        rows = rows.where("ext_id is not null").drop("digest")
        return rows if items is None else rows.join(items.select("movie_id"), "movie_id", "left_semi")
