"""Links that carry on: the store against linking everything afresh."""

import pytest

from kinora.operators import linkage
from kinora.operators.link_store import LinkStore
from kinora.session import work_dir

ITEMS = "movie_id long, title string, release_year int"
HITS = ("ext_id long, title string, original_title string, release_date string, vote_count long, vote_average double, "
        "poster_path string, backdrop_path string, overview string")


def hit(i, title, year, votes=100, poster="/p", original=None):
    return (i, title, original or title, f"{year}-05-05" if year else None, votes, 5.0, poster, "/b", "")


OLD_ITEMS = [(1, "Heat (1995)", 1995), (2, "Usual Suspects, The (1995)", 1995), (3, "शोले (1975)", 1975), (4, "Nobody Knows It (1990)", 1990),
             (5, "Seven (a.k.a. Se7en) (1995)", 1995), (6, "", None), (7, None, None)]
OLD_HITS = [hit(10, "Heat", 1995, 900), hit(11, "Heat", 1995, 100), hit(12, "The Usual Suspects", 1995), hit(13, "Sholay", 1975, original="शोले"),
            hit(14, "Se7en", 1996), hit(15, "Heat", None, 4000)] + [hit(100 + i, "Crowd", 1980, i) for i in range(40)]


def rows(df):
    return sorted((r.movie_id, r.ext_id, r.score, r["pass"]) for r in df.collect())


def runs(store):
    return {r.movie_id: r.run for r in store._newest().collect()}


def check(spark, store, items, hits):
    assert rows(store.links(items)) == rows(linkage.link_items(items, hits))


@pytest.fixture
def stored(spark):
    store = LinkStore(spark, work_dir(spark, "links-test"))
    items, hits = spark.createDataFrame(OLD_ITEMS, ITEMS), spark.createDataFrame(OLD_HITS, HITS)
    assert store.refresh("one", items, hits) == 1
    return store, items, hits


def test_first_run_links_all(spark, stored):
    store, items, hits = stored
    check(spark, store, items, hits)
    assert {m: e for m, e, *_ in rows(store.links())} == {1: 10, 2: 12, 3: 13, 5: 14}
    assert runs(store) == dict.fromkeys(range(1, 8), 1)
    assert "Exchange" not in store.links()._jdf.queryExecution().toString()


def test_nothing_changed_links_nothing(spark, stored):
    store, items, hits = stored
    assert store.refresh("two", items.repartition(3), hits.repartition(5)) == 2
    assert set(runs(store).values()) == {1}
    check(spark, store, items, hits)


def test_only_what_a_change_reaches_is_linked_again(spark, stored):
    store, _, _ = stored
    items = spark.createDataFrame([*[r for r in OLD_ITEMS if r[0] not in (2, 5)], (2, "Usual Suspects, The (1994)", 1994), (8, "Crowd (1980)", 1980)], ITEMS)
    hits = spark.createDataFrame([h if h[0] != 11 else hit(11, "Heat", 1995, 5000) for h in OLD_HITS] + [hit(16, "Nobody knows it!", 1990)], HITS)
    store.refresh("two", items, hits)
    check(spark, store, items, hits)
    # Votes of 11 (item 1), a year (2), a hit that was not there (4) and a new item (8).
    assert runs(store) == {1: 2, 2: 2, 3: 1, 4: 2, 5: 1, 6: 1, 7: 1, 8: 2}
    assert {m: e for m, e, *_ in rows(store.links(items))} == {1: 11, 2: 12, 3: 13, 4: 16, 8: 139}
    # What is not scored does not count, nor does a hit that is in no list of ten.
    same = spark.createDataFrame([(*h[:7], "/other", "other") for h in hits.collect()] + [hit(99, "Crowd", 1980, 0)], HITS)
    store.refresh("three", items, same)
    assert max(runs(store).values()) == 2


def test_a_lost_hit_takes_its_link(spark, stored):
    store, items, _ = stored
    hits = spark.createDataFrame([h for h in OLD_HITS if h[0] != 13], HITS)
    store.refresh("two", items, hits)
    assert 3 not in {m for m, *_ in rows(store.links(items))} and runs(store)[3] == 2
    check(spark, store, items, hits)
    # A reader pinned to the first run still has it.
    assert 3 in {m for m, *_ in rows(store.links(items, version=1))}


def test_a_run_said_again_changes_nothing(spark, stored):
    store, _, hits = stored
    more = spark.createDataFrame([*OLD_ITEMS, (9, "Heat (1995)", 1995)], ITEMS)
    assert store.refresh("one", more, hits) == 1
    assert 9 not in runs(store)
    assert store.refresh("two", more, hits) == 2 == store.refresh("two", more, hits)
    assert runs(store)[9] == 2


def test_cases(spark):
    store = LinkStore(spark, work_dir(spark, "links-test"))
    with pytest.raises(ValueError, match="nothing has been linked"):
        store.links()
    none, hits = spark.createDataFrame([], ITEMS), spark.createDataFrame(OLD_HITS, HITS)
    store.refresh("none", none, hits)
    assert store.links().collect() == []
    odd = spark.createDataFrame([(None, "Heat (1995)", 1995), (1, "Heat (1995)", 1995), (1, "Heat (1995)", 1995), (2, "[\"\\", 0)], ITEMS)
    store.refresh("odd", odd, hits)
    assert {m: e for m, e, *_ in rows(store.links())} == {1: 10}
    store.refresh("no hits", odd, spark.createDataFrame([], HITS))
    assert store.links().collect() == [] and runs(store) == {1: 3, 2: 2}
