"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement is written independently of the Spark code path - windows where
Spark uses aggregates, joins where Spark uses semi joins - but with the same
arithmetic (rounding forms, tie-breaks), so both engines must agree exactly.
CTE fragments below are shared between statements.
"""

from __future__ import annotations

from kinora.functions.rounding import sql_round_even, sql_round_half_up
from kinora.functions.text import WHITESPACE_CLASS

WS = WHITESPACE_CLASS

# -- fixture projections -----------------------------------------------------
RAW_MOVIES = """raw_movies AS (
  SELECT CAST(p_partkey AS BIGINT) AS movie_id,
         p_name || ' (' || CAST(1960 + p_size AS VARCHAR) || ')' AS title,
         p_type || '|' || replace(p_brand, '#', '') AS genres
  FROM part)"""

RAW_RATINGS = """raw_ratings AS (
  SELECT CAST(o.o_custkey AS BIGINT) AS user_id,
         CAST(l.l_partkey AS BIGINT) AS movie_id,
         CAST(ceil(l.l_quantity / 5) AS DOUBLE) / 2
           + CASE WHEN l.l_quantity > 45 AND l.l_tax >= 0.08 THEN 0.5 ELSE 0.0 END AS rating,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  )"""

# -- cleaning ----------------------------------------------------------------
CLEAN_MOVIES = f"""by_id AS (
  SELECT movie_id, title, genres FROM (
    SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY title, genres) AS rn
    FROM raw_movies) WHERE rn = 1),
cleaned_titles AS (
  SELECT movie_id,
         coalesce(regexp_replace(title, '^{WS}+|{WS}+$', '', 'g'), 'Untitled') AS title,
         genres
  FROM by_id),
clean_movies AS (
  SELECT movie_id, title,
         coalesce(TRY_CAST(regexp_extract(title, '\\((\\d{{4}})\\)', 1) AS INTEGER), 0) AS release_year,
         genres
  FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY movie_id) AS rn
        FROM cleaned_titles) WHERE rn = 1)"""

VALID = "coalesce(rating BETWEEN 0.5 AND 5.0, false)"

DEDUP_RATINGS = f"""ranked_ratings AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, movie_id ORDER BY "timestamp", rating) AS rn
  FROM raw_ratings),
dedup_ratings AS (SELECT user_id, movie_id, rating, "timestamp" FROM ranked_ratings WHERE rn = 1),
bounded_ratings AS (SELECT * FROM dedup_ratings WHERE {VALID}),
clean_ratings AS (
  SELECT * FROM bounded_ratings WHERE movie_id IN (SELECT movie_id FROM clean_movies))"""

SUMMARY = f"""gm AS (SELECT avg(rating) AS c FROM clean_ratings),
item_agg AS (
  SELECT movie_id, count(*) AS v, sum(rating) AS s FROM clean_ratings GROUP BY movie_id),
ratings_summary AS (
  SELECT movie_id, CAST(v AS BIGINT) AS rating_count,
         {sql_round_even('s / v', 2)} AS avg_rating,
         {sql_round_even('(v / (v + 15)) * (s / v) + (15 / (v + 15)) * gm.c', 3)} AS popularity_score
  FROM item_agg, gm)"""

TRANSFORMED = f"""transformed AS (
  SELECT m.movie_id, m.title, m.release_year, m.genres,
         coalesce(s.rating_count, 0) AS rating_count,
         coalesce(s.avg_rating, 0.0) AS avg_rating,
         coalesce(s.popularity_score, {sql_round_even('gm.c * 0.5', 3)}) AS popularity_score,
         lower(concat_ws(' ',
           regexp_replace(regexp_replace(m.title, '{WS}*\\(\\d{{4}}\\)', '', 'g'), '^{WS}+|{WS}+$', '', 'g'),
           translate(m.genres, '|-', '  '), translate(m.genres, '|-', '  '),
           CAST(m.release_year AS VARCHAR))) AS feature_text
  FROM clean_movies m LEFT JOIN ratings_summary s ON m.movie_id = s.movie_id, gm)"""

POPULAR = """popular_movies AS (
  SELECT movie_id, CAST(row_number() OVER (ORDER BY popularity_score DESC, movie_id) AS INTEGER) AS rank,
         popularity_score
  FROM transformed ORDER BY popularity_score DESC, movie_id LIMIT {n})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (RAW_MOVIES, RAW_RATINGS, CLEAN_MOVIES, DEDUP_RATINGS)
CORE = BASE + (SUMMARY, TRANSFORMED)


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ratings_summary"] = with_(*BASE, SUMMARY) + "SELECT * FROM ratings_summary"
    q["popular_movies"] = with_(*CORE, POPULAR.format(n=50)) + "SELECT * FROM popular_movies"
    q["clean_catalog"] = with_(RAW_MOVIES, CLEAN_MOVIES) + "SELECT * FROM clean_movies"
    q["clean_ratings"] = with_(*BASE) + "SELECT * FROM clean_ratings"
    q["transform_catalog"] = with_(*CORE) + "SELECT * FROM transformed"
    q["feature_text"] = with_(*CORE) + "SELECT movie_id, feature_text FROM transformed"
    q["validate_raw"] = with_(RAW_MOVIES, RAW_RATINGS) + f"""
SELECT (SELECT count(*) FROM raw_movies) AS raw_movie_count,
       (SELECT count(*) FROM raw_ratings) AS raw_rating_count,
       (SELECT count(*) - count(DISTINCT movie_id) FROM raw_movies) AS duplicate_movies,
       (SELECT count(*) FROM raw_ratings)
         - (SELECT count(*) FROM (SELECT DISTINCT user_id, movie_id FROM raw_ratings)) AS duplicate_ratings,
       (SELECT count(*) FROM raw_ratings WHERE NOT {VALID}) AS invalid_ratings,
       (SELECT count(*) FROM raw_ratings r
         WHERE NOT EXISTS (SELECT 1 FROM raw_movies m WHERE m.movie_id = r.movie_id)) AS orphan_ratings,
       CAST(0 AS BIGINT) AS user_count"""
    q["cleaning_metrics"] = with_(*BASE) + """
SELECT (SELECT count(*) FROM raw_movies) AS movies_initial,
       (SELECT count(*) FROM clean_movies) AS movies_cleaned,
       (SELECT count(*) FROM raw_movies) - (SELECT count(*) FROM clean_movies) AS movies_deduplicated,
       (SELECT count(*) FROM raw_ratings) AS ratings_initial,
       (SELECT count(*) FROM clean_ratings) AS ratings_cleaned,
       (SELECT count(*) FROM raw_ratings) - (SELECT count(*) FROM dedup_ratings) AS ratings_deduplicated,
       (SELECT count(*) FROM dedup_ratings) - (SELECT count(*) FROM bounded_ratings) AS ratings_invalid_dropped,
       (SELECT count(*) FROM bounded_ratings) - (SELECT count(*) FROM clean_ratings) AS ratings_orphans_dropped"""
    q["rating_histogram"] = with_(*BASE) + f"""
, hist AS (SELECT rating, count(*) AS count FROM clean_ratings GROUP BY rating)
SELECT rating, count,
       {sql_round_half_up('(count / (SELECT sum(count) FROM hist)) * 100.0', 1)} AS pct,
       count / (SELECT max(count) FROM hist) AS ratio_to_max
FROM hist"""
    return q


ORACLE_SQL = _sql()


# -- TF-IDF and similarity -----------------------------------------------------
def _stop_list() -> str:
    from kinora.functions.stopwords import ENGLISH_STOP_WORDS
    return "[" + ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS) + "]"


def tfidf_ctes(src: str) -> tuple[str, ...]:
    """CTEs over ``src(doc_id, text)``: toks, grams, tf, ndocs, dfs, w0, wn."""
    stop = _stop_list()
    return (
        f"""toks AS (
  SELECT doc_id,
         list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                     lambda x: NOT list_contains({stop}, x)) AS t
  FROM {src})""",
        """grams AS (
  SELECT doc_id, unnest(t) AS term FROM toks
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term
  FROM toks)""",
        "tf AS (SELECT doc_id, term, count(*) AS c FROM grams GROUP BY doc_id, term)",
        f"ndocs AS (SELECT count(*) AS n FROM {src})",
        "dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term)",
        """w0 AS (
  SELECT tf.doc_id, tf.term, (1 + ln(tf.c)) * (ln((1 + ndocs.n) / (1 + dfs.df)) + 1) AS w
  FROM tf JOIN dfs ON tf.term = dfs.term, ndocs)""",
        "wn AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w0)",
    )


def topk_ctes(k: int) -> tuple[str, ...]:
    """Exact cosine top-K over ``wn`` -> nn(src, dst, rnk, similarity_score)."""
    return (
        """sims AS (
  SELECT a.doc_id AS src, b.doc_id AS dst, sum(a.w * b.w) AS score
  FROM wn a JOIN wn b ON a.term = b.term AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id)""",
        """sims_q AS (
  SELECT src, dst, round_even(score * CAST(1e9 AS DOUBLE), 0) AS q FROM sims WHERE score > 0)""",
        f"""nn AS (
  SELECT src, dst, CAST(rnk AS INTEGER) AS rnk,
         round_even(q / CAST(1e5 AS DOUBLE), 0) / CAST(1e4 AS DOUBLE) AS similarity_score
  FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY q DESC, dst) AS rnk FROM sims_q)
  WHERE rnk <= {k})""",
    )


FEATURE_DOCS = f"""feature_docs AS (
  SELECT movie_id AS doc_id,
         lower(concat_ws(' ',
           regexp_replace(regexp_replace(title, '{WS}*\\(\\d{{4}}\\)', '', 'g'), '^{WS}+|{WS}+$', '', 'g'),
           translate(genres, '|-', '  '), translate(genres, '|-', '  '),
           CAST(release_year AS VARCHAR))) AS text
  FROM clean_movies)"""

ALL_DOCS = "all_docs AS (SELECT doc_id, text FROM documents)"
ALL_DOCS = "all_docs AS (SELECT doc_id, text FROM documents)"


def content_topk_sql(k: int) -> str:
    return (with_(RAW_MOVIES, CLEAN_MOVIES, FEATURE_DOCS, *tfidf_ctes("feature_docs"), *topk_ctes(k))
            + "SELECT src AS movie_id, dst AS recommended_movie_id, rnk AS rank, similarity_score FROM nn")


def _sql_similarity() -> dict[str, str]:
    q: dict[str, str] = {}
    toks = tfidf_ctes("all_docs")[0]
    q["tokens"] = with_(ALL_DOCS, toks) + """
SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS token FROM toks"""
    q["ngrams"] = with_(ALL_DOCS, *tfidf_ctes("all_docs")[:3]) + """
SELECT doc_id, term, c AS tf_count FROM tf"""
    q["tfidf_weights"] = with_(ALL_DOCS, *tfidf_ctes("all_docs")) + f"""
SELECT doc_id, term, {sql_round_even('w', 9)} AS weight FROM wn"""
    q["content_topk"] = content_topk_sql(15)
    q["content_topk100"] = content_topk_sql(100)
    q["doc_similarity_topk"] = (with_(ALL_DOCS, *tfidf_ctes("all_docs"), *topk_ctes(10))
                                + "SELECT src AS doc_id, dst AS neighbour_id, rnk AS rank, similarity_score FROM nn")
    return q


ORACLE_SQL.update(_sql_similarity())


# -- serving reads -------------------------------------------------------------
SERVING_VIEWS = """movies AS (SELECT movie_id, title, genres, release_year FROM clean_movies),
catalog_view AS (
  SELECT m.movie_id, m.title, m.genres, m.release_year,
         coalesce(s.avg_rating, 0.0) AS avg_rating,
         coalesce(s.rating_count, 0) AS rating_count,
         coalesce(s.popularity_score, 0.0) AS popularity_score
  FROM movies m LEFT JOIN ratings_summary s ON m.movie_id = s.movie_id),
rated AS (
  SELECT m.movie_id, m.title, m.genres, m.release_year, s.rating_count, s.avg_rating, s.popularity_score
  FROM movies m JOIN ratings_summary s ON m.movie_id = s.movie_id)"""

SERVING = CORE + (POPULAR.format(n=50), SERVING_VIEWS)

SORT_SQL = {
    "popularity": "popularity_score DESC, rating_count DESC, movie_id",
    "rating": "avg_rating DESC, rating_count DESC, movie_id",
    "votes": "rating_count DESC, movie_id",
    "title": "title ASC NULLS LAST, movie_id",
    "year": "release_year DESC NULLS LAST, popularity_score DESC, movie_id",
}

MEAN_2DP = "floor(sum(CAST(round_even({c} * 100.0, 0) AS BIGINT)) / count({c}) + 0.5) / 100.0"

GENRE_STATS = f"""genre_stats AS (
  SELECT genre, count(*) AS count, {MEAN_2DP.format(c='avg_rating')} AS avg_rating
  FROM (SELECT unnest(string_split(genres, '|')) AS genre, avg_rating FROM rated)
  WHERE genre <> 'Unknown' AND genre <> ''
  GROUP BY genre)"""

REQUESTS = """requests AS (
  SELECT CAST(p_partkey AS BIGINT) AS request_id, CAST(NULL AS VARCHAR) AS title FROM part
  UNION ALL
  SELECT DISTINCT CAST(NULL AS BIGINT), upper(p_name) FROM part
  UNION ALL SELECT CAST(999999 AS BIGINT), CAST(NULL AS VARCHAR)
  UNION ALL SELECT CAST(NULL AS BIGINT), '   '
  UNION ALL SELECT CAST(NULL AS BIGINT), 'Supercalifragilistic12345NonExistent')"""


def _list_sql(sort_by="popularity", page=1, page_size=20, genre=None) -> str:
    where = f"WHERE genres ILIKE '%{genre}%'" if genre else ""
    order = SORT_SQL.get(sort_by, SORT_SQL["popularity"])
    return (with_(*SERVING) + f"SELECT * FROM catalog_view {where} ORDER BY {order} "
            f"LIMIT {page_size} OFFSET {(page - 1) * page_size}")


def _leader_sql(order: str, where: str = "") -> str:
    return with_(*SERVING) + f"""
SELECT CAST(row_number() OVER (ORDER BY {order}, movie_id) AS INTEGER) AS rank,
       movie_id, title, genres, release_year, avg_rating, rating_count, popularity_score
FROM rated {where} ORDER BY {order}, movie_id LIMIT 10"""


def _sql_serving() -> dict[str, str]:
    q: dict[str, str] = {}
    for mode in ("popularity", "rating", "votes", "title", "year"):
        q[f"list_{mode}"] = _list_sql(mode)
    q["list_page2"] = _list_sql(page=2)
    q["list_by_genre"] = _list_sql(genre="promo", page_size=50)
    q["list_unknown_sort"] = _list_sql("no-such-mode", page=3)
    q["list_total"] = with_(*SERVING) + "SELECT count(*) AS total FROM movies WHERE genres ILIKE '%promo%'"
    q["search_titles"] = with_(*SERVING) + """
SELECT m.movie_id, m.title, m.genres, m.release_year,
       coalesce(s.avg_rating, 0.0) AS avg_rating, coalesce(s.rating_count, 0) AS rating_count,
       coalesce(s.popularity_score, 0.0) AS popularity_score
FROM movies m LEFT JOIN ratings_summary s ON m.movie_id = s.movie_id
WHERE m.title ILIKE '%Blue Anvil%'
ORDER BY CASE WHEN lower(m.title) = lower('Blue Anvil') THEN 1
              WHEN lower(m.title) LIKE lower('Blue Anvil') || '%' THEN 2 ELSE 3 END,
         s.popularity_score DESC NULLS LAST, m.movie_id
LIMIT 50"""
    q["lookup_by_id"] = with_(*SERVING, REQUESTS) + """
SELECT r.request_id, (c.movie_id IS NOT NULL) AS found, c.title, c.genres, c.release_year,
       c.avg_rating, c.rating_count, c.popularity_score
FROM requests r LEFT JOIN catalog_view c ON r.request_id = c.movie_id
WHERE r.request_id IS NOT NULL"""
    q["popular_list"] = with_(*SERVING) + """
SELECT p.rank, m.movie_id, m.title, m.genres, m.release_year, s.avg_rating, s.rating_count,
       p.popularity_score
FROM popular_movies p JOIN movies m ON p.movie_id = m.movie_id
JOIN ratings_summary s ON m.movie_id = s.movie_id
ORDER BY p.rank LIMIT 20"""
    q["genre_stats"] = with_(*SERVING, GENRE_STATS) + "SELECT * FROM genre_stats"
    q["genre_list"] = with_(*SERVING) + """
SELECT DISTINCT genre FROM (SELECT unnest(string_split(genres, '|')) AS genre FROM movies)
WHERE genre <> 'Unknown' AND genre <> ''"""
    q["genre_top6"] = with_(*SERVING, GENRE_STATS) + """
, top6 AS (SELECT CAST(row_number() OVER (ORDER BY count DESC, genre) AS INTEGER) AS position, genre, count
           FROM genre_stats ORDER BY count DESC, genre LIMIT 6)
SELECT position, genre, count, count / (SELECT max(count) FROM top6) AS ratio_to_max FROM top6"""
    q["dataset_summary"] = with_(*SERVING, GENRE_STATS) + f"""
SELECT count(movie_id) AS total_movies, CAST(coalesce(sum(rating_count), 0) AS BIGINT) AS total_ratings,
       {MEAN_2DP.format(c='avg_rating')} AS average_rating,
       (SELECT count(*) FROM genre_stats) AS total_genres,
       (SELECT count(*) FROM movies) AS catalog_count
FROM rated"""
    q["top_rated"] = _leader_sql("popularity_score DESC", "WHERE rating_count >= 40")
    q["most_rated"] = _leader_sql("rating_count DESC")
    q["table_counts"] = with_(*SERVING, FEATURE_DOCS, *tfidf_ctes("feature_docs"), *topk_ctes(15)) + """
, counts AS (
  SELECT 'movies' AS table_name, count(*) AS row_count, CAST(1 AS BIGINT) AS min_rows FROM movies
  UNION ALL SELECT 'ratings_summary', count(*), 1 FROM ratings_summary
  UNION ALL SELECT 'recommendations', count(*), 1 FROM nn
  UNION ALL SELECT 'popular_movies', count(*), 50 FROM popular_movies)
SELECT table_name, row_count, min_rows, row_count >= min_rows AS ok FROM counts"""
    return q


ORACLE_SQL.update(_sql_serving())


# -- recommendations -------------------------------------------------------------
NULL_REC = ("CAST(NULL AS INTEGER) AS rank, CAST(NULL AS BIGINT) AS movie_id, CAST(NULL AS VARCHAR) AS title, "
            "CAST(NULL AS VARCHAR) AS genres, CAST(NULL AS INTEGER) AS release_year, "
            "CAST(NULL AS DOUBLE) AS avg_rating, CAST(NULL AS BIGINT) AS rating_count, "
            "CAST(NULL AS DOUBLE) AS popularity_score, CAST(NULL AS DOUBLE) AS similarity_score")


def recommend_ctes(k: int, reqs: str = "id_reqs", key: str = "request_id") -> tuple[str, ...]:
    """rec_rows over ``reqs(<key>, source_id)`` with neighbours ``nn``."""
    return (f"""rec_ok AS (
  SELECT r.{key}, r.source_id, 'ok' AS status, false AS is_fallback, nn.rnk AS rank,
         c.movie_id, c.title, c.genres, c.release_year, c.avg_rating, c.rating_count,
         c.popularity_score, nn.similarity_score
  FROM {reqs} r JOIN nn ON nn.src = r.source_id JOIN catalog_view c ON c.movie_id = nn.dst
  WHERE nn.rnk <= {k} AND r.source_id IN (SELECT movie_id FROM movies))""",
            f"""rec_fb AS (
  SELECT * FROM (
    SELECT r.{key}, r.source_id, 'fallback' AS status, true AS is_fallback,
           CAST(row_number() OVER (PARTITION BY r.{key} ORDER BY p.rank) AS INTEGER) AS rank,
           m.movie_id, m.title, m.genres, m.release_year, s.avg_rating, s.rating_count,
           p.popularity_score, CAST(0.0 AS DOUBLE) AS similarity_score
    FROM {reqs} r, popular_movies p JOIN movies m ON p.movie_id = m.movie_id
         JOIN ratings_summary s ON s.movie_id = m.movie_id
    WHERE r.source_id IN (SELECT movie_id FROM movies)
      AND r.source_id NOT IN (SELECT src FROM nn) AND m.movie_id <> r.source_id)
  WHERE rank <= {k})""",
            f"""rec_nf AS (
  SELECT r.{key}, r.source_id, 'not_found' AS status, false AS is_fallback, {NULL_REC}
  FROM {reqs} r WHERE r.source_id NOT IN (SELECT movie_id FROM movies))""",
            """rec_rows AS (
  SELECT * FROM rec_ok UNION ALL BY NAME SELECT * FROM rec_fb UNION ALL BY NAME SELECT * FROM rec_nf)""")


ID_REQS = "id_reqs AS (SELECT request_id, request_id AS source_id FROM requests WHERE request_id IS NOT NULL)"
KEYED_REQS = """keyed AS (
  SELECT CASE WHEN request_id IS NOT NULL THEN 'id:' || CAST(request_id AS VARCHAR)
              ELSE 'title:' || title END AS request_key, request_id, title
  FROM requests)"""
TITLE_QUERIES = f"""tq AS (
  SELECT request_key AS query_id, regexp_replace(title, '^{WS}+|{WS}+$', '', 'g') AS q
  FROM keyed WHERE request_id IS NULL
    AND coalesce(regexp_replace(title, '^{WS}+|{WS}+$', '', 'g'), '') <> '')"""
SEARCH_MATCHES = """matches AS (
  SELECT tq.query_id, m.movie_id, m.title, m.genres, m.release_year,
         coalesce(s.avg_rating, 0.0) AS avg_rating, coalesce(s.rating_count, 0) AS rating_count,
         coalesce(s.popularity_score, 0.0) AS popularity_score,
         CAST(row_number() OVER (PARTITION BY tq.query_id ORDER BY
              CASE WHEN lower(m.title) = lower(tq.q) THEN 1
                   WHEN lower(m.title) LIKE lower(tq.q) || '%' THEN 2 ELSE 3 END,
              s.popularity_score DESC NULLS LAST, m.movie_id) AS INTEGER) AS position
  FROM tq JOIN movies m ON m.title ILIKE '%' || tq.q || '%'
  LEFT JOIN ratings_summary s ON s.movie_id = m.movie_id)"""


def _nn(k: int) -> tuple[str, ...]:
    return (FEATURE_DOCS, *tfidf_ctes("feature_docs"), *topk_ctes(k))


def _sql_recommend() -> dict[str, str]:
    q: dict[str, str] = {}
    q["recommend_with_fallback"] = (with_(*SERVING, REQUESTS, ID_REQS, *_nn(10), *recommend_ctes(10))
                                    + "SELECT * FROM rec_rows")
    q["recommend_per_row"] = (with_(*SERVING, REQUESTS, ID_REQS, *_nn(10), *recommend_ctes(10))
                              + "SELECT * FROM rec_rows WHERE rank IS NULL OR rank <= request_id % 10 + 1")
    q["recommend_summary"] = (with_(*SERVING, REQUESTS, ID_REQS, *_nn(10), *recommend_ctes(10))
                              + "SELECT request_id, status, is_fallback, count(movie_id) AS result_count, "
                                "CASE status WHEN 'ok' THEN 'similar items' WHEN 'not_found' THEN 'unknown item' "
                                "ELSE 'no similar items: popular items instead' END AS reason "
                                "FROM rec_rows GROUP BY request_id, status, is_fallback")
    q["similar_breakdown"] = with_(*SERVING, REQUESTS, ID_REQS, *_nn(5), *recommend_ctes(5)) + f"""
SELECT r.request_id, r.source_id, m.title AS source_title, m.genres AS source_genres,
       'TF-IDF N-Gram Vectorization + Cosine Similarity' AS similarity_method, r.rank,
       r.movie_id AS recommended_movie_id, r.title, r.genres, r.similarity_score, r.avg_rating
FROM rec_rows r JOIN movies m ON m.movie_id = r.source_id WHERE r.status <> 'not_found'"""
    q["search_batch"] = (with_(*SERVING, REQUESTS, KEYED_REQS, TITLE_QUERIES, SEARCH_MATCHES)
                         + "SELECT query_id, position, movie_id, title, genres, release_year, avg_rating, "
                           "rating_count, popularity_score FROM matches WHERE position <= 20")
    q["resolve_title"] = (with_(*SERVING, REQUESTS, KEYED_REQS, TITLE_QUERIES, SEARCH_MATCHES)
                          + "SELECT query_id, movie_id, title FROM matches WHERE position = 1")
    q["recommend_by_title"] = with_(
        *SERVING, REQUESTS, KEYED_REQS, TITLE_QUERIES, SEARCH_MATCHES, *_nn(10),
        """targets AS (
  SELECT request_key, request_id AS source_id FROM keyed WHERE request_id IS NOT NULL
  UNION ALL SELECT query_id, movie_id FROM matches WHERE position = 1)""",
        *recommend_ctes(10, "targets", "request_key")) + f"""
SELECT * FROM rec_rows
UNION ALL BY NAME
SELECT query_id AS request_key, CAST(NULL AS BIGINT) AS source_id, 'no_match' AS status, false AS is_fallback,
       {NULL_REC}
FROM tq WHERE query_id NOT IN (SELECT query_id FROM matches)
UNION ALL BY NAME
SELECT request_key, CAST(NULL AS BIGINT) AS source_id, 'rejected' AS status, false AS is_fallback, {NULL_REC}
FROM keyed WHERE request_id IS NULL
  AND coalesce(regexp_replace(title, '^{WS}+|{WS}+$', '', 'g'), '') = ''"""
    q["recommend_requests"] = with_(
        *SERVING, REQUESTS, KEYED_REQS.replace("keyed AS", "every_key AS"),
        """asked AS (SELECT *, CASE WHEN request_id IS NOT NULL THEN request_id % 120 ELSE 10 END AS top_k FROM every_key)""",
        "keyed AS (SELECT request_key, request_id, title FROM asked WHERE top_k BETWEEN 1 AND 100)", TITLE_QUERIES, SEARCH_MATCHES, *_nn(100),
        """targets AS (
  SELECT request_key, request_id AS source_id FROM keyed WHERE request_id IS NOT NULL
  UNION ALL SELECT query_id, movie_id FROM matches WHERE position = 1)""",
        *recommend_ctes(100, "targets", "request_key")) + f"""
SELECT r.* FROM rec_rows r JOIN asked a ON a.request_key = r.request_key WHERE r.rank IS NULL OR r.rank <= a.top_k
UNION ALL BY NAME
SELECT query_id AS request_key, CAST(NULL AS BIGINT) AS source_id, 'no_match' AS status, false AS is_fallback, {NULL_REC}
FROM tq WHERE query_id NOT IN (SELECT query_id FROM matches)
UNION ALL BY NAME
SELECT request_key, CAST(NULL AS BIGINT) AS source_id, 'rejected' AS status, false AS is_fallback, {NULL_REC}
FROM asked WHERE NOT (top_k BETWEEN 1 AND 100)
  OR request_id IS NULL AND coalesce(regexp_replace(title, '^{WS}+|{WS}+$', '', 'g'), '') = ''"""
    q["serve_recommendations"] = with_(*SERVING, *_nn(5)) + """
SELECT nn.src AS source_id, nn.rnk AS rank, m.movie_id, m.title, m.genres, s.avg_rating, nn.similarity_score
FROM nn JOIN movies m ON nn.dst = m.movie_id LEFT JOIN ratings_summary s ON s.movie_id = m.movie_id"""
    q["segment_topk"] = with_(*SERVING, REQUESTS, ID_REQS, *_nn(100), *recommend_ctes(100)) + """
SELECT * FROM (
  SELECT request_id, CASE WHEN movie_id >= 1000 THEN 'high' ELSE 'low' END AS segment,
         CAST(row_number() OVER (PARTITION BY request_id, CASE WHEN movie_id >= 1000 THEN 'high' ELSE 'low' END
                                 ORDER BY rank) AS INTEGER) AS segment_rank,
         rank, movie_id, similarity_score
  FROM rec_rows WHERE status <> 'not_found')
WHERE segment_rank <= 15"""
    q["title_like_neighbours"] = with_(*SERVING, *_nn(100)) + """
SELECT m.title, m.movie_id, nn.similarity_score
FROM nn JOIN movies m ON nn.dst = m.movie_id
WHERE nn.src = (SELECT min(movie_id) FROM movies WHERE title LIKE '%blue anvil%')
ORDER BY nn.similarity_score DESC, nn.rnk LIMIT 40"""
    return q


ORACLE_SQL.update(_sql_recommend())


# -- linkage and enrichment ------------------------------------------------------
def _trim(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def _fix_article(e: str) -> str:
    t = _trim(e)
    apos = f"'(?i)^(.*),{WS}*(L'')$'"
    plain = f"'(?i)^(.*),{WS}*(The|A|An|Les|La|Le|Il|Das|Der|Die|El)$'"
    return (f"(CASE WHEN regexp_matches({t}, {apos}) THEN regexp_replace({t}, {apos}, '\\2\\1') "
            f"WHEN regexp_matches({t}, {plain}) THEN regexp_replace({t}, {plain}, '\\2 \\1') "
            f"ELSE {t} END)")


def _norm(e: str) -> str:
    return f"regexp_replace(lower(coalesce({e}, '')), '[^a-z0-9]', '', 'g')"


def parse_ctes(src: str) -> tuple[str, ...]:
    """parsed(movie_id, pyear, candidates) over ``src(movie_id, title)``."""
    return (
        f"""pt0 AS (
  SELECT movie_id,
         TRY_CAST(regexp_extract(title, '\\((\\d{{4}})\\){WS}*$', 1) AS INTEGER) AS pyear,
         {_trim(f"regexp_replace(title, '{WS}*\\(\\d{{4}}\\){WS}*$', '')")} AS base
  FROM {src})""",
        f"""pt1 AS (
  SELECT movie_id, pyear, regexp_extract_all(base, '\\(([^)]+)\\)', 1) AS alts,
         {_trim(f"regexp_replace(base, '{WS}*\\([^)]*\\)', '', 'g')")} AS main
  FROM pt0)""",
        f"""pt2 AS (
  SELECT movie_id, pyear,
         list_concat([{_fix_article('main')}, main],
                     list_transform(alts, lambda a: {_fix_article(f"regexp_replace(a, '(?i)^a\\.k\\.a\\.?{WS}*', '')")})) AS c
  FROM pt1)""",
        """parsed AS (
  SELECT movie_id, pyear,
         list_filter(c, lambda x, i: x <> '' AND NOT list_contains(list_transform(c[1:i-1], lambda y: lower(y)), lower(x))) AS candidates
  FROM pt2)""")


VARIANTS = """variants AS (
  SELECT CAST(p_partkey AS BIGINT) AS movie_id,
         CASE p_partkey % 4
           WHEN 1 THEN p_name || ', The (' || CAST(1960 + p_size AS VARCHAR) || ')'
           WHEN 2 THEN p_name || ' (' || upper(p_name) || ') (' || CAST(1960 + p_size AS VARCHAR) || ')'
           WHEN 3 THEN p_name || ', L'' (a.k.a. ' || reverse(p_name) || ') (' || CAST(1960 + p_size AS VARCHAR) || ')'
           ELSE p_name || ' (' || CAST(1960 + p_size AS VARCHAR) || ')' END AS title
  FROM part)"""

HITS = """hits AS (
  SELECT CAST(p.p_partkey + 100000 AS BIGINT) AS ext_id,
         upper(left(replace(p.p_name, ' ', '-'), 1)) || lower(substr(replace(p.p_name, ' ', '-'), 2)) AS title,
         upper(p.p_name) AS original_title,
         CAST(1960 + p.p_size + p.p_partkey % 3 - 1 AS VARCHAR) || '-06-15' AS release_date,
         CAST(coalesce(v.n, 0) AS BIGINT) AS vote_count,
         CAST(p.p_retailprice % 10 AS DOUBLE) AS vote_average,
         CASE WHEN p.p_partkey % 5 = 0 THEN NULL ELSE '/p' || CAST(p.p_partkey AS VARCHAR) || '.jpg' END AS poster_path,
         CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE '/b' || CAST(p.p_partkey AS VARCHAR) || '.jpg' END AS backdrop_path,
         'About ' || p.p_name AS overview
  FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) v
       ON p.p_partkey = v.l_partkey)"""

HIT_YEAR = ("CASE WHEN regexp_matches(left(coalesce(release_date, ''), 4), '^\\d{4}$') "
            "THEN CAST(left(release_date, 4) AS INTEGER) END")


def _score_sql(pool: str) -> str:
    return f"""SELECT p.movie_id, p.ext_id,
         (CASE WHEN len(list_filter(b.candidates, lambda c: {_norm('c')} = h.nt OR {_norm('c')} = h.no)) > 0
               THEN CAST(10.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)
         + (CASE WHEN b.year IS NULL OR h.hit_year IS NULL THEN CAST(0.0 AS DOUBLE)
                 WHEN abs(h.hit_year - b.year) = 0 THEN CAST(6.0 AS DOUBLE)
                 WHEN abs(h.hit_year - b.year) = 1 THEN CAST(3.0 AS DOUBLE) ELSE CAST(-5.0 AS DOUBLE) END)
         + least(h.vote_count, 5000) / CAST(1000.0 AS DOUBLE)
         - (CASE WHEN coalesce(h.poster_path, '') = '' THEN CAST(3.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) AS score
  FROM {pool} p JOIN link_base b ON p.movie_id = b.movie_id JOIN hs h ON p.ext_id = h.ext_id"""


def link_ctes(items: str) -> tuple[str, ...]:
    """links(movie_id, ext_id, score, pass) for ``items(movie_id, title, release_year)``."""
    best = ("SELECT movie_id, ext_id, score FROM (SELECT *, row_number() OVER "
            "(PARTITION BY movie_id ORDER BY score DESC, ext_id) AS rn FROM {s}) WHERE rn = 1")
    return (
        *parse_ctes(items),
        f"""link_base AS (
  SELECT i.movie_id, coalesce(CASE WHEN i.release_year <> 0 THEN i.release_year END, p.pyear) AS year,
         p.candidates
  FROM {items} i JOIN parsed p ON i.movie_id = p.movie_id)""",
        f"""link_cands AS (
  SELECT movie_id, year, cand, cpos, {_norm('cand')} AS key FROM (
    SELECT movie_id, year, unnest(candidates) AS cand, generate_subscripts(candidates, 1) - 1 AS cpos
    FROM link_base))""",
        f"""hidx AS (
  SELECT DISTINCT key, ext_id, hit_year, votes FROM (
    SELECT unnest([{_norm('title')}, {_norm('original_title')}]) AS key, ext_id,
           {HIT_YEAR} AS hit_year, vote_count AS votes
    FROM hits))""",
        """r1 AS (
  SELECT key, hit_year AS year, ext_id FROM (
    SELECT *, row_number() OVER (PARTITION BY key, hit_year ORDER BY votes DESC, ext_id) AS rn
    FROM hidx WHERE hit_year IS NOT NULL) WHERE rn <= 10)""",
        """r2 AS (
  SELECT key, ext_id FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY votes DESC, ext_id) AS rn FROM hidx)
  WHERE rn <= 10)""",
        f"""hs AS (
  SELECT ext_id, {_norm('title')} AS nt, {_norm('original_title')} AS no, {HIT_YEAR} AS hit_year,
         vote_count, poster_path FROM hits)""",
        """pool1 AS (
  SELECT DISTINCT c.movie_id, r.ext_id FROM link_cands c JOIN r1 r ON c.key = r.key AND c.year = r.year)""",
        f"scored1 AS ({_score_sql('pool1')})",
        f"acc1 AS (SELECT *, 1 AS pass FROM ({best.format(s='scored1')}) WHERE score >= 12)",
        "pending AS (SELECT movie_id FROM link_base WHERE movie_id NOT IN (SELECT movie_id FROM acc1))",
        """pool2 AS (
  SELECT movie_id, ext_id FROM pool1 WHERE movie_id IN (SELECT movie_id FROM pending)
  UNION
  SELECT c.movie_id, r.ext_id FROM link_cands c JOIN r2 r ON c.key = r.key
  WHERE c.cpos < 2 AND c.movie_id IN (SELECT movie_id FROM pending))""",
        f"scored2 AS ({_score_sql('pool2')})",
        f"acc2 AS (SELECT *, 2 AS pass FROM ({best.format(s='scored2')}) WHERE score > 0)",
        "links AS (SELECT * FROM acc1 UNION ALL SELECT * FROM acc2)",
    )


DETAILS = """det AS (
  SELECT CAST(conv_id + 100000 AS BIGINT) AS ext_id,
         arg_min(text, turn) AS d_overview,
         CASE WHEN conv_id % 2 = 0 THEN '' ELSE 'A story' END AS d_tagline,
         CAST(sum(length(text)) % 120 + 60 AS INTEGER) AS d_runtime,
         CASE WHEN conv_id % 3 = 0 THEN NULL ELSE '/d' || CAST(conv_id AS VARCHAR) || '.jpg' END AS d_backdrop,
         arg_min(text, turn) FILTER (WHERE role = 'user') AS d_director,
         array_to_string(list_slice(list(text ORDER BY turn), 1, 8), ', ') AS d_cast,
         coalesce(arg_min('k' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR), turn) FILTER (WHERE turn % 6 = 0),
                  arg_min('k' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR), turn) FILTER (WHERE turn % 2 = 0))
           AS d_trailer
  FROM conversations GROUP BY conv_id)"""


def records_cte(name: str, items: str, links: str) -> str:
    return f"""{name} AS (
  SELECT l.movie_id, true AS found, l.ext_id AS meta_id, h.title AS meta_title, h.poster_path,
         coalesce(nullif(h.backdrop_path, ''), nullif(d.d_backdrop, '')) AS backdrop_path,
         coalesce(nullif(d.d_overview, ''), nullif(h.overview, ''), '') AS overview,
         coalesce(nullif(d.d_tagline, ''), '') AS tagline,
         d.d_runtime AS runtime, h.vote_average AS meta_rating,
         coalesce(d.d_director, '') AS director, coalesce(d.d_cast, '') AS cast_names,
         d.d_trailer AS trailer_key
  FROM {links} l JOIN hits h ON l.ext_id = h.ext_id LEFT JOIN det d ON d.ext_id = l.ext_id
  UNION ALL
  SELECT i.movie_id, false, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
         CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER),
         CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
  FROM {items} i WHERE i.movie_id NOT IN (SELECT movie_id FROM {links}))"""


def _rename_links(suffix: str) -> tuple[str, ...]:
    """link_ctes over another item set, with every CTE name suffixed."""
    names = ["pt0", "pt1", "pt2", "parsed", "link_base", "link_cands", "hidx", "r1", "r2", "hs", "pool1",
             "scored1", "acc1", "pending", "pool2", "scored2", "acc2", "links"]
    import re as _re
    out = []
    for cte in link_ctes(f"items{suffix}"):
        for n in names:
            cte = _re.sub(rf"\b{n}\b", f"{n}{suffix}", cte)
        out.append(cte)
    return tuple(out)


LINK_ITEMS = "link_items AS (SELECT movie_id, title, release_year FROM clean_movies)"


def _sql_linkage() -> dict[str, str]:
    q: dict[str, str] = {}
    q["parse_title"] = with_(VARIANTS, *parse_ctes("variants")) + """
SELECT movie_id, pyear AS parsed_year, CAST(len(candidates) AS INTEGER) AS n_candidates,
       array_to_string(candidates, ' || ') AS candidates
FROM parsed"""
    base = (RAW_MOVIES, CLEAN_MOVIES, HITS, LINK_ITEMS, *link_ctes("link_items"))
    q["link_external"] = with_(*base) + "SELECT movie_id, ext_id, score, CAST(pass AS INTEGER) AS pass FROM links"
    q["link_refresh"] = q["link_external"]  # whatever an earlier run knew
    q["enrich_record"] = with_(*base, DETAILS, records_cte("recs", "link_items", "links")) + "SELECT * FROM recs"
    old = (f"items_old AS (SELECT * FROM link_items WHERE release_year <= 1985)", *_rename_links("_old"),
           records_cte("recs_old", "items_old", "links_old"))
    q["enrich_todo"] = with_(*base, DETAILS, *old) + """
SELECT movie_id, title FROM link_items WHERE movie_id NOT IN (SELECT movie_id FROM recs_old)"""
    new = (f"items_new AS (SELECT * FROM link_items WHERE release_year >= 1980)", *_rename_links("_new"),
           records_cte("recs_new", "items_new", "links_new"))
    q["cache_upsert"] = with_(*base, DETAILS, *old, *new) + """
SELECT movie_id, found, meta_id, 'new' AS source FROM recs_new
UNION ALL
SELECT movie_id, found, meta_id, 'old' FROM recs_old WHERE movie_id NOT IN (SELECT movie_id FROM recs_new)"""
    todo = ("items_todo AS (SELECT * FROM link_items WHERE movie_id NOT IN (SELECT movie_id FROM recs_old))",
            *_rename_links("_todo"), records_cte("recs_todo", "items_todo", "links_todo"))
    q["enrich_coverage"] = with_(*base, DETAILS, *old, *todo) + """
, merged AS (SELECT movie_id, found FROM recs_todo
             UNION ALL SELECT movie_id, found FROM recs_old WHERE movie_id NOT IN (SELECT movie_id FROM recs_todo))
SELECT count(*) AS catalog_count,
       (SELECT count(*) FROM merged WHERE found AND movie_id IN (SELECT movie_id FROM link_items)) AS found_count,
       round_even(100.0 * (SELECT count(*) FROM merged WHERE found AND movie_id IN (SELECT movie_id FROM link_items))
                  / count(*) * 10, 0) / 10 AS coverage_pct
FROM link_items"""
    return q


ORACLE_SQL.update(_sql_linkage())


# -- append, quality, sources, display, metrics ------------------------------------
def _genre_case(e: str) -> str:
    from kinora.operators.append import GENRE_MAP
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in GENRE_MAP.items())
    return f"CASE {e} {whens} END"


def _feed_ids() -> str:
    from kinora.sources.external import FEED_GENRE_IDS
    return "[" + ", ".join(str(i) for i in FEED_GENRE_IDS) + "]"


FEED = f"""feed AS (
  SELECT CAST(floor(s_suppkey / 20) + 1 AS INTEGER) AS page, CAST(s_suppkey % 20 AS INTEGER) AS pos,
         replace(s_name, '#', ', No. ') AS title,
         CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE CAST(1990 + s_nationkey AS VARCHAR) || '-01-01' END AS release_date,
         CASE WHEN s_suppkey % 11 = 0 THEN CAST([] AS INTEGER[])
              ELSE [{_feed_ids()}[s_suppkey % 20 + 1], {_feed_ids()}[s_suppkey % 7 + 1]] END AS genre_ids,
         (s_acctbal + 1000.0) / 1100.0 AS vote_average
  FROM supplier
  UNION ALL
  SELECT CAST(floor(p_partkey / 20) + 1 AS INTEGER), CAST(20 + p_partkey % 20 AS INTEGER),
         p_name, CAST(1960 + p_size AS VARCHAR) || '-05-05', [{_feed_ids()}[p_size % 19 + 1]], CAST(NULL AS DOUBLE)
  FROM part)"""

NEW_ITEMS = f"""pages AS (SELECT DISTINCT page FROM feed WHERE page >= 1),
stop_page AS (
  SELECT CASE WHEN EXISTS (SELECT 1 FROM pages WHERE page = 1)
              THEN (SELECT min(page + 1) FROM pages WHERE page + 1 NOT IN (SELECT page FROM pages))
              ELSE 1 END AS s),
composed AS (
  SELECT page, pos,
         CASE WHEN substring(coalesce(release_date, ''), 1, 4) <> ''
              THEN replace(coalesce(title, ''), ',', '') || ' (' || substring(release_date, 1, 4) || ')'
              ELSE replace(coalesce(title, ''), ',', '') END AS full_title,
         genre_ids, vote_average
  FROM feed WHERE page >= 1 AND page < (SELECT s FROM stop_page)),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY full_title ORDER BY page, pos) AS rn FROM composed)
  WHERE rn = 1),
fresh AS (SELECT * FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM raw_movies m WHERE m.title = f.full_title)),
named AS (
  SELECT *, list_transform(coalesce(genre_ids, CAST([] AS INTEGER[])),
                           lambda g: coalesce({_genre_case('g')}, 'Unknown')) AS names
  FROM fresh),
new_items AS (
  SELECT CAST((SELECT greatest(600000, max(movie_id) + 1) FROM raw_movies) + row_number() OVER (ORDER BY page, pos) - 1 AS BIGINT) AS movie_id,
         full_title AS title,
         CASE WHEN len(names) > 0 THEN array_to_string(names, '|') ELSE '(no genres listed)' END AS genres,
         greatest(CAST(0.5 AS DOUBLE), least(CAST(5.0 AS DOUBLE),
                  round_even((coalesce(vote_average, 5.0) / 2) * 2, 0) / 2)) AS seed_rating
  FROM named)"""

DQ_TABLES = """recs15 AS (SELECT src AS movie_id, dst AS recommended_movie_id, rnk AS rank, similarity_score FROM nn)"""


def _dq_sql() -> str:
    parts = []
    pk = {"movies": "movie_id", "ratings_summary": "movie_id", "recs15": "movie_id, rank",
          "popular_movies": "movie_id"}
    nn_cols = {"movies": ["movie_id", "title", "genres"],
               "ratings_summary": ["movie_id", "avg_rating", "rating_count", "popularity_score"],
               "recs15": ["movie_id", "recommended_movie_id", "rank", "similarity_score"],
               "popular_movies": ["movie_id", "rank", "popularity_score"]}
    label = {"recs15": "recommendations"}
    for t, k in pk.items():
        name = label.get(t, t)
        parts.append(f"SELECT '{name}' AS table_name, 'primary_key' AS check_name, "
                     f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM {t})) AS BIGINT) AS violations FROM {t}")
        nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in nn_cols[t])
        parts.append(f"SELECT '{name}', 'not_null', CAST({nulls} AS BIGINT) FROM {t}")
    for t, c in (("ratings_summary", "movie_id"), ("popular_movies", "movie_id"), ("recs15", "movie_id"),
                 ("recs15", "recommended_movie_id")):
        parts.append(f"SELECT '{label.get(t, t)}', 'references_movies:{c}', CAST(count(*) AS BIGINT) FROM {t} x "
                     f"WHERE NOT EXISTS (SELECT 1 FROM movies m WHERE m.movie_id = x.{c})")
    parts.append("SELECT 'movies', 'genre_filter:promo', CAST(count(*) AS BIGINT) FROM "
                 "(SELECT * FROM catalog_view WHERE genres ILIKE '%promo%' ORDER BY "
                 f"{SORT_SQL['popularity']} LIMIT 50) WHERE NOT contains(lower(genres), 'promo')")
    return "\nUNION ALL\n".join(parts)


LEGACY_TYPES = """types AS (
  SELECT p_type AS name, CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS id
  FROM (SELECT DISTINCT p_type FROM part)),
ntypes AS (SELECT count(*) AS t FROM types),
legacy AS (
  SELECT CAST(p_partkey AS BIGINT) AS movie_id,
         CASE WHEN p_partkey % 9 = 0 THEN p_name ELSE p_name || ' (' || CAST(1960 + p_size AS VARCHAR) || ')' END AS title,
         CASE WHEN p_partkey % 13 = 0 THEN '' ELSE
           lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || '-' ||
           ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][p_partkey % 12 + 1] || '-' ||
           CAST(1960 + p_size AS VARCHAR) END AS release_date,
         p_partkey, p_type, p_size
  FROM part),
flags AS (
  SELECT l.movie_id, t.name, t.id FROM legacy l, types t, ntypes n
  WHERE l.p_partkey % 11 <> 0 AND (l.p_type = t.name OR 1 + l.p_size % n.t = t.id))"""


def _sql_misc() -> dict[str, str]:
    q: dict[str, str] = {}
    q["catalog_append"] = with_(RAW_MOVIES, FEED, NEW_ITEMS) + "SELECT movie_id, title, genres, seed_rating FROM new_items"
    q["catalog_append_ratings"] = with_(RAW_MOVIES, FEED, NEW_ITEMS) + """
SELECT CAST(u AS BIGINT) AS user_id, n.movie_id,
       greatest(CAST(0.5 AS DOUBLE), least(CAST(5.0 AS DOUBLE),
                n.seed_rating + CAST((n.movie_id * 31 + u) % 3 - 1 AS DOUBLE) * 0.5)) AS rating,
       (SELECT CAST(max(epoch(o_orderdate)) AS BIGINT) FROM orders) AS "timestamp"
FROM new_items n, range(900, 910) AS t(u)"""
    q["catalog_after_append"] = with_(RAW_MOVIES, FEED, NEW_ITEMS) + """
SELECT movie_id, title, genres FROM raw_movies UNION ALL SELECT movie_id, title, genres FROM new_items"""
    q["dq_checks"] = with_(*SERVING, *_nn(15), DQ_TABLES) + _dq_sql()
    q["dq_neighbours"] = with_(*SERVING, *_nn(15), DQ_TABLES) + """
, lagged AS (SELECT *, lag(similarity_score) OVER (PARTITION BY movie_id ORDER BY rank) AS prev FROM recs15)
SELECT count(*) AS rows,
       sum(CASE WHEN NOT (similarity_score BETWEEN 0.0 AND 1.0) THEN 1 ELSE 0 END) AS score_out_of_range,
       sum(CASE WHEN movie_id = recommended_movie_id THEN 1 ELSE 0 END) AS self_pairs,
       sum(CASE WHEN prev < similarity_score THEN 1 ELSE 0 END) AS order_violations,
       (SELECT CAST(count(*) FILTER (WHERE mx <> n OR mn <> 1) AS BIGINT) FROM
          (SELECT movie_id, count(*) AS n, max(rank) AS mx, min(rank) AS mn FROM recs15 GROUP BY movie_id)) AS rank_gaps
FROM lagged"""
    q["dq_popular"] = with_(*SERVING) + """
, board AS (SELECT p.rank, p.popularity_score, s.rating_count FROM popular_movies p
            JOIN movies m ON p.movie_id = m.movie_id JOIN ratings_summary s ON m.movie_id = s.movie_id
            ORDER BY p.rank LIMIT 10)
SELECT count(*) AS rows, CAST(max(rank) - count(*) AS BIGINT) AS rank_gap,
       sum(CASE WHEN popularity_score <= 0 THEN 1 ELSE 0 END) AS non_positive_score,
       sum(CASE WHEN rating_count <= 0 THEN 1 ELSE 0 END) AS no_votes
FROM board"""
    q["raw_catalog"] = with_(RAW_MOVIES) + "SELECT * FROM raw_movies"
    q["raw_ratings"] = with_(RAW_RATINGS) + "SELECT * FROM raw_ratings"
    q["legacy_genres"] = with_(LEGACY_TYPES) + "SELECT 0 AS id, 'unknown' AS name UNION ALL SELECT id, name FROM types"
    q["compile_genres"] = with_(LEGACY_TYPES) + """
SELECT l.movie_id, l.title, coalesce(g.genres, 'Unknown') AS genres
FROM legacy l LEFT JOIN (SELECT movie_id, string_agg(name, '|' ORDER BY id) AS genres FROM flags GROUP BY movie_id) g
  ON l.movie_id = g.movie_id"""
    q["year_with_fallback"] = with_(LEGACY_TYPES) + f"""
SELECT movie_id,
       coalesce(TRY_CAST(regexp_extract(title, '\\((\\d{{4}})\\)', 1) AS INTEGER),
                TRY_CAST(regexp_extract(release_date, '(\\d{{4}}){WS}*$', 1) AS INTEGER), 0) AS release_year
FROM legacy"""
    q["sink_roundtrip"] = with_(*CORE) + "SELECT * FROM transformed"
    q["serving_movies"] = with_(RAW_MOVIES, CLEAN_MOVIES) + "SELECT movie_id, title, genres, release_year FROM clean_movies"
    q["serving_recommendations"] = content_topk_sql(15)
    q["serving_popular_movies"] = with_(*CORE, POPULAR.format(n=50)) + "SELECT * FROM popular_movies"
    q["serving_ratings_summary"] = with_(*BASE, SUMMARY) + "SELECT * FROM ratings_summary"
    disp = ("CASE WHEN regexp_matches(dt, '(?i)^(.*?),\\s*(The|A|An)(\\s*\\(.*\\))?$') "
            "THEN regexp_replace(dt, '(?i)^(.*?),\\s*(The|A|An)(\\s*\\(.*\\))?$', '\\2 \\1\\3') ELSE dt END")
    q["display_card"] = with_(*SERVING, REQUESTS, ID_REQS, *_nn(5), *recommend_ctes(5)) + f"""
SELECT request_id, rank, movie_id, {disp} AS display_title,
       array_to_string(string_split(coalesce(genres, ''), '|'), ' • ') AS genres_display,
       CAST(floor(similarity_score * 100 + 0.5) AS INTEGER) AS match_pct,
       CASE WHEN coalesce(avg_rating, 0.0) = 0 THEN 'N/A' ELSE printf('%.1f', floor(avg_rating * 10 + 0.5) / 10) END
         AS rating_text,
       coalesce(CASE WHEN release_year <> 0 THEN release_year END,
                TRY_CAST(regexp_extract(title, '\\((\\d{{4}})\\){WS}*$', 1) AS INTEGER)) AS year_display
FROM (SELECT *, {_trim("regexp_replace(title, '\\s*\\(\\d{4}\\)\\s*$', '')")} AS dt FROM rec_rows
      WHERE status <> 'not_found')"""
    q["request_validation"] = with_(REQUESTS, KEYED_REQS) + f"""
SELECT request_key, top_k, reason = 'ok' AS valid, reason FROM (
  SELECT request_key, top_k,
         CASE WHEN request_id IS NULL AND coalesce({_trim('title')}, '') = '' THEN 'missing_id_and_title'
              WHEN NOT (top_k BETWEEN 1 AND 100) THEN 'top_k_out_of_range' ELSE 'ok' END AS reason
  FROM (SELECT *, CASE WHEN request_id IS NOT NULL THEN CAST(request_id % 120 AS INTEGER) ELSE 10 END AS top_k
        FROM keyed))"""
    return q


ORACLE_SQL.update(_sql_misc())


def _metrics_sql() -> str:
    vals = {
        "raw_movie_count": "(SELECT count(*) FROM raw_movies)",
        "raw_rating_count": "(SELECT count(*) FROM raw_ratings)",
        "duplicate_movies": "(SELECT count(*) - count(DISTINCT movie_id) FROM raw_movies)",
        "duplicate_ratings": "(SELECT count(*) FROM raw_ratings) - (SELECT count(*) FROM dedup_ratings)",
        "invalid_ratings": f"(SELECT count(*) FROM raw_ratings WHERE NOT {VALID})",
        "orphan_ratings": "(SELECT count(*) FROM raw_ratings r WHERE NOT EXISTS "
                          "(SELECT 1 FROM raw_movies m WHERE m.movie_id = r.movie_id))",
        "user_count": "0",
        "movies_initial": "(SELECT count(*) FROM raw_movies)",
        "movies_cleaned": "(SELECT count(*) FROM clean_movies)",
        "movies_deduplicated": "(SELECT count(*) FROM raw_movies) - (SELECT count(*) FROM clean_movies)",
        "ratings_initial": "(SELECT count(*) FROM raw_ratings)",
        "ratings_cleaned": "(SELECT count(*) FROM clean_ratings)",
        "ratings_deduplicated": "(SELECT count(*) FROM raw_ratings) - (SELECT count(*) FROM dedup_ratings)",
        "ratings_invalid_dropped": "(SELECT count(*) FROM dedup_ratings) - (SELECT count(*) FROM bounded_ratings)",
        "ratings_orphans_dropped": "(SELECT count(*) FROM bounded_ratings) - (SELECT count(*) FROM clean_ratings)",
        "transformed_movies_count": "(SELECT count(*) FROM clean_movies)",
        "movies_with_ratings": "(SELECT count(*) FROM ratings_summary)",
        "mean_rating_count": f"(SELECT {sql_round_even('avg(rating_count)', 2)} FROM ratings_summary)",
        "max_rating_count": "(SELECT max(rating_count) FROM ratings_summary)",
        "global_rating_mean": f"(SELECT {sql_round_even('c', 2)} FROM gm)",
        "total_recommendations": "(SELECT count(*) FROM nn)",
        "movies_with_recommendations": "(SELECT count(DISTINCT src) FROM nn)",
        "avg_similarity_score": "(SELECT round_even(sum(round_even(similarity_score * 1e4, 0)) / count(*), 0) "
                                "/ 1e4 FROM nn)",
        "total_popular_movies": "(SELECT count(*) FROM popular_movies)",
    }
    rows = "\nUNION ALL\n".join(f"SELECT '{k}' AS metric, CAST({v} AS DOUBLE) AS value" for k, v in vals.items())
    return with_(*CORE, POPULAR.format(n=50), FEATURE_DOCS, *tfidf_ctes("feature_docs"), *topk_ctes(100)) + rows


ORACLE_SQL["pipeline_metrics"] = _metrics_sql()


ORACLE_SQL["catalog_append_stream"] = ORACLE_SQL["catalog_append"]
ORACLE_SQL["feed_page_status"] = with_(RAW_MOVIES, FEED) + """
, p AS (SELECT DISTINCT page, (SELECT max(page) FROM feed) AS top FROM feed),
k AS (SELECT page, CASE WHEN page <> top - 4 AND page % 9 = 0 THEN 'raised' ELSE 'ok' END AS kind,
    CASE WHEN page = top - 4 THEN 2 ELSE 1 END AS landings FROM p)
SELECT page, kind, CAST(landings AS BIGINT) AS landings,
       page < (SELECT min(a) FROM (SELECT 1 AS a UNION SELECT page + 1 FROM k) WHERE a NOT IN (SELECT page FROM k)) AS passed
FROM k"""


def _after_append() -> str:
    """Items and their seed ratings joined to the raw tables, then the usual summary."""
    before = RAW_MOVIES.replace("raw_movies AS", "old_movies AS")
    new = NEW_ITEMS.replace("raw_movies", "old_movies")
    ratings = RAW_RATINGS.replace("raw_ratings AS", "old_ratings AS")
    movies = "raw_movies AS (SELECT movie_id, title, genres FROM old_movies UNION ALL SELECT movie_id, title, genres FROM new_items)"
    seeds = """raw_ratings AS (SELECT * FROM old_ratings UNION ALL
  SELECT CAST(u AS BIGINT), n.movie_id, greatest(CAST(0.5 AS DOUBLE), least(CAST(5.0 AS DOUBLE),
         n.seed_rating + CAST((n.movie_id * 31 + u) % 3 - 1 AS DOUBLE) * 0.5)),
         (SELECT CAST(max(epoch(o_orderdate)) AS BIGINT) FROM orders)
  FROM new_items n, range(900, 910) AS t(u))"""
    return with_(before, FEED, new, ratings, movies, seeds, CLEAN_MOVIES, DEDUP_RATINGS, SUMMARY) + "SELECT * FROM ratings_summary"


ORACLE_SQL["summary_after_append"] = _after_append()
ORACLE_SQL["cache_versioned"] = ORACLE_SQL["cache_upsert"]


def _sql_extra() -> dict[str, str]:
    q: dict[str, str] = {}
    q["legacy_ratings_tsv"] = with_(RAW_RATINGS) + "SELECT * FROM raw_ratings"
    q["sql_on_parquet_path"] = (with_(*BASE, SUMMARY)
                                + "SELECT movie_id, avg_rating, rating_count FROM ratings_summary WHERE rating_count >= 40")
    base = (RAW_MOVIES, CLEAN_MOVIES, HITS, LINK_ITEMS, *link_ctes("link_items"))
    old = ("items_old AS (SELECT * FROM link_items WHERE release_year <= 1985)", *_rename_links("_old"),
           records_cte("recs_old", "items_old", "links_old"))
    new = ("items_new AS (SELECT * FROM link_items WHERE release_year > 1985)", *_rename_links("_new"),
           records_cte("recs_new", "items_new", "links_new"))
    q["media_cache_json"] = with_(*base, DETAILS, *old, *new) + """
SELECT movie_id, found, meta_id FROM recs_old UNION ALL SELECT movie_id, found, meta_id FROM recs_new"""
    q["enrich_progress"] = with_(*base, DETAILS, *old, *new) + """
SELECT (SELECT count(*) FROM link_items) AS catalog_count, (SELECT count(*) FROM recs_old) AS cached_count,
       count(*) AS todo_count, count(*) AS done_count, CAST(sum(CASE WHEN found THEN 1 ELSE 0 END) AS BIGINT) AS matched_count,
       round_even(100.0 * (count(*) FILTER (WHERE found) + (SELECT count(*) FROM recs_old WHERE found))
                  / (SELECT count(*) FROM link_items) * 10, 0) / 10 AS coverage_pct
FROM recs_new"""
    q["source_readiness"] = with_(RAW_MOVIES, RAW_RATINGS, LEGACY_TYPES) + """
, c AS (SELECT 'movies' AS source, count(*) AS row_count FROM raw_movies UNION ALL SELECT 'ratings', count(*) FROM raw_ratings
  UNION ALL SELECT 'legacy_ratings', count(*) FROM raw_ratings UNION ALL SELECT 'legacy_genres', 1 + count(*) FROM types)
SELECT source, row_count, row_count > 0 AS ready FROM c"""
    q["csv_roundtrip"] = with_(*BASE, SUMMARY) + "SELECT * FROM ratings_summary"
    q["store_status"] = (f"SELECT c.*, CASE WHEN (SELECT bool_and(ok) FROM ({ORACLE_SQL['table_counts']})) THEN 'healthy' ELSE 'unhealthy' END AS status "
                         f"FROM ({ORACLE_SQL['table_counts']}) c")
    q["leaderboard_top5"] = with_(*SERVING) + """
SELECT CAST(row_number() OVER (ORDER BY rating_count DESC, movie_id) AS INTEGER) AS rank,
       movie_id, title, genres, release_year, avg_rating, rating_count, popularity_score
FROM rated ORDER BY rating_count DESC, movie_id LIMIT 5"""
    q["media_view"] = with_(*SERVING, HITS, LINK_ITEMS, *link_ctes("link_items"), DETAILS,
                            records_cte("recs", "link_items", "links")) + """
SELECT r.movie_id, r.found, c.title, coalesce(r.overview, '') AS overview, coalesce(r.director, '') AS director,
       coalesce(r.cast_names, '') AS cast_text, coalesce(r.tagline, '') AS tagline, r.meta_id,
       '/api/media/image/w500/' || ltrim(nullif(r.poster_path, ''), '/') AS poster_url,
       '/api/media/image/w1280/' || ltrim(nullif(r.backdrop_path, ''), '/') AS backdrop_url,
       CASE WHEN r.runtime IS NOT NULL AND r.runtime <> 0
            THEN CAST(CAST(floor(r.runtime / 60) AS BIGINT) AS VARCHAR) || 'h ' || CAST(r.runtime % 60 AS VARCHAR) || 'm'
       END AS runtime_text,
       CASE WHEN coalesce(r.meta_rating, 0.0) <> 0
            THEN printf('%.1f', floor(r.meta_rating * 10 + 0.5) / 10) END AS meta_rating_text,
       format('{:,}', c.rating_count) AS votes_text,
       r.trailer_key
FROM recs r JOIN catalog_view c ON r.movie_id = c.movie_id"""
    return q


ORACLE_SQL.update(_sql_extra())
