"""DuckDB SQL for the chart queries, over the same derived tables."""

from __future__ import annotations

#: The derived tables, as in ``sources.dataset``.
BASE = """
WITH places AS (
  SELECT s_suppkey, r_regionkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), weekly AS (
  SELECT r_regionkey, r_name, l_shipdate::date - ((isodow(l_shipdate::date) + 3) % 7)::int AS week_start, l_partkey,
         sum(round(l_extendedprice * 100)::bigint)::bigint AS cents, count(DISTINCT l_suppkey) AS screens
  FROM lineitem JOIN places ON l_suppkey = s_suppkey GROUP BY ALL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY r_regionkey, week_start ORDER BY cents DESC, l_partkey) AS rank,
         min(week_start) OVER (PARTITION BY r_regionkey, l_partkey) AS first_week,
         (sum(cents) OVER (PARTITION BY r_regionkey, l_partkey ORDER BY week_start ROWS UNBOUNDED PRECEDING))::bigint AS total
  FROM weekly
), movie_ids AS (SELECT p_name, min(p_partkey) AS movie_id FROM part GROUP BY p_name
), named AS (
  SELECT p_partkey AS k, p_name, p_brand, movie_id,
         CASE WHEN p_partkey % 5 = 0 THEN '  ' || upper(p_name) || ' ' WHEN p_partkey % 7 = 3 THEN replace(p_name, 'o', 'ò') ELSE p_name END AS title,
         CASE p_partkey % 7 WHEN 0 THEN 'unmatched' WHEN 1 THEN 'needs_review' WHEN 2 THEN 'no_match' WHEN 3 THEN 'manual' ELSE 'auto' END AS status
  FROM part JOIN movie_ids USING (p_name)
), fact AS (
  SELECT (k * 1000 + floor((week_start - date '1994-01-06') / 7)::bigint) * 10 + r_regionkey AS id, r_name AS territory, week_start, week_start + 3 AS week_end, rank,
         title, lower(trim(title)) AS title_key, p_brand AS distributor,
         CASE WHEN k % 29 = 0 THEN NULL WHEN k % 17 = 0 THEN 2 * cents ELSE cents END AS weekly_gross,
         CASE WHEN k % 23 = 0 THEN cents - 1 ELSE total END AS total_gross, CASE WHEN k % 31 = 0 THEN 0 ELSE screens END AS screen_count,
         floor((week_start - first_week) / 7)::bigint + 1 AS weeks_in_release,
         CASE WHEN k % 17 = 0 THEN movie_id + 1 WHEN k % 13 = 0 OR status NOT IN ('auto', 'manual') THEN NULL ELSE movie_id END AS movie_id,
         CASE WHEN k % 19 <> 0 THEN k END AS source_movie_ref
  FROM placed JOIN named ON l_partkey = k
), films AS (
  SELECT k AS id, CASE WHEN k % 11 = 0 THEN 'legacy:' || lower(trim(title)) ELSE k::varchar END AS source_movie_id, title, lower(trim(title)) AS title_key,
         CASE WHEN status IN ('auto', 'manual') THEN movie_id END AS movie_id, status AS match_status,
         CASE WHEN status = 'manual' OR (status = 'no_match' AND k % 2 = 0) THEN 'manual' WHEN status = 'auto' THEN 'title_date' END AS match_method,
         (CASE WHEN status IN ('auto', 'needs_review') THEN 500 + k % 500 WHEN status = 'manual' THEN 1000 END)::bigint AS match_confidence
  FROM named
), movies AS (
  SELECT min(p_partkey) AS id, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS title, 'The ' || p_name AS original_title,
         date '1995-01-01' + (min(p_partkey) * 37 % 2000)::int AS release_date, min(p_retailprice) AS popularity, sum(round(p_retailprice * 100)::bigint)::bigint AS revenue
  FROM part GROUP BY p_name
), runs AS (
  SELECT event_id AS id, CASE WHEN user_id % 10 = 0 THEN 'weekly_chart_recovery' ELSE 'weekly_chart' END AS pipeline_name, epoch_us(ts) AS started_at,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'success' END AS status,
         CASE WHEN event_type <> 'signup' THEN epoch_us(ts) + 60000000 END AS finished_at
  FROM events
), candidates AS (
  SELECT id AS source_movie_id, id * 10 + k AS movie_id, 400 + (id * 7 + k * 131) % 600 AS score, CASE WHEN k <> 1 THEN id * 13 % 90 END AS popularity, k AS seq
  FROM (SELECT id, unnest(generate_series(0, id % 3)) AS k FROM films WHERE match_status IN ('needs_review', 'unmatched') AND id % 3 <> 0)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source_movie_id ORDER BY score DESC, coalesce(popularity, 0) DESC, seq) AS place FROM candidates
), last AS (SELECT territory, max(week_start) AS week_start FROM fact GROUP BY territory
), latest AS (SELECT fact.* FROM fact JOIN last USING (territory, week_start)
), stored AS (SELECT DISTINCT strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') AS timestamp FROM events WHERE event_type <> 'error'
), firsts AS (SELECT source_movie_ref, min(row(week_start, id, weeks_in_release)) AS x FROM fact GROUP BY 1
), first_weeks AS (
  SELECT films.*, struct_extract(x, 1) AS first_week, struct_extract(x, 3) AS first_weeks_in_release FROM films LEFT JOIN firsts ON source_movie_ref = films.id
), deduped AS (
  SELECT * FROM fact QUALIFY row_number() OVER (PARTITION BY territory, week_start, title_key ORDER BY coalesce(rank, 0), id) = 1
), reals AS (
  SELECT * FROM films WHERE source_movie_id NOT LIKE 'legacy:%' QUALIFY row_number() OVER (PARTITION BY title_key ORDER BY id) = 1
), inconsistent AS (
  SELECT fact.id, fact.movie_id, films.movie_id AS film_movie_id FROM fact JOIN films ON source_movie_ref = films.id WHERE fact.movie_id IS DISTINCT FROM films.movie_id
), ambiguous AS (SELECT title, count(DISTINCT movie_id) AS movies FROM fact GROUP BY title HAVING count(DISTINCT movie_id) > 1
), decisions AS (
  SELECT source_movie_id, CASE WHEN best IS NULL THEN 'no_match' WHEN best >= 0.85::double AND best - coalesce(second, 0) >= 0.10::double THEN 'auto' WHEN best >= 0.55::double THEN 'needs_review' ELSE 'no_match' END AS status
  FROM (SELECT source_movie_id, max(CASE WHEN place = 1 THEN score / 1000.0::double END) AS best, max(CASE WHEN place = 2 THEN score / 1000.0::double END) AS second FROM ranked GROUP BY 1)
), pairs AS (
  SELECT l.id AS legacy_id, r.id AS real_id, l.title_key, l.movie_id AS legacy_movie, l.match_status AS legacy_status, l.match_method AS legacy_method
  FROM films l JOIN reals r USING (title_key)
  WHERE l.source_movie_id LIKE 'legacy:%' AND (l.movie_id IS NULL OR r.movie_id IS NULL OR l.movie_id = r.movie_id)
), taken AS (SELECT * FROM pairs WHERE legacy_status IN ('auto', 'manual') QUALIFY row_number() OVER (PARTITION BY real_id ORDER BY legacy_id) = 1
), films1 AS (
  SELECT f.id, f.source_movie_id, f.title, f.title_key, CASE WHEN t THEN legacy_movie ELSE movie_id END AS movie_id, CASE WHEN t THEN legacy_status ELSE match_status END AS match_status,
         CASE WHEN t THEN legacy_method ELSE match_method END AS match_method
  FROM (SELECT films.*, taken.*, real_id IS NOT NULL AND match_status NOT IN ('auto', 'manual') AND match_method IS DISTINCT FROM 'manual' AS t FROM films LEFT JOIN taken ON real_id = films.id) f
), fact1 AS (SELECT fact.* REPLACE (coalesce(real_id, source_movie_ref) AS source_movie_ref) FROM fact LEFT JOIN pairs ON legacy_id = source_movie_ref
), films2 AS (SELECT * FROM films1 WHERE source_movie_id NOT LIKE 'legacy:%' OR id IN (SELECT source_movie_ref FROM fact1 WHERE source_movie_ref IS NOT NULL)
), reals2 AS (SELECT id AS r_id, title_key FROM films2 WHERE source_movie_id NOT LIKE 'legacy:%' QUALIFY row_number() OVER (PARTITION BY title_key ORDER BY id) = 1
), fact2 AS (SELECT fact1.* REPLACE (coalesce(source_movie_ref, r_id) AS source_movie_ref) FROM fact1 LEFT JOIN reals2 USING (title_key)
), films3 AS (
  SELECT * FROM films2 UNION ALL
  SELECT -min(id), 'legacy:' || title_key, min(title), title_key, NULL, 'unmatched', NULL FROM fact2 WHERE source_movie_ref IS NULL GROUP BY title_key
  HAVING 'legacy:' || title_key NOT IN (SELECT source_movie_id FROM films2)
), holders AS (SELECT id AS h_id, title_key FROM films3 WHERE source_movie_id LIKE 'legacy:%' QUALIFY row_number() OVER (PARTITION BY title_key ORDER BY id) = 1
), fact3 AS (SELECT fact2.* REPLACE (coalesce(source_movie_ref, h_id) AS source_movie_ref) FROM fact2 LEFT JOIN holders USING (title_key)
), adopted AS (SELECT source_movie_ref AS a_id, min(movie_id) AS a_movie FROM fact3 WHERE movie_id IS NOT NULL AND source_movie_ref IS NOT NULL GROUP BY 1 HAVING count(DISTINCT movie_id) = 1
), films4 AS (
  SELECT id, source_movie_id, CASE WHEN t THEN a_movie ELSE movie_id END AS movie_id, CASE WHEN t THEN 'auto' ELSE match_status END AS match_status, CASE WHEN t THEN 'legacy_exact_title' ELSE match_method END AS match_method
  FROM (SELECT *, a_id IS NOT NULL AND match_status = 'unmatched' AS t FROM films3 LEFT JOIN adopted ON a_id = id)
), fact4 AS (
  SELECT f.id, f.source_movie_ref, CASE WHEN m.match_status IN ('auto', 'manual') THEN m.movie_id ELSE f.movie_id END AS movie_id FROM fact3 f LEFT JOIN films4 m ON m.id = f.source_movie_ref
), anomalous AS (
  SELECT * FROM (SELECT fact.*, last.week_start AS high, lag(weekly_gross) OVER (PARTITION BY territory, fact.week_start ORDER BY rank, id) AS above FROM fact JOIN last USING (territory) WHERE fact.week_start >= last.week_start - 7 * {weeks})
  WHERE weekly_gross > above OR total_gross < weekly_gross
), disordered AS (
  SELECT * FROM (SELECT *, lag(weekly_gross IGNORE NULLS) OVER (PARTITION BY territory, week_start ORDER BY rank, id) AS above FROM fact) WHERE weekly_gross > above
), run AS (
  SELECT max_by(status, id) AS status, ((SELECT max(started_at) FROM runs) + 3 * 86400000000 - max(CASE WHEN status = 'success' THEN coalesce(finished_at, started_at) END)) / 86400000000.0::double AS age_days
  FROM runs WHERE pipeline_name = 'weekly_chart'
), run_level AS (
  SELECT status, age_days, CASE WHEN status IS NULL OR status = 'failed' OR age_days IS NULL OR age_days > 8 THEN 'FAIL' WHEN status = 'running' THEN 'WARN' ELSE 'OK' END AS level FROM run
), week_level AS (
  SELECT territory, week_start, age_days, titles, CASE WHEN age_days > 14 THEN 'FAIL' WHEN age_days > 10 OR titles < 10 THEN 'WARN' ELSE 'OK' END AS level
  FROM (SELECT territory, week_start, ((SELECT max(week_start) FROM fact) + 9 - week_start)::bigint AS age_days, count(*) AS titles FROM latest GROUP BY territory, week_start)
), gaps AS (
  SELECT territory, high - g * 7 AS expected
  FROM (SELECT territory, min(week_start) AS low, max(week_start) AS high, unnest(generate_series(0, 12))::int AS g FROM fact GROUP BY territory) b
  WHERE high - g * 7 >= low - 3 AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT territory, week_start FROM fact) f WHERE f.territory = b.territory AND f.week_start BETWEEN high - g * 7 - 3 AND high - g * 7 + 3)
), gap_level AS (SELECT count(*) AS missing, CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'OK' END AS level FROM gaps
), checks AS (
  SELECT name, n, CASE WHEN n = 0 THEN 'OK' WHEN name = 'links' THEN 'FAIL' ELSE 'WARN' END AS level FROM (
    SELECT 'links' AS name, count(*) AS n FROM inconsistent UNION ALL SELECT 'unlinked', count(*) FROM fact WHERE source_movie_ref IS NULL
    UNION ALL SELECT 'match queue', count(*) FROM films WHERE match_status IN ('unmatched', 'needs_review') UNION ALL SELECT 'ambiguous titles', count(*) FROM ambiguous)
), coverage AS (
  SELECT count(movie_id) AS with_movie, count(*) AS titles, CASE WHEN count(*) > 0 AND 100 * count(movie_id) >= 85 * count(*) THEN 'OK' ELSE 'WARN' END AS level FROM latest
), report AS (
  SELECT 1::bigint AS seq, 'last run' AS name, level FROM run_level UNION ALL SELECT 2, 'latest week', CASE WHEN count(*) = 0 OR bool_or(level = 'FAIL') THEN 'FAIL' WHEN bool_or(level = 'WARN') THEN 'WARN' ELSE 'OK' END FROM week_level UNION ALL SELECT 3, 'gaps', level FROM gap_level
  UNION ALL SELECT CASE name WHEN 'links' THEN 4 WHEN 'unlinked' THEN 5 WHEN 'match queue' THEN 6 ELSE 7 END, name, level FROM checks UNION ALL SELECT 8, 'coverage', level FROM coverage
  UNION ALL SELECT 9, 'anomalies', CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'OK' END FROM anomalous
), months AS (SELECT ['gennaio','febbraio','marzo','aprile','maggio','giugno','luglio','agosto','settembre','ottobre','novembre','dicembre'] AS m
), lines AS (
  SELECT user_id AS log_id, event_id AS seq, CASE event_type WHEN 'error' THEN 'Error: ' || props WHEN 'signup' THEN ' ' ELSE 'step ' || event_type END AS line FROM events
), relevant AS (
  SELECT log_id, seq, line FROM (SELECT *, line LIKE 'Error%' AS marked, bool_or(line LIKE 'Error%') OVER (PARTITION BY log_id) AS has FROM lines WHERE trim(line) <> '')
  WHERE marked OR NOT has QUALIFY row_number() OVER (PARTITION BY log_id ORDER BY seq DESC) <= 6
), week6 AS (SELECT date '2023-12-28' + 7 * i::int AS week_start FROM generate_series(0, 5) t(i)
), trials AS (
  SELECT week_start, row_number() OVER (PARTITION BY week_start ORDER BY timestamp DESC) AS trial, timestamp
  FROM week6 JOIN stored ON strptime(timestamp[1:8], '%Y%m%d')::date BETWEEN week_start + 3 AND week_start + 10 QUALIFY trial <= 5
)
"""

PER_SCREEN = "CASE WHEN screen_count > 0 THEN (2 * weekly_gross + screen_count) // (2 * screen_count) END"

#: Films that variants of a title find: by a word that is not frequent, or by all words where all are.
SEARCH = r""", t AS (SELECT films.title || CASE WHEN films.id % 5 = 1 THEN ' - the return' ELSE '' END AS title, min(week_start) AS week_start FROM films JOIN fact ON source_movie_ref = films.id GROUP BY 1),
      tried AS (SELECT title, unnest([0, 1, 2]) AS variant, unnest([trim(title), trim(regexp_replace(trim(title), '^\.+', '')), trim(regexp_replace(trim(title), '(\s+-\s+|:\s+).*$', ''))]) AS q FROM t),
      spelt AS (SELECT title, row_number() OVER (PARTITION BY title ORDER BY variant) - 1 AS variant, q FROM (SELECT title, min(variant) AS variant, q FROM tried GROUP BY title, q)),
      asked AS (SELECT DISTINCT title, variant, unnest(regexp_extract_all(lower(strip_accents(q)), '[a-z0-9]+')) AS word FROM spelt),
      called AS (SELECT DISTINCT id, unnest(regexp_extract_all(lower(strip_accents(title || ' ' || original_title)), '[a-z0-9]+')) AS word FROM movies),
      often AS (SELECT word FROM called GROUP BY word HAVING count(*) > 20 AND count(*) > 0.02 * (SELECT count(*) FROM movies)),
      hits AS (SELECT title, variant, id, word IN (SELECT word FROM often) AS frequent FROM asked JOIN called USING (word)),
      sizes AS (SELECT title, variant, count(*) AS n, bool_and(word IN (SELECT word FROM often)) AS all_frequent FROM asked GROUP BY 1, 2),
      found AS (SELECT title, id, min(variant) AS variant FROM (
        SELECT title, variant, id FROM hits JOIN sizes USING (title, variant) GROUP BY 1, 2, 3 HAVING bool_or(NOT frequent) OR (bool_and(all_frequent) AND count(*) = max(n))) GROUP BY 1, 2)
      """

#: Decisions about the films that wait, by fresh candidates; those with an id that 13 divides have no title.
RESOLVE = """, fresh AS (SELECT *, row_number() OVER (PARTITION BY source_movie_id ORDER BY score DESC, coalesce(popularity, 0) DESC, seq) AS place
        FROM (SELECT source_movie_id, movie_id, 300 + score * 7 % 700 AS score, popularity, seq FROM candidates WHERE seq < 2)),
      waiting AS (SELECT id FROM films WHERE match_status IN ('unmatched', 'needs_review') AND match_method IS DISTINCT FROM 'manual'),
      best AS (SELECT source_movie_id, max(score) FILTER (place = 1) AS best, max(score) FILTER (place = 2) AS second, max(movie_id) FILTER (place = 1) AS best_id FROM fresh GROUP BY 1),
      done AS (SELECT id AS ref, best, best_id, CASE WHEN best IS NULL THEN 'no_match' WHEN best / 1000.0::double >= 0.85::double AND best / 1000.0::double - coalesce(second, 0) / 1000.0::double >= 0.10::double THEN 'auto'
        WHEN best / 1000.0::double >= 0.55::double THEN 'needs_review' ELSE 'no_match' END AS status FROM waiting LEFT JOIN best ON source_movie_id = id WHERE id % 13 <> 0)
      """

SQL = {
    "weekly_trend": "SELECT territory, week_start, sum(weekly_gross)::bigint AS total_gross, count(*) AS titles FROM fact GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY territory ORDER BY week_start DESC) <= 8",
    "latest_week": "SELECT * FROM last",
    "latest_week_status": "SELECT territory, week_start, count(*) AS titles FROM latest GROUP BY 1, 2",
    "movie_id_coverage": "SELECT territory, count(movie_id) AS with_movie, count(*) AS titles FROM latest GROUP BY 1",
    "top_titles": "SELECT territory, rank, title, weekly_gross, screen_count FROM latest QUALIFY row_number() OVER (PARTITION BY territory ORDER BY rank, id) <= 5",
    "sample_latest": "SELECT id, territory, week_start, rank, title FROM fact ORDER BY week_start DESC, rank, territory, id LIMIT 5",
    "match_queue": "SELECT match_status, count(*) AS n FROM films WHERE match_status IN ('unmatched', 'needs_review') GROUP BY 1",
    "match_status_counts": "SELECT match_status, count(*) AS n FROM films GROUP BY 1",
    "ambiguous_titles": "SELECT * FROM ambiguous",
    "adoptable_matches": "SELECT source_movie_ref, min(movie_id) AS movie_id FROM fact WHERE source_movie_ref IS NOT NULL GROUP BY 1 HAVING count(DISTINCT movie_id) = 1",
    "legacy_titles": "SELECT 'box' AS source_name, title_key, min(title) AS title, 'legacy:' || title_key AS source_movie_id FROM fact WHERE source_movie_ref IS NULL GROUP BY title_key",
    "duplicate_keys": "SELECT territory, week_start, title_key, count(*) AS n FROM fact GROUP BY ALL HAVING count(*) > 1",
    "unlinked_rows": "SELECT count(*) FILTER (source_movie_ref IS NULL) AS unlinked, count(*) AS total FROM fact",
    "first_real_per_title": "SELECT id, title_key FROM reals",
    "dedupe_week_title": "SELECT id, territory, week_start, title_key, rank FROM deduped",
    "merge_duplicates": """SELECT id, territory, week_start, title_key, coalesce(movie_id, next_movie) AS movie_id, coalesce(source_movie_ref, next_ref) AS source_movie_ref FROM (
      SELECT *, row_number() OVER w AS n, lead(movie_id) OVER w AS next_movie, lead(source_movie_ref) OVER w AS next_ref FROM fact WINDOW w AS (PARTITION BY territory, week_start, title_key ORDER BY weeks_in_release DESC, id DESC)) WHERE n = 1""",
    "rank_candidates": "SELECT source_movie_id, movie_id, score, place FROM ranked",
    "first_seen_distinct": "SELECT movie_id, min(id) AS id FROM fact WHERE movie_id IS NOT NULL GROUP BY 1",
    "retention_prune": """SELECT user_id AS "group", 'backup-' || event_id AS path FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, 'backup-' || event_id DESC) AS n FROM events)
      WHERE n > 3 AND epoch_us(ts) < (SELECT max(epoch_us(ts)) FROM events) - 10 * 86400000000""",
    "top_revenue_paged": "SELECT id, revenue, (n - 1) // 4 + 1 AS page FROM (SELECT id, revenue, row_number() OVER (ORDER BY revenue DESC, id) AS n FROM movies) WHERE n <= 20",
    "weekly_enriched": f"""SELECT fact.id, territory, week_start, rank, fact.title, weekly_gross, screen_count, {PER_SCREEN} AS gross_per_screen, match_status, movies.title AS movie_title, release_date
      FROM fact LEFT JOIN films ON source_movie_ref = films.id LEFT JOIN movies ON fact.movie_id = movies.id""",
    "gross_per_screen": f"SELECT id, {PER_SCREEN} AS gross_per_screen FROM fact",
    "movie_id_inconsistent": "SELECT * FROM inconsistent",
    "first_week_per_title": "SELECT id, first_week, first_weeks_in_release FROM first_weeks",
    "pending_matches": "SELECT id, match_status, first_week, first_weeks_in_release FROM first_weeks WHERE match_status IN ('unmatched', 'no_match') AND match_method IS DISTINCT FROM 'manual'",
    "legacy_pairs": "SELECT legacy_id, real_id, title_key FROM pairs",
    "legacy_orphans": "SELECT id, source_movie_id FROM films WHERE source_movie_id LIKE 'legacy:%' AND id NOT IN (SELECT source_movie_ref FROM fact WHERE source_movie_ref IS NOT NULL)",
    "review_queue": """SELECT films.id, title, coalesce(string_agg(c.movie_id::varchar, ',' ORDER BY score DESC, c.movie_id), '') AS movie_ids FROM films LEFT JOIN candidates c ON c.source_movie_id = films.id
      WHERE match_status = 'needs_review' GROUP BY films.id, title""",
    "snapshot_list": "SELECT timestamp FROM stored",
    "snapshot_candidates": "SELECT * FROM trials",
    "recover_week": """SELECT week_start, arg_min(timestamp, trial) AS timestamp, min(trial) AS trial FROM (
      SELECT *, strptime(timestamp[1:8], '%Y%m%d')::date AS day, timestamp[9:10]::int AS hour FROM trials)
      WHERE day - ((isodow(day) + 3) % 7)::int - CASE WHEN hour % 3 = 0 THEN 0 ELSE 7 END = week_start AND hour + 2 >= 10 GROUP BY week_start""",
    "missing_weeks": """, thin AS (SELECT DISTINCT territory, week_start FROM fact WHERE ((week_start - date '1994-01-06') / 7.0::double) % 4 <> 0)
      SELECT territory, high - g * 7 AS expected FROM (SELECT territory, min(week_start) AS low, max(week_start) AS high, unnest(generate_series(0, 400))::int AS g FROM thin GROUP BY territory) b
      WHERE high - g * 7 >= low - 3 AND NOT EXISTS (SELECT 1 FROM thin WHERE thin.territory = b.territory AND thin.week_start BETWEEN high - g * 7 - 3 AND high - g * 7 + 3)""",
    "backfill_weeks": "SELECT territory, week_start, week_end, count(*) AS titles FROM fact WHERE week_start BETWEEN date '2000-06-29' - 7 * 29 AND date '2000-06-29' AND (date '2000-06-29' - week_start) % 7 = 0 GROUP BY ALL",
    "anomalies": "SELECT id, territory, week_start, rank, weekly_gross, above, total_gross FROM anomalous",
    "validate_order": "SELECT id, weekly_gross, above FROM disordered",
    "validate_batch": """SELECT territory, week_start, titles, titles NOT BETWEEN 10 AND 20 AS odd_size, double_ranks, double_titles, low_totals, coalesce(disordered, 0) AS disordered FROM (
      SELECT territory, week_start, count(*) AS titles, count(rank) - count(DISTINCT rank) AS double_ranks, count(title) - count(DISTINCT title) AS double_titles, count(*) FILTER (total_gross < weekly_gross) AS low_totals FROM fact GROUP BY 1, 2)
      LEFT JOIN (SELECT territory, week_start, count(*) AS disordered FROM disordered GROUP BY 1, 2) USING (territory, week_start)""",
    "constraint_violations": """SELECT 'week_end_before_start' AS name, count(*) AS n FROM fact WHERE week_end < week_start UNION ALL SELECT 'rank_not_positive', count(*) FROM fact WHERE rank <= 0
      UNION ALL SELECT 'status_unknown', count(*) FROM films WHERE match_status NOT IN ('unmatched', 'auto', 'manual', 'needs_review', 'no_match') UNION ALL SELECT 'confidence_out_of_range', count(*) FROM films WHERE match_confidence NOT BETWEEN 0 AND 1000
      UNION ALL SELECT 'movie_without_decision', count(*) FROM films WHERE (movie_id IS NULL) = (match_status IN ('auto', 'manual'))
      UNION ALL SELECT 'natural_key_twice', count(*) FROM (SELECT 1 FROM fact GROUP BY territory, week_start, title_key HAVING count(*) > 1)
      UNION ALL SELECT 'source_id_twice', count(*) FROM (SELECT 1 FROM films GROUP BY source_movie_id HAVING count(*) > 1)
      UNION ALL SELECT 'film_missing', count(*) FROM fact WHERE source_movie_ref IS NOT NULL AND source_movie_ref NOT IN (SELECT id FROM films)
      UNION ALL SELECT 'movie_missing', count(*) FROM fact WHERE movie_id IS NOT NULL AND movie_id NOT IN (SELECT id FROM movies)""",
    "quarantine_split": "SELECT id, CASE WHEN weekly_gross IS NULL THEN 'no gross' WHEN total_gross < weekly_gross THEN 'total below week' WHEN screen_count <= 0 THEN 'no screens' WHEN source_movie_ref IS NULL THEN 'no film' END AS reason FROM fact",
    "last_success_age": "SELECT round(age_days, 6) AS age_days FROM run",
    "health_last_run": "SELECT status, level FROM run_level",
    "health_latest_week": "SELECT * FROM week_level",
    "health_gaps": "SELECT * FROM gap_level",
    "health_integrity": "SELECT * FROM checks",
    "health_coverage": "SELECT * FROM coverage",
    "health_report": "SELECT * FROM report",
    "health_details": """, m AS (
        SELECT 1 AS seq, 'last run: ' || coalesce(status, 'none') AS message FROM run_level
        UNION ALL SELECT 2, 'the oldest latest week is ' || coalesce(max(age_days), 0) || ' days old' FROM week_level
        UNION ALL SELECT 3, CASE WHEN count(*) = 0 THEN 'no week is missing' ELSE count(*) || ' missing: ' || (SELECT string_agg(expected::varchar, ', ' ORDER BY expected) FROM (SELECT DISTINCT expected FROM gaps ORDER BY expected LIMIT 6)) END FROM gaps
        UNION ALL SELECT 4, n || ' rows with another movie than their film' FROM checks WHERE name = 'links' UNION ALL SELECT 5, n || ' rows without film' FROM checks WHERE name = 'unlinked'
        UNION ALL SELECT 6, n || ' films wait' FROM checks WHERE name = 'match queue'
        UNION ALL SELECT 7, CASE WHEN count(*) = 0 THEN 'no title has several movies' ELSE count(*) || ' titles with several movies: ' || (SELECT string_agg(title, ', ' ORDER BY title) FROM (SELECT title FROM ambiguous ORDER BY title LIMIT 4)) END FROM ambiguous
        UNION ALL SELECT 8, with_movie || ' of ' || titles || ' rows of the latest weeks have a movie' FROM coverage UNION ALL SELECT 9, count(*) || ' odd rows in the last weeks' FROM anomalous)
      SELECT seq, name, level, message FROM report JOIN m USING (seq)""",
    "export_gate": "SELECT count(*) FILTER (level = 'FAIL') AS failures, count(*) FILTER (level = 'WARN') AS warnings, count(*) FILTER (level = 'FAIL') = 0 AS export FROM report",
    "upsert_weekly": """, old AS (SELECT * FROM deduped WHERE id % 3 <> 0), new AS (SELECT * REPLACE (weekly_gross + 1 AS weekly_gross, CASE WHEN id % 2 = 0 THEN movie_id END AS movie_id) FROM deduped WHERE id % 3 <> 1)
      SELECT coalesce(o.id, n.id) AS id, territory, week_start, title_key, CASE WHEN n.id IS NOT NULL THEN n.rank ELSE o.rank END AS rank, CASE WHEN n.id IS NOT NULL THEN n.weekly_gross ELSE o.weekly_gross END AS weekly_gross,
        coalesce(n.movie_id, o.movie_id) AS movie_id, coalesce(n.source_movie_ref, o.source_movie_ref) AS source_movie_ref FROM old o FULL JOIN new n USING (territory, week_start, title_key)""",
    "upsert_source": """, s AS (SELECT id, id::varchar AS source_movie_id, title, match_status, CASE WHEN id % 2 = 0 THEN '/film/' || id END AS source_url FROM films),
      o AS (SELECT * FROM s WHERE id % 5 > 0), n AS (SELECT source_movie_id, upper(title) AS title, CASE WHEN id % 3 = 0 THEN '/new' END AS source_url, 'unmatched' AS match_status FROM s WHERE id % 5 < 3)
      SELECT source_movie_id, coalesce(n.title, o.title) AS title, coalesce(n.source_url, o.source_url) AS source_url, coalesce(o.match_status, n.match_status) AS match_status FROM o FULL JOIN n USING (source_movie_id)""",
    "upsert_movies": """SELECT id, coalesce(n.title, o.title) AS title, coalesce(n.popularity, o.popularity) AS popularity FROM (SELECT * FROM movies WHERE id % 3 > 0) o FULL JOIN (SELECT id, title, popularity + 1 AS popularity FROM movies WHERE id % 3 < 2) n USING (id)""",
    "insert_absent": "SELECT id, CASE WHEN id % 3 > 0 THEN popularity ELSE 0 END AS popularity FROM movies",
    "replace_candidates": "SELECT source_movie_id, movie_id, CASE WHEN source_movie_id % 4 = 0 THEN score + 1 ELSE score END AS score FROM candidates WHERE source_movie_id % 4 <> 1",
    "propagate_match": """SELECT fact.id, CASE WHEN c THEN f.movie_id ELSE fact.movie_id END AS movie_id, c AS changed
      FROM (SELECT fact.*, f.id IS NOT NULL AND fact.movie_id IS DISTINCT FROM f.movie_id AS c FROM fact LEFT JOIN (SELECT * FROM films WHERE match_status IN ('auto', 'manual')) f ON f.id = source_movie_ref) fact LEFT JOIN films f ON f.id = source_movie_ref""",
    "manual_override": """SELECT id, CASE WHEN h THEN CASE WHEN id % 4 = 3 THEN id + 1 END ELSE movie_id END AS movie_id, CASE WHEN h THEN CASE WHEN id % 4 = 3 THEN 'manual' ELSE 'no_match' END ELSE match_status END AS match_status,
      CASE WHEN h THEN 'manual' ELSE match_method END AS match_method, CASE WHEN h THEN CASE WHEN id % 4 = 3 THEN 1000 END ELSE match_confidence END AS match_confidence FROM (SELECT *, id % 10 = 3 AS h FROM films)""",
    "legacy_link_result": "SELECT * FROM fact4",
    "legacy_link_films": "SELECT * FROM films4",
    "legacy_link_counts": """SELECT count(*) FILTER (a.source_movie_ref IS NULL) AS linked, count(*) FILTER (a.source_movie_ref IS NOT NULL AND a.source_movie_ref <> b.source_movie_ref) AS promoted,
      count(*) FILTER (a.movie_id IS DISTINCT FROM b.movie_id) AS synced,
      count(*) FILTER (a.source_movie_ref IS NULL AND f.source_movie_id NOT LIKE 'legacy:%') AS linked_to_real, count(*) FILTER (a.source_movie_ref IS NULL AND f.source_movie_id LIKE 'legacy:%') AS linked_to_legacy,
      (SELECT count(*) FROM films4 WHERE id NOT IN (SELECT id FROM films)) AS legacy_created, (SELECT count(*) FROM films WHERE id NOT IN (SELECT id FROM films4)) AS legacy_removed,
      (SELECT count(*) FROM films4 WHERE match_method = 'legacy_exact_title') AS adopted
      FROM fact a JOIN fact4 b USING (id) LEFT JOIN films4 f ON f.id = b.source_movie_ref""",
    "payload_problems": """SELECT territory, unnest(['note: a text is expected', 'has_quality_warnings: true or false is expected', 'generated_at: an ISO date is expected']) AS problem FROM last
      UNION ALL SELECT territory, 'top_titles[' || i || ']: fields are missing or of another type' FROM (
        SELECT territory, weekly_gross, row_number() OVER (PARTITION BY territory ORDER BY rank, title) - 1 AS i FROM latest QUALIFY row_number() OVER (PARTITION BY territory ORDER BY rank, id) <= 5)
      WHERE weekly_gross IS NULL""",
    "load_batch": """, o AS (SELECT * FROM deduped WHERE id % 3 <> 0),
      n AS (SELECT *, min(id) OVER (PARTITION BY source_movie_ref) AS first FROM deduped WHERE id % 3 <> 1),
      r AS (SELECT n.id, n.territory, n.week_start, n.title_key, n.weekly_gross + 1 AS weekly_gross, CASE WHEN n.source_movie_ref % 4 = 1 THEN first ELSE n.source_movie_ref END AS source_movie_ref,
              coalesce(nullif(CASE WHEN n.id % 2 = 0 AND n.id % 7 <> 0 THEN n.movie_id END, 0), CASE WHEN n.source_movie_ref % 4 <> 1 THEN films.movie_id END) AS movie_id FROM n LEFT JOIN films ON films.id = n.source_movie_ref)
      SELECT coalesce(o.id, r.id) AS id, territory, week_start, title_key, CASE WHEN r.id IS NULL THEN o.weekly_gross ELSE r.weekly_gross END AS weekly_gross,
             coalesce(r.movie_id, o.movie_id) AS movie_id, coalesce(r.source_movie_ref, o.source_movie_ref) AS source_movie_ref, CASE WHEN r.id IS NULL THEN 1 ELSE 2 END::bigint AS ingestion_run_id,
             CASE WHEN o.id IS NULL THEN 200 ELSE 100 END::bigint AS created_at, CASE WHEN r.id IS NULL THEN 100 ELSE 200 END::bigint AS updated_at
      FROM o FULL JOIN r USING (territory, week_start, title_key)""",
    "load_count": "SELECT count(*) AS rows FROM deduped WHERE id % 3 <> 1",
    "refused_pages": """SELECT DISTINCT territory, week_start AS page_week, ((rank - 1) // 99)::bigint AS part,
      CASE dayofyear(week_start) % 4 WHEN 1 THEN 'the page names no week' WHEN 2 THEN 'the page has no entry' ELSE 'the page is of the week ' || week_start || '..' || week_end || ', which has no ' || (week_start + 30) END AS reason
      FROM fact WHERE weekly_gross IS NOT NULL AND dayofyear(week_start) % 4 <> 0""",
    "page_links": r"""SELECT page_id, (unnest(generate_series(1, len(x))) - 1)::bigint AS seq, unnest(list_transform(x, lambda a: regexp_extract(a, 'href="([^"]*)"', 1))) AS href,
             unnest(list_transform(x, lambda a: trim(regexp_extract(a, '>([^<]*)<', 1)))) AS text
      FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="[^"]*"[^>]*>[^<]*<') AS x FROM pages)""",
    "site_payload": r"""SELECT territory, sha256(document) AS document_sha256, length(document)::int AS n_chars FROM (
      SELECT territory, '{"source":"box","territory":"' || territory || '","currency":"EUR","latest_week":"' || week_start::varchar || '","weekly_trend":[' || trend || '],"top_titles":[' || top || ']}' AS document
      FROM last JOIN (SELECT territory, string_agg('{"week_start":"' || week_start::varchar || '"' || coalesce(',"total_gross":' || gross, '') || ',"titles":' || titles || '}', ',' ORDER BY week_start) AS trend
        FROM (SELECT territory, week_start, sum(weekly_gross)::bigint AS gross, count(*) AS titles FROM fact GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY territory ORDER BY week_start DESC) <= 8) GROUP BY 1) USING (territory)
      JOIN (SELECT territory, string_agg('{"rank":' || rank || ',"title":"' || title || '"' || coalesce(',"weekly_gross":' || weekly_gross, '') || coalesce(',"screen_count":' || screen_count, '') || '}', ',' ORDER BY rank, title) AS top
        FROM (SELECT * FROM latest QUALIFY row_number() OVER (PARTITION BY territory ORDER BY rank, id) <= 5) GROUP BY 1) USING (territory))""",
    "match_search": r""", t AS (SELECT title || CASE WHEN id % 5 = 1 THEN ' - the return' ELSE '' END AS title FROM films WHERE id IN (SELECT source_movie_ref FROM fact) GROUP BY 1),
      v AS (SELECT title, unnest([0, 1, 2]) AS variant, unnest([trim(title), trim(regexp_replace(trim(title), '^\.+', '')), trim(regexp_replace(trim(title), '(\s+-\s+|:\s+).*$', ''))]) AS q FROM t),
      w AS (SELECT title, row_number() OVER (PARTITION BY title ORDER BY variant) - 1 AS variant, q FROM (SELECT title, min(variant) AS variant, q FROM v GROUP BY title, q)),
      words AS (SELECT DISTINCT title, variant, unnest(regexp_extract_all(lower(strip_accents(q)), '[a-z0-9]+')) AS word FROM w),
      called AS (SELECT DISTINCT id, unnest(regexp_extract_all(lower(strip_accents(title || ' ' || original_title)), '[a-z0-9]+')) AS word FROM movies)
      SELECT title, id, min(variant)::bigint AS variant FROM words JOIN called USING (word) GROUP BY 1, 2""",
    "title_similarity": SEARCH + """, x AS (SELECT found.title, movies.title AS movie_title, array_to_string(regexp_extract_all(lower(strip_accents(found.title)), '[a-z0-9]+'), ' ') AS a, array_to_string(regexp_extract_all(lower(strip_accents(movies.title)), '[a-z0-9]+'), ' ') AS b FROM found JOIN movies USING (id)),
      y AS (SELECT *, regexp_replace(a, '^(?:(?:il|lo|la|i|gli|le|l|un|una|the|a|an) )+(.)', '\\1') AS c, regexp_replace(b, '^(?:(?:il|lo|la|i|gli|le|l|un|una|the|a|an) )+(.)', '\\1') AS e FROM x),
      z AS (SELECT *, CASE WHEN length(e) < length(c) THEN e ELSE c END AS s, CASE WHEN length(e) < length(c) THEN c ELSE e END AS g,
        list_sum(list_transform(string_split('abcdefghijklmnopqrstuvwxyz0123456789 ', ''), lambda k: least(length(a) - length(replace(a, k, '')), length(b) - length(replace(b, k, ''))))) AS n,
        list_sum(list_transform(string_split('abcdefghijklmnopqrstuvwxyz0123456789 ', ''), lambda k: least(length(c) - length(replace(c, k, '')), length(e) - length(replace(e, k, ''))))) AS m FROM y),
      w AS (SELECT *, CASE WHEN contains(s, ' ') AND starts_with(g || ' ', s || ' ') THEN CASE WHEN length(e) < length(c) THEN 0.88 ELSE 0.78 END ELSE 0 END::double AS t FROM z),
      v AS (SELECT title, movie_title, CASE WHEN a = '' OR b = '' THEN 0::double WHEN a = b THEN 1::double WHEN c = e THEN 0.97::double END AS k, t, greatest(2 * n / (length(a) + length(b)), 2 * m / (length(c) + length(e)), t) AS u FROM w)
      SELECT title, movie_title, CASE WHEN coalesce(k, t) = coalesce(k, u) THEN round(coalesce(k, t), 9) END AS score, round(coalesce(k, t), 9) AS least, round(coalesce(k, u), 9) AS most FROM v""",
    "score_parts": SEARCH + """, x AS (SELECT found.title, id, min(week_start) OVER (PARTITION BY found.title) AS estimated, release_date, popularity, movies.title AS p, original_title AS q FROM found JOIN t USING (title) JOIN movies USING (id)),
      y AS (SELECT title, id, estimated - release_date AS d, popularity, list_transform([title, p, q], lambda v: array_to_string(regexp_extract_all(lower(strip_accents(v)), '[a-z0-9]+'), ' ')) AS k FROM x),
      z AS (SELECT *, list_transform(k, lambda v: regexp_replace(v, '^(?:(?:il|lo|la|i|gli|le|l|un|una|the|a|an) )+(.)', '\\1')) AS b FROM y),
      w AS (SELECT title, id, CASE WHEN k[1] IN (k[2], k[3]) THEN 1 WHEN b[1] IN (b[2], b[3]) THEN 0.97 END::double AS tier,
        CASE WHEN d IS NULL THEN 0.4 WHEN d BETWEEN -21 AND 150 THEN 1 WHEN d > 150 AND d <= 450 THEN 1 - 0.8::double * (d - 150) / 300 WHEN d >= -90 AND d < -21 THEN 1 - (-21 - d) / 69.0::double ELSE 0 END::double AS date_part,
        CASE WHEN popularity > 0 THEN least(1.0, log10(1 + popularity) / 3) ELSE 0 END::double AS popularity_part FROM z)
      SELECT title, id, tier, round(date_part, 9) AS date_part, round(popularity_part, 9) AS popularity_part, round(0.70::double * tier + 0.25::double * date_part + 0.05::double * popularity_part, 9) AS exact_score FROM w""",
    "resolve_films": RESOLVE + """SELECT id, CASE WHEN status IS NOT NULL THEN CASE WHEN status = 'auto' THEN best_id END ELSE movie_id END AS movie_id, coalesce(status, match_status) AS match_status,
      CASE WHEN status IS NOT NULL THEN 'catalogue_search' ELSE match_method END AS match_method, CASE WHEN status IS NOT NULL THEN best ELSE match_confidence END AS match_confidence FROM films LEFT JOIN done ON ref = id""",
    "resolve_rows": RESOLVE + """SELECT id, CASE WHEN status IS NOT NULL THEN CASE WHEN status = 'auto' THEN best_id END ELSE movie_id END AS movie_id FROM fact LEFT JOIN done ON ref = source_movie_ref""",
    "resolve_movies": RESOLVE + """, n AS (SELECT id * 10 AS id, title, popularity FROM movies WHERE id * 10 IN (SELECT best_id FROM done WHERE status = 'auto'))
      SELECT id, coalesce(n.title, m.title) AS title, coalesce(n.popularity, m.popularity) AS popularity FROM movies m FULL JOIN n USING (id)""",
    "resolve_candidates": RESOLVE + """SELECT source_movie_id, movie_id, score, seq FROM candidates WHERE source_movie_id NOT IN (SELECT ref FROM done)
      UNION ALL SELECT source_movie_id, movie_id, score, seq FROM fresh JOIN done ON ref = source_movie_id WHERE status <> 'auto' AND place <= 5""",
    "resolve_pending": RESOLVE + """SELECT count(*) FILTER (status = 'auto') AS auto, count(*) FILTER (status = 'needs_review') AS needs_review, count(*) FILTER (status = 'no_match') AS no_match,
      (SELECT count(*) FROM waiting WHERE id % 13 = 0) AS errors, (SELECT count(*) FROM waiting) AS total FROM done""",
    "normalize_records": "SELECT id, 'box' AS source_name, 'IT' AS territory, title, title_key FROM fact",
    "title_key": "SELECT id, CASE WHEN id % 9 <> 0 THEN title_key ELSE '' END AS title_key FROM films",
    "genres_join": "SELECT p_partkey, concat_ws(', ', p_type, CASE WHEN p_size % 2 = 0 THEN p_brand END) AS genres FROM part",
    "normalize_movie": "SELECT id, title, CASE WHEN id % 3 <> 0 THEN release_date END AS release_date, CASE WHEN id % 2 = 0 THEN revenue ELSE 0 END AS revenue, 0::bigint AS budget, popularity FROM movies",
    "archive_urls": """SELECT week_start, i::bigint AS priority, CASE i WHEN 0 THEN b || strftime(week_start, '%Y/%m/%d/') WHEN 1 THEN b || strftime(week_start, '%Y-%m-%d/') WHEN 2 THEN b || strftime(week_start, '?date=%Y-%m-%d') ELSE b || strftime(week_start, '?year=%Y&month=%m&day=%d') END AS url
      FROM (SELECT DISTINCT week_start, 'https://charts.example/weekly/' AS b FROM fact), generate_series(0, 3) t(i)""",
    "release_dates_json": "SELECT id, CASE WHEN id % 5 < 3 THEN strftime(release_date, '%Y-%m-%d') || ',' || strftime(release_date + 9, '%Y-%m-%d') ELSE strftime(release_date, '%Y-%m-%d') END AS dates FROM movies",
    "raw_snapshot_digest": "SELECT page_id, url, sha256(html) AS content_sha256 FROM pages",
    "parse_chart_pages": """SELECT territory, week_start, week_end, (rank - 1) % 99 + 1 AS rank, trim(title) AS title, distributor, weekly_gross // 100 * 100 AS weekly_gross, total_gross // 100 * 100 AS total_gross, screen_count, weeks_in_release,
      (id // 10000)::varchar AS source_movie_id, 'https://charts.example/film/x/' || id // 10000 || '/scheda/' AS source_url FROM fact WHERE weekly_gross IS NOT NULL""",
    "first_page": """SELECT territory || '/' || year(week_start) AS request, min(week_start) AS page_week FROM fact WHERE weekly_gross IS NOT NULL GROUP BY 1""",
    "parse_euro": "SELECT id, (total_gross % 10000000) * 100 + id % 100 AS cents FROM fact",
    "parse_int": "SELECT id, total_gross AS value FROM fact",
    "parse_it_date": "SELECT DISTINCT week_start, week_start AS parsed FROM fact",
    "week_range": "SELECT DISTINCT week_start, week_start AS parsed_start, week_end AS parsed_end FROM fact",
    "relevant_log_lines": "SELECT * FROM relevant",
    "failure_report": """SELECT log_id, concat_ws(chr(10), concat_ws('; ', CASE WHEN log_id % 3 <> 0 THEN 'pipeline: exit code ' || log_id % 3 END, CASE WHEN log_id % 2 <> 0 THEN 'health check: exit code ' || log_id % 2 END), detail) AS message
      FROM (SELECT DISTINCT log_id FROM lines WHERE log_id % 3 <> 0 OR log_id % 2 <> 0) LEFT JOIN (SELECT log_id, string_agg(line, chr(10) ORDER BY seq) AS detail FROM relevant GROUP BY log_id) USING (log_id)""",
    "normalize_title": "SELECT id, trim(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', ' ', 'g')) AS normalised FROM films",
    "strip_articles": "SELECT id, lower(substr(original_title, 5)) AS bare FROM movies",
    "query_variants": """, t AS (SELECT id, trim(CASE WHEN id % 4 = 0 THEN '...' ELSE '' END || title || CASE id % 3 WHEN 0 THEN ' - part two' WHEN 1 THEN ': a story' ELSE '' END) AS a FROM films), u AS (SELECT id, a, trim(regexp_replace(a, '^\\.+', '')) AS b FROM t),
      v AS (SELECT id, a, b, trim(regexp_replace(b, '( - |: ).*$', '')) AS c FROM u)
      SELECT id, array_to_string(list_filter([a, CASE WHEN b <> a THEN b END, CASE WHEN c <> b AND c <> a THEN c END], lambda x: x IS NOT NULL), '|') AS variants FROM v""",
    "estimated_release": "SELECT id, week_start - 7 * greatest(coalesce(nullif(CASE WHEN id % 7 <> 0 THEN weeks_in_release END, 0), 1) - 1, 0)::int AS estimated FROM fact",
    "date_score": """SELECT id, round(CASE WHEN d IS NULL THEN 0.4 WHEN d BETWEEN -21 AND 150 THEN 1 WHEN d > 150 AND d <= 450 THEN 1 - 0.8::double * (d - 150) / 300 WHEN d >= -90 AND d < -21 THEN 1 - (-21 - d) / 69.0::double ELSE 0 END::double, 9) AS score
      FROM (SELECT fact.id, week_start - release_date AS d FROM fact LEFT JOIN movies ON fact.movie_id = movies.id)""",
    "local_release_score": """SELECT id, round(CASE WHEN id % 5 = 0 THEN NULL WHEN g <= 10 THEN 1 WHEN g <= 45 THEN 1 - 0.8::double * (g - 10) / 35 ELSE 0 END::double, 9) AS score FROM (SELECT id, least(id % 70, abs(id % 70 - 21)) AS g FROM movies)""",
    "popularity_score": "SELECT p_partkey, round(CASE WHEN p_retailprice - 910 > 0 THEN least(1.0, log10(1 + p_retailprice - 910) / 3) ELSE 0 END::double, 9) AS score FROM part",
    "match_decision": "SELECT * FROM decisions",
    "match_summary": "SELECT count(*) FILTER (status = 'auto') AS auto, count(*) FILTER (status = 'needs_review') AS needs_review, count(*) FILTER (status = 'no_match') AS no_match, count(*) AS total FROM decisions",
}


#: Weeks that the anomaly check looks back, where it is not the report's three.
WEEKS = {"anomalies": 60}


def oracle_sql() -> dict[str, str]:
    return {name: BASE.replace("{weeks}", str(WEEKS.get(name, 3))).rstrip() + (sql if sql.startswith(",") else "\n" + sql) for name, sql in SQL.items()}
