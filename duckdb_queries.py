"""DuckDB SQL per query, written from the definitions and not from the Spark code.

Each text is a chain of common table expressions from the ``events`` table on. Snapshots are
range joins here, distinct counts are direct, metrics compare every row with every threshold
or rank all rows, so that the two sides share no method.
"""

from __future__ import annotations

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, sql: str) -> None:
    CTE[name] = (tuple(needs.split()), sql)


def query(needs: str, select: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in CTE[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for needed in needs.split():
        visit(needed)
    chain = ",\n".join(f"{name} AS (\n{CTE[name][1]}\n)" for name in ordered)
    return f"WITH {chain}\n{select}"


FIRST_DAY, LAST_DAY, AFTER = "2024-01-05", "2024-01-24", "2024-01-25"
DAYS = 20
EARLIER_RUN, LAST_RUN = "2024-02-01 06:00:00", "2024-02-08 06:00:00"

LANGUAGES = (
    "Python Go Rust Java C++ C Kotlin Swift Ruby PHP Scala Haskell Elixir Erlang Clojure Lua Perl R Julia Dart "
    "TypeScript JavaScript Shell Zig Nim OCaml Fortran Ada Cobol Prolog Scheme Racket Groovy Crystal Solidity Vala"
).split()

cte("mapped", "", """
  SELECT *, CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent'
              WHEN 'purchase' THEN 'PullRequestEvent' WHEN 'signup' THEN 'ForkEvent'
              WHEN 'error' THEN 'IssuesEvent' END AS kind,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         CASE WHEN event_id % 3 = 0 THEN user_id % 5 ELSE user_id END AS owner,
         event_id // 50 AS turn,
         CASE WHEN event_id % 97 = 0 THEN moment - INTERVAL 10 YEAR
              WHEN event_id % 101 = 0 THEN moment + INTERVAL 50 YEAR ELSE moment END AS base
  FROM (SELECT *, CASE WHEN event_id % 9 = 0 THEN date_trunc('day', ts) ELSE ts END AS moment FROM events)""")

cte("raw", "mapped", f"""
  SELECT *, CASE WHEN event_id % 103 <> 0 THEN moved END AS happened,
         CASE WHEN event_id % 103 = 0 THEN 'yesterday' ELSE strftime(moved, '%Y-%m-%dT%H:%M:%S.%fZ') END AS created_text
  FROM (
    SELECT event_id, copy, CAST(event_id AS VARCHAR) AS id, kind AS type,
           CASE WHEN event_id % 71 <> 0 THEN user_id * 3 + CAST(floor(k / 10) AS INTEGER) % 3 END AS actor_id,
           CASE WHEN event_id % 89 <> 0 AND (copy = 1 OR turn % 5 <> 0) THEN owner * 10 + k % 10 END AS repo_id,
           CASE WHEN event_id % 83 = 0 THEN '' ELSE 'org' || owner || '/r' || (k % 10)
             || CASE WHEN k % 10 IN (2, 3, 4) AND day(base) >= 16 THEN '-new' ELSE '' END
             || CASE WHEN k % 10 = 7 AND event_id % 2 = 0 THEN '.x' ELSE '' END END AS repo_name,
           CASE WHEN copy = 2 THEN coalesce(CASE WHEN k % 7 <> 0 THEN CAST(floor(value * 60) AS INTEGER) END, 0) + 1
                WHEN k % 7 <> 0 THEN CAST(floor(value * 60) AS INTEGER) END AS size,
           CASE WHEN kind IN ('ForkEvent', 'PullRequestEvent')
                THEN ({LANGUAGES!r})[CAST((k + owner) % {len(LANGUAGES) + 1} AS INTEGER) + 1] END AS lang,
           CASE kind WHEN 'PullRequestEvent' THEN 'opened' WHEN 'WatchEvent' THEN 'started' END AS action,
           CASE WHEN copy = 2 THEN base + to_hours(CAST(turn % 3 - 1 AS INTEGER)) ELSE base END AS moved
    FROM mapped CROSS JOIN LATERAL
      (SELECT unnest(CASE WHEN event_id % 50 = 0 THEN [1, 2] ELSE [1] END) AS copy))""")

cte("flat", "raw", """
  SELECT id AS event_id, type AS event_type, actor_id, 'dev' || actor_id AS actor_login, repo_id,
         repo_name, coalesce(lang, 'Unknown') AS language, coalesce(size, 0) AS commits_count,
         action, happened AS created_at, size
  FROM raw""")

cte("clean", "flat", """
  SELECT event_id, event_type, actor_id, actor_login, repo_id, repo_name, language,
         commits_count, action, created_at
  FROM flat
  WHERE event_type IN ('PushEvent', 'WatchEvent', 'ForkEvent', 'PullRequestEvent')
    AND event_id IS NOT NULL AND repo_id IS NOT NULL AND repo_name IS NOT NULL AND repo_name <> ''
    AND created_at IS NOT NULL
    AND created_at >= TIMESTAMP '2020-01-01 00:00:00' AND created_at <= TIMESTAMP '2026-01-01 00:00:00'
    AND (event_type <> 'PushEvent' OR coalesce(size, 1) <= 10000)
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY created_at, commits_count) = 1""")

cte("period", "clean", f"""
  SELECT * FROM clean
  WHERE created_at >= TIMESTAMP '{FIRST_DAY} 00:00:00' AND created_at < TIMESTAMP '{AFTER} 00:00:00'""")

cte("mart_hourly", "clean", """
  SELECT date_trunc('hour', created_at) AS hour, event_type, count(*) AS event_count,
         count(DISTINCT actor_id) AS unique_users, count(DISTINCT repo_id) AS unique_repos
  FROM clean GROUP BY ALL""")

cte("mart_repo", "clean", """
  SELECT date_trunc('hour', created_at) AS hour, repo_id, repo_name, count(*) AS total_events,
         count(DISTINCT actor_id) AS unique_actors,
         count(*) FILTER (event_type = 'WatchEvent') AS stars_gained,
         count(*) FILTER (event_type = 'ForkEvent') AS forks_gained,
         CAST(sum(commits_count) AS BIGINT) AS total_commits
  FROM clean GROUP BY ALL""")

cte("hourly_period", "mart_hourly", f"""
  SELECT * FROM mart_hourly
  WHERE hour >= TIMESTAMP '{FIRST_DAY} 00:00:00' AND hour < TIMESTAMP '{AFTER} 00:00:00'""")

cte("landed", "", """
  SELECT CAST(ts AS DATE) AS event_date, hour(ts) AS event_hour,
         strftime(ts, '%Y-%m-%d') || '-' || hour(ts) || '.json' AS source_file
  FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events)""")

cte("manifest", "", """
  SELECT CAST(h AS DATE) AS event_date, CAST(hour(h) AS INTEGER) AS event_hour,
         strftime(h, '%Y-%m-%d') || '-' || hour(h) || '.json.gz' AS file_name
  FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)),
                 date_trunc('day', max(ts)) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS h FROM events)""")

cte("bounds", "clean", "  SELECT min(created_at) AS first_event, max(created_at) AS last_event FROM clean")

cte("calendar", "bounds", """
  SELECT CAST(t1 AS DATE) AS snapshot_date, t1, t1 - INTERVAL 14 DAY AS w_start, t1 + INTERVAL 7 DAY AS w_end,
         t1 - INTERVAL 7 DAY AS middle, t1 + INTERVAL 7 DAY <= last_event AS label_available
  FROM (SELECT unnest(generate_series(date_trunc('day', first_event + INTERVAL 14 DAY), last_event,
                 INTERVAL 7 DAY)) AS t1, last_event FROM bounds)""")

cte("observed", "clean calendar", """
  SELECT c.*, s.* FROM clean c JOIN calendar s ON c.created_at >= s.w_start AND c.created_at < s.t1""")

cte("windowed", "observed", """
  SELECT snapshot_date, repo_id,
    arg_max(repo_name, struct_pack(a := created_at, b := repo_name, c := language)) AS repo_name,
    arg_max(language, struct_pack(a := created_at, b := repo_name, c := language)) AS language,
    count(*) AS events_total,
    count(*) FILTER (event_type = 'PushEvent') AS pushes,
    CAST(coalesce(sum(commits_count) FILTER (event_type = 'PushEvent'), 0) AS BIGINT) AS commits_total,
    count(*) FILTER (event_type = 'WatchEvent') AS stars,
    count(*) FILTER (event_type = 'ForkEvent') AS forks,
    count(*) FILTER (event_type = 'PullRequestEvent') AS prs,
    count(DISTINCT actor_id) AS actors,
    count(DISTINCT CAST(created_at AS DATE)) AS active_days,
    date_diff('hour', min(created_at), max(created_at)) + 1 AS activity_span_hours,
    date_diff('hour', max(created_at), t1) AS hours_since_last,
    count(*) FILTER (created_at < middle) AS events_first_half,
    count(*) FILTER (created_at >= middle) AS events_second_half
  FROM observed GROUP BY snapshot_date, t1, repo_id HAVING count(*) >= 3""")

cte("top_actor", "observed", """
  SELECT snapshot_date, repo_id, max(n) AS top_actor_events, CAST(sum(n) AS BIGINT) AS actor_events_total
  FROM (SELECT snapshot_date, repo_id, actor_id, count(*) AS n FROM observed GROUP BY ALL)
  GROUP BY ALL""")

cte("outcome", "clean calendar", """
  SELECT snapshot_date, repo_id, count(*) AS n
  FROM clean c JOIN calendar s ON c.created_at >= s.t1 AND c.created_at < s.w_end
  GROUP BY ALL""")

cte("rows", "windowed top_actor outcome calendar", """
  SELECT w.*, t.top_actor_events,
         CASE WHEN s.label_available THEN coalesce(o.n, 0) END AS future_events, s.label_available,
         t.top_actor_events / (w.events_total + 1e-9::DOUBLE) AS top_actor_share,
         w.events_total / (w.active_days + 1e-9::DOUBLE) AS events_per_active_day,
         w.commits_total / (w.pushes + 1e-9::DOUBLE) AS commits_per_push,
         (w.events_second_half + 1)::DOUBLE / (w.events_first_half + 1) AS trend_ratio,
         w.events_total / (w.actors + 1e-9::DOUBLE) AS events_per_actor,
         CASE WHEN s.label_available AND o.n IS NULL THEN 1 ELSE 0 END AS abandoned
  FROM windowed w JOIN calendar s USING (snapshot_date)
    LEFT JOIN top_actor t USING (snapshot_date, repo_id)
    LEFT JOIN outcome o USING (snapshot_date, repo_id)""")

cte("train", "rows", "  SELECT * FROM rows WHERE label_available")

cte("top15", "train", """
  SELECT language, row_number() OVER (ORDER BY count(*) DESC, language) AS place
  FROM train GROUP BY language QUALIFY place <= 15""")

NUMERIC = (
    "events_total pushes commits_total stars forks prs actors active_days activity_span_hours"
    " hours_since_last events_first_half events_second_half top_actor_share events_per_active_day"
    " commits_per_push trend_ratio events_per_actor"
).split()

# --- evaluation: two formulas as models --------------------------------------------------

cte("scores", "train", """
  SELECT 'recency' AS model, snapshot_date, repo_id, least(1.0::DOUBLE, hours_since_last / 336.0::DOUBLE) AS p,
         abandoned AS y FROM train
  UNION ALL
  SELECT 'slowdown', snapshot_date, repo_id, 1.0::DOUBLE / (1.0::DOUBLE + events_second_half), abandoned FROM train""")

cte("recency", "scores", "  SELECT * FROM scores WHERE model = 'recency'")

cte("classes", "scores", """
  SELECT model, count(*) AS n, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg
  FROM scores GROUP BY model""")

cte("auc", "scores classes", """
  SELECT model, CASE WHEN any_value(c.pos) > 0 AND any_value(c.neg) > 0 THEN
           (sum(mean_rank) FILTER (y = 1) - any_value(c.pos) * (any_value(c.pos) + 1) / 2.0::DOUBLE)
           / (any_value(c.pos)::DOUBLE * any_value(c.neg)) END AS roc_auc
  FROM (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY p)
               + (count(*) OVER (PARTITION BY model, p) - 1) / 2.0::DOUBLE AS mean_rank FROM scores)
    JOIN classes c USING (model)
  GROUP BY model""")

cte("cumulated", "scores", """
  SELECT model, p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg,
         sum(count(*) FILTER (y = 1)) OVER w AS tp, sum(count(*) FILTER (y = 0)) OVER w AS fp
  FROM scores GROUP BY model, p
  WINDOW w AS (PARTITION BY model ORDER BY p DESC)""")

cte("ap", "cumulated classes", """
  SELECT model, CASE WHEN any_value(c.pos) > 0
           THEN sum((u.pos::DOUBLE / c.pos) * (u.tp::DOUBLE / (u.tp + u.fp))) ELSE 0 END AS pr_auc
  FROM cumulated u JOIN classes c USING (model) GROUP BY model""")

cte("sized", "classes", """
  SELECT *, least(greatest(CAST(floor(n * 0.05::DOUBLE) AS BIGINT), 10), n) AS k FROM classes""")

cte("at_k", "scores sized", """
  SELECT s.model, any_value(s.k) AS k, count(*) FILTER (y = 1)::DOUBLE / any_value(s.k) AS precision_at_k,
         CASE WHEN any_value(s.pos) > 0 THEN count(*) FILTER (y = 1)::DOUBLE / any_value(s.pos) END AS recall_at_k
  FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY p DESC,
            CAST('0x' || substr(md5(repo_id || ':' || strftime(snapshot_date, '%Y-%m-%d')), 1, 8) AS BIGINT),
            snapshot_date, repo_id) AS place FROM scores) r
    JOIN sized s ON s.model = r.model AND r.place <= s.k
  GROUP BY s.model""")

cte("candidates", "scores", """
  SELECT DISTINCT model, round_even(p * 1000, 0)::DOUBLE / 1000 AS t FROM scores""")

cte("rated", "scores candidates", """
  SELECT c.model, t, count(*) FILTER (p >= t AND y = 1) AS tp, count(*) FILTER (p >= t AND y = 0) AS fp,
         count(*) FILTER (p < t AND y = 1) AS fn, count(*) FILTER (p < t AND y = 0) AS tn
  FROM candidates c JOIN scores s ON s.model = c.model GROUP BY c.model, t""")

cte("best", "rated", """
  SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
         CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS "precision",
         CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall
  FROM rated QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, t) = 1""")

cte("metrics", "auc ap at_k best train", f"""
  SELECT TIMESTAMP '{LAST_RUN}' AS trained_at, model, (SELECT count(*) FROM train) AS dataset_rows,
         (SELECT avg(abandoned) FROM train) AS abandoned_share, round(roc_auc, 9) AS roc_auc,
         round(pr_auc, 9) AS pr_auc, f1, "precision", recall, precision_at_k, recall_at_k, k,
         '{{"threshold":' || t || ',"confusion":[[' || tn || ',' || fp || '],[' || fn || ',' || tp || ']]}}'
           AS params
  FROM auc JOIN ap USING (model) JOIN at_k USING (model) JOIN best USING (model)""")

# --- predictions -------------------------------------------------------------------------

cte("predicted", "rows", f"""
  SELECT snapshot_date, repo_id, repo_name, language,
         least(1.0::DOUBLE, hours_since_last / 336.0::DOUBLE) AS probability,
         CAST(least(1.0::DOUBLE, hours_since_last / 336.0::DOUBLE) >= 0.25 AS INTEGER) AS prediction,
         CASE WHEN label_available THEN CAST(future_events = 0 AS INTEGER) END AS label,
         'recency' AS model, TIMESTAMP '{LAST_RUN}' AS trained_at
  FROM rows""")

cte("earlier", "predicted", f"""
  SELECT * REPLACE (probability / 2 AS probability, CAST(probability / 2 >= 0.25 AS INTEGER) AS prediction,
                    CAST(NULL AS INTEGER) AS label, TIMESTAMP '{EARLIER_RUN}' AS trained_at)
  FROM predicted""")

cte("history", "predicted earlier", "  SELECT * FROM predicted UNION ALL SELECT * FROM earlier")

cte("final", "history", """
  SELECT * FROM history
  QUALIFY row_number() OVER (PARTITION BY snapshot_date, repo_id ORDER BY trained_at DESC) = 1""")

cte("last", "final", "  SELECT * FROM final WHERE snapshot_date = (SELECT max(snapshot_date) FROM final)")

cte("closed", "final", "  SELECT * FROM final WHERE snapshot_date = DATE '2024-01-22'")

FORECAST = "CASE WHEN prediction = 1 THEN 'abandoned' ELSE 'active' END AS forecast"
FACT = "CASE WHEN label IS NULL THEN 'unknown' WHEN label = 1 THEN 'abandoned' ELSE 'active' END AS fact"

cte("sample", "last", f"""
  SELECT repo_id, repo_name, language, probability, prediction, label, {FORECAST}, {FACT}
  FROM last
  ORDER BY CAST('0x' || substr(md5(CAST(repo_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE * probability,
           repo_id
  LIMIT 500""")


def top_repos(metric: str) -> str:
    return query("period", f"""
  SELECT repo_id, repo_name, count(*) AS events, count(*) FILTER (event_type = 'WatchEvent') AS stars,
         count(*) FILTER (event_type = 'ForkEvent') AS forks,
         count(*) FILTER (event_type = 'PushEvent') AS pushes,
         round_even({metric} / {DAYS}.0::DOUBLE * 10, 0) / 10 AS per_day
  FROM period GROUP BY repo_id, repo_name ORDER BY {metric} DESC, repo_id, repo_name LIMIT 20""")


def scaled(column: str) -> str:
    return (
        f"round((({column})::DOUBLE - avg({column}) OVER ()) / stddev_pop({column}) OVER (), 6) AS {column}"
    )


IS_TEST = "CAST('0x' || substr(md5('42:' || repo_id), 1, 8) AS BIGINT) % 100 < 25"
TERMS = len(NUMERIC) + 16
STEPS = 15


def scored_test_rows(model: str) -> str:
    """What a fitted ensemble has to score, and that its rows give the library's probabilities; SQL cannot fit it again."""
    return query("train", f"""
  SELECT snapshot_date, repo_id, abandoned, '{model}' AS model, true AS scored, true AS rows_agree FROM train WHERE {IS_TEST}""")


def logistic(select: str) -> str:
    """Probabilities of the logistic model, fitted here by Newton's method: its optimum is unique.

    A step solves the augmented matrix of second derivatives and slopes by elimination, pivot by pivot.
    """
    one_hot = ", ".join(f"CAST(coalesce(place = {i + 1}, false) AS DOUBLE)" for i in range(15))
    each = lambda f: ", ".join(f"{f}(raw[{i + 1}])" for i in range(TERMS))
    pivots = ", ".join(f"[[{i + 1}.0::DOUBLE]]" for i in range(TERMS + 1))
    return query("rows train", f"""
, fit_language AS MATERIALIZED (
  SELECT language, row_number() OVER (ORDER BY count(*) DESC, language) AS place
  FROM train WHERE NOT ({IS_TEST}) GROUP BY language QUALIFY place <= 15
),
placed AS MATERIALIZED (
  SELECT r.*, label_available AND NOT ({IS_TEST}) AS is_fit,
         [{", ".join(f"CAST({c} AS DOUBLE)" for c in NUMERIC)}, {one_hot}, CAST(place IS NULL AS DOUBLE)] AS raw
  FROM rows r LEFT JOIN fit_language USING (language)
),
spread AS MATERIALIZED (SELECT [{each("avg")}] AS mean, [{each("stddev_pop")}] AS deviation FROM placed WHERE is_fit),
class AS MATERIALIZED (
  SELECT abandoned, sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*)) AS w FROM placed WHERE is_fit GROUP BY abandoned
),
vector AS MATERIALIZED (
  SELECT p.*, w, list_prepend(1.0::DOUBLE, list_transform(list_zip(raw, mean, deviation),
           lambda z: CASE WHEN z[3] = 0 THEN 0.0::DOUBLE ELSE (z[1] - z[2]) / z[3] END)) AS x
  FROM placed p LEFT JOIN class USING (abandoned), spread
),
newton AS (
  SELECT 0 AS k, list_transform(range({TERMS + 1}), lambda _: 0.0::DOUBLE) AS beta
  UNION ALL
  SELECT k + 1, list_transform(list_zip(beta, list_transform(list_reduce(list_prepend(m, [{pivots}]),
           lambda m, q: list_transform(m, lambda r, i: CASE WHEN i = q[1][1] THEN list_transform([r[i]], lambda d: list_transform(r, lambda v: v / d))[1]
             ELSE list_transform([r[CAST(q[1][1] AS INTEGER)] / m[CAST(q[1][1] AS INTEGER)][CAST(q[1][1] AS INTEGER)]],
               lambda f: list_transform(list_zip(r, m[CAST(q[1][1] AS INTEGER)]), lambda z: z[1] - f * z[2]))[1] END)),
           lambda r: r[{TERMS + 2}])), lambda z: z[1] - z[2])
  FROM (
    SELECT k, any_value(beta) AS beta, list(line ORDER BY i) AS m
    FROM (
      SELECT k, i, any_value(beta) AS beta,
             list_append(list(h + CASE WHEN i = j AND i > 1 THEN 1 ELSE 0 END ORDER BY j), any_value(g) + CASE WHEN i > 1 THEN any_value(beta)[i] ELSE 0 END) AS line
      FROM (
        SELECT k, i, j, any_value(beta) AS beta, sum(w * p * (1 - p) * x[i] * x[j]) AS h, sum(w * (p - abandoned) * x[i]) AS g
        FROM (
          SELECT *, unnest(range(1, {TERMS + 2})) AS j
          FROM (
            SELECT n.k, n.beta, v.x, v.w, v.abandoned, 1 / (1 + exp(-list_dot_product(v.x, n.beta))) AS p, unnest(range(1, {TERMS + 2})) AS i
            FROM newton n, vector v WHERE n.k < {STEPS} AND v.is_fit
          )
        ) GROUP BY k, i, j
      ) GROUP BY k, i
    ) GROUP BY k
  )
),
judged AS (
  SELECT v.*, 1 / (1 + exp(-list_dot_product(x, beta))) AS probability FROM vector v, newton WHERE k = {STEPS}
)
{select}""").replace("WITH ", "WITH RECURSIVE ", 1)


ORACLES: dict[str, str] = {
    "model_logreg": logistic(f"""
  SELECT snapshot_date, repo_id, abandoned, 'logreg_baseline' AS model, round(probability, 3) AS probability, true AS rows_agree
  FROM judged WHERE label_available AND {IS_TEST}"""),
    "model_rf": scored_test_rows("random_forest"),
    "model_gbt": scored_test_rows("boosted_trees"),
    "predictions_export": logistic(f"""
  SELECT snapshot_date, repo_id, repo_name, language, CAST(NULL AS INTEGER) AS label, 'logreg_baseline' AS model,
         TIMESTAMP '{LAST_RUN}' AS trained_at, round(probability, 3) AS probability, CAST(probability >= 0.5 AS INTEGER) AS prediction
  FROM judged WHERE NOT label_available"""),
    "raw_scan": query("raw", """
  SELECT id, type, actor_id, 'dev' || actor_id AS actor_login, repo_id, repo_name, action, size,
         CASE WHEN type = 'ForkEvent' THEN lang END AS fork_language,
         CASE WHEN type = 'PullRequestEvent' THEN lang END AS base_language,
         created_text AS created_at
  FROM raw"""),
    "raw_landing": query("raw", """
  SELECT CAST(happened AS DATE) AS event_date, CAST(hour(happened) AS INTEGER) AS event_hour,
         strftime(happened, '%Y-%m-%d') || '-' || hour(happened) || '.json' AS source_file,
         unnest(CASE WHEN event_id % 67 = 0 THEN [line, '{"id": "'] ELSE [line] END) AS raw
  FROM (SELECT *, '{"id":"' || id || '","type":"' || type || '","actor":{'
         || coalesce('"id":' || actor_id || ',"login":"dev' || actor_id || '"', '')
         || '},"repo":{' || coalesce('"id":' || repo_id || ',', '') || '"name":"' || repo_name
         || '"},"payload":{' || coalesce('"action":"' || action || '",', '')
         || coalesce('"size":' || size || ',', '') || '"forkee":{'
         || CASE WHEN type = 'ForkEvent' THEN coalesce('"language":"' || lang || '"', '') ELSE '' END
         || '},"pull_request":{"base":{"repo":{'
         || CASE WHEN type = 'PullRequestEvent' THEN coalesce('"language":"' || lang || '"', '') ELSE '' END
         || '}}}},"created_at":"' || created_text || '"}' AS line
        FROM raw)
  WHERE happened IS NOT NULL"""),
    "archive_quarantine": query("raw", """
  SELECT source_file, CASE WHEN cut THEN 0 ELSE lines END AS lines, CASE WHEN cut THEN 'truncated' END AS reason
  FROM (
    SELECT source_file, landed AS lines, row_number() OVER (ORDER BY written DESC, source_file || '.gz') = 1 AS cut
    FROM (
      SELECT strftime(happened, '%Y-%m-%d') || '-' || hour(happened) || '.json' AS source_file,
             CAST(sum(CASE WHEN event_id % 67 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS landed,
             sum(1 + CAST(event_id % 67 = 0 AS INTEGER) + CAST(event_id % 59 = 0 AS INTEGER)) AS written
      FROM raw WHERE happened IS NOT NULL GROUP BY 1
    )
  )"""),
    "incremental_etl": query("clean", "SELECT * FROM clean"),
    "incremental_files": query("landed", """
  SELECT DISTINCT strftime(ts, '%Y-%m-%d') || '-' || hour(ts) || '.json.gz' AS file_name,
         strftime(ts, '%Y-%m-%d') || '-' || hour(ts) || '.json' AS source_file
  FROM events
  WHERE strftime(ts, '%Y-%m-%d') || '-' || hour(ts) || '.json' NOT IN (SELECT source_file FROM landed)"""),
    "landed_counts": """
  SELECT strftime(ts, '%Y-%m-%d') || '-' || hour(ts) || '.json' AS source_file, count(*) AS lines
  FROM events GROUP BY 1""",
    "hour_manifest": query("manifest", "SELECT * FROM manifest"),
    "hour_manifest_n": """
  SELECT CAST(h AS DATE) AS event_date, CAST(hour(h) AS INTEGER) AS event_hour,
         strftime(h, '%Y-%m-%d') || '-' || hour(h) || '.json.gz' AS file_name
  FROM (SELECT d + to_hours(CAST(i AS INTEGER)) AS h FROM
          (SELECT date_trunc('day', min(ts)) + INTERVAL 16 HOUR AS d,
                  unnest(range(0, count(DISTINCT date_trunc('hour', ts)))) AS i FROM events))""",
    "missing_hours": query("manifest landed", """
  SELECT * FROM manifest WHERE replace(file_name, '.gz', '') NOT IN (SELECT source_file FROM landed)"""),
    "backfill_progress": query("manifest landed", """
  SELECT count(*) FILTER (replace(file_name, '.gz', '') NOT IN (SELECT source_file FROM landed)) AS to_fetch,
         count(*) FILTER (replace(file_name, '.gz', '') IN (SELECT source_file FROM landed)) AS skipped
  FROM manifest"""),
    "flt_target_types": query("raw", """
  SELECT id, type, created_text AS created_at FROM raw
  WHERE type IN ('PushEvent', 'WatchEvent', 'ForkEvent', 'PullRequestEvent')"""),
    "flt_date_sanity": query("raw", """
  SELECT id, happened AS created_at FROM raw
  WHERE happened BETWEEN TIMESTAMP '2020-01-01 00:00:00' AND TIMESTAMP '2026-01-01 00:00:00'"""),
    "flt_bot_pushes": query("raw", """
  SELECT id, type, size FROM raw WHERE type <> 'PushEvent' OR coalesce(size, 1) <= 10000"""),
    "flt_period": query("period", "SELECT event_id, created_at FROM period"),
    "resolve_language": query("raw", "SELECT id, coalesce(lang, 'Unknown') AS language FROM raw"),
    "dedup_events": query("flat", """
  SELECT * EXCLUDE (size) FROM flat
  QUALIFY row_number() OVER (PARTITION BY event_id
            ORDER BY created_at NULLS FIRST, repo_id NULLS FIRST, commits_count) = 1"""),
    "clean_events": query("clean", "SELECT * FROM clean"),
    "mart_language": query("clean", """
  SELECT date_trunc('hour', created_at) AS hour, language, count(*) AS total_events,
         count(DISTINCT actor_id) AS unique_actors,
         count(*) FILTER (event_type = 'PushEvent') AS push_count,
         count(*) FILTER (event_type = 'WatchEvent') AS star_count,
         count(*) FILTER (event_type = 'PullRequestEvent') AS pr_count,
         count(*) FILTER (event_type = 'ForkEvent') AS fork_count
  FROM clean WHERE language <> 'Unknown' GROUP BY ALL"""),
    "mart_repo": query("mart_repo", "SELECT * FROM mart_repo"),
    "mart_hourly": query("mart_hourly", "SELECT * FROM mart_hourly"),
    "mart_merge": query("mart_repo", """
  SELECT hour, repo_id, CAST(sum(total_events) AS BIGINT) AS total_events,
         CAST(sum(stars_gained) AS BIGINT) AS stars_gained,
         CAST(sum(forks_gained) AS BIGINT) AS forks_gained,
         CAST(sum(total_commits) AS BIGINT) AS total_commits
  FROM mart_repo GROUP BY hour, repo_id"""),
    "data_bounds": query("bounds mart_hourly", """
  SELECT first_event, last_event, (SELECT min(hour) FROM mart_hourly) AS first_hour,
         (SELECT max(hour) FROM mart_hourly) AS last_hour FROM bounds"""),
    "rpt_kpi": query("period", f"""
  SELECT count(*) AS events, count(DISTINCT actor_id) AS actors, count(DISTINCT repo_id) AS repos,
         count(*) FILTER (event_type = 'WatchEvent') AS stars,
         count(*) FILTER (event_type = 'ForkEvent') AS forks,
         count(*) FILTER (event_type = 'PullRequestEvent') AS prs,
         count(*) FILTER (event_type = 'PushEvent') AS pushes,
         count(*) / {DAYS}.0::DOUBLE AS events_per_day
  FROM period"""),
    "rpt_kpi_sketch": query("period", f"""
  SELECT count(*) AS events, count(*) FILTER (event_type = 'WatchEvent') AS stars,
         count(*) FILTER (event_type = 'ForkEvent') AS forks, count(*) FILTER (event_type = 'PullRequestEvent') AS prs,
         count(*) FILTER (event_type = 'PushEvent') AS pushes, count(*) / {DAYS}.0::DOUBLE AS events_per_day,
         true AS actors_near, true AS repos_near
  FROM period"""),
    "rpt_peak": query("hourly_period", "SELECT max(event_count) AS peak FROM hourly_period"),
    "rpt_peak_total": query("period", """
  SELECT max(n) AS peak FROM (SELECT count(*) AS n FROM period GROUP BY date_trunc('hour', created_at))"""),
    "rpt_daily": query("period", """
  SELECT CAST(created_at AS DATE) AS day, count(*) AS events FROM period GROUP BY 1"""),
    "rpt_mix": query("period", """
  SELECT event_type, count(*) AS events, count(*)::DOUBLE / sum(count(*)) OVER () AS share
  FROM period GROUP BY event_type"""),
    "rpt_heatmap": query("period", """
  SELECT CAST(isodow(created_at) AS INTEGER) AS dow, CAST(hour(created_at) AS INTEGER) AS h,
         count(*) AS events FROM period GROUP BY 1, 2"""),
    "rpt_heatmap_grid": query("period", """
  SELECT CAST(d AS INTEGER) AS dow, CAST(g AS INTEGER) AS h, count(p.event_id) AS events
  FROM (SELECT unnest(range(1, 8)) AS d) CROSS JOIN (SELECT unnest(range(0, 24)) AS g)
    LEFT JOIN period p ON isodow(p.created_at) = d AND hour(p.created_at) = g
  GROUP BY 1, 2"""),
    "rpt_lang_stats": query("period", """
  SELECT language, count(*) AS events, count(DISTINCT actor_id) AS actors,
         count(*) FILTER (event_type = 'WatchEvent') AS stars,
         count(*) FILTER (event_type = 'ForkEvent') AS forks,
         count(*) FILTER (event_type = 'PullRequestEvent') AS prs
  FROM period WHERE language <> 'Unknown' GROUP BY language ORDER BY events DESC, language LIMIT 25"""),
    "rpt_lang_trend": query("period", """
  SELECT CAST(created_at AS DATE) AS day, language, count(*) AS events,
         count(*) FILTER (event_type = 'WatchEvent') AS stars
  FROM period
  WHERE language IN (SELECT language FROM period WHERE language <> 'Unknown' GROUP BY language
                     ORDER BY count(*) DESC, language LIMIT 8)
  GROUP BY 1, 2"""),
    **{f"rpt_top_repos_{m}": top_repos(m) for m in ("stars", "forks", "pushes", "events")},
    "rpt_repo_detail": query("period", """
  SELECT CAST(created_at AS DATE) AS day, count(*) AS events,
         count(*) FILTER (event_type = 'WatchEvent') AS stars,
         count(*) FILTER (event_type = 'ForkEvent') AS forks,
         count(*) FILTER (event_type = 'PushEvent') AS pushes
  FROM period
  WHERE repo_name = (SELECT repo_name FROM period GROUP BY repo_id, repo_name
                     ORDER BY count(*) DESC, repo_id, repo_name LIMIT 1)
  GROUP BY 1"""),
    "snapshot_calendar": query("calendar", """
  SELECT snapshot_date, CAST(w_start AS DATE) AS observed_from, CAST(w_end AS DATE) AS outcome_until,
         label_available FROM calendar"""),
    "event_snapshot": query("clean calendar", """
  SELECT event_id, snapshot_date, created_at < t1 AS observed, label_available
  FROM clean JOIN calendar ON created_at >= w_start AND created_at < w_end"""),
    "repo_latest_attrs": query("clean", """
  SELECT repo_id, arg_max(repo_name, struct_pack(a := created_at, b := repo_name, c := language)) AS repo_name,
         arg_max(language, struct_pack(a := created_at, b := repo_name, c := language)) AS language
  FROM clean GROUP BY repo_id"""),
    "top_actor": query("top_actor", "SELECT * FROM top_actor"),
    "labels": query("train", "SELECT snapshot_date, repo_id, future_events, abandoned FROM train"),
    "features_window": query("windowed", "SELECT * FROM windowed"),
    "features_from_panes": query("windowed", "SELECT * FROM windowed"),
    "features_derived": query("rows", """
  SELECT snapshot_date, repo_id, top_actor_share, events_per_active_day, commits_per_push, trend_ratio,
         events_per_actor FROM rows"""),
    "dataset_train": query("train", "SELECT * FROM train"),
    "dataset_predict": query("rows", "SELECT * FROM rows WHERE NOT label_available"),
    "abandoned_repos": query("windowed calendar outcome", """
  SELECT snapshot_date, repo_id, repo_name FROM windowed JOIN calendar USING (snapshot_date)
    ANTI JOIN outcome USING (snapshot_date, repo_id)
  WHERE label_available"""),
    "dataset_summary": query("train", """
  SELECT count(*) AS dataset_rows, count(DISTINCT repo_id) AS repos, avg(abandoned) AS abandoned_share
  FROM train"""),
    "lang_bucket": query("train top15", """
  SELECT snapshot_date, repo_id, language,
         CASE WHEN language IN (SELECT language FROM top15) THEN language ELSE 'other' END AS lang_bucket
  FROM train"""),
    "lang_onehot": query("train top15", f"""
  SELECT snapshot_date, repo_id,
         {", ".join(f"CAST(coalesce(place = {i + 1}, false) AS DOUBLE) AS lang_{i}" for i in range(15))},
         CAST(place IS NULL AS DOUBLE) AS lang_other
  FROM train LEFT JOIN top15 USING (language)"""),
    "group_split": query("train", """
  SELECT snapshot_date, repo_id,
         CAST('0x' || substr(md5('42:' || repo_id), 1, 8) AS BIGINT) % 100 < 25 AS is_test,
         CAST('0x' || substr(md5('43:' || repo_id), 1, 8) AS BIGINT) % 100 < 15 AS is_validation
  FROM train"""),
    "class_weights": query("train", """
  SELECT abandoned, count(*) AS class_rows,
         sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*)) AS class_weight
  FROM train GROUP BY abandoned"""),
    "scaled_features": query("train", f"""
  SELECT snapshot_date, repo_id, {", ".join(scaled(c) for c in NUMERIC)} FROM train"""),
    "met_roc_auc": query("auc", "SELECT round(roc_auc, 9) AS roc_auc FROM auc WHERE model = 'recency'"),
    "met_pr_auc": query("ap", "SELECT round(pr_auc, 9) AS pr_auc FROM ap WHERE model = 'recency'"),
    "met_at_k": query("at_k", "SELECT k, precision_at_k, recall_at_k FROM at_k WHERE model = 'recency'"),
    "met_best_f1": query("best", "SELECT t AS threshold, f1 FROM best WHERE model = 'recency'"),
    "met_confusion": query("recency", """
  SELECT tn, fp, fn, tp, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS "precision",
         CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall
  FROM (SELECT count(*) FILTER (p < 0.25 AND y = 0) AS tn, count(*) FILTER (p >= 0.25 AND y = 0) AS fp,
               count(*) FILTER (p < 0.25 AND y = 1) AS fn, count(*) FILTER (p >= 0.25 AND y = 1) AS tp
        FROM recency)"""),
    "met_roc_curve": query("cumulated classes", """
  SELECT fpr, tpr, threshold FROM (
    SELECT u.fp::DOUBLE / c.neg AS fpr, u.tp::DOUBLE / c.pos AS tpr, p AS threshold,
           row_number() OVER w = 1 OR lead(u.pos) OVER w IS NULL
             OR u.pos <> lead(u.pos) OVER w OR u.neg <> lead(u.neg) OVER w AS corner
    FROM cumulated u JOIN classes c USING (model) WHERE model = 'recency' WINDOW w AS (ORDER BY p DESC))
  WHERE corner
  UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE, 'infinity'::DOUBLE"""),
    "model_metrics": query("metrics", "SELECT * FROM metrics"),
    "best_model": query("metrics", "SELECT model, pr_auc FROM metrics ORDER BY pr_auc DESC, model LIMIT 1"),
    "latest_metrics": query("metrics", f"""
  SELECT trained_at, model, roc_auc, pr_auc, f1, "precision", recall, precision_at_k, recall_at_k, k
  FROM (SELECT * FROM metrics
        UNION ALL SELECT * REPLACE (TIMESTAMP '{EARLIER_RUN}' AS trained_at, 1.0::DOUBLE AS pr_auc) FROM metrics)
  WHERE trained_at = TIMESTAMP '{LAST_RUN}'"""),
    "predictions": query("predicted", "SELECT * FROM predicted"),
    "predictions_backfilled": query("earlier rows", """
  SELECT e.* REPLACE (CASE WHEN r.label_available THEN r.abandoned END AS label)
  FROM earlier e LEFT JOIN rows r USING (snapshot_date, repo_id)"""),
    "predictions_final": query("final", "SELECT * FROM final"),
    "latest_snapshot": query("final", "SELECT max(snapshot_date) AS snapshot_date FROM final"),
    "rpt_pred_summary": query("last", """
  SELECT *, flagged::DOUBLE / total AS flagged_share, 1 - flagged::DOUBLE / total AS healthy_share FROM (
    SELECT count(*) AS total, count(*) FILTER (prediction = 1) AS flagged,
           count(*) FILTER (prediction = 0) AS healthy, count(label) AS known_labels FROM last)"""),
    "rpt_threshold": query("last", """
  SELECT coalesce(min(probability) FILTER (prediction = 1), 0.5::DOUBLE) AS threshold FROM last"""),
    "rpt_prob_hist": query("last", """
  SELECT bucket, repos, bucket >= (SELECT coalesce(min(probability) FILTER (prediction = 1), 0.5::DOUBLE) FROM last)
           AS flagged
  FROM (SELECT round_even(probability * 10, 0) / 10 AS bucket, count(*) AS repos FROM last GROUP BY 1)"""),
    "rpt_verdict_sample": query("sample", "SELECT * FROM sample"),
    "verdict_filtered": query("sample", "SELECT * FROM sample WHERE prediction = 1"),
    "verdict_outcome": query("closed", f"""
  SELECT repo_id, repo_name, probability, {FORECAST}, {FACT},
         CASE WHEN label IS NULL THEN 'unknown' WHEN label = prediction THEN 'hit' ELSE 'miss' END AS outcome
  FROM closed"""),
    "rpt_top_risk": query("last", """
  SELECT repo_id, repo_name, language, probability FROM last ORDER BY probability DESC, repo_id LIMIT 20"""),
    "rpt_agreement": query("closed", """
  SELECT count(*) AS total, count(*) FILTER (prediction = 1) AS flagged,
         count(*) FILTER (label = 1) AS actually_abandoned,
         count(*) FILTER (prediction = 1 AND label = 1) AS hits FROM closed"""),
    "rpt_risk_by_language": query("last", """
  SELECT language, count(*) AS repos, count(*) FILTER (prediction = 1) AS flagged,
         count(*) FILTER (prediction = 1)::DOUBLE / count(*) AS flagged_share
  FROM last GROUP BY language"""),
    "rpt_risk_change": query("final", """
  SELECT repo_id, snapshot_date, probability, lag(probability) OVER w AS previous,
         probability - lag(probability) OVER w AS change
  FROM final WINDOW w AS (PARTITION BY repo_id ORDER BY snapshot_date)"""),
}
