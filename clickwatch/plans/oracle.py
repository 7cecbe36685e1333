"""The registered queries once more, as SQL over the same tables.

Written independently of the Spark plans where that is possible: global
`row_number`, rank formulas and as-of joins stand against counting and filters.
"""

from __future__ import annotations

from clickwatch import constants as C
from clickwatch.plans.fixed_forest import score_sql

GEO_LIST = "['US','IN','BR','DE','FR','UK','CA','JP','IT','AU']"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def iso(expr: str) -> str:
    return f"strftime({expr}, {ISO})"


def uniform(text: str, i: int) -> str:
    return f"(cast('0x' || substr(md5({text} || '#{i // 4}'), {1 + 8 * (i % 4)}, 8) AS bigint) / 4294967296.0::double)"


def key_text(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return f"concat_ws('|', cast(epoch({p}window_end) AS bigint)::varchar, {p}geo, {p}platform, '{C.FOREST_SEED}')"


MODEL = ("ctr", "bounce", "log_count")
# name -> (needs, body); bodies become WITH entries in the order of their needs
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTES[name] = (tuple(needs.split()), body)


cte("clicks", "", f"""
SELECT event_id,
  make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 120) AS ts,
  substr(sha256(user_id::varchar || ':salt'), 1, 16) AS user_id_hash,
  'ad_' || (1000 + event_id % 9000)::varchar AS ad_id,
  'camp_' || (100 + user_id % 900)::varchar AS campaign_id,
  list_extract({GEO_LIST}, (user_id % 10 + 1)::bigint) AS geo,
  CASE WHEN event_id % 20 < 9 THEN 'web' WHEN event_id % 20 < 15 THEN 'android' ELSE 'ios' END AS platform,
  'agent/' || event_type AS user_agent,
  ((100 + cents % 1100) / 1000.0::double)::decimal(10,3) AS cpc,
  ((cents % 500) / 10000.0::double)::decimal(10,4) AS ctr,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS conversion,
  ((200 + (cents * 7) % 700) / 1000.0::double)::decimal(10,3) AS bounce_rate,
  value / 100 AS seconds, user_id
FROM (SELECT *, round(value * 100)::bigint AS cents FROM events)
""")

cte("raw", "clicks", """
SELECT event_id, CASE WHEN event_id % 50 = 5 THEN substr(v, 1, 40) ELSE v END AS value FROM (
  SELECT event_id, '{' || concat_ws(',',
    '"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || CASE WHEN event_id % 50 = 1 THEN '' ELSE 'Z' END || '"',
    '"user_id_hash":"' || CASE WHEN event_id % 50 = 2 THEN 'xyz' ELSE user_id_hash END || '"',
    '"ad_id":"' || CASE WHEN event_id % 50 = 3 THEN 'advertisement_1' ELSE ad_id END || '"',
    '"campaign_id":"' || campaign_id || '"',
    '"geo":"' || CASE event_id % 50 WHEN 4 THEN lower(geo) WHEN 6 THEN 'USA' ELSE geo END || '"',
    '"platform":"' || CASE WHEN event_id % 50 = 7 THEN 'desktop' ELSE platform END || '"',
    '"user_agent":"' || CASE WHEN event_id % 50 = 8 THEN '  ' ELSE user_agent END || '"',
    '"CPC":' || CASE event_id % 50 WHEN 9 THEN '-0.5' WHEN 13 THEN '12345678.5' ELSE cpc::varchar END,
    '"CTR":' || CASE WHEN event_id % 50 = 10 THEN '1.5' ELSE ctr::varchar END,
    '"conversion":' || CASE WHEN event_id % 50 = 11 THEN '2' ELSE conversion::varchar END,
    CASE WHEN event_id % 50 <> 12 THEN '"bounce_rate":' || bounce_rate::varchar END) || '}' AS v
  FROM clicks)
""")

cte("parsed", "raw", """
SELECT event_id, j IS NOT NULL AS readable,
  j->>'timestamp' AS "timestamp", j->>'user_id_hash' AS user_id_hash, j->>'ad_id' AS ad_id,
  j->>'campaign_id' AS campaign_id, j->>'geo' AS geo, j->>'platform' AS platform, j->>'user_agent' AS user_agent,
  try_cast(j->>'CPC' AS double) AS CPC, try_cast(j->>'CTR' AS double) AS CTR,
  try_cast(j->>'conversion' AS double) AS conversion, try_cast(j->>'bounce_rate' AS double) AS bounce_rate
FROM (SELECT event_id, CASE WHEN json_valid(value) THEN value::json END AS j FROM raw)
""")

EVENT_RULES = {
    "timestamp": """"timestamp" LIKE '%Z' AND try_cast(rtrim("timestamp", 'Z') AS timestamp) IS NOT NULL""",
    "user_id_hash": "regexp_full_match(user_id_hash, '[0-9a-f]{16,64}')",
    "ad_id": r"regexp_full_match(ad_id, 'ad_\d+')",
    "campaign_id": r"regexp_full_match(campaign_id, 'camp_\d+')",
    "geo": "regexp_full_match(geo, '[A-Z]{2}')",
    "platform": "platform IN ('web','ios','android')",
    "user_agent": "trim(user_agent) <> ''",
    "CPC": "CPC >= 0",
    "CTR": "CTR BETWEEN 0 AND 1",
    "conversion": "conversion IN (0, 1)",
    "bounce_rate": "bounce_rate BETWEEN 0 AND 1",
    "CPC_range": "(CPC IS NULL OR CPC < 9999999.9995)",
}
UPPER_GEO = "length(geo) = 2 AND upper(geo) = geo AND lower(geo) <> geo"


def all_of(rules: list[str]) -> str:
    return " AND ".join(f"coalesce({r}, false)" for r in rules)


cte("checked", "parsed", "SELECT *, concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT coalesce({r}, false) THEN '{n}' END" for n, r in EVENT_RULES.items()) + ") AS failed_rules FROM parsed")
cte("valid", "parsed", f"SELECT * EXCLUDE readable FROM parsed WHERE {all_of(list(EVENT_RULES.values()))}")
cte("table_rows", "valid", """
SELECT event_id, rtrim("timestamp", 'Z')::timestamp AS "timestamp", user_id_hash, ad_id, campaign_id, geo, platform,
  user_agent, CPC::decimal(10,3)::double AS cpc, CTR::decimal(10,4)::double AS ctr, conversion::int AS conversion,
  bounce_rate::decimal(10,3)::double AS bounce_rate
FROM valid
""")
cte("subset", "parsed", f"""
SELECT event_id, rtrim("timestamp", 'Z')::timestamp AS ts, geo, platform, CTR AS ctr, bounce_rate FROM parsed
WHERE {all_of([EVENT_RULES["timestamp"], UPPER_GEO, EVENT_RULES["platform"], EVENT_RULES["CTR"], EVENT_RULES["bounce_rate"]])}
""")


def windowed(source: str, copies: int) -> str:
    """Windows of 5 minutes, `copies` per row, exact half-up means."""
    slide = 300 // copies
    return f"""
SELECT make_timestamp(ws * 1000000) AS window_start, make_timestamp((ws + 300) * 1000000) AS window_end, geo, platform,
  ((2 * cs + n) // (2 * n)) / 10000.0::double AS ctr_avg,
  ((2 * bs + n) // (2 * n)) / 1000.0::double AS bounce_rate_avg, n AS event_count
FROM (SELECT (epoch_us(ts) // {slide * 1000000}) * {slide} - {slide} * o AS ws, geo, platform,
        sum(round(ctr * 10000)::bigint)::bigint AS cs, sum(round(bounce_rate * 1000)::bigint)::bigint AS bs, count(*) AS n
      FROM {source} CROSS JOIN range({copies}) r(o) GROUP BY ALL)
"""


cte("features", "clicks", windowed("clicks", 5))
cte("tumbling", "clicks", windowed("clicks", 1))
cte("subset_features", "subset", windowed("subset", 5))

cte("raw_features", "features", f"""
SELECT CASE WHEN fault = 6 THEN substr(v, 1, 40) ELSE v END AS value FROM (
  SELECT fault, '{{' || concat_ws(',',
    '"window_start":"' || {iso("window_start")} || '"',
    '"window_end":"' || CASE WHEN fault = 5 THEN rtrim({iso("window_end")}, 'Z') ELSE {iso("window_end")} END || '"',
    CASE WHEN fault <> 8 THEN '"geo":"' || CASE WHEN fault = 1 THEN lower(geo) ELSE geo END || '"' END,
    '"platform":"' || CASE WHEN fault = 2 THEN 'desktop' ELSE platform END || '"',
    '"ctr_avg":' || CASE WHEN fault = 3 THEN '1.5' ELSE ctr_avg::decimal(10,4)::varchar END,
    '"bounce_rate_avg":' || CASE WHEN fault = 7 THEN '-0.1' ELSE bounce_rate_avg::decimal(10,3)::varchar END,
    '"event_count":' || CASE fault WHEN 4 THEN '0' WHEN 9 THEN event_count || '.0' ELSE event_count::varchar END) || '}}' AS v
  FROM (SELECT *, (epoch_us(window_start) // 60000000 + event_count) % 20 AS fault FROM features))
""")
cte("messages", "raw_features", """
SELECT j->>'window_start' AS window_start, j->>'window_end' AS window_end, j->>'geo' AS geo, j->>'platform' AS platform,
  try_cast(j->>'ctr_avg' AS double) AS ctr_avg, try_cast(j->>'bounce_rate_avg' AS double) AS bounce_rate_avg,
  try_cast(j->>'event_count' AS double) AS any_count,
  CASE WHEN regexp_full_match(j->>'event_count', '-?\\d+') THEN (j->>'event_count')::bigint END AS event_count
FROM (SELECT CASE WHEN json_valid(value) THEN value::json END AS j FROM raw_features)
""")
STRICT_FEATURE = all_of([
    "window_start LIKE '%Z'", "window_end LIKE '%Z'", UPPER_GEO, "platform IN ('web','ios','android')",
    "ctr_avg BETWEEN 0 AND 1", "bounce_rate_avg BETWEEN 0 AND 1", "any_count >= 1 AND any_count = floor(any_count)"])
LENIENT = ["window_start IS NOT NULL", "window_end IS NOT NULL", "length(geo) = 2", "platform IN ('web','ios','android')",
           "ctr_avg >= 0", "bounce_rate_avg >= 0", "event_count >= 0"]
cte("strict_messages", "messages",
    f"SELECT * EXCLUDE (any_count) REPLACE (any_count::bigint AS event_count) FROM messages WHERE {STRICT_FEATURE}")
cte("lenient_messages", "messages", f"SELECT * EXCLUDE (any_count) FROM messages WHERE {all_of(LENIENT)}")

# --- dataset -----------------------------------------------------------------------------
cte("cap", "features", "SELECT quantile_cont(greatest(event_count, 1)::double, 0.999) AS q, greatest(quantile_cont(greatest(event_count, 1)::double, 0.999), 1000.0::double) AS cap FROM features")
cte("bounded", "features cap", """
SELECT window_end, geo, platform, least(greatest(ctr_avg, 0.0::double), 1.0::double) AS ctr,
  least(greatest(bounce_rate_avg, 0.0::double), 1.0::double) AS bounce, least(greatest(event_count, 1)::double, (SELECT cap FROM cap)) AS "count",
  row_number() OVER (ORDER BY window_end, geo, platform) <= floor(0.8::double * count(*) OVER ()) AS is_train
FROM features
""")
cte("prepared", "bounded cap", """
SELECT window_end, geo, platform, is_train, ctr, bounce, ln(1 + least("count", (SELECT cap FROM cap))) AS log_count FROM bounded
""")
cte("scaler", "prepared", "SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN min({c}) = max({c}) THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in MODEL) + " FROM prepared WHERE is_train")
cte("scaled", "prepared scaler", "SELECT window_end, geo, platform, is_train, " + ", ".join(
    f"({c} - m_{c}) / s_{c} AS {c}" for c in MODEL) + " FROM prepared, scaler")


def serving(source: str) -> str:
    raw = {
        "ctr": "least(greatest(ctr_avg, 0.0::double), 1.0::double)",
        "bounce": "least(greatest(bounce_rate_avg, 0.0::double), 1.0::double)",
        "log_count": f"ln(1 + least(event_count::double, {C.SERVING_COUNT_CAP}::double))",
    }
    return f"SELECT *, " + ", ".join(
        f"({raw[c]} - {m!r}::double) / {s!r}::double AS {c}" for c, m, s in zip(MODEL, C.SERVING_MEAN, C.SERVING_SCALE)) + f" FROM {source}"


cte("served", "features", serving("features"))
cte("fixed", "served", f"SELECT *, {score_sql()} AS anomaly_score FROM served")
cte("tau", "fixed", "SELECT quantile_cont(anomaly_score, 0.98) AS tau FROM fixed")
cte("flags", "fixed tau", "SELECT fixed.*, tau, anomaly_score >= tau AS is_anomaly FROM fixed, tau")
cte("served_messages", "strict_messages", serving("strict_messages"))
cte("scored_messages", "served_messages",
    f"SELECT *, {score_sql()} AS anomaly_score, {score_sql()} >= {C.SERVING_THRESHOLD!r}::double AS is_anomaly FROM served_messages")

cte("request_checks", "messages", """
SELECT *, concat_ws(',', CASE WHEN NOT coalesce(ctr_avg BETWEEN 0 AND 1, false) THEN 'ctr_avg' END,
  CASE WHEN NOT coalesce(bounce_rate_avg BETWEEN 0 AND 1, false) THEN 'bounce_rate_avg' END,
  CASE WHEN NOT coalesce(event_count >= 1, false) THEN 'event_count' END) AS faults FROM messages
""")
cte("served_requests", "request_checks", serving("request_checks WHERE faults = ''"))

# --- a small forest, grown level by level ------------------------------------------------------------
TREES, SAMPLES, DEPTH = 3, 16, 4


def named(*parts: str) -> str:
    """A draw in [0, 1) from the names of tree and node."""
    return f"(('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 8))::bigint / 4294967296.0::double)"


def mean_path(size: str) -> str:
    return f"""CASE WHEN {size} <= 1 THEN 0.0::double WHEN {size} = 2 THEN 1.0::double
    ELSE 2.0::double * (ln({size} - 1) + {C.EULER_GAMMA!r}::double) - 2.0::double * ({size} - 1) / {size} END"""


cte("train_rows", "scaled", f"""
SELECT *, row_number() OVER (ORDER BY {uniform("t", 0)}, window_end, geo, platform) - 1 AS position, count(*) OVER () AS total
FROM (SELECT *, {key_text()} AS t FROM scaled WHERE is_train)
""")
cte("forest_draws", "train_rows", f"""
SELECT tree_id, position FROM (
  SELECT tree_id, position, row_number() OVER (PARTITION BY tree_id ORDER BY min(draw)) AS nth FROM (
    SELECT tree_id, draw, ('0x' || substr(md5('{C.FOREST_SEED}|' || tree_id || '|' || draw), 1, 15))::bigint % (SELECT max(total) FROM train_rows) AS position
    FROM range({TREES}) a(tree_id), range({40 * SAMPLES}) b(draw)) GROUP BY tree_id, position)
WHERE nth <= {SAMPLES}
""")
cte("members_0", "forest_draws train_rows", f"SELECT tree_id, 0 AS node_id, {', '.join(MODEL)} FROM forest_draws JOIN train_rows USING (position)")
for depth in range(DEPTH + 1):
    ranges = ", ".join(f"min({c}) AS low_{i}, max({c}) AS high_{i}" for i, c in enumerate(MODEL))
    wide = ", ".join(f"CASE WHEN high_{i} > low_{i} THEN {i} END" for i in range(3))
    chosen = named(f"'{C.FOREST_SEED}'", "tree_id", "node_id", "'feature'")
    placed = named(f"'{C.FOREST_SEED}'", "tree_id", "node_id", "'threshold'")
    pick = lambda kind: "CASE feature " + " ".join(f"WHEN {i} THEN {kind}_{i}" for i in range(3)) + " END"
    cte(f"nodes_{depth}", f"members_{depth}", f"""
SELECT tree_id, node_id, coalesce(feature, -1) AS feature, {pick("low")} + {placed} * ({pick("high")} - {pick("low")}) AS threshold, size,
  CASE WHEN feature IS NULL THEN {depth} + {mean_path("size")} END AS path_length
FROM (SELECT *, {"NULL" if depth == DEPTH else f"wide[floor({chosen} * len(wide))::bigint + 1]"} AS feature
      FROM (SELECT *, list_filter([{wide}], lambda f: f IS NOT NULL) AS wide
            FROM (SELECT tree_id, node_id, count(*) AS size, {ranges} FROM members_{depth} GROUP BY tree_id, node_id)))
""")
    value = "CASE feature " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(MODEL)) + " END"
    cte(f"members_{depth + 1}", f"members_{depth} nodes_{depth}", f"""
SELECT tree_id, 2 * node_id + 1 + ({value} > threshold)::int AS node_id, {', '.join(MODEL)} FROM members_{depth} JOIN nodes_{depth} USING (tree_id, node_id)
WHERE feature >= 0
""")
cte("small_nodes", " ".join(f"nodes_{d}" for d in range(DEPTH + 1)), " UNION ALL ".join(f"SELECT * FROM nodes_{d}" for d in range(DEPTH + 1)))
cte("descent_0", "scaled", f"SELECT window_end, geo, platform, {', '.join(MODEL)}, tree_id, 0 AS node_id FROM scaled, range({TREES}) a(tree_id) WHERE NOT is_train")
for depth in range(DEPTH):
    cte(f"descent_{depth + 1}", f"descent_{depth} small_nodes", f"""
SELECT d.* REPLACE (CASE WHEN feature < 0 THEN d.node_id ELSE 2 * d.node_id + 1 + ({value} > threshold)::int END AS node_id)
FROM descent_{depth} d JOIN small_nodes n ON d.tree_id = n.tree_id AND d.node_id = n.node_id
""")
cte("small_scores", f"descent_{DEPTH} small_nodes", f"""
SELECT window_end, geo, platform, pow(2, -sum(path_length) / {TREES} / ({mean_path(str(SAMPLES))})) AS anomaly_score
FROM descent_{DEPTH} JOIN small_nodes USING (tree_id, node_id) GROUP BY window_end, geo, platform
""")

# --- evaluation ------------------------------------------------------------------------------
cte("validation", "bounded", f"""
SELECT window_end, geo, platform, ctr, bounce, "count", md5({key_text()} || '|pick') AS draw, md5({key_text()} || '|top-up') AS draw2,
  greatest(1, round_even({C.INJECTION_RATE}::double * count(*) OVER (), 0))::bigint AS k
FROM bounded WHERE NOT is_train
""")
cte("uniform_labels", "validation", """
SELECT *, row_number() OVER (ORDER BY draw, window_end, geo, platform) <= k AS picked FROM validation
""")
cte("stratum_picks", "validation", """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY geo, platform ORDER BY draw, window_end, geo, platform)
            <= greatest(1, k // (SELECT count(*) FROM (SELECT DISTINCT geo, platform FROM validation))) AS in_stratum
  FROM validation)
""")
cte("stratified_labels", "stratum_picks", """
SELECT * EXCLUDE (in_stratum, in_order, extra, chosen),
  CASE WHEN in_stratum THEN in_order <= k ELSE extra <= k - chosen END AS picked
FROM (SELECT *, count(*) FILTER (WHERE in_stratum) OVER () AS chosen,
  row_number() OVER (PARTITION BY in_stratum ORDER BY window_end, geo, platform) AS in_order,
  row_number() OVER (PARTITION BY in_stratum ORDER BY draw2, window_end, geo, platform) AS extra
  FROM stratum_picks)
""")


def injected(labels: str) -> str:
    u = [uniform("t", i) for i in range(6)]

    def spread(i: int, bounds: tuple[float, float]) -> str:
        return f"({bounds[0]!r}::double + u{i} * {bounds[1] - bounds[0]!r}::double)"

    return f"""
SELECT window_end, geo, platform,
  CASE WHEN picked THEN least(greatest(ctr * CASE kind WHEN 'ctr_spike' THEN {spread(1, C.CTR_SPIKE_FACTOR)}
    WHEN 'mixed' THEN {spread(1, C.MIXED_CTR_FACTOR)} ELSE 1 END + jitter, 0), 1) ELSE ctr END AS ctr,
  CASE WHEN picked THEN least(greatest(bounce + CASE kind WHEN 'bounce_spike' THEN {spread(2, C.BOUNCE_SPIKE_SHIFT)}
    WHEN 'mixed' THEN {spread(2, C.MIXED_BOUNCE_SHIFT)} ELSE 0 END + jitter, 0), 1) ELSE bounce END AS bounce,
  CASE WHEN picked THEN least("count" * CASE kind WHEN 'volume_spike' THEN {spread(3, C.VOLUME_SPIKE_FACTOR)}
    WHEN 'mixed' THEN {spread(3, C.MIXED_VOLUME_FACTOR)} ELSE 1 END, (SELECT cap FROM cap)) ELSE "count" END AS "count",
  picked::int AS label, CASE WHEN picked THEN kind END AS kind
FROM (SELECT *, list_extract(['ctr_spike','bounce_spike','volume_spike','mixed'], (floor(u0 * 4) + 1)::bigint) AS kind,
        {C.JITTER_STD!r}::double * sqrt(-2.0::double * ln(1.0::double - u4)) * cos(2 * pi() * u5) AS jitter
      FROM (SELECT *, {", ".join(f"{e} AS u{i}" for i, e in enumerate(u))}
            FROM (SELECT *, {key_text()} AS t FROM {labels})))
"""


cte("injected_uniform", "uniform_labels cap", injected("uniform_labels"))
cte("injected_stratified", "stratified_labels cap", injected("stratified_labels"))
cte("labelled_inputs", "injected_uniform scaler cap", "SELECT window_end, geo, platform, label, " + ", ".join(
    f"({e} - m_{c}) / s_{c} AS {c}" for c, e in zip(MODEL, ("ctr", "bounce", 'ln(1 + least("count", (SELECT cap FROM cap)))'))
) + " FROM (SELECT * FROM injected_uniform), scaler")
cte("labelled", "labelled_inputs", f"SELECT *, {score_sql()} AS anomaly_score FROM labelled_inputs")
cte("labelled_flags", "labelled", "SELECT *, anomaly_score >= (SELECT quantile_cont(anomaly_score, 0.98) FROM labelled) AS flagged FROM labelled")


def auc(source: str) -> str:
    """Mean-rank formula: ties share the average rank."""
    return f"""
SELECT (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2.0::double) / (p::double * n) AS auc
FROM (SELECT label, rank() OVER (ORDER BY anomaly_score) + (count(*) OVER (PARTITION BY anomaly_score) - 1) / 2.0::double AS r,
        count(*) FILTER (WHERE label = 1) OVER () AS p, count(*) FILTER (WHERE label = 0) OVER () AS n FROM {source})
GROUP BY p, n
"""


cte("random_labelled", "fixed", f"SELECT *, ({uniform(key_text() + chr(32) + '|| ' + chr(39) + '|random-label' + chr(39), 0)} < {C.INJECTION_RATE}::double)::int AS label FROM fixed")

# --- late rows: a window takes a row only if it was open after the run before -------------------------
cte("arrivals", "subset clicks", """
SELECT s.*, CASE WHEN s.event_id % 7 = 0 AND c.ts < TIMESTAMP '2024-01-01 01:00:00' THEN 3 WHEN c.ts < TIMESTAMP '2024-01-01 02:00:00' THEN 1
  WHEN c.ts < TIMESTAMP '2024-01-01 04:00:00' THEN 2 ELSE 3 END AS run
FROM subset s JOIN clicks c USING (event_id)
""")
cte("late_windows", "arrivals", """
SELECT make_timestamp(ws * 1000000) AS window_start, make_timestamp((ws + 300) * 1000000) AS window_end, geo, platform,
  ((2 * cs + n) // (2 * n)) / 10000.0::double AS ctr_avg, ((2 * bs + n) // (2 * n)) / 1000.0::double AS bounce_rate_avg, n AS event_count
FROM (SELECT ws, geo, platform, sum(round(ctr * 10000)::bigint)::bigint AS cs, sum(round(bounce_rate * 1000)::bigint)::bigint AS bs, count(*) AS n
      FROM (SELECT *, (epoch_us(ts) // 60000000) * 60 - 60 * o AS ws,
              (SELECT max(b.ts) FROM arrivals b WHERE b.run < a.run) - INTERVAL 30 seconds AS closed FROM arrivals a CROSS JOIN range(5) r(o))
      WHERE closed IS NULL OR make_timestamp((ws + 300) * 1000000) > closed GROUP BY ws, geo, platform)
""")

# --- feature store ------------------------------------------------------------------------------
ONLINE = """
SELECT geo, platform, max(window_end) AS event_timestamp, arg_max(ctr_avg, window_end)::float::double AS ctr_avg,
  arg_max(bounce_rate_avg, window_end)::float::double AS bounce_rate_avg, arg_max(event_count, window_end) AS event_count
FROM {source} GROUP BY geo, platform
"""
cte("online", "features", ONLINE.format(source="features"))


def sql(needs: str, final: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + final


def rounded(*names: str) -> str:
    return ", ".join(f'round("{n}", 9) AS "{n}"' for n in names)


WINDOW_COLUMNS = f"{iso('window_start')} AS window_start, {iso('window_end')} AS window_end, geo, platform, ctr_avg, bounce_rate_avg, event_count"
MEANS = """round(sum((ctr * 10000)::bigint)::double / 10000 / count(*), 9) AS avg_ctr,
  round(sum((bounce_rate * 1000)::bigint)::double / 1000 / count(*), 9) AS avg_bounce_rate,
  round(sum((cpc * 1000)::bigint)::double / 1000 / count(*), 9) AS avg_cpc"""
DAILY = f"""
SELECT strftime(ts, '%Y-%m-%d') AS date, geo, platform, count(*) AS total_events, {MEANS},
  sum(conversion)::bigint AS total_conversions, count(CASE WHEN conversion = 1 THEN 1 END) AS conversion_count
FROM clicks GROUP BY 1, 2, 3
"""
EVENT_COLUMNS = "user_id_hash, ad_id, campaign_id, geo, platform, user_agent"
MODEL_ROUNDED = rounded(*MODEL)
END_KEYS = f"{iso('window_end')} AS window_end, geo, platform"


cte("altered_features", "features", """
SELECT geo, platform, window_end, event_count, ctr_avg, bounce_rate_avg FROM (
  SELECT *, row_number() OVER (PARTITION BY geo, platform, window_end ORDER BY event_count DESC, ctr_avg DESC, bounce_rate_avg DESC) AS nth
  FROM (SELECT geo, platform, window_end + INTERVAL 1 second * ((n * 17) % 60) AS window_end, n + extra AS event_count, ctr_avg, bounce_rate_avg
        FROM (SELECT *, event_count AS n FROM features) f, (SELECT unnest([0, 1]) AS extra) WHERE extra = 0 OR n % 2 = 0))
WHERE nth = 1
""")


def asof(age: str, features: str = "features") -> str:
    return sql(f"clicks {features}", f"""
SELECT event_id, epoch_us(ts) AS ts, geo, platform,
  CASE WHEN fresh THEN {iso("we")} END AS window_end, CASE WHEN fresh THEN ctr_avg END AS ctr_avg,
  CASE WHEN fresh THEN bounce_rate_avg END AS bounce_rate_avg, CASE WHEN fresh THEN event_count END AS event_count
FROM (SELECT c.event_id, c.ts, c.geo, c.platform, f.window_end AS we, f.ctr_avg, f.bounce_rate_avg, f.event_count,
        f.window_end >= c.ts - INTERVAL {age} AS fresh
      FROM clicks c ASOF LEFT JOIN {features} f ON c.geo = f.geo AND c.platform = f.platform AND c.ts >= f.window_end)
""")


HISTOGRAM = "\nUNION ALL ".join(
    [f"SELECT '{b}' AS le, count(*) FILTER (WHERE anomaly_score <= {b}) AS rows FROM fixed" for b in C.SCORE_BUCKETS]
    + ["SELECT '+Inf' AS le, count(*) AS rows FROM fixed"])

P95 = f"""
SELECT {iso("w")} AS window_start, sum(n)::bigint AS observations, round(coalesce(
    min(low + (le - low) * (rank - (cum - n)) / n) FILTER (WHERE cum >= rank AND cum - n < rank AND le < 1e300), 10.0), 9) AS quantile
FROM (SELECT w, le, low, n, sum(n) OVER (PARTITION BY w ORDER BY le) AS cum, 0.95::double * sum(n) OVER (PARTITION BY w) AS rank
  FROM (SELECT time_bucket(INTERVAL 5 minutes, ts) AS w, b.le, b.low, count(*) AS n
    FROM clicks JOIN (SELECT unnest([0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 1e308]::double[]) AS le,
                             unnest([0.0, 0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]::double[]) AS low) b
      ON seconds <= b.le AND (seconds > b.low OR b.low = 0)
    GROUP BY ALL))
GROUP BY w
"""


# --- sampled counters: read every minute, restarted at the full hour ---------------------------------------
cte("counter_samples", "clicks", """
SELECT instance, le, minute + INTERVAL 1 minute AS read_at,
  sum(n) OVER (PARTITION BY instance, le, date_trunc('hour', minute) ORDER BY minute) AS value
FROM (SELECT (user_id % 3)::int AS instance, b.le, date_trunc('minute', ts) AS minute, count(*) FILTER (WHERE seconds <= b.le) AS n
      FROM clicks CROSS JOIN (SELECT unnest([0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 'Infinity'::double]) AS le) b GROUP BY ALL)
""")
cte("counter_gains", "counter_samples", """
SELECT instance, le, time_bucket(INTERVAL 5 minutes, read_at) AS w,
  (CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END)::bigint AS increase
FROM (SELECT *, lag(value) OVER (PARTITION BY instance, le ORDER BY read_at) AS before FROM counter_samples)
""")
COUNTER_P95 = f"""
SELECT {iso("w")} AS window_start, max(observations)::bigint AS observations,
  round(arg_min(CASE WHEN le = 'Infinity'::double THEN low ELSE low + (le - low) * (0.95::double * observations - below) / (upto - below)::double END, le), 9) AS quantile
FROM (SELECT w, le, upto, coalesce(lag(le) OVER bounds, 0.0) AS low, coalesce(lag(upto) OVER bounds, 0) AS below, max(upto) OVER (PARTITION BY w) AS observations
  FROM (SELECT w, le, sum(increase)::bigint AS upto FROM counter_gains GROUP BY w, le) WINDOW bounds AS (PARTITION BY w ORDER BY le))
WHERE observations > 0 AND upto >= 0.95::double * observations
GROUP BY w
"""
OPEN_WINDOWS = f"""
SELECT {iso("make_timestamp((ws + 300) * 1000000)")} AS window_end, geo, platform, count(*) AS event_count
FROM (SELECT *, (epoch_us(ts) // 60000000) * 60 - 60 * o AS ws FROM arrivals CROSS JOIN range(5) r(o) WHERE run <= 2)
WHERE make_timestamp((ws + 300) * 1000000) > (SELECT max(ts) FROM arrivals WHERE run <= 2) - INTERVAL 30 seconds
GROUP BY ws, geo, platform
"""
# web has no rows after 02:00, and an hour after its newest row a key is gone
UNEXPIRED = f"""
WITH told AS (SELECT * REPLACE (rtrim(window_end, 'Z')::timestamp AS window_end) FROM lenient_messages WHERE window_end LIKE '%Z'),
kept AS (SELECT * FROM told WHERE platform <> 'web' OR window_end <= TIMESTAMP '2024-01-01 02:00:00')
SELECT * REPLACE ({iso("event_timestamp")} AS event_timestamp) FROM ({ONLINE.format(source="kept")})
WHERE event_timestamp + INTERVAL 1 hour > (SELECT max(window_end) FROM kept) - INTERVAL 30 seconds
"""

REPORT = f"""
SELECT * FROM (WITH stats AS (
  SELECT CASE WHEN grouping(geo) = 1 THEN 'total' WHEN grouping(date) = 1 THEN 'geo' ELSE 'daily' END AS section, date, geo, platform,
    count(*) AS events, {MEANS}, sum(conversion)::bigint AS total_conversions
  FROM (SELECT *, strftime(clicks.ts, '%Y-%m-%d') AS date FROM clicks) GROUP BY GROUPING SETS ((date, geo, platform), (geo), ())),
ranked AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY date DESC, CASE WHEN section = 'geo' THEN -events END, geo, platform) AS position FROM stats)
SELECT section, position, date, geo, platform, events, avg_ctr, avg_bounce_rate, avg_cpc, total_conversions, NULL AS event_id, NULL AS ts
FROM ranked WHERE section <> 'daily' OR position <= 10
UNION ALL
SELECT 'recent', row_number() OVER (ORDER BY t DESC, event_id DESC), NULL, geo, platform, NULL, NULL, NULL, NULL, NULL, event_id, epoch_us(t)
FROM (SELECT *, clicks.ts AS t FROM clicks ORDER BY clicks.ts DESC, event_id DESC LIMIT 5))
"""


ORACLE: dict[str, str] = {
    "sliding_features": sql("features", f"SELECT {WINDOW_COLUMNS} FROM features"),
    "tumbling_features": sql("tumbling", f"SELECT {WINDOW_COLUMNS} FROM tumbling"),
    "parse_events": sql("parsed", "SELECT * FROM parsed"),
    "valid_events": sql("valid", "SELECT * FROM valid"),
    "invalid_events": sql("checked", "SELECT event_id, failed_rules FROM checked WHERE failed_rules <> ''"),
    "rule_failure_counts": sql("checked", "SELECT rule, count(*) AS failures FROM (SELECT unnest(string_split(failed_rules, ',')) AS rule FROM checked WHERE failed_rules <> '') GROUP BY rule"),
    "stream_subset_events": sql("subset", "SELECT * REPLACE (epoch_us(ts) AS ts) FROM subset"),
    "valid_features": sql("strict_messages", "SELECT * FROM strict_messages"),
    "lenient_features": sql("lenient_messages", "SELECT * FROM lenient_messages"),
    "lenient_features_tail": sql("lenient_messages", "SELECT * FROM lenient_messages WHERE window_start LIKE '%Z' AND window_end LIKE '%Z'"),
    "scorable_features": sql("messages", "SELECT * EXCLUDE (any_count) FROM messages WHERE ctr_avg BETWEEN 0 AND 1 AND bounce_rate_avg BETWEEN 0 AND 1 AND event_count >= 1"),
    "ingest_quality": sql("checked", "SELECT count(*) AS processed, count(*) FILTER (WHERE failed_rules = '') AS valid, count(*) FILTER (WHERE failed_rules <> '') AS invalid, round(count(*) FILTER (WHERE failed_rules = '') / count(*)::double, 9) AS valid_rate FROM checked"),
    "clickstream_events": sql("table_rows", 'SELECT * REPLACE (epoch_us("timestamp") AS "timestamp") FROM table_rows'),
    "score_requests": sql("strict_messages", 'SELECT ctr_avg, bounce_rate_avg, event_count, geo, platform, window_end AS "timestamp" FROM strict_messages'),
    "pseudonymous_users": "SELECT user_id, substr(sha256(user_id::varchar || ':salt'), 1, 16) AS user_id_hash, count(*) AS events FROM events GROUP BY user_id",
    "events_as_json": sql("valid", """SELECT '{"timestamp":"' || "timestamp" || '","user_id_hash":"' || user_id_hash || '","ad_id":"' || ad_id || '","campaign_id":"' || campaign_id || '","geo":"' || geo || '","platform":"' || platform || '","user_agent":"' || user_agent || '","CPC":' || CPC::decimal(10,3)::varchar || ',"CTR":' || CTR::decimal(10,4)::varchar || ',"conversion":' || conversion::int::varchar || ',"bounce_rate":' || bounce_rate::decimal(10,3)::varchar || '}' AS value FROM valid"""),
    "lake_hour_counts": sql("table_rows", """SELECT strftime("timestamp", '%Y') AS y, strftime("timestamp", '%m') AS m, strftime("timestamp", '%d') AS d, strftime("timestamp", '%H') AS h, count(*) AS events FROM table_rows GROUP BY ALL"""),
    "total_events": "SELECT count(*) AS total_events FROM events",
    "daily_stats": sql("clicks", DAILY),
    "daily_stats_top10": sql("clicks", f"SELECT * FROM ({DAILY}) ORDER BY date DESC, geo, platform LIMIT 10"),
    "geo_stats": sql("clicks", f"SELECT geo, count(*) AS event_count, {MEANS} FROM clicks GROUP BY geo"),
    "top_recent_events": sql("clicks", "SELECT event_id, epoch_us(ts) AS ts, user_id_hash, ad_id, campaign_id, geo, platform, cpc::double AS cpc, ctr::double AS ctr, conversion, bounce_rate::double AS bounce_rate FROM clicks ORDER BY clicks.ts DESC, event_id DESC LIMIT 10"),
    "recent_events": sql("clicks", f"SELECT event_id, epoch_us(ts) AS ts, {EVENT_COLUMNS}, cpc::double AS cpc, ctr::double AS ctr, conversion, bounce_rate::double AS bounce_rate FROM clicks WHERE clicks.ts >= TIMESTAMP '2024-01-02 03:00:00' - INTERVAL 24 hours"),
    "features_by_window_end": sql("features", f"SELECT {WINDOW_COLUMNS} FROM features WHERE features.window_end >= TIMESTAMP '2024-01-08 03:00:00' - INTERVAL 7 days"),
    "offline_backfill": sql("features", f"SELECT strftime(window_end, '%Y-%m-%d') AS ingest_date, count(*) AS rows, sum(event_count)::bigint AS events, {iso('min(window_end)')} AS first_end, {iso('max(window_end)')} AS last_end FROM features GROUP BY 1"),
    "offline_scan": sql("features", f"SELECT {iso('window_start')} AS window_start, {iso('window_end')} AS window_end, geo, platform, ctr_avg AS avg_ctr, bounce_rate_avg AS avg_bounce_rate, event_count, strftime(features.window_end, '%Y-%m-%d') AS ingest_date FROM features"),
    "online_latest": sql("online", f"SELECT * REPLACE ({iso('event_timestamp')} AS event_timestamp) FROM online"),
    "online_lookup": sql("parsed online", f"""
SELECT event_id, geo, platform, CASE WHEN fresh THEN {iso("event_timestamp")} END AS event_timestamp, CASE WHEN fresh THEN ctr_avg END AS ctr_avg,
  CASE WHEN fresh THEN bounce_rate_avg END AS bounce_rate_avg, CASE WHEN fresh THEN event_count END AS event_count
FROM (SELECT event_id, p.geo, p.platform, o.* EXCLUDE (geo, platform), event_timestamp >= TIMESTAMP '2024-01-04 06:04:00' - INTERVAL 3 days AS fresh
      FROM parsed p LEFT JOIN online o ON p.geo = o.geo AND p.platform = o.platform)"""),
    "asof_features": asof("3 days"),
    "asof_features_short_ttl": asof("30 seconds"),
    "asof_features_altered": asof("2 minutes", "altered_features"),
    "materialize_incremental": sql("features", f"SELECT * REPLACE ({iso('event_timestamp')} AS event_timestamp) FROM (" + ONLINE.format(source="features WHERE window_end <= TIMESTAMP '2024-01-01 04:30:00'") + ")"),
    "materialize_since_last_run": sql("features", f"SELECT * REPLACE ({iso('event_timestamp')} AS event_timestamp) FROM (" + ONLINE.format(source="features WHERE window_end <= TIMESTAMP '2024-01-01 04:30:00'") + ")"),
    "sketched_quantiles": sql("clicks", "SELECT p::double AS p, count(DISTINCT clicks.ts::date) AS days, count(*) AS rows, true AS near FROM clicks, (VALUES (0.02), (0.25), (0.5), (0.98)) t(p) GROUP BY t.p"),
    "report": sql("clicks", REPORT),
    "count_cap": sql("cap", "SELECT round(q, 9) AS quantile, round(cap, 9) AS cap FROM cap"),
    "prepared_features": sql("prepared", f"SELECT {END_KEYS}, {MODEL_ROUNDED} FROM prepared"),
    "time_split": sql("bounded", f"SELECT {END_KEYS}, CASE WHEN is_train THEN 'train' ELSE 'val' END AS split FROM bounded"),
    "time_split_null_keys": sql("features", f"""
SELECT {iso("window_end")} AS window_end, geo, platform, CASE WHEN pos <= floor(0.8::double * total) THEN 'train' ELSE 'val' END AS split, count(*) AS rows
FROM (SELECT *, rank() OVER (ORDER BY window_end NULLS LAST, geo NULLS LAST, platform NULLS LAST) AS pos, count(*) OVER () AS total
  FROM (SELECT CASE WHEN fault <> 1 THEN window_end END AS window_end, CASE WHEN fault <> 2 THEN geo END AS geo, CASE WHEN fault <> 3 THEN platform END AS platform
        FROM (SELECT *, (event_count + epoch(window_end)::bigint) % 7 AS fault FROM features)))
GROUP BY ALL"""),
    "split_sizes": sql("bounded", "SELECT count(*) FILTER (WHERE is_train) AS train_size, count(*) FILTER (WHERE NOT is_train) AS val_size, count(*) AS total_size FROM bounded"),
    "scaler_fit": sql("scaler", "\nUNION ALL ".join(f"SELECT '{c}' AS feature, round(m_{c}, 9) AS mean, round(s_{c}, 9) AS scale FROM scaler" for c in MODEL)),
    "standardized_features": sql("scaled", f"SELECT {END_KEYS}, CASE WHEN is_train THEN 'train' ELSE 'val' END AS split, {MODEL_ROUNDED} FROM scaled"),
    "split_summary": sql("scaled", "SELECT CASE WHEN is_train THEN 'train' ELSE 'val' END AS split, " + ", ".join(
        f"round({f}({c}), 9) AS {n}_{c}" for c in MODEL for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"))) + " FROM scaled GROUP BY 1"),
    "serving_features": sql("served", f"SELECT {END_KEYS}, {MODEL_ROUNDED} FROM served"),
    "inverse_features": sql("scaled scaler", f"SELECT {END_KEYS}, round(ctr * s_ctr + m_ctr, 9) AS ctr, round(bounce * s_bounce + m_bounce, 9) AS bounce, round(greatest(exp(log_count * s_log_count + m_log_count) - 1, 1), 9) AS \"count\" FROM scaled, scaler"),
    "small_forest_nodes": sql("small_nodes", "SELECT tree_id::int AS tree_id, node_id::int AS node_id, feature::int AS feature, round(threshold, 9) AS threshold, size::int AS size, round(path_length, 9) AS path_length FROM small_nodes"),
    "small_forest_scores": sql("small_scores", f"SELECT {END_KEYS}, round(anomaly_score, 9) AS anomaly_score FROM small_scores"),
    "fixed_forest_scores": sql("fixed", f"SELECT {END_KEYS}, round(anomaly_score, 9) AS anomaly_score FROM fixed"),
    "fixed_forest_scores_jvm": sql("fixed", f"SELECT {END_KEYS}, round(anomaly_score, 9) AS anomaly_score FROM fixed"),
    "contamination_flags": sql("fixed", f"""
SELECT {END_KEYS}, round(-anomaly_score - off, 9) AS decision, -anomaly_score - off < 0 AS is_outlier
FROM fixed, (SELECT quantile_cont(-anomaly_score, 0.02) AS off FROM (
  SELECT anomaly_score, row_number() OVER (ORDER BY window_end, geo, platform) <= floor(0.8::double * count(*) OVER ()) AS is_train FROM fixed) WHERE is_train)"""),
    "threshold": sql("tau", "SELECT round(tau, 9) AS threshold FROM tau"),
    "flagged_windows": sql("flags", f"SELECT {END_KEYS}, round(anomaly_score, 9) AS anomaly_score, round(tau, 9) AS threshold, is_anomaly FROM flags"),
    "anomaly_results": sql("flags", f"SELECT {iso('window_end')} AS \"timestamp\", geo, platform, round(anomaly_score, 6) AS anomaly_score, CASE WHEN is_anomaly THEN 'isolation_forest' END AS anomaly_type, is_anomaly, event_count FROM flags"),
    "score_batch": sql("request_checks served_requests", f"""
SELECT round({score_sql()}, 9) AS anomaly_score, {score_sql()} >= {C.SERVING_THRESHOLD!r}::double AS is_anomaly, round({C.SERVING_THRESHOLD!r}::double, 9) AS threshold,
  'ctr_avg,bounce_rate_avg,event_count' AS features_used, geo, platform, window_end AS "timestamp", NULL AS error FROM served_requests
UNION ALL SELECT NULL, NULL, round({C.SERVING_THRESHOLD!r}::double, 9), 'ctr_avg,bounce_rate_avg,event_count', geo, platform, window_end, 'invalid: ' || faults FROM request_checks WHERE faults <> ''"""),
    "alerts": sql("flags", f"SELECT {iso('window_end')} AS ts, geo, platform, ctr_avg, bounce_rate_avg, event_count, round(anomaly_score, 9) AS anomaly_score, round(tau, 9) AS threshold, {iso('window_start')} AS source_start, {iso('window_end')} AS source_end FROM flags WHERE is_anomaly"),
    "inject_uniform": sql("injected_uniform", f"SELECT {END_KEYS}, {rounded('ctr', 'bounce', 'count')}, label, kind FROM injected_uniform"),
    "inject_stratified": sql("injected_stratified", f"SELECT {END_KEYS}, {rounded('ctr', 'bounce', 'count')}, label, kind FROM injected_stratified"),
    "confusion_metrics": sql("labelled_flags", """
SELECT tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0)::double, 0), 9) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0)::double, 0), 9) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::double, 0), 9) AS f1
FROM (SELECT count(*) FILTER (WHERE flagged AND label = 1) AS tp, count(*) FILTER (WHERE flagged AND label = 0) AS fp,
  count(*) FILTER (WHERE NOT flagged AND label = 1) AS fn, count(*) FILTER (WHERE NOT flagged AND label = 0) AS tn FROM labelled_flags)"""),
    "roc_auc": sql("labelled", f"SELECT round(auc, 9) AS roc_auc FROM ({auc('labelled')})"),
    "roc_curve": sql("labelled", """
SELECT round(sum(n) OVER w / sum(n) OVER ()::double, 9) AS fpr, round(sum(p) OVER w / sum(p) OVER ()::double, 9) AS tpr, round(s, 9) AS threshold
FROM (SELECT anomaly_score AS s, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM labelled GROUP BY 1)
WINDOW w AS (ORDER BY s DESC)
UNION ALL SELECT 0, 0, NULL"""),
    "roc_curve_corners": sql("labelled", """
SELECT round(fp / total_n::double, 9) AS fpr, round(tp / total_p::double, 9) AS tpr, round(s, 9) AS threshold
FROM (SELECT s, sum(n) OVER w AS fp, sum(p) OVER w AS tp, sum(n) OVER () AS total_n, sum(p) OVER () AS total_p,
        lead(n) OVER w IS NOT DISTINCT FROM n AND lead(p) OVER w IS NOT DISTINCT FROM p AS repeated
      FROM (SELECT anomaly_score AS s, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM labelled GROUP BY 1)
      WINDOW w AS (ORDER BY s DESC))
WHERE NOT repeated
UNION ALL SELECT 0, 0, NULL"""),
    "value_quantiles": " UNION ALL ".join(
        f"SELECT {p}::double AS p, round(quantile_cont(value + event_id / 1e7::double, {p}), 9) AS quantile FROM events" for p in (0.0, 0.02, 0.5, 0.98, 0.999, 1.0)),
    "value_auc": f"""
WITH scored AS (SELECT coalesce(value + event_id / 1e7::double, -1e300) AS anomaly_score, label FROM (
  SELECT CASE WHEN event_id % 11 <> 0 THEN value END AS value, event_id, (event_type = 'purchase')::int AS label FROM events))
SELECT round(auc, 9) AS roc_auc FROM ({auc('scored')})""",
    "random_label_auc": sql("random_labelled", f"SELECT round(auc, 9) AS roc_auc, round(auc, 9) <= {C.RANDOM_LABEL_MAX_AUC} AS plausible FROM ({auc('random_labelled')})"),
    "score_histogram": sql("fixed", HISTOGRAM),
    "scoring_counters": sql("messages scored_messages", "SELECT 'ok' AS counter, count(*) AS total FROM scored_messages UNION ALL SELECT 'error', (SELECT count(*) FROM messages) - count(*) FROM scored_messages UNION ALL SELECT 'alerts', count(*) FILTER (WHERE is_anomaly) FROM scored_messages"),
    "scored_rate": sql("features", f"SELECT {iso('time_bucket(INTERVAL 5 minutes, window_end)')} AS window_start, round(count(*) / 300.0::double, 9) AS per_second FROM features GROUP BY 1"),
    "alert_rate": sql("flags", f"SELECT {iso('time_bucket(INTERVAL 5 minutes, window_end)')} AS window_start, round(count(*) / 300.0::double, 9) AS per_second FROM flags WHERE is_anomaly GROUP BY 1"),
    "latency_p95": sql("clicks", P95),
    "partition_lag": sql("clicks", "SELECT 'clickstream' AS topic, (user_id % 3)::int AS partition, count(*) AS highwater, count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-01 05:00:00') AS committed, greatest(0, count(*) - count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-01 05:00:00')) AS lag FROM clicks GROUP BY 2 HAVING committed > 0"),
    "stream_sliding_features": sql("subset subset_features", f"SELECT {WINDOW_COLUMNS} FROM subset_features WHERE subset_features.window_end <= (SELECT max(ts) FROM subset) - INTERVAL 30 seconds"),
    "stream_late_events": sql("arrivals late_windows", f"""
SELECT {WINDOW_COLUMNS} FROM late_windows WHERE late_windows.window_end <= (SELECT max(ts) FROM arrivals) - INTERVAL 30 seconds"""),
    "stream_observed_counts": sql("checked", "SELECT count(*) AS processed, count(*) FILTER (WHERE failed_rules = '') AS valid, count(*) FILTER (WHERE failed_rules <> '') AS invalid FROM checked"),
    "stream_open_windows": sql("arrivals", OPEN_WINDOWS),
    "stream_online_expiry": sql("lenient_messages", f"SELECT * FROM ({UNEXPIRED})"),
    "counter_served_rate": sql("counter_gains", f"SELECT {iso('w')} AS window_start, instance, round(sum(increase) / 300.0::double, 9) AS per_second FROM counter_gains WHERE le = 'Infinity'::double GROUP BY w, instance"),
    "counter_latency_p95": sql("counter_gains", COUNTER_P95),
    "stream_quarantine": sql("raw checked", "SELECT value, failed_rules FROM checked JOIN raw USING (event_id) WHERE failed_rules <> ''"),
    "stream_table_ingest": sql("table_rows", 'SELECT * EXCLUDE (event_id) REPLACE (epoch_us("timestamp") AS "timestamp") FROM table_rows'),
    "stream_lake_flushes": sql("table_rows", """SELECT strftime("timestamp", '%Y') AS y, strftime("timestamp", '%m') AS m, strftime("timestamp", '%d') AS d, strftime("timestamp", '%H') AS h, count(*) AS events, true AS sizes_fit FROM table_rows GROUP BY 1, 2, 3, 4"""),
    "stream_online_latest": sql("lenient_messages", f"SELECT * REPLACE ({iso('event_timestamp')} AS event_timestamp) FROM (" + ONLINE.format(
        source="(SELECT * REPLACE (rtrim(window_end, 'Z')::timestamp AS window_end) FROM lenient_messages WHERE window_end LIKE '%Z')") + ")"),
    "stream_alerts": sql("scored_messages", "SELECT window_end AS ts, geo, platform, event_count, round(anomaly_score, 9) AS anomaly_score FROM scored_messages WHERE is_anomaly"),
}
