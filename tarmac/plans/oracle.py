"""DuckDB SQL for the registered queries (the correctness oracle).

Written independently of the Spark code: each statement derives the same
views from the raw tables and states the expected result in plain SQL.
Tables are the pre-registered views region, nation, customer, supplier,
part, orders, lineitem, events, ... of one data folder.
"""

from __future__ import annotations

import hashlib

# Same fixed values as the Spark side states them.
TREE_ID = hashlib.md5(b"day-tree").hexdigest()
MAJORITY_ID = hashlib.md5(b"majority").hexdigest()
MISSING_ID = "missing-model"
ART_PREFIX = "models/spark_random_forest_classifier.flight_delays."

FLIGHTS = """flights AS (
  SELECT CASE WHEN l.l_quantity <> 50 THEN CAST(datediff('day', o.o_orderdate, l.l_shipdate) AS DOUBLE) END AS ArrDelay,
         o.o_orderdate AS CRSDepTime, l.l_shipdate AS CRSArrTime, l.l_returnflag AS Carrier,
         CAST(day(o.o_orderdate) AS INTEGER) AS DayOfMonth,
         CAST(isodow(o.o_orderdate) - 1 AS INTEGER) AS DayOfWeek,
         CAST(dayofyear(o.o_orderdate) AS INTEGER) AS DayOfYear,
         l.l_quantity - CAST(25 AS DOUBLE) AS DepDelay, cn.n_name AS Dest, sn.n_name AS Origin,
         l.l_extendedprice / CAST(40 AS DOUBLE) AS Distance, CAST(l.l_orderkey AS VARCHAR) AS FlightNum,
         CAST(o.o_orderdate AS DATE) AS FlightDate,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey)"""

BUCKET = """CAST(CASE WHEN ArrDelay IS NULL THEN NULL WHEN ArrDelay < -15 THEN 0 WHEN ArrDelay < 0 THEN 1
  WHEN ArrDelay < 30 THEN 2 ELSE 3 END AS DOUBLE)"""

# Training frame: flights with Route and class, null classes removed.
TF = f"""tf AS (SELECT *, Origin || '-' || Dest AS Route, {BUCKET} AS ArrDelayBucket FROM flights
  WHERE ArrDelay IS NOT NULL)"""

DIST = """dist AS (SELECT Origin, Dest, Distance FROM flights
  QUALIFY row_number() OVER (PARTITION BY Origin, Dest
                             ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1)"""

EV = """ev AS (SELECT event_id, ts, user_id, event_type, value, props,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


def _m(x: str) -> str:
    return f"md5('model-' || CAST({x} AS VARCHAR))"


def forms(model_id: str | None = None) -> str:
    if model_id is None:
        a, b = _m("e.user_id"), _m("e.k")
    else:
        a, b = f"'{model_id}'", f"'{MISSING_ID}'"
    return f"""forms AS (
  SELECT e.event_id, e.ts, CASE WHEN e.k >= 3 THEN cn.n_name END AS Origin,
    CASE WHEN e.k >= 97 THEN 'UNKNOWN' ELSE sn.n_name END AS Dest,
    CASE e.event_type WHEN 'purchase' THEN 'A' WHEN 'view' THEN 'N' WHEN 'click' THEN 'R'
                      WHEN 'signup' THEN '' END AS Carrier,
    e.value - CAST(25 AS DOUBLE) AS DepDelay, strftime(e.ts, '%Y-%m-%d') AS FlightDate,
    CAST(e.user_id AS VARCHAR) AS FlightNum,
    CASE e.event_type
      WHEN 'purchase' THEN '["' || {a} || '", "' || {b} || '"]'
      WHEN 'view' THEN '["' || {a} || '"]'
      WHEN 'click' THEN '[' || {a} || ']'
      WHEN 'signup' THEN '[]' END AS model_ids
  FROM ev e
  LEFT JOIN (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) cn
         ON e.user_id = cn.c_custkey
  LEFT JOIN (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) sn
         ON e.k = sn.s_suppkey)"""


REQUESTS = """requests AS (
  SELECT f.Origin, coalesce(f.FlightNum, '') AS FlightNum,
    CAST(isodow(CAST(f.FlightDate AS DATE)) - 1 AS INTEGER) AS DayOfWeek,
    CAST(dayofyear(CAST(f.FlightDate AS DATE)) AS INTEGER) AS DayOfYear,
    CAST(day(CAST(f.FlightDate AS DATE)) AS INTEGER) AS DayOfMonth,
    f.Dest, CAST(f.DepDelay AS DOUBLE) AS DepDelay, f.ts AS Timestamp, CAST(f.FlightDate AS DATE) AS FlightDate,
    coalesce(f.Carrier, '') AS Carrier, CAST(f.event_id AS VARCHAR) AS UUID, d.Distance, f.model_ids
  FROM forms f LEFT JOIN dist d ON f.Origin = d.Origin AND f.Dest = d.Dest)"""

VALID = """valid AS (SELECT *, Origin || '-' || Dest AS Route FROM requests
  WHERE UUID IS NOT NULL AND Origin IS NOT NULL AND Dest IS NOT NULL AND Carrier IS NOT NULL
    AND FlightNum IS NOT NULL)"""


def ids_of(col: str) -> str:
    return (f"list_distinct(list_filter(list_transform(string_split(regexp_replace(regexp_replace({col}, '^\\[', ''),"
            f" '\\]$', ''), ','), lambda x: replace(trim(x), '\"', '')), lambda x: length(x) > 0))")


def req_base(model_id: str | None = None) -> str:
    return ",\n".join([FLIGHTS, DIST, EV, forms(model_id), REQUESTS])


ARTS = f"""arts AS (SELECT CASE
    WHEN e.event_type = 'click' AND e.event_id % 2 = 0
      THEN 'models/arrival_bucketizer_1.0.bin/part-' || CAST(e.event_id AS VARCHAR)
    WHEN e.event_type = 'error' AND e.event_id % 2 = 0
      THEN 'backup/a.b.zzz.bin/part-' || CAST(e.event_id AS VARCHAR)
    WHEN e.event_type = 'purchase' THEN '{ART_PREFIX}' || md5('orphan-' || CAST(e.k AS VARCHAR))
         || '.bin/part-' || CAST(e.event_id AS VARCHAR)
    WHEN e.event_type = 'click' THEN 'models/' || {_m('e.user_id')} || '.bin'
    WHEN e.event_type = 'error' THEN {_m('e.user_id')} || '.bin'
    ELSE '{ART_PREFIX}' || {_m('e.user_id')} || '.bin/part-' || CAST(e.event_id AS VARCHAR) END AS key,
  e.ts AS last_modified FROM ev e)"""

ART_ID = f"""CASE WHEN starts_with(key, '{ART_PREFIX}') AND len(string_split(key, '/')) >= 2
   AND len(string_split(string_split(key, '/')[2], '.')) >= 3
   AND string_split(string_split(key, '/')[2], '.')[-1] = 'bin'
  THEN string_split(string_split(key, '/')[2], '.')[-2] END"""

TIMES = f"""times AS (SELECT model_id, max(last_modified) AS last_modified
  FROM (SELECT {ART_ID} AS model_id, last_modified FROM arts) WHERE model_id IS NOT NULL GROUP BY model_id)"""

RUNS = f"""runs AS (SELECT md5('run-' || CAST(event_id AS VARCHAR)) AS run_id,
    CASE WHEN k < 50 THEN 'rf-' || CAST(k AS VARCHAR) END AS run_name,
    CASE WHEN event_type = 'click' THEN 'RUNNING' ELSE 'FINISHED' END AS status,
    (epoch_us(ts) // 1000) AS start_time,
    CASE WHEN event_type = 'error' THEN 'deleted' WHEN event_type = 'view' THEN NULL ELSE 'active' END
      AS lifecycle_stage,
    CAST(k + 1 AS VARCHAR) AS num_trees,
    CAST(CAST(floor(k / 10) AS BIGINT) + 1 AS VARCHAR) AS max_depth,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS duration,
    value / (value + CAST(30 AS DOUBLE)) AS accuracy,
    CASE WHEN k >= 90 THEN NULL ELSE {_m('user_id')} END AS model_version,
    CASE WHEN value / (value + CAST(30 AS DOUBLE)) >= 0.6 THEN 'true' ELSE 'false' END AS verified_text
  FROM ev)"""

CATALOG = """catalog AS (SELECT coalesce(model_version, run_id) AS run_id, run_id AS tracker_run_id,
    coalesce(run_name, substr(coalesce(model_version, run_id), 1, 8)) AS run_name, status, start_time,
    num_trees, max_depth, accuracy, verified_text = 'true' AS verified
  FROM runs WHERE coalesce(lifecycle_stage, 'active') <> 'deleted')"""

REG = """reg AS (SELECT md5('run-' || CAST(event_id AS VARCHAR)) AS run_id, 'flight_delays' AS name,
    CAST(event_id AS VARCHAR) AS version,
    CASE WHEN value >= 45 THEN 'Production' ELSE 'Staging' END AS stage
  FROM ev WHERE event_type = 'purchase'
  UNION ALL
  SELECT md5('run-' || CAST(event_id AS VARCHAR)), 'flight_delays', CAST(event_id + 1 AS VARCHAR), 'Archived'
  FROM ev WHERE event_type = 'purchase' AND event_id % 5 = 0)"""

CAT_REG = """cat_reg AS (SELECT c.*, coalesce(r.stage, 'None') AS stage, r.version, r.name AS registered_name
  FROM catalog c LEFT JOIN (
    SELECT * FROM reg QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY CAST(version AS BIGINT) DESC) = 1) r
  ON c.tracker_run_id = r.run_id)"""

UNREG = """unreg AS (SELECT model_id AS run_id, substr(model_id, 1, 8) AS run_name, 'FINISHED' AS status,
    (epoch_us(last_modified) // 1000) AS start_time, 'None' AS stage
  FROM times t WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.run_id = t.model_id))"""

ACTIVE = """acts AS (SELECT md5('model-' || CAST(user_id AS VARCHAR)) AS model_id,
    CASE WHEN event_type = 'purchase' THEN 'activate' ELSE 'deactivate' END AS action, ts
  FROM ev WHERE event_type IN ('purchase', 'click', 'error')),
active AS (SELECT model_id, ts AS activated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY ts DESC, action DESC) AS rn FROM acts)
  WHERE rn = 1 AND action = 'activate')"""

MODELS = "models AS (SELECT DISTINCT model_id FROM times)"

MAJORITY = """maj AS (SELECT ArrDelayBucket AS p FROM tf GROUP BY ArrDelayBucket
  ORDER BY count(*) DESC, ArrDelayBucket ASC LIMIT 1)"""

# The commonest class of each day of the month, the smaller of equal ones.
TREE = """tree AS (SELECT DayOfMonth AS day, ArrDelayBucket AS p, count(*) AS hits FROM tf GROUP BY DayOfMonth, ArrDelayBucket
  QUALIFY row_number() OVER (PARTITION BY DayOfMonth ORDER BY count(*) DESC, ArrDelayBucket ASC) = 1)"""


def dicts() -> str:
    parts = []
    for c in ("Carrier", "Origin", "Dest", "Route"):
        parts.append(f"""d_{c} AS (SELECT label, CAST(row_number() OVER (ORDER BY cnt DESC, label ASC) - 1 AS DOUBLE) AS idx
  FROM (SELECT {c} AS label, count(*) AS cnt FROM tf WHERE {c} IS NOT NULL GROUP BY {c})),
n_{c} AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM d_{c})""")
    return ",\n".join(parts)


def encoded(src: str) -> str:
    """Columns X_index of ``src`` rows (alias s) using the training dictionaries, unseen -> numLabels."""
    sel = ", ".join(f"coalesce(d_{c}.idx, (SELECT n FROM n_{c})) AS {c}_index" for c in ("Carrier", "Origin", "Dest", "Route"))
    joins = " ".join(f"LEFT JOIN d_{c} ON s.{c} = d_{c}.label" for c in ("Carrier", "Origin", "Dest", "Route"))
    return f"SELECT s.*, {sel} FROM {src} s {joins}"


def _json_str(key: str, expr: str) -> str:
    return f"CASE WHEN {expr} IS NULL THEN NULL ELSE '\"{key}\":' || to_json({expr}) END"


def _json_num(key: str, expr: str) -> str:
    return f"CASE WHEN {expr} IS NULL THEN NULL ELSE '\"{key}\":' || CAST({expr} AS VARCHAR) END"


def _json_dbl(key: str, expr: str) -> str:
    # Java prints whole doubles with a trailing .0, as DuckDB's VARCHAR cast of a DOUBLE does.
    return _json_num(key, f"CAST({expr} AS DOUBLE)")


def _json_ts(key: str, expr: str) -> str:
    return (f"CASE WHEN {expr} IS NULL THEN NULL ELSE '\"{key}\":\"' || strftime({expr}, '%Y-%m-%dT%H:%M:%S.%g')"
            f" || 'Z\"' END")


def _json_date(key: str, expr: str) -> str:
    return f"CASE WHEN {expr} IS NULL THEN NULL ELSE '\"{key}\":\"' || strftime({expr}, '%Y-%m-%d') || '\"' END"


def json_obj(*frags: str) -> str:
    return "'{' || concat_ws(',', " + ", ".join(frags) + ") || '}'"


REQUEST_JSON = json_obj(
    _json_str("Origin", "Origin"), _json_str("FlightNum", "FlightNum"), _json_num("DayOfWeek", "DayOfWeek"),
    _json_num("DayOfYear", "DayOfYear"), _json_num("DayOfMonth", "DayOfMonth"), _json_str("Dest", "Dest"),
    _json_dbl("DepDelay", "DepDelay"), _json_ts("Timestamp", "Timestamp"), _json_date("FlightDate", "FlightDate"),
    _json_str("Carrier", "Carrier"), _json_str("UUID", "UUID"), _json_dbl("Distance", "Distance"),
    _json_str("model_ids", "model_ids"))

RESPONSE_JSON = json_obj(
    _json_str("UUID", "UUID"), _json_str("model_id", "model_id"), _json_str("Origin", "Origin"),
    _json_str("Dest", "Dest"), _json_str("Carrier", "Carrier"), _json_date("FlightDate", "FlightDate"),
    _json_str("FlightNum", "FlightNum"), _json_dbl("DepDelay", "DepDelay"), _json_dbl("Distance", "Distance"),
    _json_str("Route", "Route"), _json_num("DayOfYear", "DayOfYear"), _json_num("DayOfMonth", "DayOfMonth"),
    _json_num("DayOfWeek", "DayOfWeek"), _json_dbl("Prediction", "Prediction"), _json_ts("Timestamp", "Timestamp"))

# Scored responses: requests pointed at the day tree; a valid row that asked for it gets its prediction.
SCORED = f"""scored AS (SELECT v.*, '{TREE_ID}' AS model_id, t.p AS Prediction FROM valid v JOIN tree t ON v.DayOfMonth = t.day
  WHERE list_contains({ids_of('v.model_ids')}, '{TREE_ID}'))"""

STORED_FROM_SCORED = f"""SELECT UUID AS uuid, CAST(Prediction AS INTEGER) AS prediction, model_id, Origin AS origin,
    Dest AS dest, DepDelay AS dep_delay, Carrier AS carrier, strftime(FlightDate, '%Y-%m-%d') AS flight_date,
    FlightNum AS flight_num, Distance AS distance, Route AS route, DayOfYear AS day_of_year,
    DayOfMonth AS day_of_month, DayOfWeek AS day_of_week,
    strftime(Timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS timestamp FROM scored"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _flight_cols() -> str:
    return ("ArrDelay, epoch_us(CRSDepTime) AS CRSDepTime, epoch_us(CRSArrTime) AS CRSArrTime, Carrier, DayOfMonth,"
            " DayOfWeek, DayOfYear, DepDelay, Dest, Origin, Distance, FlightNum,"
            " strftime(FlightDate, '%Y-%m-%d') AS FlightDate")


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["route_delay_profile"] = _with(FLIGHTS) + f"""SELECT Route, ArrDelayBucket, count(*) AS flights,
  avg(ArrDelay) AS mean_arr_delay, avg(DepDelay) AS mean_dep_delay
FROM (SELECT Origin || '-' || Dest AS Route, {BUCKET} AS ArrDelayBucket, ArrDelay, DepDelay FROM flights)
GROUP BY Route, ArrDelayBucket"""
    q["scan_json_schema"] = _with(FLIGHTS) + f"SELECT {_flight_cols()} FROM flights"
    q["flight_table"] = q["scan_json_schema"]
    q["distance_dim"] = _with(FLIGHTS, DIST) + \
        "SELECT Origin, Dest, Distance, (SELECT count(*) FROM flights) AS loaded_rows," \
        " (SELECT count(*) FROM dist) AS routes FROM dist"
    q["preview"] = _with(FLIGHTS) + """SELECT FlightNum, Origin, Dest, Origin || '-' || Dest AS Route, ArrDelay,
  l_orderkey, l_linenumber, l_partkey, l_suppkey FROM flights
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 6"""
    q["route"] = _with(FLIGHTS, EV, forms()) + "SELECT event_id, Origin, Dest, Origin || '-' || Dest AS Route FROM forms"
    q["delay_bucket"] = _with(FLIGHTS) + f"SELECT FlightNum, ArrDelay, {BUCKET} AS ArrDelayBucket FROM flights"
    q["date_features"] = _with(req_base()) + \
        "SELECT UUID, strftime(FlightDate, '%Y-%m-%d') AS FlightDate, DayOfYear, DayOfMonth, DayOfWeek FROM requests"
    q["model_ids"] = _with(FLIGHTS, EV, forms()) + f"""SELECT event_id, model_id FROM forms,
  unnest({ids_of('model_ids').replace('list_distinct(', '(')}) AS t(model_id) WHERE model_ids IS NOT NULL"""
    q["request_defaults"] = _with(req_base()) + "SELECT UUID, FlightNum, Carrier FROM requests"
    q["request_json"] = _with(req_base()) + f"SELECT UUID, {REQUEST_JSON} AS value FROM requests"
    q["request_parse"] = _with(req_base()) + """SELECT UUID, Origin, Dest, Carrier, FlightNum, DepDelay, Distance,
  DayOfWeek, DayOfYear, DayOfMonth, (epoch_us(Timestamp) // 1000) AS ts_ms, strftime(FlightDate, '%Y-%m-%d') AS FlightDate,
  model_ids, Origin || '-' || Dest AS Route FROM requests
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM ev WHERE event_type = 'error'"""
    q["valid_requests"] = _with(req_base(), VALID) + "SELECT UUID, Route, Carrier, FlightNum FROM valid"
    q["requested_models"] = _with(req_base()) + f"""SELECT DISTINCT model_id FROM requests,
  unnest({ids_of('model_ids')}) AS t(model_id) WHERE model_ids IS NOT NULL"""
    q["artifact_id"] = _with(EV, ARTS) + f"SELECT key, {ART_ID} AS model_id FROM arts"
    q["run_id_clean"] = _with(EV) + """SELECT event_id, run_id, translate(run_id, ':+', '__') AS clean_id FROM (
  SELECT event_id, 'manual__' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS run_id FROM ev)"""
    q["run_duration"] = _with(EV) + """SELECT event_id, (epoch_us(ts) // 1000) AS start_ms,
  CAST(CAST(trunc(value * 60000) AS BIGINT) // 1000 AS BIGINT) AS duration_seconds FROM ev"""
    q["label_index"] = _with(FLIGHTS) + """SELECT label, count,
  CAST(row_number() OVER (ORDER BY count DESC, label ASC) - 1 AS DOUBLE) AS index
FROM (SELECT Origin || '-' || Dest AS label, count(*) AS count FROM flights
      WHERE Origin || '-' || Dest IS NOT NULL GROUP BY 1)"""
    q["label_encode"] = _with(FLIGHTS, TF, dicts()) + \
        f"""SELECT FlightNum, Carrier, Origin, Dest, Route, Carrier_index, Origin_index, Dest_index, Route_index
FROM ({encoded('tf')})"""
    q["label_encode_unseen"] = _with(req_base(), TF, dicts(),
                                     "rq AS (SELECT *, Origin || '-' || Dest AS Route FROM requests)") + \
        f"""SELECT UUID, Carrier, Origin, Dest, Route, Carrier_index, Origin_index, Dest_index, Route_index
FROM ({encoded('rq')})"""
    q["feature_frame"] = _with(FLIGHTS, TF, dicts()) + f"""SELECT FlightNum, ArrDelayBucket, DepDelay, Distance,
  DayOfMonth, DayOfWeek, DayOfYear, Carrier_index, Origin_index, Dest_index, Route_index FROM ({encoded('tf')})"""
    q["assemble"] = _with(FLIGHTS, TF, dicts()) + f"""SELECT FlightNum, DepDelay AS f_DepDelay, Distance AS f_Distance,
  CAST(DayOfMonth AS DOUBLE) AS f_DayOfMonth, CAST(DayOfWeek AS DOUBLE) AS f_DayOfWeek,
  CAST(DayOfYear AS DOUBLE) AS f_DayOfYear, Carrier_index AS f_Carrier_index, Origin_index AS f_Origin_index,
  Dest_index AS f_Dest_index, Route_index AS f_Route_index FROM ({encoded('tf')})"""
    q["enrich_distance"] = _with(FLIGHTS, DIST, EV, forms()) + """SELECT f.event_id, f.Origin, f.Dest, d.Distance
FROM forms f LEFT JOIN dist d ON f.Origin = d.Origin AND f.Dest = d.Dest"""
    q["enrich_distance_stream"] = _with(FLIGHTS, DIST, """first_dist AS (SELECT Origin, Dest, Distance FROM flights WHERE l_linenumber = 1
  QUALIFY row_number() OVER (PARTITION BY Origin, Dest
                             ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1)""", EV, forms()) + """
SELECT f.event_id, f.Origin, f.Dest, CASE WHEN f.event_id % 2 = 0 THEN a.Distance ELSE d.Distance END AS Distance
FROM forms f LEFT JOIN dist d ON f.Origin = d.Origin AND f.Dest = d.Dest
LEFT JOIN first_dist a ON f.Origin = a.Origin AND f.Dest = a.Dest"""
    q["last_wins"] = _with(FLIGHTS) + """SELECT FlightNum, Distance, DepDelay, l_linenumber FROM flights
QUALIFY row_number() OVER (PARTITION BY FlightNum ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1"""
    airports = """SELECT DISTINCT code FROM (SELECT Origin AS code FROM flights UNION ALL SELECT Dest FROM flights)
WHERE code IS NOT NULL"""
    q["airports"] = _with(FLIGHTS) + airports
    q["airport_suggest"] = _with(FLIGHTS) + f"""SELECT code FROM ({airports}) WHERE starts_with(code, 'NATION_1')
ORDER BY code LIMIT 50"""
    q["run_catalog"] = _with(EV, RUNS, CATALOG) + \
        "SELECT run_id, tracker_run_id, run_name, status, start_time, num_trees, max_depth, accuracy, verified FROM catalog"
    q["run_registry"] = _with(EV, RUNS, CATALOG, REG, CAT_REG) + \
        "SELECT run_id, tracker_run_id, stage, version, registered_name FROM cat_reg"
    q["unregistered_models"] = _with(EV, RUNS, CATALOG, ARTS, TIMES, UNREG) + "SELECT * FROM unreg"
    q["model_list"] = _with(EV, RUNS, CATALOG, REG, CAT_REG, ARTS, TIMES, UNREG) + """SELECT * EXCLUDE (part),
  row_number() OVER (ORDER BY part, start_time DESC, run_id, tracker_run_id) - 1 AS position FROM (
  SELECT run_id, tracker_run_id, run_name, status, start_time, accuracy, verified, stage, version, registered_name,
    0 AS part FROM cat_reg
  UNION ALL
  SELECT run_id, NULL, run_name, status, start_time, NULL, NULL, stage, NULL, NULL, 1 FROM unreg)"""
    q["model_gate"] = _with(EV, RUNS) + "SELECT run_id, accuracy, verified_text AS verified FROM runs"
    q["latest_model"] = _with(EV, ARTS, TIMES) + """SELECT model_id, epoch_us(last_modified) AS last_modified
FROM times ORDER BY last_modified DESC, model_id DESC LIMIT 1"""
    q["latest_version"] = _with(EV, RUNS) + """SELECT model_version, start_time FROM runs
WHERE coalesce(lifecycle_stage, 'active') <> 'deleted' AND model_version IS NOT NULL
ORDER BY start_time DESC, model_version DESC LIMIT 1"""
    q["artifact_latest"] = _with(EV, ARTS, TIMES) + "SELECT model_id, epoch_us(last_modified) AS last_modified FROM times"
    q["run_by_version"] = _with(EV, RUNS) + """SELECT model_version, run_id, start_time FROM runs
WHERE coalesce(lifecycle_stage, 'active') <> 'deleted' AND model_version IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY start_time DESC, run_id DESC) = 1"""
    q["active_models"] = _with(EV, ACTIVE) + "SELECT model_id, epoch_us(activated_at) AS activated_at FROM active"
    q["active_set_stream"] = q["active_models"]
    q["purge_models"] = _with(EV, RUNS, CATALOG, ACTIVE,
                              "dels AS (SELECT DISTINCT md5('model-' || CAST(user_id AS VARCHAR)) AS model_id "
                              "FROM ev WHERE event_type = 'error')") + """
SELECT 'run' AS kind, run_id AS id
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY start_time DESC, tracker_run_id DESC) AS nth FROM catalog) c
WHERE nth > 1 OR NOT EXISTS (SELECT 1 FROM dels d WHERE d.model_id = c.run_id)
UNION ALL
SELECT 'active', model_id FROM active a WHERE NOT EXISTS (SELECT 1 FROM dels d WHERE d.model_id = a.model_id)"""
    q["kv_map"] = _with(EV, RUNS) + """SELECT run_id, 'model_version' AS key, model_version AS value FROM runs
WHERE model_version IS NOT NULL
UNION ALL SELECT run_id, 'verified', verified_text FROM runs"""
    q["metric_record"] = _with(EV, RUNS) + """SELECT accuracy, coalesce(model_version, run_id) AS model_version,
  CAST(num_trees AS INTEGER) AS num_trees, CAST(max_depth AS INTEGER) AS max_depth,
  CAST(duration AS BIGINT) AS training_duration_seconds, run_name
FROM runs WHERE coalesce(lifecycle_stage, 'active') <> 'deleted'"""
    pairs = f"""SELECT DISTINCT v.UUID, t.model_id FROM valid v, unnest({ids_of('v.model_ids')}) AS t(model_id)
  WHERE v.model_ids IS NOT NULL AND t.model_id IN (SELECT model_id FROM models)"""
    q["score_scope_row"] = _with(req_base(), VALID, ARTS, TIMES, MODELS) + pairs
    q["score_scope_batch"] = _with(req_base(), VALID, ARTS, TIMES, MODELS,
                                   "vb AS (SELECT *, CAST(UUID AS BIGINT) % 8 AS batch_id FROM valid)",
                                   "rb AS (SELECT *, CAST(UUID AS BIGINT) % 8 AS batch_id FROM requests)",
                                   f"""wanted AS (SELECT DISTINCT rb.batch_id, t.model_id FROM rb,
  unnest({ids_of('rb.model_ids')}) AS t(model_id)
  WHERE rb.model_ids IS NOT NULL AND t.model_id IN (SELECT model_id FROM models))""") + \
        "SELECT vb.UUID, w.model_id FROM vb JOIN wanted w ON vb.batch_id = w.batch_id"
    scored = _with(req_base(TREE_ID), VALID, TF, TREE, SCORED)
    q["response_json"] = scored + f"SELECT {RESPONSE_JSON} AS value FROM scored"
    q["response_rows"] = scored + STORED_FROM_SCORED
    q["response_stream"] = q["stream_score"] = q["stream_resume"] = q["response_rows"]
    q["response_replay"] = scored + f"SELECT uuid, model_id, 1 AS logged FROM ({STORED_FROM_SCORED})"
    q["forest_table_score"] = _with(FLIGHTS, TF, TREE) + f"""
SELECT FlightNum, '{TREE_ID}' AS model_id, p AS Prediction, true AS same FROM tf JOIN tree ON DayOfMonth = day
UNION ALL SELECT FlightNum, 'registered', NULL, true FROM tf"""
    q["forest_nodes"] = _with(FLIGHTS, TF) + f"""
SELECT '{TREE_ID}' AS model_id, 1 AS trees, true AS sound, CAST(ArrDelayBucket AS INTEGER) AS class, CAST(count(*) AS DOUBLE) AS rows
FROM tf GROUP BY ArrDelayBucket
UNION ALL SELECT 'registered', 5, true, NULL, NULL"""
    q["artifact_stream"] = f"SELECT * FROM (VALUES ('{TREE_ID}', 1, 0, true), ('{MAJORITY_ID}', 1, 1, true)) AS t(model_id, times, batch, equal)"
    q["score_union"] = _with(req_base(), VALID, TF, TREE, MAJORITY) + f"""
SELECT UUID, '{TREE_ID}' AS model_id, p AS Prediction FROM valid JOIN tree ON DayOfMonth = day
UNION ALL SELECT UUID, '{MAJORITY_ID}', (SELECT p FROM maj) FROM valid"""
    q["forest_score"] = _with(FLIGHTS, TF, TREE) + """SELECT FlightNum, ArrDelayBucket, p AS Prediction,
  true AS top_is_prediction FROM tf JOIN tree ON DayOfMonth = day"""
    q["forest_train"] = _with(FLIGHTS, TF, MAJORITY) + """SELECT 'registered' AS model_version, 5 AS num_trees, 5 AS max_depth,
  'registered' AS run_name, 'FINISHED' AS status, true AS gate_agrees, true AS at_least_majority,
  CAST(count(*) FILTER (WHERE ArrDelayBucket = (SELECT p FROM maj)) AS DOUBLE) / count(*) AS majority_share FROM tf"""
    q["artifact_roundtrip"] = _with(FLIGHTS, TF) + "SELECT FlightNum, true AS same FROM tf"
    q["artifact_listing"] = f"""SELECT artifact, CASE WHEN artifact LIKE 'spark_random%' THEN '{TREE_ID}' END AS model_id
FROM (VALUES ('arrival_bucketizer.{TREE_ID}.bin'), ('string_indexer_model.{TREE_ID}.bin'),
  ('numeric_vector_assembler.{TREE_ID}.bin'), ('spark_random_forest_classifier.flight_delays.{TREE_ID}.bin'),
  ('accuracy.{TREE_ID}.json')) AS t(artifact)"""
    q["request_stamp"] = """SELECT count(*) AS requests, count(*) AS distinct_ids, count(*) AS uuid_form,
  count(*) AS version_form, count(*) AS time_form FROM events"""
    q["response_upsert"] = _with(req_base(), VALID, ARTS, TIMES, MODELS, f"pairs AS ({pairs})") + """
SELECT v.UUID AS uuid, 0 AS prediction, p.model_id, v.Origin AS origin, v.Dest AS dest, v.DepDelay AS dep_delay,
  v.Carrier AS carrier, strftime(v.FlightDate, '%Y-%m-%d') AS flight_date, v.FlightNum AS flight_num,
  v.Distance AS distance, v.Route AS route, v.DayOfYear AS day_of_year, v.DayOfMonth AS day_of_month,
  v.DayOfWeek AS day_of_week, '' AS timestamp
FROM valid v JOIN pairs p ON v.UUID = p.UUID
QUALIFY row_number() OVER (PARTITION BY v.UUID ORDER BY p.model_id DESC) = 1"""
    q["accuracy"] = _with(FLIGHTS, TF, TREE) + """SELECT avg(CAST(ArrDelayBucket = p AS DOUBLE)) AS accuracy, count(*) AS rows
FROM tf JOIN tree ON DayOfMonth = day"""
    q["request_stream"] = _with(req_base()) + """SELECT UUID, Origin, Dest, Origin || '-' || Dest AS Route, Carrier,
  FlightNum, DepDelay, Distance, (epoch_us(Timestamp) // 1000) AS ts_ms, model_ids FROM requests"""
    return q
