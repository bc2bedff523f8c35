"""DuckDB texts that give the result of each registered query independently of Spark."""

from __future__ import annotations

from gaugeframe.plans import views

TEL = """
tel AS (
  SELECT concat('S', lpad(CAST(user_id AS VARCHAR), 6, '0')) AS sensor_id,
         CASE event_type WHEN 'click' THEN 'us-east' WHEN 'view' THEN 'eu-west'
              WHEN 'purchase' THEN 'ap-south' WHEN 'error' THEN 'af-south' ELSE 'xx-lab' END AS region,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST((event_id * 37) % 101 AS INT) END AS quality
  FROM events),
st AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM tel),
norm AS (SELECT tel.*, (value - mu) * CASE WHEN sd > 1e-12 THEN 1.0 / sd ELSE 0.0 END AS value_norm
         FROM tel CROSS JOIN st)
"""

DIM = """
dim AS (SELECT * FROM (VALUES
  ('eu-west', 'EU', 250, 'gold'), ('eu-north', 'EU', 300, 'silver'), ('us-east', 'NA', 200, 'gold'),
  ('us-west', 'NA', 220, 'gold'), ('sa-east', 'SA', 400, 'bronze'), ('ap-south', 'AS', 350, 'silver'),
  ('ap-north', 'AS', 320, 'silver'), ('af-south', 'AF', 500, 'bronze'))
  AS d(region, continent, sla_ms, tier))
"""


def _group(name: str, keys: str, source: str, x: str, sigma: float = 3.0) -> str:
    return f"""
{name} AS (
  SELECT {keys}, count(*) AS readings, avg({x}) AS mean_norm, stddev_pop({x}) AS stddev_norm,
         min({x}) AS min_norm, max({x}) AS max_norm,
         CAST(sum(CASE WHEN abs({x}) > {sigma} THEN 1 ELSE 0 END) AS BIGINT) AS anomalies,
         CAST(sum(CASE WHEN abs({x}) > {sigma} THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS anomaly_ratio
  FROM {source} WHERE quality >= 60 GROUP BY {keys})
"""


ROUNDED = """readings, round(mean_norm, 6) AS mean_norm, round(stddev_norm, 6) AS stddev_norm,
  round(min_norm, 6) AS min_norm, round(max_norm, 6) AS max_norm, anomalies,
  round(anomaly_ratio, 6) AS anomaly_ratio"""
PROFILE = f"WITH {TEL}, {DIM}, {_group('g', 'region, sensor_id', 'norm', 'value_norm')}"
DEFAULTS = """coalesce(dim.continent, '??') AS continent, coalesce(dim.sla_ms, 999) AS sla_ms,
  coalesce(dim.tier, 'unknown') AS tier"""
ENRICHED = f"""{PROFILE}
SELECT g.region, g.sensor_id, {ROUNDED}, {DEFAULTS}
FROM g LEFT JOIN dim ON g.region = dim.region"""


def _top(k: int) -> str:
    return f"""{PROFILE},
e AS (SELECT g.*, {DEFAULTS} FROM g LEFT JOIN dim ON g.region = dim.region
      ORDER BY anomaly_ratio DESC, readings DESC, g.region, sensor_id LIMIT {k})
SELECT region, sensor_id, {ROUNDED}, continent, sla_ms, tier FROM e"""



LINE_STATS = """WITH st AS (SELECT min(l_extendedprice) AS mn, max(l_extendedprice) AS mx,
  avg(l_extendedprice) AS mu, stddev_pop(l_extendedprice) AS sd FROM lineitem)"""
SCALES = {
    "zscore": ("mu", "CASE WHEN sd > 1e-12 THEN 1.0 / sd ELSE 0.0 END"),
    "minmax": ("mn", "CASE WHEN mx - mn > 1e-12 THEN 1.0 / (mx - mn) ELSE 0.0 END"),
    "robust": ("mu", "CASE WHEN mx - mn > 1e-12 THEN 1.0 / (mx - mn) ELSE 0.0 END"),
}


def _line(mode: str) -> str:
    shift, scale = SCALES[mode]
    return f"""{LINE_STATS}
SELECT l_orderkey, l_linenumber, round((l_extendedprice - {shift}) * {scale}, 6) AS value_norm
FROM lineitem CROSS JOIN st"""


def _by_key(key: str, name: str) -> str:
    columns = ", ".join(f"round((l_extendedprice - {shift}) * {scale}, 6) AS {mode}"
                        for mode, (shift, scale) in SCALES.items())
    return f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_extendedprice, {key} AS {name} FROM lineitem),
st AS (SELECT {name} AS id, min(l_extendedprice) AS mn, max(l_extendedprice) AS mx,
  avg(l_extendedprice) AS mu, stddev_pop(l_extendedprice) AS sd FROM x GROUP BY {name})
SELECT l_orderkey, l_linenumber, {name}, {columns} FROM x JOIN st ON {name} = id"""


def _array(mode: str) -> str:
    shift, scale = SCALES[mode]
    return f"""WITH x AS (
  SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
st AS (SELECT vec_id AS id, min(x) AS mn, max(x) AS mx, avg(x) AS mu, stddev_pop(x) AS sd
       FROM x GROUP BY vec_id)
SELECT vec_id, pos, round((x - {shift}) * {scale}, 5) AS x FROM x JOIN st ON vec_id = id"""


def _timing(source: str, keys: str, value: str, median: str) -> str:
    return f"""SELECT {keys}, count({value}) AS runs, round({median}, 6) AS median,
  round(avg({value}), 6) AS mean, round(coalesce(stddev_samp({value}), 0), 6) AS stdev,
  min({value}) AS min, max({value}) AS max,
  round(CASE WHEN count({value}) > 1 THEN stddev_samp({value}) / avg({value}) * 100 ELSE 0 END, 6) AS cv_pct
FROM {source} GROUP BY {keys}"""


RUNS = """(SELECT user_id AS job_id, event_id AS run_id,
  CASE event_type WHEN 'click' THEN 'rdd' ELSE 'dataframe' END AS pipeline, value AS seconds
  FROM events WHERE event_type IN ('click', 'view')) AS r"""


def _analysis(base: str) -> str:
    return f"""WITH norm AS (
  SELECT user_id AS job_id, max(value) AS total_s,
         CASE WHEN user_id % 3 = 0 THEN 'cuda' ELSE 'openmp' END AS backend FROM events GROUP BY user_id),
runs AS (
  SELECT job_id, pipeline, run_id, 1000 + CASE WHEN run_id % 50 = 0 THEN 1 ELSE 0 END AS groups,
         run_id % 80 AS anomalies, run_id % 80 * 1000 + 1 AS readings, seconds AS median_s FROM {RUNS}),
j AS (
  SELECT job_id, arg_min(median_s, run_id) FILTER (pipeline = 'rdd') AS rdd_s,
         arg_min(median_s, run_id) FILTER (pipeline = 'dataframe') AS dataframe_s,
         coalesce(max({base}), 0) AS base, coalesce(max(anomalies), 0) AS anomalies,
         count(DISTINCT groups) AS kinds FROM runs GROUP BY job_id),
a AS (
  SELECT norm.job_id, backend, total_s, rdd_s, dataframe_s, kinds,
         CASE WHEN base > 0 THEN CAST(anomalies AS DOUBLE) / base ELSE 0.0 END AS rate,
         CASE WHEN dataframe_s > 0 THEN rdd_s / dataframe_s END AS s
  FROM norm LEFT JOIN j ON norm.job_id = j.job_id)
SELECT job_id, round(rate, 6) AS anomaly_rate, rdd_s, dataframe_s, round(s, 6) AS speedup, backend,
  total_s,
  CASE WHEN s >= 1.5 THEN printf('DataFrame es %.2fx más rápido que RDD', round(s, 2))
       WHEN s >= 1.0 THEN printf('DataFrame es marginalmente más rápido (%.2fx)', round(s, 2))
       WHEN s = 0 THEN 'RDD resultó más rápido (Infinityx): revise el tamaño del dataset'
       WHEN s IS NOT NULL THEN printf('RDD resultó más rápido (%.2fx): revise el tamaño del dataset', round(1 / s, 2))
       ELSE 'sólo se ejecutó un pipeline: sin comparación disponible' END AS verdict,
  concat_ws('; ',
    CASE WHEN backend <> 'cuda' THEN 'la fase GPU se ejecutó en CPU (OpenMP): el runtime no expuso ninguna GPU' END,
    CASE WHEN kinds > 1 THEN 'los pipelines RDD y DataFrame devolvieron cardinalidades distintas' END,
    CASE WHEN rate > 0.05 THEN printf('tasa de anomalías inusualmente alta (%.1f%%): revise la calibración del sensor', round(rate * 100, 1)) END) AS warnings
FROM a"""


BENCH_PIVOT = """WITH b AS (
  SELECT user_id AS n, CASE event_type WHEN 'purchase' THEN 'gpu' WHEN 'click' THEN 'cpu1' ELSE 'cpun' END AS kind,
         min(value) AS ms FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY ALL),
w AS (SELECT n, max(ms) FILTER (kind = 'cpu1') AS c1, max(ms) FILTER (kind = 'cpun') AS cn,
             max(ms) FILTER (kind = 'gpu') AS g FROM b GROUP BY n)
SELECT n, round(c1, 6) AS cpu1_ms, round(cn, 6) AS cpun_ms, round(g, 6) AS gpu_ms,
  round(g * 0.5, 6) AS kernel_ms, round(c1 / nullif(cn, 0), 6) AS cpu_speedup,
  round(c1 / nullif(cn, 0) / 8 * 100, 6) AS cpu_efficiency_pct,
  round(c1 / nullif(g, 0), 6) AS gpu_speedup_vs_1, round(cn / nullif(g, 0), 6) AS gpu_speedup_vs_n,
  round((g * 0.25 + g * 0.125) / nullif(g, 0) * 100, 6) AS transfer_pct,
  round(CASE WHEN c1 > 0 THEN n * 12.0::DOUBLE / (c1 * 1e6) WHEN c1 = 0 THEN 0 END, 6) AS cpu1_gbps,
  round(CASE WHEN cn > 0 THEN n * 12.0::DOUBLE / (cn * 1e6) WHEN cn = 0 THEN 0 END, 6) AS cpun_gbps
FROM w WHERE c1 IS NOT NULL"""

REQUESTS = """req AS (
  SELECT o_orderkey AS job_id,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat(
      CASE o_orderkey % 7 WHEN 0 THEN 'ftp' WHEN 1 THEN 's3' WHEN 2 THEN 'gs' WHEN 3 THEN 'hdfs'
           WHEN 4 THEN 's3a' WHEN 5 THEN 'file' ELSE 'abfss' END,
      '://bucket/c', o_custkey, '/data-', o_orderkey, '.parquet') END AS dataset_uri,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'zscore' WHEN '2-HIGH' THEN 'minmax' WHEN '3-MEDIUM' THEN 'robust'
         WHEN '5-LOW' THEN 'logaritmica' ELSE 'MINMAX' END AS mode,
    CASE WHEN o_orderstatus = 'O' THEN 'both' WHEN o_orderstatus = 'F' THEN 'rdd'
         WHEN o_totalprice > 250000 THEN 'spark' ELSE 'dataframe' END AS pipeline,
    CASE WHEN o_orderkey % 5 = 0 THEN 's3://out/' END AS output_uri,
    CASE o_orderkey % 11 WHEN 1 THEN 'https://hook/x' WHEN 2 THEN 'mailto:x' END AS callback_url
  FROM orders),
checked AS (
  SELECT *, list_filter([
    CASE WHEN dataset_uri IS NULL THEN 'datasetUri es obligatorio'
         WHEN NOT regexp_matches(dataset_uri, '^(s3|s3a|gs|hdfs|file|abfss)://.+')
         THEN concat('datasetUri con esquema no soportado: ', dataset_uri) END,
    CASE WHEN mode NOT IN ('minmax', 'zscore', 'robust')
         THEN concat('mode ''', mode, ''' inválido (use minmax/zscore/robust)') END,
    CASE WHEN pipeline NOT IN ('rdd', 'dataframe', 'both')
         THEN concat('pipeline ''', pipeline, ''' inválido (use rdd/dataframe/both)') END,
    CASE WHEN callback_url NOT LIKE 'http://%' AND callback_url NOT LIKE 'https://%'
         THEN concat('callbackUrl debe ser http(s): ', callback_url) END], lambda x: x IS NOT NULL) AS errs
  FROM req)"""

BODIES = """bodies AS (
  SELECT o_orderkey AS job_id, CASE o_orderkey % 16
    WHEN 0 THEN '' WHEN 1 THEN ', "mode": "minmax"' WHEN 2 THEN ', "mode": " robust "'
    WHEN 3 THEN ', "mode": "  "' WHEN 4 THEN ', "mode": 5' WHEN 5 THEN ', "mode": null'
    WHEN 6 THEN ', "pipeline": "rdd", "forceCpu": true' WHEN 7 THEN ', "forceCpu": "yes"'
    WHEN 8 THEN ', "forceCpu": null' WHEN 9 THEN ', "column": "value"' WHEN 10 THEN ', "column": false'
    WHEN 11 THEN ', "outputUri": "s3://o/", "callbackUrl": "http://h"'
    WHEN 12 THEN ', "outputUri": 7, "callbackUrl": ""' WHEN 13 THEN ', "unknown": 1'
    ELSE ', "mode": "zscore"' END AS rest
  FROM orders),
texts AS (
  SELECT job_id, CASE job_id % 19 WHEN 0 THEN '[1]' WHEN 1 THEN '{bad'
    WHEN 2 THEN concat('{"x": 1', rest, '}') WHEN 3 THEN concat('{"datasetUri": 12', rest, '}')
    ELSE concat('{"datasetUri": "s3://b/', job_id, '"', rest, '}') END AS body FROM bodies),
docs AS (
  SELECT job_id, json_valid(body) AND json_type(CASE WHEN json_valid(body) THEN body ELSE '0' END) = 'OBJECT' AS is_object,
         CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM texts)"""


def _json_text(field: str) -> str:
    return (f"CASE WHEN json_type(j, '$.{field}') = 'VARCHAR' THEN "
            f"nullif(trim(json_extract_string(j, '$.{field}')), '') END")


def _json_error(field: str) -> str:
    return (f"CASE WHEN json_type(j, '$.{field}') <> 'NULL' AND {_json_text(field)} IS NULL THEN "
            f"concat('''{field}'' debe ser una cadena, recibido ', "
            f"CAST(json_extract(j, '$.{field}') AS VARCHAR)) END")


PARSED = f"""WITH {BODIES}
SELECT job_id, {_json_text('datasetUri')} AS dataset_uri,
  coalesce({_json_text('mode')}, 'zscore') AS mode,
  coalesce({_json_text('pipeline')}, 'both') AS pipeline,
  {_json_text('outputUri')} AS output_uri, {_json_text('callbackUrl')} AS callback_url,
  coalesce(json_type(j, '$.forceCpu') = 'BOOLEAN' AND json_extract_string(j, '$.forceCpu') = 'true', false) AS force_cpu,
  {_json_text('column')} AS "column",
  CASE WHEN NOT is_object THEN 'se esperaba un objeto JSON' ELSE concat_ws('; ',
    {_json_error('datasetUri')},
    CASE WHEN coalesce(json_type(j, '$.datasetUri'), 'NULL') = 'NULL'
         THEN 'falta el campo obligatorio ''datasetUri''' END,
    {_json_error('mode')}, {_json_error('pipeline')}, {_json_error('outputUri')}, {_json_error('callbackUrl')},
    CASE WHEN json_type(j, '$.forceCpu') NOT IN ('NULL', 'BOOLEAN')
         THEN concat('''forceCpu'' debe ser booleano, recibido ', CAST(json_extract(j, '$.forceCpu') AS VARCHAR)) END,
    {_json_error('column')}) END AS parse_errors
FROM docs"""

LOG = """log AS (
  SELECT user_id AS job_id, event_id AS seq, ts AS "at",
    CASE event_type WHEN 'signup' THEN 'job_accepted' WHEN 'click' THEN 'input_validated'
      WHEN 'view' THEN 'gpu_completed' WHEN 'error' THEN 'stage_retry_scheduled'
      ELSE CASE event_id % 4 WHEN 0 THEN 'spark_completed' WHEN 1 THEN 'analysis_completed'
                WHEN 2 THEN 'response_delivered' ELSE 'job_failed' END END AS event_type,
    CASE event_id % 7 WHEN 0 THEN 'gpu' WHEN 1 THEN 'spark' WHEN 2 THEN 'warmup' WHEN 3 THEN 'drain'
      ELSE 'analyzing' END AS stage,
    CAST(event_id % 5 + 1 AS INT) AS attempt, concat('HTTP ', 500 + event_id % 4) AS reason,
    props AS payload FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY "at", seq) AS pos FROM log),
retries AS (SELECT job_id, stage, arg_max(attempt, pos) AS attempts FROM ranked
            WHERE event_type = 'stage_retry_scheduled' GROUP BY job_id, stage),
folded AS (
  SELECT job_id,
    coalesce(arg_max(CASE event_type WHEN 'job_accepted' THEN 'validating' WHEN 'input_validated' THEN 'gpu'
      WHEN 'gpu_completed' THEN 'spark' WHEN 'spark_completed' THEN 'analyzing'
      WHEN 'analysis_completed' THEN 'responding' WHEN 'response_delivered' THEN 'completed'
      ELSE 'failed' END, pos) FILTER (event_type <> 'stage_retry_scheduled'), 'received') AS stage,
    coalesce(arg_max("at", pos) FILTER (event_type = 'job_accepted'), min("at")) AS created_at,
    max("at") AS updated_at,
    arg_max(payload, pos) FILTER (event_type IN ('job_accepted', 'input_validated')) AS request,
    arg_max(payload, pos) FILTER (event_type = 'gpu_completed') AS gpu,
    arg_max(payload, pos) FILTER (event_type = 'spark_completed') AS runs,
    arg_max(payload, pos) FILTER (event_type = 'analysis_completed') AS analysis,
    arg_max(CASE event_type WHEN 'job_failed' THEN concat('[', stage, '] ', reason)
      ELSE concat('reintento ', attempt, ' en ', stage, ': ', reason) END, pos)
      FILTER (event_type IN ('job_failed', 'stage_retry_scheduled')) AS error
  FROM ranked GROUP BY job_id)"""
JOB_STATES = f"""WITH {LOG}
SELECT job_id, stage, created_at, updated_at, stage IN ('completed', 'failed') AS is_terminal FROM folded"""

def _sql_list(texts: list[str]) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in texts) + "]"


# Number, text and boolean fields by JSON type, with the library's rules.
NUMBER = "json_type({0}) IN ('UBIGINT', 'BIGINT', 'DOUBLE')"


def _text(v: str) -> str:
    return f"CASE WHEN json_type({v}) = 'VARCHAR' OR {NUMBER.format(v)} THEN {v} ->> '$' END"


def _double(v: str) -> str:
    return f"CASE WHEN {NUMBER.format(v)} THEN CAST({v} AS DOUBLE) END"


def _long(v: str) -> str:
    return f"CASE WHEN {NUMBER.format(v)} THEN CAST(trunc(CAST({v} AS DOUBLE)) AS BIGINT) END"


def _string(v: str) -> str:
    return f"CASE WHEN json_type({v}) = 'VARCHAR' AND trim({v} ->> '$') <> '' THEN trim({v} ->> '$') END"


RESULT_LOG = LOG.replace("props AS payload FROM events)", f"""replace(replace(
  CASE WHEN event_type IN ('signup', 'click') THEN ({_sql_list(views.REQUEST_TEXTS)})[event_id % 5 + 1]
    WHEN event_type = 'view' THEN ({_sql_list(views.GPU_TEXTS)})[event_id % 8 + 1]
    WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN ({_sql_list(views.RUN_TEXTS)})[event_id // 4 % 6 + 1]
    WHEN event_type = 'purchase' AND event_id % 4 = 1 THEN ({_sql_list(views.ANALYSIS_TEXTS)})[event_id // 4 % 4 + 1] END,
  '@', CAST(event_id AS VARCHAR)), '#', printf('%.3f', event_id / 8)) AS payload FROM events)""")
TYPED = f"""{RESULT_LOG},
parsed AS (
  SELECT f.*, CASE WHEN json_valid(request) THEN CAST(request AS JSON) END AS q,
    CASE WHEN json_valid(gpu) THEN CAST(gpu AS JSON) END AS g, CASE WHEN json_valid(analysis) THEN CAST(analysis AS JSON) END AS a,
    CASE WHEN json_valid(runs) THEN CAST(runs AS JSON) END AS s,
    (SELECT max("at") FROM log AS l WHERE l.job_id = f.job_id AND l.event_type = 'spark_completed') AS spark_at FROM folded AS f),
typed AS (
  SELECT job_id, stage, created_at, updated_at, spark_at, error, {_string("q -> '$.datasetUri'")} AS dataset_uri,
    CASE WHEN dataset_uri IS NOT NULL THEN coalesce({_string("q -> '$.mode'")}, 'zscore') END AS mode,
    CASE WHEN dataset_uri IS NOT NULL THEN coalesce({_string("q -> '$.pipeline'")}, 'both') END AS pipeline,
    CASE WHEN dataset_uri IS NOT NULL THEN {_string("q -> '$.outputUri'")} END AS request_output,
    CASE WHEN dataset_uri IS NOT NULL THEN coalesce(CASE WHEN json_type(q -> '$.forceCpu') = 'BOOLEAN'
      THEN CAST(q -> '$.forceCpu' AS BOOLEAN) END, false) END AS force_cpu,
    CASE WHEN dataset_uri IS NOT NULL THEN {_string("q -> '$.column'")} END AS "column",
    CASE WHEN g IS NOT NULL THEN coalesce({_text("g -> '$.backend'")}, 'unknown') END AS backend,
    CASE WHEN g IS NOT NULL THEN coalesce({_text("g -> '$.device'")}, 'unknown') END AS device,
    CASE WHEN g IS NOT NULL THEN coalesce({_long("g -> '$.elements'")}, 0) END AS elements,
    CASE WHEN g IS NOT NULL THEN coalesce({_double("g -> '$.stats.mean'")}, 'nan'::DOUBLE) END AS mean,
    CASE WHEN g IS NOT NULL THEN coalesce({_double("g -> '$.stats.stddev'")}, 'nan'::DOUBLE) END AS stddev,
    CASE WHEN g IS NOT NULL THEN coalesce({_double("g -> '$.timing_ms.kernel_ms'")}, 0) END AS kernel_ms,
    CASE WHEN g IS NOT NULL THEN coalesce({_double("g -> '$.wall_ms'")}, 0) END AS wall_ms,
    CASE WHEN g IS NOT NULL THEN coalesce({_text("g -> '$.output_uri'")}, request_output, '') END AS output_uri,
    list_transform(CASE json_type(s) WHEN 'ARRAY' THEN CAST(s AS JSON[]) WHEN 'OBJECT' THEN [s] ELSE [] END, lambda r: {{
      'pipeline': coalesce({_text("(r -> '$.pipeline')")}, ''), 'run': coalesce({_text("(r -> '$.run_id')")}, ''),
      'groups': coalesce({_long("(r -> '$.groups')")}, 0), 'anomalies': coalesce({_long("(r -> '$.anomalies')")}, 0),
      'seconds': coalesce({_double("(r -> '$.median_s')")}, 0), 'output': {_text("(r -> '$.output_uri')")}}}) AS spark_runs,
    CASE WHEN a IS NOT NULL THEN coalesce({_double("a -> '$.anomalyRate'")}, 0) END AS anomaly_rate,
    {_double("a -> '$.rddSeconds'")} AS rdd_s, CASE WHEN a IS NOT NULL THEN coalesce({_text("a -> '$.gpuBackend'")}, 'unknown') END AS gpu_backend,
    CASE WHEN a IS NOT NULL THEN coalesce({_double("a -> '$.totalSeconds'")}, 0) END AS total_s,
    CASE WHEN a IS NOT NULL THEN coalesce({_text("a -> '$.verdict'")}, '') END AS verdict,
    CASE WHEN a IS NOT NULL THEN array_to_string(list_filter(list_transform(CASE WHEN json_type(a -> '$.warnings') = 'ARRAY'
      THEN CAST(a -> '$.warnings' AS JSON[]) ELSE [] END, lambda w: {_text("w")}), lambda w: w IS NOT NULL), ',') END AS warnings
  FROM parsed),
status AS (
  SELECT t.* EXCLUDE (spark_runs, spark_at), coalesce(m.attempts, '') AS attempts,
    array_to_string(list_transform(spark_runs, lambda r: concat_ws('|', r.pipeline, r.run, r.groups, r.anomalies,
      printf('%.3f', r.seconds), coalesce(r.output, '-'))), ',') AS spark
  FROM typed AS t LEFT JOIN (SELECT job_id, string_agg(concat(stage, '=', attempts), ',' ORDER BY stage) AS attempts
                             FROM retries GROUP BY job_id) AS m ON t.job_id = m.job_id)"""
STATUS_COLUMNS = ["stage", "created_at", "updated_at", "attempts", "dataset_uri", "mode", "pipeline", "request_output",
                  "force_cpu", '"column"', "backend", "device", "elements", "mean", "stddev", "kernel_ms", "wall_ms",
                  "output_uri", "spark", "anomaly_rate", "rdd_s", "gpu_backend", "total_s", "verdict", "warnings", "error"]
FROM_LOG = f"""WITH {TYPED},
found AS (SELECT job_id, backend, floor((epoch_us(coalesce(spark_at, updated_at)) - epoch_us(created_at)) / 1000) / 1000.0 AS total_s,
    coalesce(list_max(list_transform(spark_runs, lambda r: r.groups)), 0) AS base,
    coalesce(list_max(list_transform(spark_runs, lambda r: r.anomalies)), 0) AS worst,
    list_unique(list_transform(spark_runs, lambda r: r.groups)) > 1 AS differ,
    list_filter(spark_runs, lambda r: r.pipeline = 'rdd')[1].seconds AS rdd_s,
    list_filter(spark_runs, lambda r: r.pipeline = 'dataframe')[1].seconds AS dataframe_s
  FROM typed WHERE backend IS NOT NULL),
rated AS (SELECT *, CASE WHEN base > 0 THEN worst / base ELSE 0.0 END AS rate,
          CASE WHEN dataframe_s > 0 THEN rdd_s / dataframe_s END AS speedup FROM found)
SELECT job_id, round(rate, 6) AS anomaly_rate, rdd_s, dataframe_s, round(speedup, 6) AS speedup, backend, round(total_s, 6) AS total_s,
  CASE WHEN speedup >= 1.5 THEN printf('DataFrame es %.2fx más rápido que RDD', speedup)
       WHEN speedup >= 1.0 THEN printf('DataFrame es marginalmente más rápido (%.2fx)', speedup)
       WHEN speedup IS NOT NULL THEN printf('RDD resultó más rápido (%.2fx): revise el tamaño del dataset', 1 / speedup)
       ELSE 'sólo se ejecutó un pipeline: sin comparación disponible' END AS verdict,
  array_to_string(list_filter([
    CASE WHEN backend <> 'cuda' THEN 'la fase GPU se ejecutó en CPU (OpenMP): el runtime no expuso ninguna GPU' END,
    CASE WHEN differ THEN 'los pipelines RDD y DataFrame devolvieron cardinalidades distintas' END,
    CASE WHEN rate > 0.05 THEN printf('tasa de anomalías inusualmente alta (%.1f%%): revise la calibración del sensor', rate * 100) END],
    lambda w: w IS NOT NULL), '; ') AS warnings FROM rated"""
ROUND_TRIP = f"""WITH {TYPED}
SELECT CASE WHEN job_id % 17 = 0 THEN -job_id ELSE job_id END AS job_id,
  {", ".join(f"CASE WHEN job_id % 17 <> 0 THEN {c} END AS {c}" for c in STATUS_COLUMNS)} FROM status"""
INSTANTS = """WITH t AS (SELECT event_id, event_id % 8 AS form, ts FROM events),
p AS (SELECT event_id, CASE WHEN event_id % 23 = 0 OR form >= 6 THEN NULL
    WHEN form = 0 THEN date_trunc('second', ts) WHEN form = 1 THEN date_trunc('millisecond', ts)
    WHEN form IN (2, 3) THEN ts WHEN form = 4 THEN date_trunc('second', ts) - INTERVAL 150 MINUTE
    ELSE date_trunc('second', ts) + INTERVAL 45 MINUTE END AS "at" FROM t)
SELECT event_id, CAST("at" AS TIMESTAMP) AS "at", CASE WHEN epoch_us("at") % 1000000 = 0 THEN strftime("at", '%Y-%m-%dT%H:%M:%SZ')
  WHEN epoch_us("at") % 1000 = 0 THEN concat(strftime("at", '%Y-%m-%dT%H:%M:%S'), printf('.%03dZ', epoch_us("at") // 1000 % 1000))
  ELSE strftime("at", '%Y-%m-%dT%H:%M:%S.%fZ') END AS printed FROM p"""

STATES = """states AS (SELECT event_id AS run_id, CASE event_type WHEN 'click' THEN 'RUNNING' WHEN 'view' THEN 'success'
  WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'CANCELLING' END AS state FROM events)"""

DIFF = f"""WITH {TEL}, {_group('g', 'region, sensor_id', 'norm', 'value_norm')},
l AS (SELECT * FROM g WHERE sensor_id NOT LIKE '%4'),
r AS (SELECT region, sensor_id, anomaly_ratio,
             mean_norm + CASE WHEN readings % 5 = 0 THEN 0.5 ELSE 0.0 END AS mean_norm
      FROM g WHERE sensor_id NOT LIKE '%3'),
b AS (SELECT coalesce(l.region, r.region) AS region, coalesce(l.sensor_id, r.sensor_id) AS sensor_id,
             l.mean_norm AS lm, r.mean_norm AS rm,
             CASE WHEN l.region IS NULL THEN 'missing_left' WHEN r.region IS NULL THEN 'missing_right'
                  WHEN abs(l.mean_norm - r.mean_norm) > 1e-6 THEN 'value' END AS status
      FROM l FULL JOIN r ON l.region = r.region AND l.sensor_id = r.sensor_id)
SELECT region, sensor_id, CASE WHEN status = 'value' THEN 'mean_norm' END AS "column", status,
  CASE WHEN status = 'value' THEN round(lm, 6) END AS "left",
  CASE WHEN status = 'value' THEN round(rm, 6) END AS "right"
FROM b WHERE status IS NOT NULL"""

EQUIVALENCE = f"""WITH {TEL}, {_group('a', 'region, sensor_id', 'norm', 'value_norm')},
{_group('b', 'region, sensor_id', 'norm', 'value_norm', 2.5)},
ta AS (SELECT count(*) AS groups, CAST(sum(anomalies) AS BIGINT) AS anomalies FROM a),
tb AS (SELECT count(*) AS groups, CAST(sum(anomalies) AS BIGINT) AS anomalies FROM b),
ra AS (SELECT row_number() OVER (ORDER BY anomaly_ratio DESC, readings DESC, region, sensor_id) AS p, * FROM a),
rb AS (SELECT row_number() OVER (ORDER BY anomaly_ratio DESC, readings DESC, region, sensor_id) AS p, * FROM b),
pairs AS (SELECT CAST(ra.p AS INT) AS position, ra.sensor_id AS ls, rb.sensor_id AS rs,
                 ra.anomaly_ratio AS lr, rb.anomaly_ratio AS rr
          FROM ra JOIN rb ON ra.p = rb.p WHERE ra.p <= 5)
SELECT 'groups' AS "check", CAST(NULL AS INT) AS position, CAST(ta.groups AS VARCHAR) AS "left",
  CAST(tb.groups AS VARCHAR) AS "right" FROM ta CROSS JOIN tb WHERE ta.groups <> tb.groups
UNION ALL SELECT 'anomalies', NULL, CAST(ta.anomalies AS VARCHAR), CAST(tb.anomalies AS VARCHAR)
  FROM ta CROSS JOIN tb WHERE ta.anomalies <> tb.anomalies
UNION ALL SELECT 'top_sensor', position, ls, rs FROM pairs WHERE ls <> rs
UNION ALL SELECT 'top_ratio', position, CAST(lr AS VARCHAR), CAST(rr AS VARCHAR)
  FROM pairs WHERE ls = rs AND abs(lr - rr) > 1e-6"""


def _xxhash_steps(*ints: str) -> list[str]:
    """64-bit xxHash of a long ``id`` and then 32-bit integers, step by step on 128-bit integers; each
    step is an expression over the last one's ``h``."""
    two64 = "18446744073709551616::UHUGEINT"
    p1, p2, p3, p4, p5 = (f"{p}::UHUGEINT" for p in (
        11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579,
        2870177450012600261))

    def mul(x: str, p: str) -> str:
        return f"(({x}) * {p} % {two64})"

    def rotl(x: str, r: int) -> str:
        return f"(((({x}) << {r}) | (({x}) >> {64 - r})) % {two64})"

    mix = ["xor(h, h >> 33)", mul("h", p2), "xor(h, h >> 29)", mul("h", p3), "xor(h, h >> 32)"]

    def of_int(value: str) -> list[str]:
        return [f"(h + {p5} + 4) % {two64}", f"xor(h, {mul(value, p1)})",
                f"({mul(rotl('h', 23), p2)} + {p3}) % {two64}", *mix]

    return [mul("id", p2), mul(rotl("h", 31), p1), f"xor(h, (42 + {p5} + 8) % {two64})",
            f"({mul(rotl('h', 27), p1)} + {p4}) % {two64}", *mix, *[s for i in ints for s in of_int(i)]]


def _permuted(numbers: str, size: str, key: str) -> str:
    """CTEs ``walk`` and ``placed`` (id, place): Feistel rounds over a near-square table, walked
    until inside the range. ``numbers`` gives (id, x, block)."""
    rounds = [(48_271, 12_345_701), (69_621, 987_654_323), (1_226_874_159, 7_368_787), (630_360_016, 1_406_932_606),
              (397_204_094, 86_028_121), (16_807, 179_424_673)]

    def shuffled(source: str) -> str:
        text = f"(SELECT *, spot // side AS r, spot % side AS c FROM {source})"
        for i, (factor, shift) in enumerate(rounds):
            of, into, width = ("r", "c", "side") if i % 2 else ("c", "r", "n_rows")
            once = f"((({of} + key) % 2147483647 * {factor} + {shift}) % 2147483647)"
            moved = f"(({into} + ({once} * {once} + {shift}) % 2147483647) % {width})"
            text = f"(SELECT * EXCLUDE ({into}), {moved} AS {into} FROM {text})"
        return text

    return f"""sized AS (SELECT id, x, {size} AS size, {key} AS key FROM ({numbers})),
squared AS (SELECT id, x AS spot, size, key, CAST(ceil(sqrt(size)) AS BIGINT) AS side,
  CAST(ceil(size / ceil(sqrt(size))) AS BIGINT) AS n_rows FROM sized),
walk AS (
  SELECT id, size, key, side, n_rows, r * side + c AS spot FROM {shuffled('squared')}
  UNION ALL SELECT id, size, key, side, n_rows, r * side + c FROM {shuffled('(SELECT * FROM walk WHERE spot >= size)')}),
placed AS (SELECT id, spot AS place, size FROM walk WHERE spot < size)"""


def _generated(outlier: str = "u0 < 0.004", placed: str = "") -> str:
    """The generator's draws: a hash of (id, seed, draw) each."""
    steps = _xxhash_steps("42::UHUGEINT", "draw")
    ctes = ["s0 AS (SELECT CAST(event_id AS UHUGEINT) AS id, CAST(d AS UHUGEINT) AS draw, "
            "0::UHUGEINT AS h FROM events, range(10) AS r(d))"]
    ctes += [f"s{i} AS (SELECT id, draw, {step} AS h FROM s{i - 1})" for i, step in enumerate(steps, 1)]
    draws = ", ".join(f"max(u) FILTER (draw = {d}) AS u{d}" for d in range(10))
    return f"""WITH RECURSIVE {placed}{", ".join(ctes)},
u AS (SELECT id, draw, (CAST(h >> 11 AS DOUBLE) + 0.5) / 9007199254740992.0 AS u FROM s{len(steps)}),
w AS (SELECT id, {draws} FROM u GROUP BY id),
v AS (SELECT *, 100 + 25 * sqrt(-2 * ln(u3)) * cos(2 * pi() * u4)
        + CASE WHEN {outlier} THEN CASE WHEN u5 < 0.5 THEN -1 ELSE 1 END * (100 + 100 * u6) ELSE 0 END AS value,
      80 + 18 * sqrt(-2 * ln(u7)) * cos(2 * pi() * u8) AS q FROM w)
SELECT printf('S%06d', CAST(floor(u2 * 5000) AS INT)) AS sensor_id,
  CASE WHEN u1 < 0.25 THEN 'eu-west' WHEN u1 < 0.33 THEN 'eu-north' WHEN u1 < 0.63 THEN 'us-east'
       WHEN u1 < 0.75 THEN 'us-west' WHEN u1 < 0.81 THEN 'sa-east' WHEN u1 < 0.91 THEN 'ap-south'
       WHEN u1 < 0.97 THEN 'ap-north' ELSE 'af-south' END AS region,
  CAST(floor(u9 * 2592000) AS BIGINT) AS ts, round(value, 6) AS value,
  round((value - 100) / 25, 6) AS value_norm,
  CAST(trunc(least(greatest(q, 0), 100)) AS INT) AS quality
FROM v"""


EXACT = _generated("id IN (SELECT id FROM placed WHERE place < floor(size * 0.004))", _permuted(
    "SELECT event_id AS id, (event_id - first) % 1000 AS x, (event_id - first) // 1000 AS block, n "
    "FROM events, (SELECT min(event_id) AS first, count(*) AS n FROM events)",
    "least(1000, n - block * 1000)", "block * 7919 + 42") + ",\n")
_STEPS = _xxhash_steps("42::UHUGEINT")
SAMPLE = f"""WITH s0 AS (SELECT event_id, user_id, value, CAST(event_id AS UHUGEINT) AS id, 0::UHUGEINT AS h FROM events),
{", ".join(f"s{i} AS (SELECT event_id, user_id, value, id, {step} AS h FROM s{i - 1})" for i, step in enumerate(_STEPS, 1))}
SELECT event_id, user_id, value FROM s{len(_STEPS)}
ORDER BY CASE WHEN h >= 9223372036854775808::UHUGEINT THEN CAST(h AS HUGEINT) - 18446744073709551616::HUGEINT
         ELSE CAST(h AS HUGEINT) END LIMIT (SELECT count(*) // 10 FROM events)"""

ORACLES: dict[str, str] = {
    "generate_telemetry": _generated(),
    "telemetry_exact_outliers": EXACT,
    "sample_exact": SAMPLE,
    "anomaly_profile": ENRICHED,
    "profile_sink": ENRICHED,
    "top_anomalies": _top(20),
    "top_first_rows": _top(5),
    "profile_totals": f"""{PROFILE}
SELECT count(*) AS groups, CAST(coalesce(sum(anomalies), 0) AS BIGINT) AS anomalies FROM g""",
    "profile_null_zero": f"""WITH {TEL},
z AS (SELECT region, sensor_id, quality, coalesce(value_norm, 0.0) AS x FROM norm),
{_group('g', 'region, sensor_id', 'z', 'x')}
SELECT region, sensor_id, {ROUNDED} FROM g""",
    "profile_unmatched_null": f"""{PROFILE}
SELECT g.region, g.sensor_id, {ROUNDED}, continent, sla_ms, tier
FROM g LEFT JOIN dim ON g.region = dim.region""",
    "normalized_sink": f"{PROFILE} SELECT region, sensor_id, {ROUNDED} FROM g",
    "region_profile_lineitem": f"""{LINE_STATS},
x AS (SELECT l_suppkey, r_name AS region, CAST(l_quantity * 2 AS INT) AS quality,
             (l_extendedprice - mu) * {SCALES['zscore'][1]} AS x
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey CROSS JOIN st),
{_group('g', 'region, l_suppkey', 'x', 'x', 1.5)}
SELECT l_suppkey, region, {ROUNDED} FROM g""",
    "quality_filter": f"WITH {TEL} SELECT sensor_id, region, ts, value, quality FROM tel WHERE quality >= 60",
    "csv_round_trip": f"""WITH {TEL}
SELECT sensor_id, region, ts, value, round(value_norm, 6) AS value_norm, quality FROM norm""",
    "column_stats": f"""WITH {TEL}
SELECT count(value) AS n, min(value) AS min, max(value) AS max, round(avg(value), 4) AS mean,
  round(stddev_pop(value), 4) AS stddev, round(sum(value), 4) AS sum, round(sum(value * value), 4) AS sumsq
FROM tel""",
    "pick_column_stats": """WITH k AS (SELECT count(*) AS n, CAST(min(o_orderkey) AS DOUBLE) AS min,
  CAST(max(o_orderkey) AS DOUBLE) AS max FROM orders)
SELECT 0 AS choice, 'o_orderkey' AS col_name, * FROM k
UNION ALL SELECT 1, 'o_orderkey', * FROM k
UNION ALL SELECT 2, 'o_totalprice', count(*), min(o_totalprice), max(o_totalprice) FROM orders""",
    **{f"normalize_{mode}": _line(mode) for mode in SCALES},
    **{f"normalize_array_{mode}": _array(mode) for mode in SCALES},
    "normalize_by_key": _by_key("l_returnflag", "l_returnflag"),
    "normalize_by_many_keys": _by_key("CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_partkey END", "k"),
    "normalize_fixed": "SELECT event_id, round((value - 100) / 25, 6) AS value_norm FROM events",
    "normalize_float32": """WITH st AS (SELECT CAST(avg(x) AS FLOAT) AS mu, CAST(1.0 / stddev_pop(x) AS FLOAT) AS sc
  FROM (SELECT CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS x FROM lineitem) AS f)
SELECT l_orderkey, l_linenumber,
  round(CAST((CAST(l_extendedprice AS FLOAT) - mu) * sc AS DOUBLE), 4) AS value_norm
FROM lineitem CROSS JOIN st""",
    "normalize_summary": """SELECT 'robust' AS mode, count(l_quantity) AS elements, min(l_quantity) AS min,
  max(l_quantity) AS max, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS stddev,
  sum(l_quantity) AS sum, sum(l_quantity * l_quantity) AS sumsq, round(avg(l_quantity), 6) AS shift,
  round(1.0 / (max(l_quantity) - min(l_quantity)), 6) AS scale FROM lineitem""",
    "timing_summary": _timing("events", "user_id, event_type", "value", "median(value)"),
    "timing_summary_hot": _timing("events", "event_type", "value", "median(value)"),
    "timing_summary_upper": _timing(RUNS, "job_id, pipeline", "seconds",
                                    "list_sort(list(seconds))[CAST(count(*) // 2 + 1 AS BIGINT)]"),
    "compare_runs": f"""WITH m AS (
  SELECT job_id, median(seconds) FILTER (pipeline = 'rdd') AS b,
         median(seconds) FILTER (pipeline = 'dataframe') AS c FROM {RUNS} GROUP BY job_id)
SELECT job_id, round(b, 6) AS baseline_s, round(c, 6) AS candidate_s, round(b / nullif(c, 0), 6) AS speedup,
  round((1 - c / nullif(b, 0)) * 100, 6) AS reduction_pct FROM m""",
    "job_analysis": _analysis("groups"),
    "job_analysis_readings": _analysis("readings"),
    "bench_pivot": BENCH_PIVOT,
    "bench_csv": BENCH_PIVOT,
    "profile_equivalence": EQUIVALENCE,
    "diff_tables": DIFF,
    "max_rel_error": """SELECT round(max(abs(l_extendedprice - CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE))
  / greatest(1e-6, abs(l_extendedprice))) FILTER (l_orderkey % 50 <> 0), 12) AS max_rel_error,
  count(*) FILTER (l_orderkey % 50 <> 0) AS compared, count(*) FILTER (l_orderkey % 50 = 0) AS one_sided FROM lineitem""",
    "validate_requests": f"""WITH {REQUESTS}
SELECT job_id, dataset_uri, mode, pipeline, callback_url,
  CASE WHEN len(errs) = 0 THEN coalesce(output_uri,
    concat(regexp_replace(dataset_uri, '[^/]*$', ''), 'processed/', job_id, '/')) ELSE output_uri END AS output_uri,
  array_to_string(errs, '; ') AS errors, len(errs) = 0 AS valid FROM checked""",
    "split_requests": f"""WITH {REQUESTS}
SELECT len(errs) = 0 AS valid, count(*) AS requests, CAST(sum(len(errs)) AS BIGINT) AS problems
FROM checked GROUP BY 1""",
    "parse_requests": PARSED,
    "fold_jobs": f"""WITH {LOG},
m AS (SELECT job_id, string_agg(concat(stage, '=', attempts), ',' ORDER BY stage) AS attempts
      FROM retries GROUP BY job_id)
SELECT f.*, coalesce(attempts, '') AS attempts, stage IN ('completed', 'failed') AS is_terminal,
  round(floor((epoch_us(TIMESTAMP '2024-02-15 00:00:00') - epoch_us(created_at)) / 1000) / 1000.0, 3) AS elapsed_s
FROM folded AS f LEFT JOIN m ON f.job_id = m.job_id""",
    "job_status_json": f"""WITH {LOG},
s AS (SELECT *, stage IN ('completed', 'failed') AS is_terminal, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS c,
      strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS u FROM folded)
SELECT job_id, CAST(CASE WHEN error IS NULL
    THEN json_object('jobId', job_id, 'stage', stage, 'createdAt', c, 'updatedAt', u, 'isTerminal', is_terminal)
    ELSE json_object('jobId', job_id, 'stage', stage, 'createdAt', c, 'updatedAt', u, 'isTerminal', is_terminal,
                     'error', error) END AS VARCHAR) AS status,
  job_id AS parsed_id, stage, created_at, updated_at, is_terminal, error FROM s""",
    "analysis_from_log": FROM_LOG,
    "typed_jobs": f"WITH {TYPED} SELECT job_id, {', '.join(STATUS_COLUMNS)} FROM status",
    "job_status_round_trip": ROUND_TRIP,
    "instants": INSTANTS,
    "job_attempts": f"WITH {LOG} SELECT job_id, stage, attempts FROM retries",
    "recent_jobs": f"{JOB_STATES} ORDER BY updated_at DESC, job_id LIMIT 100",
    "lookup_job": f"{JOB_STATES} WHERE job_id = 7",
    "retain_jobs": """SELECT event_id AS job_id, ts AS updated_at FROM events
WHERE ts + INTERVAL 30 DAY > TIMESTAMP '2024-02-15 00:00:00'""",
    "job_counts": f"""WITH {STATES}
SELECT count(*) AS runs, count(*) FILTER (state = 'RUNNING') AS active FROM states""",
    "run_family": f"""WITH {STATES}
SELECT run_id, CASE upper(coalesce(state, 'PENDING')) WHEN 'SUCCESS' THEN 'success' WHEN 'COMPLETED' THEN 'success'
  WHEN 'FAILED' THEN 'failed' WHEN 'CANCELLED' THEN 'failed' WHEN 'CANCELLING' THEN 'failed'
  ELSE 'pending' END AS family FROM states""",
    "first_starts": f"""WITH {LOG}
SELECT job_id, seq, "at", payload, (SELECT count(*) FROM log AS o WHERE o.job_id = ranked.job_id) - 1 AS rejected
FROM ranked WHERE pos = 1""",
    "classify_failures": """WITH f AS (
  SELECT CASE event_id % 9 WHEN 0 THEN 'java.net.SocketTimeoutException' WHEN 1 THEN 'NonRetryable'
    WHEN 2 THEN 'java.net.UnknownHostException' WHEN 3 THEN 'java.io.IOException'
    WHEN 4 THEN 'java.net.MalformedURLException' WHEN 5 THEN 'javax.net.ssl.SSLException'
    WHEN 6 THEN 'java.lang.OutOfMemoryError' WHEN 7 THEN 'com.example.StorageIOException'
    ELSE 'java.lang.RuntimeException' END AS error_class, event_id % 9 AS kind,
    CASE WHEN event_id % 7 = 0 THEN 'read timeout' ELSE concat('launcher HTTP ', 400 + event_id % 4 * 43) END AS message
  FROM events WHERE event_type = 'error')
SELECT error_class, CASE WHEN kind IN (1, 2, 6) THEN false WHEN kind IN (0, 3, 4, 5, 7) THEN true
  ELSE contains(message, 'HTTP 5') OR contains(message, 'HTTP 429') OR contains(message, 'timeout')
    OR contains(message, 'Connection refused') END AS retryable, count(*) AS failures
FROM f GROUP BY 1, 2""",
    "metrics_round_trip": f"""{PROFILE},
t AS (SELECT count(*) AS groups, CAST(sum(anomalies) AS BIGINT) AS anomalies FROM g),
r AS (SELECT * FROM (VALUES ('rdd', 'events', 0, 3.0::DOUBLE), ('rdd', 'events', 1, 1.0), ('rdd', 'events', 2, 2.0),
  ('dataframe', 'events', 0, 1.5), ('dataframe', 'events', 1, 0.5)) AS v(pipeline, input, run, seconds))
SELECT pipeline, input, run, seconds, groups, anomalies FROM r CROSS JOIN t""",
    "decode_f32": """SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS pos, unnest(embedding) AS x
FROM embeddings""",
    "malformed_payloads": """WITH p AS (SELECT vec_id % 13 <> 0 AS given, CASE WHEN vec_id % 13 = 0 THEN NULL
    WHEN vec_id % 11 = 0 THEN 'base64' WHEN vec_id % 7 = 0 THEN 'length' END AS problem FROM embeddings)
SELECT problem, count(*) AS rows, count(*) FILTER (given) AS payloads FROM p GROUP BY problem""",
    "enrich_large_dimension": """WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN -1
    WHEN l_orderkey % 31 <> 0 THEN l_partkey END AS p_partkey FROM lineitem)
SELECT l_orderkey, l_linenumber, l.p_partkey, CASE WHEN p.p_partkey IS NULL THEN 'none' ELSE p_brand END AS p_brand,
  CASE WHEN p.p_partkey IS NULL THEN 0 ELSE p_size END AS p_size FROM l LEFT JOIN part AS p ON l.p_partkey = p.p_partkey""",
    "read_npy_files": """WITH v AS (SELECT vec_id // 64 AS file, (row_number() OVER (PARTITION BY vec_id // 64 ORDER BY vec_id) - 1)
    * len(embedding) AS begins, embedding FROM embeddings),
x AS (SELECT file, begins + generate_subscripts(embedding, 1) - 1 AS idx, unnest(embedding) AS v FROM v)
SELECT file, count(*) AS elements, CAST(sum(idx) AS BIGINT) AS sum_idx, max(idx) AS last_idx, min(v) AS lowest,
  max(v) AS highest, arg_min(v, idx) AS first_value, arg_max(v, idx) AS last_value FROM x GROUP BY file""",
    "read_npy": """WITH x AS (SELECT unnest(embedding) AS v FROM embeddings)
SELECT round(v, 1) AS bin, count(*) AS elements, min(v) AS lowest, max(v) AS highest FROM x GROUP BY 1""",
}
