"""Job history: an event log folded into the current state of each job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.instants import parse_instant
from ..functions.status import failure_retryable, is_terminal
from ..schema import RECENT_JOBS, RETENTION_DAYS

# The stage a job is in after each event. A retry leaves it where it was.
STAGE_AFTER = {
    "job_accepted": "validating",
    "input_validated": "gpu",
    "gpu_completed": "spark",
    "spark_completed": "analyzing",
    "analysis_completed": "responding",
    "response_delivered": "completed",
    "job_failed": "failed",
}
RETRY_EVENT = "stage_retry_scheduled"
RETRY_TEXT = "concat('reintento ', attempt, ' en ', stage, ': ', reason)"
FAILED_TEXT = "concat('[', stage, '] ', reason)"


# The events whose payload, or text, a field of the state keeps.
WRITES = {"request": ["job_accepted", "input_validated"], "gpu": ["gpu_completed"], "runs": ["spark_completed"],
          "analysis": ["analysis_completed"], "error": ["job_failed", RETRY_EVENT]}
SHIFT = 1 << 64


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def position(at: Column | str = "at", seq: Column | str = "seq") -> Column:
    """The place of an event among those of its job, by time and then sequence, as one number:
    a fixed-size value, of which a hash aggregate keeps the greatest."""
    at, seq = (F.col(c) if isinstance(c, str) else c for c in (at, seq))
    micros = F.coalesce(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at),
                        F.lit(-(1 << 62)))
    low = F.coalesce(seq.cast("decimal(20,0)"), _whole(-(1 << 63))) + _whole(1 << 63)
    return (micros.cast("decimal(19,0)") * _whole(SHIFT) + low).cast("decimal(38,0)")


def fold_with_times(events: DataFrame) -> DataFrame:
    """``fold_jobs`` without ``is_terminal``, with ``spark_at``, the last time runs were reported.

    One hash aggregate finds where each kind of event was last seen: numbers only, combined on the
    map side, so a job may have any number of events. The texts at those places are then fetched by
    (job, position), a handful for each job; nothing is sorted by job.
    """
    placed = events.withColumn("__at", position())
    retried = F.when(F.col("event_type") == RETRY_EVENT, F.coalesce("stage", F.lit("")))
    seen = placed.groupBy("job_id", "event_type", retried.alias("__retried")).agg(
        F.max("__at").alias("__last"), F.min("at").alias("__first_at"), F.max("at").alias("__last_at"))
    kind = F.col("event_type")

    def last_of(types: list[str]) -> Column:
        return F.max(F.when(kind.isin(types), F.col("__last")))

    ladder = F.lit(None).cast("string")
    for event in STAGE_AFTER:
        ladder = F.when(F.col("__stage_at") == F.col(f"__{event}"), F.lit(STAGE_AFTER[event])).otherwise(ladder)
    jobs = seen.groupBy("job_id").agg(
        F.min("__first_at").alias("__first_at"), F.max("__last_at").alias("updated_at"),
        F.max(F.when(kind == "job_accepted", F.col("__last_at"))).alias("__accepted_at"),
        F.max(F.when(kind == "spark_completed", F.col("__last_at"))).alias("spark_at"),
        last_of(list(STAGE_AFTER)).alias("__stage_at"), *[last_of([e]).alias(f"__{e}") for e in STAGE_AFTER],
        *[last_of(types).alias(f"__at_{field}") for field, types in WRITES.items()],
        # One entry per stage name that the job retried.
        F.collect_list(F.when(kind == RETRY_EVENT, F.struct(
            F.col("__last").alias("at"), F.col("__retried").alias("slot")))).alias("__retries"))
    fields = F.array(*[F.struct(F.col(f"__at_{f}").alias("at"), F.lit(f"field {f}").alias("slot")) for f in WRITES])
    tries = F.transform("__retries", lambda r: F.struct(r["at"].alias("at"), F.concat(F.lit("tries "), r["slot"]).alias("slot")))
    wanted = jobs.select(F.col("job_id").alias("__job"), F.explode(F.concat(fields, tries)).alias("w")).filter(
        "w.at IS NOT NULL").select("__job", F.col("w.at").alias("__place"), F.col("w.slot").alias("__slot"))
    retry, writes = kind == RETRY_EVENT, kind.isin([t for types in WRITES.values() for t in types])
    text = (F.when(retry, F.expr(RETRY_TEXT)).when(kind == "job_failed", F.expr(FAILED_TEXT)).otherwise(F.col("payload")))
    # Of a retry both its text and its number are read; other fields belong to their own events.
    owner = F.lit(None).cast("string")
    for field, types in WRITES.items():
        owner = F.when(kind.isin(types), F.lit(f"field {field}")).otherwise(owner)
    rows = placed.filter(writes).select("job_id", "__at", owner.alias("__owner"), text.alias("__text"), retried.alias("__retried"),
                                        F.when(retry, F.col("attempt")).alias("__attempt"))
    mine = (F.col("__slot") == F.col("__owner")) | (F.col("__slot") == F.concat(F.lit("tries "), F.col("__retried")))
    value = F.when(F.col("__slot").startswith("tries "), F.col("__attempt").cast("string")).otherwise(F.col("__text"))
    found = rows.join(wanted, F.col("job_id").eqNullSafe(F.col("__job")) & (F.col("__at") == F.col("__place")) & mine)
    # Events given twice meet here as equal rows; of different ones at one place the greatest counts.
    found = found.select("__job", "__slot", value.alias("__value")).distinct().groupBy(
        "__job").agg(F.collect_list(F.struct("__slot", "__value")).alias("__found"))

    def of(slot: Column) -> Column:
        return F.array_max(F.transform(F.filter("__found", lambda e: e["__slot"] == slot), lambda e: e["__value"]))

    attempts = F.map_from_entries(F.transform("__retries", lambda r: F.struct(
        r["slot"], of(F.concat(F.lit("tries "), r["slot"])).cast("int"))))
    state = jobs.join(found, F.col("job_id").eqNullSafe(F.col("__job")), "left")
    return state.select(
        "job_id", F.coalesce(ladder, F.lit("received")).alias("stage"),
        F.coalesce("__accepted_at", "__first_at").alias("created_at"), "updated_at",
        *[of(F.lit(f"field {f}")).alias(f) for f in WRITES], attempts.alias("attempts"), "spark_at")


def fold_jobs(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Current state per job of ``job_id, seq, at, event_type, stage, attempt, reason, payload``.

    Last-write-wins values, by time and then sequence. ``attempts`` maps each retried stage, by the
    name in the event, to its last recorded attempt. ``now`` adds ``elapsed_s``.
    """
    state = fold_with_times(events).drop("spark_at").withColumn("is_terminal", is_terminal("stage"))
    if now is not None:
        state = state.withColumn("elapsed_s", elapsed_seconds(F.col("created_at"), now))
    return state


def elapsed_seconds(since: Column, now: Column) -> Column:
    """Time between two timestamps in seconds, down to whole milliseconds. Taken from their
    interval, so zone-less timestamps do not pass through the session time zone."""
    span = now - since
    seconds = (F.extract(F.lit("DAY"), span) * 86400 + F.extract(F.lit("HOUR"), span) * 3600
               + F.extract(F.lit("MINUTE"), span) * 60 + F.extract(F.lit("SECOND"), span))
    return F.floor(seconds * 1000) / 1000.0


def job_attempts(events: DataFrame) -> DataFrame:
    """``job_id, stage, attempts``: the last recorded attempt of each retried stage, by the name
    in the event: names outside the domain stay apart."""
    return (events.filter(F.col("event_type") == RETRY_EVENT).groupBy("job_id", "stage")
            .agg(F.max_by("attempt", position()).alias("attempts")))


INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def job_status_json(jobs: DataFrame) -> DataFrame:
    """``job_id, status``: the folded state as a JSON text, instants in ISO form. A field that is
    NULL is left out."""
    status = F.to_json(F.struct(
        F.col("job_id").alias("jobId"), "stage", F.date_format("created_at", INSTANT).alias("createdAt"),
        F.date_format("updated_at", INSTANT).alias("updatedAt"), F.col("is_terminal").alias("isTerminal"), "error"))
    return jobs.select("job_id", status.alias("status"))


def parse_job_status(df: DataFrame, json_col: str, id_type: str = "bigint") -> DataFrame:
    """The columns of ``job_status_json`` back from its text; a malformed text gives NULLs, and so
    does a field that is no instant as Java prints them."""
    body = F.from_json(json_col, f"jobId {id_type}, stage string, createdAt string, updatedAt string, "
                                 "isTerminal boolean, error string")
    instant = [parse_instant(F.col(f"__s.{c}")).alias(name)
               for c, name in (("createdAt", "created_at"), ("updatedAt", "updated_at"))]
    return df.withColumn("__s", body).select(
        *df.columns, F.col("__s.jobId").alias("parsed_id"), "__s.stage", *instant,
        F.col("__s.isTerminal").alias("is_terminal"), "__s.error")


def recent_jobs(jobs: DataFrame, n: int = RECENT_JOBS) -> DataFrame:
    return jobs.orderBy(F.col("updated_at").desc(), "job_id").limit(n)


def lookup_job(jobs: DataFrame, job_id) -> DataFrame:
    return jobs.filter(F.col("job_id") == F.lit(job_id))


def retain(jobs: DataFrame, days: int = RETENTION_DAYS, now: Column | None = None) -> DataFrame:
    """Jobs updated within the last ``days``: a bound on the column itself, so it is pushed down."""
    now = F.current_timestamp() if now is None else now
    return jobs.filter(F.col("updated_at") > now - F.make_dt_interval(days=F.lit(days)))


def job_counts(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count(F.lit(1)).alias("runs"),
                    F.count_if(F.col("state") == "RUNNING").alias("active"))


def accept_starts(starts: DataFrame) -> DataFrame:
    """The first start of each job (by at, seq), with how many later ones were refused. Of different
    starts at one place the smallest row counts. The rows are fetched by (job, position) once a hash
    aggregate of numbers knows the positions."""
    placed = starts.withColumn("__at", position())
    firsts = placed.groupBy(F.col("job_id").alias("__job")).agg(
        F.min("__at").alias("__place"), (F.count(F.lit(1)) - 1).alias("rejected"))
    columns = [c for c in starts.columns if c != "job_id"]
    found = placed.join(firsts, F.col("job_id").eqNullSafe(F.col("__job")) & (F.col("__at") == F.col("__place")))
    rows = found.select("job_id", "rejected", *columns).distinct().groupBy("job_id", "rejected").agg(
        F.array_min(F.collect_list(F.struct(*columns))).alias("first"))
    return rows.select("job_id", "first.*", "rejected")


def classify_failures(errors: DataFrame, class_col: str, msg_col: str) -> DataFrame:
    """Number of failures by error class and whether a retry may help."""
    return (errors.groupBy(F.col(class_col), failure_retryable(class_col, msg_col).alias("retryable"))
            .agg(F.count(F.lit(1)).alias("failures")))
