"""Column expressions on job, run and failure states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import HIGH_ANOMALY_RATE, STAGES
from .numeric import printed

# The texts a job analysis carries.
WARN_CPU = "la fase GPU se ejecutó en CPU (OpenMP): el runtime no expuso ninguna GPU"
WARN_GROUPS = "los pipelines RDD y DataFrame devolvieron cardinalidades distintas"
WARN_RATE = "tasa de anomalías inusualmente alta (%.1f%%): revise la calibración del sensor"
VERDICT_FASTER = "DataFrame es %.2fx más rápido que RDD"
VERDICT_MARGINAL = "DataFrame es marginalmente más rápido (%.2fx)"
VERDICT_SLOWER = "RDD resultó más rápido (%.2fx): revise el tamaño del dataset"
VERDICT_NONE = "sólo se ejecutó un pipeline: sin comparación disponible"

# What makes a failure worth a retry.
RETRY_MESSAGES = ["HTTP 5", "HTTP 429", "timeout", "Connection refused"]
FINAL_CLASSES = ["NonRetryable", "UnknownHostException"]
RETRY_CLASSES = ["TimeoutException"]
# The I/O exceptions of java.io, java.net, java.nio.channels and javax.net.ssl whose
# names do not say so. A name that ends in IOException is one as well, except java.io's unchecked one.
IO_CLASSES = ["SocketTimeoutException", "ConnectException", "SocketException", "BindException",
              "NoRouteToHostException", "PortUnreachableException", "EOFException",
              "FileNotFoundException", "MalformedURLException", "ProtocolException",
              "UnknownServiceException", "HttpRetryException", "CharConversionException",
              "UTFDataFormatException", "UnsupportedEncodingException", "SyncFailedException",
              "ObjectStreamException", "InvalidClassException", "InvalidObjectException",
              "NotSerializableException", "StreamCorruptedException", "ClosedChannelException",
              "AsynchronousCloseException", "ClosedByInterruptException", "FileLockInterruptionException",
              "InterruptedByTimeoutException", "SSLException", "SSLHandshakeException", "SSLKeyException",
              "SSLPeerUnverifiedException", "SSLProtocolException"]
NO_IO_CLASS = "UncheckedIOException"

# Launcher states by family.
STATES_OK = ["SUCCESS", "COMPLETED"]
STATES_FAILED = ["FAILED", "CANCELLED", "CANCELLING"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stage_name(col: Column | str) -> Column:
    """Stage checked against its domain; any other name reads as ``failed``."""
    stage = _col(col)
    return F.when(stage.isin(STAGES), stage).otherwise(F.lit("failed"))


def is_terminal(stage: Column | str) -> Column:
    return stage_name(stage).isin("completed", "failed")


def run_family(state: Column | str) -> Column:
    """``success`` / ``failed`` / ``pending``; a missing state is pending."""
    name = F.upper(F.coalesce(_col(state), F.lit("PENDING")))
    return (F.when(name.isin(STATES_OK), F.lit("success"))
             .when(name.isin(STATES_FAILED), F.lit("failed"))
             .otherwise(F.lit("pending")))


def failure_retryable(error_class: Column | str, message: Column | str,
                      io_classes: list[str] = IO_CLASSES) -> Column:
    """Transient failures only. Any I/O exception may be retried, an ``Error`` never; other
    exceptions go by their message."""
    name = F.coalesce(F.element_at(F.split(_col(error_class), r"\."), -1), F.lit(""))
    text = F.coalesce(_col(message), F.lit(""))
    by_message = F.lit(False)
    for part in RETRY_MESSAGES:
        by_message = by_message | text.contains(part)
    return (F.when(name.isin(FINAL_CLASSES), F.lit(False))
             .when(name.isin(RETRY_CLASSES + io_classes) | (name.endswith("IOException") & (name != NO_IO_CLASS)),
                   F.lit(True))
             .when(name.endswith("Error"), F.lit(False))
             .otherwise(by_message))


def run_warnings(backend: Column, groups_differ: Column, rate: Column, rounded: bool = False) -> Column:
    """``rounded`` writes the rate by ``printed``."""
    percent = rate * 100.0
    high = (F.format_string(WARN_RATE.replace("%.1f", "%s"), printed(percent, 1)) if rounded
            else F.format_string(WARN_RATE, percent))
    return F.array_compact(F.array(
        F.when(~backend.eqNullSafe(F.lit("cuda")), F.lit(WARN_CPU)),
        F.when(groups_differ, F.lit(WARN_GROUPS)),
        F.when(rate > HIGH_ANOMALY_RATE, high),
    ))


def verdict(speedup: Column, rounded: bool = False) -> Column:
    """``rounded`` writes the factors by ``printed``."""
    def text(form: str, factor: Column) -> Column:
        return F.format_string(form.replace("%.2f", "%s"), printed(factor, 2)) if rounded else F.format_string(form, factor)

    return (F.when(speedup >= 1.5, text(VERDICT_FASTER, speedup))
             .when(speedup >= 1.0, text(VERDICT_MARGINAL, speedup))
             .when(speedup == 0, F.format_string(VERDICT_SLOWER, F.lit(float("inf"))))
             .when(speedup.isNotNull(), text(VERDICT_SLOWER, F.try_divide(F.lit(1.0), speedup)))
             .otherwise(F.lit(VERDICT_NONE)))


def analysis_of(runs: Column, backend: Column, total_s: Column, rate_base: str = "groups") -> Column:
    """A job's analysis as a struct, from its runs (array of pipeline, groups, anomalies,
    medianSeconds): seconds of the first run of either pipeline, greatest counts of all."""
    def seconds(name: str) -> Column:
        return F.get(F.filter(runs, lambda r: r["pipeline"] == name), F.lit(0))["medianSeconds"]

    def greatest(field: str) -> Column:
        return F.coalesce(F.array_max(F.transform(runs, lambda r: r[field])), F.lit(0))

    rdd, frame = seconds("rdd"), seconds("dataframe")
    speedup = F.when(frame > 0, F.try_divide(rdd, frame))
    rate = F.when(greatest(rate_base) > 0, greatest("anomalies") / greatest(rate_base)).otherwise(F.lit(0.0))
    differ = F.size(F.array_distinct(F.transform(runs, lambda r: r["groups"]))) > 1
    return F.struct(rate.alias("anomalyRate"), rdd.alias("rddSeconds"), frame.alias("dataFrameSeconds"),
                    speedup.alias("sparkSpeedup"), backend.alias("gpuBackend"), total_s.alias("totalSeconds"),
                    verdict(speedup).alias("verdict"), run_warnings(backend, differ, rate).alias("warnings"))
