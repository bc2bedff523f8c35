from .compare import diff_tables, equivalent, max_rel_error
from .enrich import enrich
from .jobs import (accept_starts, classify_failures, fold_jobs, job_attempts, job_counts,
                   job_status_json, lookup_job, parse_job_status, recent_jobs, retain)
from .normalize import (column_stats, normalize, normalize_fixed, normalize_modes,
                        normalize_summary)
from .order_stats import middle_values
from .profile import (anomaly_profile, filter_quality, profile_totals, project_profile_input,
                      top_anomalies)
from .requests import split_requests, validate_requests
from .results import analyze_folded, decode_status, encode_status, typed_jobs
from .runs import analyze_jobs, bench_pivot, compare_runs, metrics_record, timing_summary
from .sample import sample_cut, sample_exact

__all__ = [
    "accept_starts", "analyze_folded", "analyze_jobs", "anomaly_profile", "bench_pivot", "classify_failures",
    "column_stats", "compare_runs", "decode_status", "diff_tables", "encode_status", "enrich", "equivalent", "filter_quality",
    "fold_jobs", "job_attempts", "job_counts", "job_status_json", "lookup_job", "max_rel_error",
    "metrics_record",
    "middle_values", "normalize", "normalize_fixed", "normalize_modes", "normalize_summary",
    "parse_job_status", "profile_totals", "project_profile_input", "recent_jobs", "retain", "sample_cut",
    "sample_exact", "split_requests",
    "timing_summary", "top_anomalies", "typed_jobs", "validate_requests",
]
