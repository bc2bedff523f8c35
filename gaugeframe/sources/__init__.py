from .requests import parse_requests
from .runs import read_bench, read_metrics, read_runs
from .sinks import write_metrics, write_normalized, write_profile, write_table
from .synthetic import block_outlier, generate_telemetry, telemetry_from_ids
from .telemetry import pick_column, read_telemetry
from .vectors import read_npy

__all__ = [
    "block_outlier", "generate_telemetry", "parse_requests", "pick_column", "read_bench", "read_metrics",
    "read_npy", "read_runs", "read_telemetry", "telemetry_from_ids", "write_metrics",
    "write_normalized", "write_profile", "write_table",
]
