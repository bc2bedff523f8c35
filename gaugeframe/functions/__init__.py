from .arrays import decode_f32, f32_problem, normalize_array
from .numeric import affine, clean_number, epoch_seconds, is_anomaly, null_policy_value
from .status import failure_retryable, run_family, run_warnings, stage_name, verdict
from .uris import default_output, pipeline_output

__all__ = [
    "affine", "clean_number", "decode_f32", "default_output", "epoch_seconds",
    "f32_problem", "failure_retryable", "is_anomaly", "normalize_array", "null_policy_value",
    "pipeline_output", "run_family", "run_warnings", "stage_name", "verdict",
]
