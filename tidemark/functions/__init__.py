from tidemark.functions.hashing import canonical, row_hash
from tidemark.functions.scalars import (
    FULL_LOAD_REQUEST,
    FULL_LOAD_START,
    check_range,
    composite_id,
    concat_blank,
    effective_start,
    elapsed_seconds,
    parse_time,
    run_id,
    safe_key,
    time_literal,
    with_defaults,
)

__all__ = [
    "FULL_LOAD_REQUEST", "FULL_LOAD_START", "canonical", "check_range", "composite_id",
    "concat_blank", "effective_start", "elapsed_seconds", "parse_time", "row_hash", "run_id",
    "safe_key", "time_literal", "with_defaults",
]
