"""tidemark — incremental, idempotent, quality-gated daily marts on PySpark.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions (no Python UDFs).  Path-level helpers add the write
protocol (validate, rewrite touched partitions, then advance state).
"""

from tidemark.session import checkpoint_dir, get_session, scale_settings
from tidemark.operators.enrich import enrich, gap_fill, gap_fill_sized, gap_fill_time
from tidemark.operators.incremental import merge_incremental, window_replace
from tidemark.operators.profile import profile
from tidemark.operators.quality import (accepted_range, check_report, contract_diff,
                                        enforce_contract, failing_rows, freshness, not_null,
                                        row_rule, trace, unique_combination)
from tidemark.operators.series import (calendar_spine, carry_forward, carry_forward_increment,
                                       time_spine)
from tidemark.operators.upsert import upsert, upsert_columns, upsert_path, window_replace_path
from tidemark.plans.windows import advance_watermarks, plan_windows, windowed_batch

__all__ = [
    "get_session", "checkpoint_dir", "scale_settings",
    "calendar_spine", "time_spine", "carry_forward", "carry_forward_increment",
    "gap_fill", "gap_fill_sized", "gap_fill_time", "enrich",
    "upsert", "upsert_columns", "upsert_path", "window_replace_path",
    "merge_incremental", "window_replace",
    "not_null", "accepted_range", "row_rule", "unique_combination", "check_report",
    "failing_rows", "trace", "freshness", "contract_diff", "enforce_contract", "profile",
    "plan_windows", "windowed_batch", "advance_watermarks",
]
__version__ = "0.1.0"
