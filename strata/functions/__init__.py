"""Column functions (all built from JVM-side Spark SQL functions)."""

from strata.functions.text import (  # noqa: F401
    java_trim, jvm_split, jvm_split_size, has_exact_fields, strip_nul_prefix, split_fields,
)
from strata.functions.kv import kv_get, kv_map  # noqa: F401
from strata.functions.clock import (  # noqa: F401
    bucket_start, bucket_path, bucket_folder, bucket_glob, run_date, days_before, window_before,
)
from strata.functions.codes import rs_type_of  # noqa: F401
