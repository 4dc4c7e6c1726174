from wardflow.sources.readers import (  # noqa: F401
    jdbc_options, read_query, read_key_range, read_target_keys, register_views,
)
from wardflow.sources.sinks import append, overwrite_partitions, apply_corrections  # noqa: F401
from wardflow.sources.conform import conform  # noqa: F401
from wardflow.sources.audit import audited  # noqa: F401
