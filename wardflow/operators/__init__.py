from wardflow.operators.latest import last_per_key, latest_joint_max  # noqa: F401
from wardflow.operators.delta import new_records  # noqa: F401
from wardflow.operators.lookup import dedupe_lookup, prepare_lookup, standardise  # noqa: F401
from wardflow.operators.joins import parent_exists, join_parents  # noqa: F401
from wardflow.operators.repair import repair_dates  # noqa: F401
