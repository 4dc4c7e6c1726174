from wardflow.plans.spec import LoadSpec, Latest, Lookup, Parent, Rule  # noqa: F401
from wardflow.plans.run import FrameIO, JdbcIO, ParquetIO, build_load, run_load  # noqa: F401
