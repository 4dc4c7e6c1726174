"""All load specs by name."""

from wardflow.plans import ct, facility, hts, mnch, prep

SPECS = {s.name: s for mod in (ct, facility, hts, mnch, prep) for s in mod.SPECS}


def by_id(pid: str):
    """'p23' -> the spec whose name starts with it."""
    return next(s for n, s in SPECS.items() if n.startswith(pid + "_"))
