"""All registered queries (importing the modules registers them)."""

from txlens.plans import queries as _base  # noqa: F401
from txlens.plans import queries_ml as _ml  # noqa: F401
from txlens.plans import queries_models as _models  # noqa: F401
from txlens.plans import queries_profile as _profile  # noqa: F401
from txlens.plans import queries_twins as _twins  # noqa: F401
from txlens.plans.queries import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
