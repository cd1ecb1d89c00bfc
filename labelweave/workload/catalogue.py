"""All registered queries."""

from labelweave.workload import file_queries  # noqa: F401
from labelweave.workload import labelling_queries  # noqa: F401
from labelweave.workload import model_queries  # noqa: F401
from labelweave.workload import token_queries  # noqa: F401
from labelweave.workload.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
