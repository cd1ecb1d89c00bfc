"""Named queries and the SQL each of them must agree with."""

QUERIES = {}
ORACLES = {}


def query(name, oracle=None):
    """Registers ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register
