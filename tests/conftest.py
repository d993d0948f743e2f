import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def frame(spark, rows, schema, with_ord=True):
    """createDataFrame plus an ``ord`` column holding the list position."""
    if with_ord:
        rows = [tuple(r) + (i,) for i, r in enumerate(rows)]
        schema = schema + ", ord long"
    return spark.createDataFrame(rows, schema)


def by(df, *keys):
    """Rows as dicts keyed by the given column values."""
    out = {}
    for r in df.collect():
        d = r.asDict()
        key = tuple(d[k] for k in keys)
        out[key[0] if len(keys) == 1 else key] = d
    return out
