import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from shelfwise.session import get_spark
    warehouse = tempfile.mkdtemp(prefix="shelfwise-warehouse-")
    s = get_spark("shelfwise-tests", master="local[4]", shuffle_partitions=4,
                  conf={"spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a sorted list of tuples (optionally selected columns)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple("" if v is None else str(v) for v in t))
