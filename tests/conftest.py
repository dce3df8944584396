import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    import compare
    from trawl.operators import lookups, store
    # small indexes: few files to write
    store.BUCKETS, lookups.BUCKETS = 6, 3
    session = compare.session()
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
