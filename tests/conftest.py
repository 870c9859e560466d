import gc
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))



@pytest.fixture(scope="session")
def spark():
    from staylytics.session import ensure_checkpoint_dir, get_spark

    import tempfile

    wh = tempfile.mkdtemp(prefix="staylytics-wh-", dir="/tmp")
    s = get_spark("local[4]", 8, conf={"spark.sql.warehouse.dir": wh})
    ensure_checkpoint_dir(s)
    yield s
    from staylytics.registry import drop_contexts

    drop_contexts(s)
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def tidy(spark):
    """What a module has kept goes before the next one begins: caches, and what the driver's Python holds of finished frames."""
    yield
    spark.catalog.clearCache()
    gc.collect()
    spark._jvm.System.gc()
