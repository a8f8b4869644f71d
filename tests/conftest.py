import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from reliefgrid.session import get_session

    s = get_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def grid(spark):
    """Arrays -> pixel table with one raster per entry."""
    import numpy as np
    import pandas as pd

    def make(rasters, name="z", row0=0, col0=0):
        frames = []
        for k, a in rasters.items():
            r, c = np.indices(a.shape)
            v = a.ravel()
            frames.append(pd.DataFrame({"k": k, "row": (r.ravel() + row0).astype("int32"), "col": (c.ravel() + col0).astype("int32"), name: v}))
        df = pd.concat(frames, ignore_index=True)
        kind = "boolean" if df[name].dtype == bool else "double"
        if kind == "double":
            df[name] = df[name].astype(object).where(df[name].notna(), None)
        return spark.createDataFrame(df, f"k string, row int, col int, {name} {kind}")

    return make
