import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tasador.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "4", 4)


@pytest.fixture(scope="session")
def raw_pandas():
    """200 raw listings with gaps, odd spellings and other countries."""
    rng = np.random.default_rng(42)
    n = 200
    df = pd.DataFrame(
        {
            "id": [f"p{i}" for i in range(n)],
            "l1": rng.choice(["Argentina", "Argentina", "Argentina", "Uruguay"], n),
            "l2": rng.choice([" buenos aires", "CÓRDOBA ", "santa fe"], n),
            "l3": rng.choice(["la plata", "o'higgins", None], n),
            "operation_type": rng.choice(["Venta", "Alquiler", "Alquiler temporal"], n),
            "property_type": rng.choice(["Casa", "departamento", "PH"], n),
            "price": np.abs(rng.normal(150000, 50000, n)).round(2),
            "surface_total": np.abs(rng.normal(100, 30, n)).round(1),
            "surface_covered": np.abs(rng.normal(80, 25, n)).round(1),
            "rooms": rng.integers(1, 6, n).astype(float),
            "bedrooms": rng.integers(1, 4, n).astype(float),
            "bathrooms": rng.integers(1, 3, n).astype(float),
        }
    )
    df.loc[::17, "price"] = np.nan
    df.loc[::23, "surface_total"] = np.nan
    df.loc[::13, "bedrooms"] = np.nan
    df.loc[5, "price"] = 5e6
    df.loc[6, "surface_total"] = 2000.0
    df.loc[7, "surface_total"] = 0.0
    return df


@pytest.fixture(scope="session")
def raw(spark, raw_pandas):
    from tasador.functions.numeric import nan_to_null

    return nan_to_null(spark.createDataFrame(raw_pandas)).cache()


@pytest.fixture(scope="session")
def rows(spark):
    """Model rows of the stand-in listings."""
    from tasador.plans.queries import stored

    return stored(spark, SF).cache()


@pytest.fixture
def folder(spark):
    from tasador.session import scratch_path

    return scratch_path(spark, "test")
