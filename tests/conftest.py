import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pitwall.session import get_session

    session = get_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cars(spark):
    """A season fixture with one driver and one circuit that hold most rows."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    rows = []
    for race in range(60):
        year, rnd = 2000 + race // 12, race % 12 + 1
        circuit = 1 if race % 3 else 2 + race % 4
        for car in range(8):
            rows.append((len(rows), race, year, rnd, circuit, 1 if rng.random() < 0.4 else int(rng.integers(2, 9)),
                         int(rng.integers(1, 4)), float(rng.integers(40, 60)),
                         None if rng.random() < 0.1 else float(rng.integers(70_000, 90_000)), int(rng.random() < 0.4)))
    pdf = pd.DataFrame(rows, columns=["rowId", "raceId", "year", "round", "circuitId", "driverId", "constructorId",
                                      "laps", "x", "target_cls"])
    schema = ("rowId long, raceId long, year long, round long, circuitId long, driverId long, constructorId long, "
              "laps double, x double, target_cls int")
    clean = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False, name=None)]
    return spark.createDataFrame(clean, schema)
