import datetime as dt

import pandas as pd
import pytest

from dayloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "dayloom-tests", shuffle=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def make_panel(spark):
    """Panel from {series: [y, …]} starting 2025-01-06 (a Monday), flat weather."""

    def build(series, start=dt.date(2025, 1, 6), **columns):
        rows = []
        for name, values in series.items():
            for i, y in enumerate(values):
                row = {"series_id": name, "ds": start + dt.timedelta(days=i), "y": y}
                row |= {"temp": 20.0 + i % 9, "precip": float(i % 7 == 3), "snow": 0.0}
                row |= {c: f(i) for c, f in columns.items()}
                rows.append(row)
        pdf = pd.DataFrame(rows)
        kinds = {c: "double" for c in pdf.columns if c not in ("series_id", "ds")}
        schema = "series_id string, ds date, " + ", ".join(f"`{c}` {t}" for c, t in kinds.items())
        data = [
            tuple(None if isinstance(v, float) and v != v else v for v in r)
            for r in pdf.itertuples(index=False, name=None)
        ]
        return spark.createDataFrame(data, schema)

    return build
