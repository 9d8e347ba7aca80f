import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lossmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "lossmill-tests", memory="6g")
    yield session
    session.stop()


@pytest.fixture
def portfolio(spark):
    """A small portfolio with every special case of the marts."""
    columns = (
        "IDpol long, Exposure double, Area string, VehPower long, VehAge long, DrivAge long, "
        "BonusMalus long, VehBrand string, VehGas string, Density long, Region string, "
        "ReportedClaimCount long, TotalClaimAmount double, PaidClaimCount long, "
        "Underwriting_Date date"
    )
    from datetime import date

    rows = [
        (1, 1.0, "A", 5, 3, 25, 50, "B1", "Gas", 10, "R1", 0, 0.0, 0, date(2024, 1, 5)),
        (2, 1.0, "B", 5, 3, 26, 50, "B1", "Gas", 10, "R1", 1, 900.0, 1, date(2024, 1, 9)),
        (3, 0.0, "A", 6, 1, 40, 60, "B2", "Gas", 20, "R1", 1, 120.0, 1, date(2024, 3, 1)),
        (4, 0.5, "C", 7, 2, None, 55, "B2", "Gas", 20, "R2", 2, 4000.0, 2, date(2024, 3, 2)),
        (5, 0.25, "C", 8, 0, 60, 90, "B2", "Gas", 30, "R1", 0, 0.0, 0, date(2024, 3, 9)),
        (6, 0.75, "B", 4, 9, 33, 100, "B3", "Gas", 30, "R2", 1, 0.0, 1, date(2024, 4, 9)),
    ]
    return spark.createDataFrame(rows, columns)
