from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from compare import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4")


@pytest.fixture
def visitors(spark):
    """Visitors of a tower: id, name, height in cm, badge, time of entry."""
    rows = [
        ("1", "Ødegård", 158, "north.17@gate.example", "2031-06-11 08:15:30"),
        ("2", "Šárka", 172, "east.4@gate.example", "2031-06-11 09:40:00"),
        ("3", "Ng Wei", 190, "north.3@gate.example", "2031-06-12 17:05:45"),
        ("4", "Łucja", 175, "west.88@gate.example", "2031-06-13 10:00:10"),
        ("5", "José", 181, "east.5@gate.example", "2031-06-15 23:59:59"),
    ]
    return spark.createDataFrame(rows, "id string, name string, height int, badge string, entered string")


@pytest.fixture
def three(visitors):
    return visitors.where("id <= '3'")
