import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from arealis.functions import geometry as G  # noqa: E402
from arealis.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]
DIAMOND = [(10, -3), (14, 0), (10, 3), (6, 0), (10, -3)]
ELBOW = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0)]
ISLAND = [(20, 0), (21, 0), (21, 1), (20, 1), (20, 0)]


def polygon(*parts):
    """Parts of rings of (x, y) to the nested form."""
    return [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in parts]


@pytest.fixture
def shapes(spark):
    rows = [
        ("square", polygon([SQUARE])),
        ("holed", polygon([SQUARE, HOLE])),
        ("diamond", polygon([DIAMOND])),
        ("elbow", polygon([ELBOW])),
        ("multi", polygon([SQUARE], [ISLAND])),
        ("empty", []),
        ("missing", None),
    ]
    return spark.createDataFrame(rows, f"code string, geom {G.GEOM_TYPE}")
