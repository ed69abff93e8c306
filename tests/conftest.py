import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from billow.session import build_session
    s = build_session("local[8]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def write_csv_file(path, header, rows):
    """Write one small raw CSV file the way a billing export looks."""
    import csv
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])
