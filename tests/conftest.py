import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("cohortlens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cohortlens-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def five_groups(spark):
    """3,000 rows in five separated normal groups (means / spreads / shares of the original
    generator's five segments): age, income, spending + the true segment."""
    import numpy as np

    rng = np.random.default_rng(42)
    spec = [  # (share, age mean, age sd, income mean, income sd, spending mean, spending sd)
        (0.20, 25, 3, 300000, 50000, 80, 6),
        (0.22, 40, 4, 500000, 60000, 45, 6),
        (0.20, 55, 4, 1200000, 100000, 20, 5),
        (0.18, 30, 3, 1300000, 100000, 85, 5),
        (0.20, 62, 3, 250000, 40000, 30, 5),
    ]
    rows, cid = [], 1
    for seg, (share, am, asd, im, isd, sm, ssd) in enumerate(spec):
        for _ in range(int(3000 * share)):
            rows.append((cid, "Female" if rng.random() < 0.5 else "Male", float(rng.normal(am, asd)),
                         float(rng.normal(im, isd)), float(rng.normal(sm, ssd)), f"S{seg}"))
            cid += 1
    return spark.createDataFrame(rows, "id long, gender string, age double, income double, spending double, truth string")
