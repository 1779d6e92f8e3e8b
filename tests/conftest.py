import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(
        4, "tests", **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "4"}
    )
    session.sparkContext.setCheckpointDir(folder)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ten_loans(spark):
    rows = [
        (1, 1000.0, 500.0, 5.0, "10+ years", 0),
        (2, 2000.0, None, 7.0, "< 1 year", 0),
        (3, 4000.0, 4000.0, 9.0, None, 1),
        (4, 5000.0, 10000.0, 11.0, "2 years", 1),
        (5, 8000.0, 2000.0, 13.0, "10+ years", 0),
        (6, 10000.0, 30000.0, 15.0, "2 years", 1),
        (7, 0.0, 100.0, 17.0, "< 1 year", 0),
        (8, None, 50.0, None, "2 years", 0),
        (9, 1000.0, 3000.0, 12.0, None, 1),
        (10, 20000.0, 1000.0, 99.0, "10+ years", 0),
    ]
    return spark.createDataFrame(
        rows,
        "loan_id bigint, funded_amnt double, max_bal_owed double, interest_rate double, emp_length string, y int",
    )


@pytest.fixture(scope="session")
def kept_loans(ten_loans):
    from riskloom.plans.prepare import clean_loans

    return clean_loans(ten_loans, zero_fill=["max_bal_owed"], drop=[])


@pytest.fixture(scope="session")
def eight_scores(spark):
    rows = [(1, 0.9), (1, 0.10), (1, 0.05), (0, 0.05), (0, 0.3), (0, 0.02), (0, 0.10), (1, 0.3)]
    return spark.createDataFrame(rows, "PD int, p double")
