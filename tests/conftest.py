import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from taxoweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, name="tests")
    yield session
    session.stop()


TAXONOMY = [
    (1, "IT", "Software", "Apps", "CRM Tools", "IT > Software > Apps > CRM Tools", ""),
    (2, "IT", "Software", "Apps", "Payroll", "IT > Software > Apps > Payroll", "contractor pay goes to people"),
    (3, "IT", "Cloud", "Hosting", "Compute", "IT > Cloud > Hosting > Compute", ""),
    (4, "People", "Staff", "Temps", "IT Contractors", "People > Staff > Temps > IT Contractors", " "),
    (5, "People", "Staff", "Wear", "Uniforms", "People > Staff > Wear > Uniforms", ""),
    (6, "Estate", "Safety", "Air", "Asbestos Survey", "Estate > Safety > Air > Asbestos Survey", ""),
    (7, "Estate", "Safety", "HR", "Gas", "Estate > Safety > HR > Gas", ""),
]


@pytest.fixture(scope="session")
def taxonomy(spark):
    from taxoweave.schemas import TAXONOMY as SCHEMA

    return spark.createDataFrame(TAXONOMY, SCHEMA)
