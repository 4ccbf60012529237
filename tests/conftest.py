import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from credlake.session import get_spark
    s = get_spark(app="credlake-tests", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder per test (never reused)."""
    return tempfile.mkdtemp(prefix="credlake-test-")


# FIXED VALUE: the published sample of an extracted-document payload
# (one pretty-printed JSON object per file), key order as written.
SAMPLE_DOCUMENT = """{
    "SK_ID_CURR": "999999",
    "TARGET": 0,
    "NAME_CONTRACT_TYPE": "Cash loans",
    "CODE_GENDER": "M",
    "AMT_CREDIT": 15000.0,
    "AMT_INCOME_TOTAL": 1130.63,
    "AMT_ANNUITY": 850.0,
    "DAYS_EMPLOYED": -1200,
    "NAME_EDUCATION_TYPE": "Higher education",
    "NAME_FAMILY_STATUS": "Married",
    "CNT_CHILDREN": 1,
    "IDP_METADATA": {
        "document_type": "Boleta_Pago_Fisica",
        "confidence_score": 85.5
    }
}"""
