"""A key holding a third of all rows never lands whole in one task.

Runs tests/skew_probe.py in its own Spark process (it needs its own event log
and AQE settings) and reads the largest number of shuffled records any single
task read, per operator.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

import pytest

PROBE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "skew_probe.py")


@pytest.fixture(scope="module")
def probe():
    scratch = tempfile.mkdtemp(prefix="strata-skew-")
    out = subprocess.run([sys.executable, PROBE, scratch], capture_output=True, text=True, timeout=900, check=True)
    return json.loads(out.stdout.strip().splitlines()[-1])


@pytest.mark.parametrize(
    "operator",
    [
        "dedupe_latest",
        "daily_country_sales",
        "quality_profile",
        "duplicate_keys",
        "multiset_difference",
        "fact_join",
        "partitioned_write",
    ],
)
def test_hot_key_is_split_or_pre_aggregated(probe, operator):
    result = probe[operator]
    assert 0 < result["max_task_shuffle_records"] < result["hot_rows"] / 2, result
