import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def small_params():
    """Thresholds that the groups of the smallest folder reach."""
    from grouprank.params import Params
    return Params(min_rows=100, n_queries=50, lookup_min_rows=100, lookup_per_group=10)


@pytest.fixture(scope="session")
def spark():
    from grouprank.session import local_session
    s = local_session("*", shuffle_partitions=8, driver_memory="4g")
    yield s
