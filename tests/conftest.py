import os
import sys

import pytest

from paths import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from loanlab.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8,
                    extra={"spark.driver.memory": os.environ.get("LOANLAB_DRIVER_MEMORY", "6g")})
    yield s
    s.stop()
