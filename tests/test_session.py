"""The package travels to the executors once, also when fits run side by side."""
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from loanlab import session


def test_ship_from_threads_adds_one_archive():
    added, ready = [], threading.Barrier(4)

    def add(path):
        added.append(path)
        time.sleep(0.2)

    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app-of-test-ship", addPyFile=add))

    def one(_):
        ready.wait()
        session.ship(spark)

    with ThreadPoolExecutor(4) as ex:
        list(ex.map(one, range(4)))
    assert len(added) == 1
