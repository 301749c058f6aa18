"""One writer per landed root."""

import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest

from tests.test_landing import T1, T2, cfg, frame
from tidemark import fs
from tidemark.plans.landing import land_table, land_tables
from tidemark.plans.lease import LeaseLostError, RootBusyError, RootLease


def test_numbers_rise_and_old_ones_go(spark, root):
    for n in range(1, 6):
        with RootLease(spark, root) as lease:
            assert lease.number == n and lease.held()
        assert not lease.held()
    names = {name for name, *_ in fs.children(spark, lease.folder)}
    assert len(names) <= 6 and "lease-000000000001" not in names and not any(n.endswith(".tmp") for n in names)


def test_a_live_lease_is_waited_for(spark, root):
    with RootLease(spark, root, seconds=30):
        with pytest.raises(RootBusyError):
            RootLease(spark, root, seconds=30, wait_seconds=0.3, poll_seconds=0.1).acquire()
    with RootLease(spark, root, seconds=30, wait_seconds=0) as second:
        assert second.number == 2


def test_a_silent_lease_is_taken_over_and_known_as_lost(spark, root, monkeypatch):
    monkeypatch.setattr(RootLease, "_renew", lambda self: None)
    dead = RootLease(spark, root, seconds=1).acquire()
    with RootLease(spark, root, seconds=1, wait_seconds=20, poll_seconds=0.2) as second:
        assert second.number == 2 and not dead.held()
        with pytest.raises(LeaseLostError):
            dead.check()
        dead.release()
        assert second.held()


def test_a_renewed_lease_outlives_its_seconds(spark, root):
    with RootLease(spark, root, seconds=1.5):
        with pytest.raises(RootBusyError):
            RootLease(spark, root, seconds=1.5, wait_seconds=4, poll_seconds=0.2).acquire()


def test_one_holder_at_a_time_among_many(spark, root):
    inside, most, numbers = [], [], []
    lock = threading.Lock()

    def work(_):
        with RootLease(spark, root, poll_seconds=0.02) as lease:
            with lock:
                inside.append(lease.number)
                most.append(len(inside))
                numbers.append(lease.number)
            time.sleep(0.02)
            with lock:
                inside.remove(lease.number)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(work, range(24)))
    assert max(most) == 1 and sorted(numbers) == list(range(1, 25))


def test_claims_have_one_winner(spark, root):
    for i in range(5):
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda k: fs.claim(spark, f"{root}/c{i}", f"owner{k}"), range(8)))
        assert sum(won) == 1 and os.listdir(f"{root}/c{i}") in (["_owner"], [".__owner.crc", "_owner"], ["_owner", ".__owner.crc"], ["._owner.crc", "_owner"], ["_owner", "._owner.crc"])
    assert not [n for n in os.listdir(root) if n.endswith(".tmp")]


def test_concurrent_landings_land_every_key_once(spark, root):
    def land(i):
        rows = [(str(k), f"run{i}") for k in range(i * 20, i * 20 + 60)]
        return land_table(spark, cfg(root, on_empty="skip"), T1 + timedelta(seconds=i), source=frame(spark, rows)).new_rows

    with ThreadPoolExecutor(4) as pool:
        new = list(pool.map(land, range(4)))
    keys = [r["k"] for r in spark.read.option("recursiveFileLookup", "true").parquet(root).select("k").collect()]
    assert sorted(keys, key=int) == [str(k) for k in range(120)] and sum(new) == 120


def test_a_landing_that_lost_its_lease_takes_its_run_back(spark, root, monkeypatch):
    land_table(spark, cfg(root), T1, source=frame(spark, [("1", "a")]))
    held = RootLease.held
    monkeypatch.setattr(RootLease, "held", lambda self: False)
    with pytest.raises(LeaseLostError):
        land_table(spark, cfg(root), T2, source=frame(spark, [("2", "b")]))
    monkeypatch.setattr(RootLease, "held", held)
    assert not os.path.exists(os.path.join(root, "2025/01/02"))
    assert land_table(spark, cfg(root), T2, source=frame(spark, [("2", "b")])).landed_rows == 1


def test_busy_roots_are_reported_and_leases_can_be_off(spark, root):
    with RootLease(spark, root):
        rows = land_tables(spark, [cfg(root, lease_wait_seconds=0.1, source=lambda s: frame(s, [("1", "a")]))], T1, max_attempts=2).collect()
        assert rows[0]["status"] == "FAILED" and rows[0]["attempts"] == 2 and "RootBusyError" in rows[0]["error"]
        assert land_table(spark, cfg(root, lease_seconds=0), T1, source=frame(spark, [("1", "a")])).new_rows == 1
    with pytest.raises(ValueError):
        cfg(root, lease_seconds=-1)
