"""The replay stream keeps state by shard, and its query takes input of any number of files."""

import duckdb
import numpy as np
import pytest

from regloom.queries import ORACLES, QUERIES
from regloom.streaming import streams
from tests.compare import differences, views


def test_replay_of_events_in_seven_files(spark, tmp_path):
    """Micro-batches of a quarter of the files took a slice in three, and the last part of it came out as late."""
    (tmp_path / "events.parquet").mkdir()
    for i in range(7):
        duckdb.sql(f"COPY (SELECT * FROM '/root/testdata/sf0.001/events.parquet' WHERE event_id % 7 = {i}) TO '{tmp_path}/events.parquet/{i}.parquet'")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a partition for each file
    try:
        got = QUERIES["stream_replay"](spark, str(tmp_path)).toPandas()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert differences(got, views(str(tmp_path)).execute(ORACLES["stream_replay"]).df()) == ""


@pytest.mark.parametrize("cuts", [[0, 60], [0, 9, 30, 31, 60]])
def test_a_shard_of_keys_folds_each_in_order(cuts):
    r = np.random.default_rng(4)
    e = np.zeros(60, streams._EVENT)
    e["key"], e["ts"], e["ord"], e["kind"] = r.integers(5, size=60), np.sort(r.integers(30, size=60)), np.arange(60), r.integers(5, size=60)
    e["ord"][3] = streams._NONE
    s = np.empty(0, streams._SUM)
    for a, b in zip(cuts, cuts[1:], strict=False):
        part = e[a:b]
        s, _ = streams._applied(s, part[np.lexsort((part["kind"], part["ord"], part["ts"], part["key"]))])
    assert s["key"].tolist() == sorted(set(e["key"].tolist()))
    for row in s:
        own = sorted((int(x["ts"]), int(x["ord"]), int(x["kind"])) for x in e[e["key"] == row["key"]])
        last = lambda *codes: max((x[:2] for x in own if x[2] in codes), default=(streams._NONE,) * 2)
        created = min((x[:2] for x in own if x[2] == 1 and x[:2] > last(3)), default=(streams._NONE,) * 2)
        want = {"made": last(1), "waits": last(2), "gone": last(3), "created": created, "done": own[-1][:2]}
        assert {n: (int(row[f"{n}_ts"]), int(row[f"{n}_ord"])) for n in want} == want
        assert (row["n_reviews"], row["n_updates"]) == (sum(x[2] == 4 for x in own), sum(x[2] == 1 for x in own))
