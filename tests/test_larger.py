"""Queries against their SQL on small tables that hold what only larger ones show: ties, long keys, cut entities."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from regloom import published_queries, rule_queries, text_queries, validator_queries  # noqa: F401  these add their queries
from regloom.functions import catalogue, urls
from regloom.queries import ORACLES, QUERIES
from tests.compare import differences, views


@pytest.fixture
def agrees(spark, tmp_path):
    def run(name: str, **given: list[dict]) -> pd.DataFrame:
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        for table, rows in given.items():
            pd.DataFrame(rows).to_parquet(folder / f"{table}.parquet")
        got = QUERIES[name](spark, str(folder)).toPandas()
        assert differences(got, views(str(folder)).execute(ORACLES[name]).df()) == ""
        return got

    return run


def test_cells_of_one_height_keep_the_order_of_their_keys(agrees):
    cells = [{"c_custkey": k, "c_nationkey": 1, "c_acctbal": y} for k, y in ((4, 10.0), (2, 20.0), (3, 20.0), (1, 30.0))]
    one, other = agrees("cell_bounds", customer=cells), agrees("cell_bounds", customer=cells[::-1])
    assert differences(one, other) == ""
    assert [tuple(r) for r in one.sort_values("c_custkey")[["top", "bottom"]].to_numpy()] == [(88.0, 25.0), (25.0, 20.0), (20.0, 15.0), (15.0, -48.0)]


def test_decision_numbers_in_titles_have_five_digits_at_most(agrees):
    """A url may name a longer number."""
    keys = [(1, 99_999), (2, 99_999), (3, 100_000), (4, 100_000)]
    got = agrees("decision_identities", orders=[{"o_orderkey": o, "o_custkey": c} for o, c in keys])
    assert got.sort_values("o_orderkey")["number"].tolist() == ["99999/QĐ-UBND", "99999/QĐ-UBND", None, "100000/QĐ-UBND"]


def test_decisions_keep_numbers_of_any_length(spark, agrees):
    keys = [7, 99_999, 100_000, 899_999, 1_234_567, 9_876_543_210]
    got = agrees("decision_identities", orders=[{"o_orderkey": 2 * i + odd, "o_custkey": k} for i, k in enumerate(keys) for odd in (0, 1)])
    assert got.sort_values("o_orderkey")["number"].tolist() == [f"{k}/QĐ-UBND" for k in keys for _ in (0, 1)]
    titles = {"QUYẾT ĐỊNH số: 1234567 / QD-UBND": "1234567/QĐ-UBND", "12/QD-BNV, Quyết định 123456/QĐ-UBND": "123456/QĐ-UBND", "theo 12/QD-BNV": "12/QĐ-BNV", "Quyết định 12/2020": None, "": None, None: None}
    rows = spark.createDataFrame([(x,) for x in titles], "x string").select("x", catalogue.decision_identity(F.lit("https://x.vn/"), F.col("x"))["number"].alias("n")).collect()
    assert {r["x"]: r["n"] for r in rows} == titles


def test_entities_without_a_semicolon_are_read_as_in_browsers(agrees):
    html = "<title>a &amp b&amp</title><p>c &copy d &quot;e&quot f&amp;copy &middot</p><p>&am &quo</p>"
    agrees("html_blocks", pages=[{"page_id": i, "html": html} for i in (0, 1)])


def customers(n: int) -> list[dict]:
    return [{"c_custkey": k, "c_name": f"c{k}", "c_nationkey": k % 25, "c_acctbal": 1.0, "c_mktsegment": "BUILDING"} for k in range(n)]


@pytest.mark.parametrize("name", ["link_findings", "record_upgrade"])
def test_costly_rows_of_one_small_file_are_spread(spark, tmp_path, name):
    pd.DataFrame(customers(12_000)).to_parquet(tmp_path / "customer.parquet")
    assert QUERIES[name](spark, str(tmp_path)).rdd.getNumPartitions() == 3


def test_a_link_is_taken_apart_once(spark, tmp_path):
    pd.DataFrame(customers(10)).to_parquet(tmp_path / "customer.parquet")
    plan = QUERIES["link_findings"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("commune=([^&#]+)") in (1, 2)  # in what is ok and in the name of the route, which one row function shares


def test_parameters_of_urls(spark):
    cases = {"h?a=1&b=2": "1", "h?x=a=9&a=2": "2", "h?a=&a=3": "3", "h?ba=1": None, "h#?a=1": None, "h?b=1#&a=2": None, "h?b=1&&a=%20c&a=d": " c", "h?a=%zz": None, "a=1": None, "h?b?a=1": None, None: None}
    rows = spark.createDataFrame([(u,) for u in cases], "u string").select("u", urls.param(F.col("u"), "a").alias("v")).collect()
    assert {r["u"]: r["v"] for r in rows} == cases
