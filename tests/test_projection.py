"""The projection plan against a plain fold of the rows in order, table cells, and repaired names."""

import random
import unicodedata

from pyspark.sql import functions as F

from regloom.functions import catalogue
from regloom.functions import text as tx
from regloom.operators import cells
from regloom.operators.projection import Producer, plan

RANKS = {"live": 4, "future": 3, "gone": 2}


def folded(rows):
    """Rows (sheet, key, day, status, name, note) in order of arrival: winners and conflicts as the plan states them."""
    won, conflicts = {}, set()
    for sheet, key, day, status, name, note in rows:
        if sheet is None or not key.strip():
            continue
        k, rank = (sheet, key.strip()), RANKS.get(status, 0)
        new = (day or "", rank)
        if k not in won or new > won[k][0]:
            won[k] = (new, status or "", name, note)
        elif new == won[k][0] and (status or "", name) != won[k][1:3]:
            conflicts.add((*k, status or "", name))
    return {(*k, w[0][0], *w[1:]) for k, w in won.items()}, conflicts


def test_plan_equals_a_fold_in_order(spark):
    r = random.Random(4)
    days, status, sheets = ["2024-01-01", "2024-02-01", None], ["live", "future", "gone", "odd", None], ["commune", "city", None]
    sources = [[(i, r.choice(sheets), r.choice(["1", "2", " 3", "4", ""]), r.choice(days), r.choice(status), r.choice("ab"), r.choice("xy")) for i in range(60)] for _ in range(3)]
    kind = "i int, sheet string, k string, day string, status string, name string, note string"
    c = F.col
    producers = [
        Producer(spark.createDataFrame(rows, kind), c("sheet"), c("k"), c("day"), c("status"), F.lpad(c("i").cast("string"), 5, "0"), {"name": c("name"), "note": c("note")}, {"sparse": c("note") == "y", "only:unclassified": F.lit(True)}, F.lit("commune"))
        for rows in sources
    ]
    out = [x.asDict() for x in plan(producers, RANKS, ["name"]).collect()]
    arrived = [x[1:] for rows in sources for x in rows]
    winners, conflicts = folded(arrived)
    assert {(x["sheet"], x["key"], x["day"], x["status"], x["name"], x["note"]) for x in out if x["sheet"] != "review"} == winners
    assert len([x for x in out if x["sheet"] != "review"]) == len(winners)
    queue = [x for x in out if x["sheet"] == "review"]
    assert {(x["of"], x["key"], x["status"], x["name"]) for x in queue if x["reason"] == "same_date_material_conflict"} == conflicts
    count = lambda reason: sum(x["n"] for x in queue if x["reason"] == reason)
    assert count("missing_code") == sum(s is not None and not k for s, k, *_ in arrived)
    assert count("sparse") == sum(s is not None and n == "y" for s, *_, n in arrived)
    assert count("unclassified") == sum(s is None for s, *_ in arrived)
    assert sum(x["n"] for x in out if x["sheet"] != "review") == sum(s is not None and bool(k) for s, k, *_ in arrived)


def test_process_and_dossier_cells(spark):
    head = ["Cách thức  thực hiện", "Hình thức nộp", "Thời hạn", "Lệ phí"]
    late = [["x"]] * 6 + [head, ["a", "b", "c", "d"]]
    tables = [None, [["a", "b"], None], late, [[None], head, ["Trực tuyến", "Nộp", "5 ngày"], None, ["", "", ""], ["Bưu chính", "", " 3  ngày ", "2.000"]], [head, ["z", "z", "z", "z"]]]
    papers = [[["Thành phần hồ sơ", "Bản chính", "Bản sao", "Số lượng"], ["Đơn", "", "3", "Bản chính: 2; BẢN SAO : 9"], ["ĐƠN ", "9", "9", ""], ["Loại giấy tờ", "", "", ""]], [["Loại giấy tờ", "Tờ khai"], ["Đơn", "mẫu"], ["đơn"]]]
    kind = "t array<array<array<string>>>"
    p = spark.createDataFrame([(tables,), (None,), ([],)], kind).select(cells.process(F.col("t")).alias("p")).collect()
    assert [tuple(x) for x in p[0]["p"]["times"]] == [("Trực tuyến", "5 ngày", None), ("Bưu chính", "3 ngày", None)]
    assert [x["fee"] for x in p[0]["p"]["fees"]] == ["2.000"] and [len(x["p"]["times"]) + len(x["p"]["fees"]) for x in p[1:]] == [0, 0]
    d = spark.createDataFrame([(papers,), (None,)], kind).select(cells.dossier(F.col("t")).alias("d")).collect()
    assert [tuple(x) for x in d[0]["d"]] == [("Đơn", None, "2", "3", "Bản chính: 2; BẢN SAO : 9"), ("Đơn", "mẫu", None, None, None)] and d[1]["d"] == []


def test_names_are_repaired_in_order(spark):
    names = ["Th ủ tục c ấp  phép", "\x07\x07 Tên \x07 khác", "\x07 \x07", None, "Cấp giấy phép - Thời hạn 5 ngày", "Cấp - Thời hạn 5", unicodedata.normalize("NFD", "Cấp phép;"), "ab"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i")
    pairs = [("c ấp", "cấp"), ("Th ủ", "Thủ"), ("Thủ tục cấp", "X"), ("ab", "bb"), ("bb", "c")]
    over = F.create_map(F.lit("7"), F.lit("own"))
    assert [r[0] for r in df.select(tx.repaired_name(F.col("n"), F.lit("1"), pairs, catalogue.NAME_BLEED)).collect()] == ["X phép", "Tên", "", "", "Cấp giấy phép", "Cấp - Thời hạn 5", "Cấp phép", "c"]
    assert [r[0] for r in df.select(tx.repaired_name(F.col("n"), F.col("i").cast("string"), pairs, catalogue.NAME_BLEED, over)).collect()][-1] == "own"
    other = [("bb", "c"), ("ab", "bb")]
    assert df.where("i = 7").select(tx.replaced_in_order(F.col("n"), other)).first()[0] == "bb"
    many = [(f"w{i}x", f"v{i}") for i in range(300)]
    assert df.where("i = 7").select(tx.replaced_in_order(F.lit("w7x w299x"), many)).first()[0] == "v7 v299"
    titles = [("Ch ứng chỉ tr ạm", "Chứng chỉ trạm", None), ("\x07Tên\x07", "Tên", None), ("\x07 \x07", None, "only_control"), ("a\x02", None, "control_character"), (None, None, None)]
    t = spark.createDataFrame([(i, x) for i, (x, _, _) in enumerate(titles)], "i int, x string").orderBy("i").select(tx.cleaned_title(F.col("x"), catalogue.TITLE_WORDS).alias("t")).collect()
    assert [tuple(r["t"]) for r in t] == [(a, b) for _, a, b in titles]
