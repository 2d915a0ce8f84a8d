"""Hard negatives, lexical search and the factorisation machine: plain versions, edge cases, held-out accuracy."""

import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from regloom.llm import factorisation, hard_negatives, lexical
from regloom.llm.queries import ORACLES, QUERIES
from tests.compare import differences, views
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_lexical_search"])
def test_queries_agree_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SF).toPandas(), views(SF).execute(ORACLES[name]).df()) == ""


# hard negatives


@pytest.mark.parametrize(("most", "width"), [(1, 3), (256, 64), (2**20, 64), (2**23, 300), (5, 2000), (2**14, 1100)])
def test_residue_scores_are_exact(most, width):
    rng = np.random.default_rng(most)
    a, b = rng.integers(-most, most + 1, (9, width)), rng.integers(-most, most + 1, (40, width))
    b[0], b[1] = a[0], -a[0]  # the ends of the range
    got = hard_negatives.scores(hard_negatives.Rows(a), hard_negatives.Rows(b), slice(0, 9), slice(0, 40))
    assert (got == a.astype(object) @ b.T.astype(object)).all()


def test_more_primes_for_larger_scores():
    assert [len(hard_negatives.primes_for(b)) for b in (0, 125, 126, 30_245, 30_246, 2**56)] == [1, 1, 2, 2, 3, 8]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, v long, a long, b long, positives string")


def mined(df, **more):
    return {tuple(r) for r in df.transform(lambda d: hard_negatives.hard_negatives(d, **more)).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


def test_hard_negatives_edges(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice((-1.0, 0.25, 0.5, 1.0)) for _ in range(3)], rng.randrange(3)) for i in range(-10, 70)]  # many ties
    rows += [(100, [1.0, 1.0], 0), (101, [1.0, 1.0, 1.0, 1.0], 1), (105, [], 0)]  # short, long and empty vectors
    bad = [(110, None, 0), (115, [1.0, None], 0), (120, [math.nan], 1), (125, [math.inf], 1), (130, [1.0], None), (None, [1.0], 0), (135, [2.0**27], 0)]
    twice = [rows[3], rows[3], (*rows[4][:2], 9)]  # a repeated row, and one that differs by a larger label
    whole = [(i, y, [math.floor(256 * x) for x in v] + [0] * (4 - len(v))) for i, v, y in rows]
    got = mined(vectors(spark, [(i, v, y, 7, 7, 7, "x") for i, v, y in [*rows, *bad, *twice]]), every=5)
    assert got == brute.hard_negatives(whole, every=5)
    assert mined(vectors(spark, [])) == set()
    assert mined(vectors(spark, [(0, [1.0], 1, 0, 0, 0, "")])) == set()


def test_hard_negatives_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK", 7)
    monkeypatch.setattr(hard_negatives, "_ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "_ROWS", 4)
    rng = random.Random(7)
    rows = [(i, [rng.randrange(-3, 4) / 4 for _ in range(4)], rng.randrange(2)) for i in range(90)]
    got = mined(vectors(spark, [(i, v, y, 0, 0, 0, "") for i, v, y in rows]), every=3)
    assert got == brute.hard_negatives([(i, y, [math.floor(256 * x) for x in v]) for i, v, y in rows], every=3)


# lexical search


def searched(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("key", "term", "b", "g", "score", "item")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({n: F.lit(1) for n in ("key", "term", "times")})
    return [tuple(r) for r in lexical.search(d, i, **more).orderBy("item_id", "rank").select("item_id", "rank", "doc_id", "score").collect()]


@pytest.mark.parametrize("more", [{}, {"most_sent": 0}, {"stages": 1}, {"stages": 7}, {"k": 3}])
def test_lexical_search_edges(spark, more, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 9)
    monkeypatch.setattr(lexical, "BUNDLE", 2)
    rng = random.Random(3)
    words = ["the", "THE", "of", "Öl", "öl", "a1", "x_y", "\U0001f600", "straße", "é", *(f"w{i}" for i in range(30))]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    docs += [(70, None), (71, ""), (72, " ?! \x00\x7f"), (3, docs[3][1]), (3, "the w1"), (73, "the " * 30_000), (None, "w1 the"), (75, docs[5][1]), (76, docs[5][1])]
    items = {1: "the OF öl w1 w1", 2: "", 4: None, 5: "w3,w4;w5 ~ nowhere", 6: "\U0001f600straße É é", 7: "x y a1 " * 50, None: "the w2"}
    got = searched(spark, docs, [*items.items(), (1, items[1])], **more)
    assert sorted(got, key=str) == sorted(brute.lexical(docs, items, more.get("k", 10)), key=str)


def test_lexical_search_of_nothing(spark):
    assert searched(spark, [], [(1, "a")]) == [] and searched(spark, [(1, "a")], []) == [] and searched(spark, [(1, None)], [(1, "a")]) == []


def test_terms():
    text = "Ab-c_dÄä[Z{z}9]/@:`~ x y"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == brute.terms(text)


def test_owners_hold_like_shares(spark):
    df = spark.range(1, 2000).select(F.col("id").cast("string").alias("term"), F.greatest(F.lit(1), F.floor(20_000 / F.col("id"))).alias("df"))
    held = lexical._owned(df, 20_000, 4).join(df, "term").groupBy("stage").agg(F.sum("df").alias("n"), F.min("w").alias("low"), F.max("w").alias("high")).orderBy("stage").collect()
    assert [r["stage"] for r in held] == [0, 1, 2, 3]
    assert max(r["n"] for r in held) < 0.5 * sum(r["n"] for r in held)
    assert all(a["low"] >= b["high"] for a, b in zip(held, held[1:]))


# the factorisation machine


def test_linear_time_equals_all_pairs():
    rng = np.random.default_rng(2)
    m = factorisation.Machine(0.3, rng.normal(size=40), rng.normal(size=(40, 5)))
    texts = [(np.sort(rng.choice(40, n, replace=False)), rng.normal(size=n)) for n in (1, 2, 7, 40)]
    got = m.logits(*factorisation._stacked(texts), len(texts))
    for (at, x), s in zip(texts, got, strict=True):
        pairs = sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i + 1, len(at)))
        assert abs(s - (0.3 + m.weights[at] @ x + pairs)) < 1e-9


def test_pairs_are_learnt():
    """Whether two of three features come together decides, so no linear score can tell the classes."""
    rng = np.random.default_rng(4)
    rows, y = [], []
    for _ in range(600):
        a, b = rng.integers(0, 2, 2)
        rows.append((np.array([a, 2 + b, 4]), np.ones(3)))
        y.append(float(a == b))
    m = factorisation.train(rows, np.array(y), passes=60)
    assert ((factorisation._chance(m.logits(*factorisation._stacked(rows), 600)) > 0.5) == np.array(y)).mean() == 1


def test_op13_held_out(spark):
    """On the largest table: of the held-out fold nearly all good texts are kept and nearly all bad ones rejected."""
    larger = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r for r in QUERIES["op13_factorisation_machine"](spark, larger).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    assert len(found) == duckdb.sql(f"SELECT count(*) FROM '{larger}/documents.parquet'").fetchall()[0][0]
    told = [(q, found[d]["predicted"]) for d, q in duckdb.sql(f"SELECT doc_id, quality FROM '{larger}/labels.parquet'").fetchall() if found[d]["held_out"]]
    assert np.mean([p for q, p in told if q == 1]) >= 0.99
    assert np.mean([1 - p for q, p in told if q == 0]) >= 0.95


def test_op13_edges(spark):
    docs = [(i, "a good text of words. " * (1 + i % 7) if i % 2 else "!!! ### " * (1 + i % 5), "x", 0.5) for i in range(60)]
    odd = [(100, None), (101, ""), (None, "a good text of words."), (1, docs[1][1]), (103, "\x00\x7f \U0001f600"), (104, "word " * 300_000)]
    kind = "doc_id long, text string, lang string, score double"
    d = spark.createDataFrame([*docs, *((i, t, None, None) for i, t in odd)], kind)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None), (100, 0), (999, 1)], "doc_id long, quality int")
    machine = factorisation.fit(d, labels)
    rows = factorisation.score(d, machine).collect()
    assert len(rows) == len(docs) + len(odd) and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in rows if r["doc_id"] in range(60)]) == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    assert factorisation.score(d.limit(0), machine).count() == 0
    assert factorisation.fit(d, labels.where("quality = 1")) is None and factorisation.fit(d.limit(0), labels) is None
    assert {r["predicted"] for r in factorisation.score(d, None).collect()} == {1}


def test_op13_reads_the_text_alone(spark):
    kind = "doc_id long, text string, lang string, source string"
    d = spark.createDataFrame([(i, "fine words here " * (1 + i % 3) if i % 2 else "@@@@ $$$$", "en", "s") for i in range(40)], kind)
    machine = factorisation.fit(d, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"))
    other = d.withColumns({"doc_id": F.col("doc_id") + 1000, "lang": F.lit(None), "source": F.lit("t")})
    pairs = [sorted(r["score"] for r in factorisation.score(x, machine).collect()) for x in (d, other)]
    assert pairs[0] == pairs[1]


def test_pii_thresholds_by_hand():
    """A kind with few candidates leans on the others; free candidates count for themselves; no size switches a kind off."""
    from regloom.llm import pii

    clean = [(0, False, 99, 500.0, 500)]
    assert pii.thresholds_of(clean) == (0.99,) * 4
    assert pii.thresholds_of([(0, False, 99, 1.0, 1)]) == (0.99,) * 4
    assert pii.thresholds_of([]) == (2.0,) * 4
    # three good ones of one kind at a lower score: taken, as all kinds are good there
    assert pii.thresholds_of([*clean, (2, True, 60, 3.0, 3)]) == (0.6,) * 4
    # one bad one among few: no kind takes scores below its own
    assert pii.thresholds_of([*clean, (2, True, 60, 2.0, 3)])[2] == 0.99
    # a bad kind stays out wherever its scores lie, the others stay in
    assert pii.thresholds_of([*clean, (3, False, 99, 0.0, 50), (3, True, 99, 0.0, 2)])[3] == 2.0


def test_pii_of_few_documents(spark):
    """With a handful of candidates of a kind rewritten forms are found, and a bare run of digits is no phone."""
    from regloom.llm import pii

    plain = [(i, f"write to a{i}@b{i}.com or call +1 (555) 123-45{i % 10}{i // 10 % 10} from 10.0.{i}.1") for i in range(60)]
    odd = [(100 + i, f"number {54994038693460 + i:016d} stands here") for i in range(5)]
    told = [(200 + i, f"please phone 0049 30 12345{i}{i} soon") for i in range(5)]
    docs = spark.createDataFrame([*plain, *odd, *told], "doc_id long, text string")
    model = pii.fit(docs)
    spans = {r["doc_id"]: r["spans"] for r in pii.report(docs, model).collect()}
    base = {r["doc_id"]: r["spans"] for r in pii.report(docs, pii.SpanModel(None, (2.0,) * 4)).collect()}
    assert all(spans[d] == base[d] for d, _ in [*plain, *odd])
    assert all(spans[d] == f"phone:13:{13 + len('0049 30 1234500')}" for d, _ in told)
