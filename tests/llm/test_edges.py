"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from regloom.llm import chat, mixing, ngram_join, packing, pii, quality, sharding, suffix_dedup, topk, toxicity
from regloom.llm.graph import components
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, slot string, sig string, target string, label string, h string, kind string"
EXTRA = ("e",) * 7


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    base = words(1, 120)
    rows = [
        (1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 3), (4, base, "en", "a", 1), (5, base, "en", "a", 1),
        (5, base, "en", "a", 1), (6, base + " tail of words", None, None, 1), (None, base, "en", "a", 1), (7, "a" * 60_000, "en", "b", 1),
        (8, words(2, 20_000), "en", "b", 1), (9, "a@b.c_d@e.f 1.2.3.4.5.6.7.8 +1 (499) 555-6503 4111 1111 1111 1111 " + "x.y@" * 3000, "en", "b", 1),
        (10, "é" * 70 + "😀" * 20, "fr", "b", 1), (11, "one two three", "en", "b", 1), (12, "ONE Two  three", "en", "b", 1), (13, "." * 5000 + "a" + ".b" * 9000 + "@c" + ".d" * 9000, "en", "c", 1),
    ]
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def unique(odd):
    return {r["doc_id"]: r["text"] for r in odd.select("doc_id", "text").collect() if r["doc_id"] is not None}


def test_near_duplicates(odd, none):
    got = by_id(ngram_join.near_duplicates(odd))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == brute.near_components(unique(odd))
    assert ngram_join.near_duplicates(none).count() == 0


@pytest.mark.parametrize("bucket_bytes", [ngram_join.BUCKET_BYTES, 4000])
def test_near_duplicates_of_many_sizes(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr(ngram_join, "BUCKET_BYTES", bucket_bytes)
    r = random.Random(5)
    texts, n = {}, 0
    for size in (1, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 33, 60, 100, 150):
        for _ in range(4):
            w = words(r.random(), size).split()
            for k in range(5):
                v = list(w)
                for _ in range(r.randint(0, max(1, size // 12))):
                    at = r.randrange(len(v))
                    v[at : at + r.randint(0, 1)] = [words(r.random(), 1)] * r.randint(0, 1)
                texts[n] = " ".join(v)
                n += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    got = by_id(ngram_join.near_duplicates(df))
    assert {d: (x["n_shingles"], x["component_id"]) for d, x in got.items()} == brute.near_components(texts)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 101), (7, 7)]
    random.Random(1).shuffle(chain)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 61)) and {got[i] for i in (100, 101, 103)} == {100}


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_repeats_by_batches(spark, batches):
    r = random.Random(batches)
    passages = [words(i, 14) for i in range(6)]
    texts = {}
    for d in range(80):
        parts = [words(1000 + d * 7 + i, r.randint(0, 12)) for i in range(4)]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 25)
            parts.insert(r.randint(0, 4), p[a : a + r.randint(30, 90)])
        texts[d] = " ".join(parts)
    texts[33] = texts[12]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = suffix_dedup.remove_repeats(df, batches=batches).withColumn("sha", F.sha2("kept", 256))
    want = brute.removed_rows(texts)
    assert {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["sha"]) for x in got.collect()} == want


def test_family_levels_merge_geometrically(spark):
    family = suffix_dedup.SuffixFamily(4)
    sizes = []
    for i in range(5):
        family.absorb(spark.createDataFrame([(i, bytearray(words(i, 60).encode()))], "doc_id long, body binary"))
        sizes.append([n for n, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]


def test_repeats_edges(odd, none):
    got = suffix_dedup.remove_repeats(odd).collect()
    want = brute.removed_rows(unique(odd))
    assert len(got) == odd.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == want[r["doc_id"]][:3]
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_pii_edges(odd, none):
    model = pii.fit(odd)
    for r in pii.report(odd, model).collect():
        if r["doc_id"] is not None:
            assert tuple(r)[1:6] == brute.pii_row(unique(odd)[r["doc_id"]]), r["doc_id"]
    assert pii.report(none, pii.fit(none)).count() == 0
    kept = pii.redact(odd, model)
    assert kept.columns == odd.columns and kept.where("doc_id = 9").first()["text"].startswith("[EMAIL]")
    assert kept.where("doc_id = 4").first()["text"] == unique(odd)[4]


def test_pii_adds_calibrated_spans(spark):
    v = spark.createDataFrame([(1, "call 555 123 4567 now or a (at) b.com")], "doc_id long, text string")
    everything = pii.SpanModel(lambda f: F.lit(1.0), (0.5,) * 4)
    spans = pii.report(v, everything).first()["spans"].split(",")
    assert "email:25:37" in spans and any(s.startswith("phone:5:") for s in spans)


def test_pii_fit_finds_rewritten_forms(spark):
    r = random.Random(5)

    def card(good):
        d = [4, *[r.randrange(10) for _ in range(14)]]
        last = -sum(sum(divmod(2 * x, 10)) if i % 2 == 0 else x for i, x in enumerate(d)) % 10
        t = "".join(map(str, [*d, last if good else (last + 1) % 10]))
        return [t[i : i + 4] for i in range(0, 16, 4)]

    number = lambda n: str(r.randrange(10 ** (n - 1), 10**n))
    name = lambda: "".join(r.choices("abcdefgh", k=6))
    octets = lambda: [str(r.randrange(1, 256)) for _ in range(4)]
    plain = {
        "email": lambda: f"{name()}@{name()}.com", "ip": lambda: ".".join(octets()), "card": lambda: "".join(card(True)),
        "phone": lambda: f"+1 ({number(3)}) {number(3)}-{number(4)}",
    }
    rewritten = {
        "email": lambda: f"{name()} (at) {name()} [dot] com", "ip": lambda: ":".join(octets()), "card": lambda: r.choice("./").join(card(True)),
        "phone": lambda: r.choice([f"0049 {number(2)} {number(7)}", f"({number(3)}) {number(3)}-{number(4)}"]),
    }
    decoys = {"ip": lambda: f"{r.randrange(300, 999)}:{number(3)}:{number(3)}:{number(3)}", "card": lambda: "/".join(card(False)), "phone": lambda: f"20{number(2)}-{r.randrange(10, 13)}-{r.randrange(10, 29)} 10"}
    rows, told = [], {}
    for form, share in ((plain, 250), (rewritten, 60), (decoys, 60)):
        for kind, make in form.items():
            for _ in range(share):
                v, before = make(), words(r.random(), 3) + " "
                rows.append((len(rows), f"{before}{v} {words(r.random(), 2)}"))
                told[len(rows) - 1] = (form, kind, f"{kind}:{len(before)}:{len(before) + len(v)}")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs)
    assert max(model.thresholds) <= 1
    found = {x["doc_id"]: x["spans"].split(",") for x in pii.report(docs, model).collect()}
    for form, wanted in ((plain, True), (rewritten, True), (decoys, False)):
        for kind in form:
            hits = [span in found[d] for d, (f, k, span) in told.items() if f is form and k == kind]
            assert (sum(hits) >= 0.95 * len(hits)) if wanted else (sum(hits) <= 0.05 * len(hits)), (kind, wanted, sum(hits))


def test_redact_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "to a@b.com", 1, "s", "w", "f"), (2, None, 2, "s", "w", "f")], "doc_id long, text string, base int, spans string, wide string, k string")
    got = sorted(map(tuple, pii.redact(df, pii.SpanModel(None, (2.0,) * 4)).collect()))
    assert got == [(1, "to [EMAIL]", 1, "s", "w", "f"), (2, None, 2, "s", "w", "f")]


def test_quality_of_singular_groups(spark):
    """Two texts, many copies each, lie on a line; a null source is no name of its language."""
    a, b = words(1, 80), words(2, 300) + " " + words(3, 10)
    rows = [(i, (a, b)[i % 2], "en", "s") for i in range(240)]
    rows += [(1000 + i, words(i, 60 + i), "en", None) for i in range(80)] + [(2000 + i, words(i, 50 + i % 9), None, None) for i in range(70)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == len(rows) and all(r["distance"] is None or 0 <= r["distance"] < 1e9 for r in got)
    assert all(r["kept"] for r in got if r["doc_id"] < 1000 and not r["base_failed"])


def test_minimum_determinant(spark):
    """The estimate's determinant is as small as the best of many random starts of a plain version, give or take little."""
    import numpy as np

    g = np.random.default_rng(4)
    x = g.multivariate_normal(np.zeros(5), np.diag([4, 1, 1, 2, 3]) + 0.5, 400)
    x[:60] = g.normal(9, 0.3, (60, 5))
    rows = spark.createDataFrame([("a", *map(float, v)) for v in x], "g string, x0 double, x1 double, x2 double, x3 double, x4 double")
    found = quality.robust_estimates(rows).first()
    h, best = 300, np.inf
    for _ in range(60):
        at = g.choice(len(x), 6, replace=False)
        m, c = x[at].mean(0), np.cov(x[at].T, bias=True) + 1e-6 * np.eye(5)
        for _ in range(15):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            near = x[np.argsort(d)[:h]]
            m, c = near.mean(0), np.cov(near.T, bias=True)
        best = min(best, np.linalg.slogdet(c)[1])
    assert found["det"] <= best + 0.1
    assert np.abs([found[f"m{i}"] for i in range(5)]).max() < 0.6  # the outliers do not pull it


def test_quality_edges(odd, none):
    got = quality.judge(odd)
    assert got.count() == odd.count()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in got.collect():
        if r["doc_id"] is not None:
            assert tuple(r[n] for n in names) == brute.quality_row(unique(odd)[r["doc_id"]])
    assert quality.judge(none).count() == 0


def test_toxicity_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.fit(odd, labels)).count() == odd.count()
    assert toxicity.fit(none, labels.where("doc_id < 0")) is None
    machine = toxicity.Machine(*toxicity.train_words(["idiot", "idiots", "moron", "morons"], [words(i, 1) for i in range(60)]), [0.0, 3.0, 0.0, 0.0, 0.0])
    near, far = machine.margins(["id-iot", "idiiot", "moroon"]), machine.margins(["table", "window", ""])
    assert near.min() > far.max()
    assert machine.scores(["you i d i o t"])[0] > machine.scores(["you all"])[0]
    assert toxicity.score(none, machine).count() == 0 and toxicity.score(odd, machine).count() == odd.count()
    assert toxicity.keep_clean(odd, machine).columns == odd.columns


def test_kernel_against_all_subsequences():
    said = ["idiot", "idiiot", "xx", "moron", "window", "a"]
    k = toxicity.kernel(said, said)
    for i, a in enumerate(said):
        for j, b in enumerate(said):
            assert abs(k[i, j] - brute.subsequence_kernel(a, b, toxicity.DECAY, toxicity.REACH)) < 1e-5


def test_long_words_and_all_scripts_count():
    assert toxicity.kernel(["z" * 60 + "idiot"], ["idiot"])[0, 0] > 0.3  # beyond the first piece
    codes, n = toxicity.encoded(["愚か者", "바보", "!?"])
    assert n.tolist() == [5, 4, 2] and (codes > 0).all()


def test_packing_maps_special_tokens(spark):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|", "<|endof<|endoftext|>text|>\n\n <|endoftext|>"):
        got = packing.tokenized_pieces(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        ids = [*t.encode(text, add_special_tokens=False).ids, 0]
        assert (got["length"], got["ids_crc32"]) == (len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))


def test_packing_edges(odd, none):
    got = packing.pack_documents(odd).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in odd.select("doc_id").collect()}
    assert [r["length"] for r in got if r["doc_id"] in (1, 2)] == [1, 1]
    assert packing.pack_documents(none).count() == 0


def test_plan_uses_gaps():
    from collections import Counter

    r = random.Random(3)
    for sizes in ([r.randint(1, 100) for _ in range(999)], [700] * 7, [34] * 100 + [60] * 9, [100] * 5, [51] * 4 + [49] * 4):
        p = packing.plan(dict(Counter(min(s, 100) for s in sizes)), 100)
        total = sum(min(s, 100) for s in sizes)
        assert int(p["sequences"]) >= -(-total // 100)
        if len(sizes) > 900:
            # sizes above half need a sequence each, so the bound is not the total alone
            assert int(p["sequences"]) <= 1.02 * max(total / 100, sum(min(s, 100) > 50 for s in sizes)) + 1


def test_sharding_edges(odd, none):
    got = sharding.shard_documents(odd).collect()
    assert len(got) == odd.count()
    assert sorted(r["slot"] for r in got if r["shard"] == got[0]["shard"]) == list(range(sum(r["shard"] == got[0]["shard"] for r in got)))
    assert len({r["shard"] for r in got if r["doc_id"] in (4, 5, None)}) == 1
    assert sharding.shard_documents(none).count() == 0


def test_smallest_capacity_is_exact(spark):
    r = random.Random(2)
    texts = [(i, words(i, r.randint(1, 40))) for i in range(300)] + [(1000 + i, words(5, 30)) for i in range(200)]
    got = sharding.shard_documents(spark.createDataFrame(texts, "doc_id long, text string"), 7).collect()
    import hashlib

    order = {}
    for d, t in texts:
        order[hashlib.md5(t.encode()).hexdigest()] = order.get(hashlib.md5(t.encode()).hexdigest(), 0) + len(t.encode()) + 1
    sizes = [order[k] for k in sorted(order)]

    def shards(c):
        n, at = 1, 0
        for s in sizes:
            n, at = (n + 1, s) if at + s > c else (n, at + s)
        return n

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if shards(c) <= 7)
    per = {}
    for x in got:
        per[x["shard"]] = per.get(x["shard"], 0) + x["size"]
    assert max(per.values()) <= best


def test_mixing_edges(odd, none):
    got = mixing.mix(odd)
    assert got.count() == odd.count() and got.where("taken > 2 * size OR taken < 0").count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    rows = mixing.mixed_documents(odd)
    n = rows.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    taken = got.agg(F.sum("taken")).first()[0]
    longest = got.groupBy("source_size").agg(F.max("size").alias("n")).agg(F.sum("n")).first()[0]
    assert abs(n - taken) <= longest and rows.columns == odd.columns
    assert rows.join(odd, ["doc_id", "text"], "left_anti").where("doc_id IS NOT NULL").count() == 0


def test_chat_edges(spark):
    said = ["", None, "\\", "<\\s>", "<s>", "a</s>", "[/INST]", "<<s>", "\\[INST]", "[/INST", "😀<"]
    rows = [(1, i, ["user", "assistant", "assistant", None][i % 4], s) for i, s in enumerate(said)] + [(None, None, "user", "x"), (2, 0, "a</s>b", "t"), (2, 0, "a</s>b", "t")]
    f = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    back = {r["conv_id"]: [(x["role"], x["text"]) for x in r["t"]] for r in f.select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}
    assert back[1] == [(["user", "assistant", "assistant", ""][i % 4], s or "") for i, s in enumerate(said)]
    assert back[2] == [("a</s>b", "t")] * 2 and back[None] == [("user", "x")]
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_topk_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (50, [0.5]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (5, [1.0, 2.0]), (None, [1.0]), (100, [float("inf"), 0.0]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in topk.top_k(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 4), (0, 2, 5), (0, 3, 50), (0, 4, 6), (50, 1, 0), (50, 2, 4), (50, 3, 5), (50, 4, 6)]
    assert topk.top_k(df.where("vec_id < 0")).count() == 0


def test_topk_of_repeated_rows(spark):
    """More equal rows of one id than places."""
    rows = [(0, [1.0])] + [(4, [9.0])] * 7 + [(i, [float(i)]) for i in (1, 2, 3, 5)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [4, 5, 3, 2, 1]


def test_mtree_skips_by_stored_distances():
    import numpy as np

    r = np.random.default_rng(0)
    x = np.concatenate([r.normal(c, 2, (400, 3)) for c in r.uniform(-300, 300, (20, 3))]).round()
    tree = topk.MTree(x, page=32)
    ids = np.arange(len(x))
    got = tree.search(x[:40], 5, ids, ids[:40])
    for i, found in enumerate(got):
        s = sorted((-float(x[i] @ v), j) for j, v in enumerate(x) if j != i)[:5]
        assert found == [(int(-a), j) for a, j in s]
    assert tree.computed < 0.5 * 40 * len(x)


def test_pipeline_on_odd_tables(spark, odd, none):
    """Nulls, ties, repeated ids and rows, clashing names, and no rows at all."""
    sf = "/root/testdata/sf0.001"
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stage(spark, docs, sf)
            assert docs.columns == columns, name
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()


def test_groups_keep_different_texts_of_one_id(spark):
    a, b, c = words(1, 40), words(2, 40), words(3, 40)
    rows = [(1, a), (1, b), (1, b), (2, a), (3, c), (None, a), (4, None), (5, "")]
    got = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, a), (1, b), (3, c), (None, a), (4, None), (5, "")], key=str)


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name == "near_duplicates":
            assert docs.count() <= before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
