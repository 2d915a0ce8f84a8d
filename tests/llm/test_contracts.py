"""The numbered queries on the small driver tables against plain Python versions of their contracts."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from regloom.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def run(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF).collect()]


def test_op1_pieces_and_places(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in run(spark, "op1_best_fit_packing"):
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(texts)
    total = 0
    for doc, text in texts.items():
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        total += len(ids)
        own = sorted(pieces[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]]
        assert sum(r["length"] for r in own) == len(ids) and all(r["length"] == 2048 for r in own[1:])
        assert all(zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in own)
    sequences = defaultdict(list)
    for own in pieces.values():
        for r in own:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 1


def test_op2_components(spark, texts):
    want = brute.near_components(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, "op2_ngram_join")} == want


def test_op3_base_statistics_and_verdicts(spark, texts):
    found = run(spark, "op3_quality_rules")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in found} == {d: brute.quality_row(t) for d, t in texts.items()}
    assert not any(r["kept"] for r in found if r["base_failed"])
    good = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    judged = [(r["kept"], good[r["doc_id"]]) for r in found if not r["base_failed"] and r["doc_id"] in good]
    assert np.mean([k == bool(q) for k, q in judged]) > 0.9


def test_op4_held_out(spark):
    found = {r["doc_id"]: r for r in run(spark, "op4_toxicity")}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    wrong = [d for d, y in toxic.items() if y == 0 and found[d]["predicted"]]
    assert len(wrong) <= 0.05 * len(toxic)


def test_op4_finds_held_out_toxic_documents(spark):
    """On the largest table, whose held-out fold has a hundred toxic texts: four fifths found at least, few clean ones hit."""
    larger = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r["predicted"] for r in QUERIES["op4_toxicity"](spark, larger).where("held_out").collect()}
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{larger}/labels.parquet'").fetchall())
    told = [(toxic[d], p) for d, p in found.items() if toxic.get(d) is not None]
    assert np.mean([p for y, p in told if y == 1]) >= 0.8
    assert np.mean([p for y, p in told if y == 0]) <= 0.02


def test_op5_removed_bytes(spark, texts):
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in run(spark, "op5_suffix_dedup")} == brute.removed_rows(texts)


def test_op6_round_trip(spark):
    turns = defaultdict(list)
    for c, t, role, text in duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall():
        turns[c].append((t, role, text or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    found = {r["conv_id"]: r for r in run(spark, "op6_chat_formatting")}
    assert set(found) == set(turns)
    for c, rows in turns.items():
        rows = sorted(rows)
        loss = "".join(x for _, r, x in rows if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, r, x in rows)
        f = found[c]
        assert (f["n_turns"], f["turns_sha256"]) == (len(rows), hashlib.sha256(whole.encode()).hexdigest())
        assert (f["loss_chars"], f["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_op7_shards(spark, texts):
    found = run(spark, "op7_sharding")
    shards, home = defaultdict(list), {}
    for r in found:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (len(text.encode()) + 1, brute.crc(text))
        assert home.setdefault(text, r["shard"]) == r["shard"]
        shards[r["shard"]].append(r)
    assert set(shards) <= set(range(16)) and all(sorted(x["slot"] for x in s) == list(range(len(s))) for s in shards.values())
    groups = defaultdict(int)
    for r in found:
        groups[texts[r["doc_id"]]] += r["size"]
    total = sum(groups.values())
    assert max(sum(x["size"] for x in s) for s in shards.values()) <= -(-total // 16) + max(groups.values())


def test_op8_base_spans(spark, texts):
    for r in run(spark, "op8_pii"):
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == brute.pii_row(texts[r["doc_id"]])
        assert set(filter(None, brute.told(brute.base_spans(texts[r["doc_id"]])).split(","))) <= set(r["spans"].split(","))


def test_op9_exact(spark):
    v = dict(duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall())
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in run(spark, "op9_top_k")}
    assert got == brute.topk(v, [i for i in v if i % 50 == 0])


def test_op10_targets(spark, texts):
    source = dict(duckdb.sql(f"SELECT doc_id, source FROM '{SF}/documents.parquet'").fetchall())
    size = {d: len(brute.WORDS.findall(t)) for d, t in texts.items()}
    per = defaultdict(int)
    for d, n in size.items():
        per[source[d]] += n
    names = sorted(per)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    goal, capped = 1.5 * sum(per.values()), set()
    while True:
        left = goal - sum(2 * per[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        over = [s for s in open_ if left * weight[s] / sum(weight[o] for o in open_) > 2 * per[s]]
        if not over:
            break
        capped |= set(over)
    target = {s: 2 * per[s] if s in capped else left * weight[s] / sum(weight[o] for o in open_) for s in names}
    found = run(spark, "op10_mixing")
    taken = defaultdict(int)
    for r in found:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], per[s]) and abs(r["target"] - target[s]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert sorted(map(str, found)) == sorted(map(str, run(spark, "op10_mixing")))
