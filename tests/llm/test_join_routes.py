"""Where the near-duplicate join sends what segments and documents tell each other."""

import random

import numpy as np
import pandas as pd
import pytest

from regloom.llm import ngram_join as nj
from tests.llm import brute

BUCKETS, SEGMENTS, DOCS = 64, 200, 5


def dealt(blocks: pd.DataFrame, step) -> pd.DataFrame:
    return pd.concat([step(b) for _, b in blocks.groupby("bucket")], ignore_index=True)


def asked() -> pd.DataFrame:
    """Sets that differ in labels and meet in many segments, all of them with the smallest one."""
    k = np.zeros(SEGMENTS * DOCS, dtype=nj.KNOWN)
    k["sig"], k["doc"] = np.repeat(np.arange(SEGMENTS), DOCS), np.tile(np.arange(DOCS), SEGMENTS)
    k["label"], k["size"], k["asks"], k["index"] = k["doc"], 100 + k["doc"], 1, 1
    return nj._frame(nj._split(k, (k["sig"] % np.uint64(BUCKETS)).astype(np.int64), 5))


def sent(blocks: pd.DataFrame) -> pd.DataFrame:
    tokens = np.random.default_rng(1).integers(1 << 62, size=104).astype(np.uint64)
    now = pd.DataFrame({"doc": range(DOCS), "label": range(DOCS), "sketch": [nj.sketch(tokens[: 100 + d]) for d in range(DOCS)]})
    return dealt(blocks, lambda b: nj._labelled(BUCKETS, sketches=True)(b, now[now["doc"] == b["bucket"].iloc[0]]))


@pytest.mark.parametrize("routed", [800_000, 1])
def test_sketches_go_where_the_smallest_document_of_their_segments_is(monkeypatch, routed):
    monkeypatch.setattr(nj, "ROUTED", routed, raising=False)
    at = sent(dealt(asked(), nj._open(BUCKETS, hubs=False)))
    copies = sum(len(node) for body in at["sketches"] for _, node, _ in nj._unsketched(body))
    assert copies == (DOCS if routed > 1 else DOCS * BUCKETS)  # with too many records for one bucket they stay spread
    pairs = dealt(at, nj._pairs(nearest=False))
    assert set(map(tuple, pairs[["doc", "other"]].to_numpy().tolist())) == {(a, b) for a in range(DOCS) for b in range(a)}
    assert sorted(nj._records(at, 5, nj.KNOWN)["sig"].tolist()) == sorted(np.repeat(np.arange(SEGMENTS), DOCS).tolist())


def test_hubs_are_told_in_the_records_themselves():
    blocks = dealt(asked(), nj._open(BUCKETS, hubs=True))
    assert set(blocks["kind"]) == {5}
    assert len(nj._records(blocks, 5, nj.KNOWN)) == SEGMENTS * DOCS
    got = dealt(blocks, nj._hubs_of)
    assert dict(zip(got["doc"], got["hub"], strict=True)) == {d: 0 for d in range(DOCS)}


@pytest.mark.parametrize("routed", [800_000, 1])
def test_links_are_those_of_all_pairs(spark, monkeypatch, routed):
    monkeypatch.setattr(nj, "ROUTED", routed, raising=False)
    monkeypatch.setattr(nj, "BUCKET_BYTES", 4000)
    r = random.Random(9)
    texts = {}
    for base in range(12):
        line = [f"w{r.randrange(500)}" for _ in range(r.choice((8, 40, 150)))]
        for k in range(8):
            w = list(line)
            for _ in range(r.randint(0, max(1, len(w) // 14))):
                w[r.randrange(len(w))] = f"x{r.randrange(9000)}"
            texts[base * 8 + k] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in nj.near_duplicates(df).collect()}
    assert got == brute.near_components(texts)
