"""Removal of repeated passages with a logarithmic family of sparse suffix arrays.

Batches of documents come in the order of their ids. A batch's suffixes are sampled: in every run of SPAN bytes the GRAM
bytes with the smallest hash are its anchor, so two equal runs have equal anchors at equal places, and one suffix for each
anchor is enough. The sorted suffixes of a batch, dealt to buckets by anchor, are merge-scanned against the levels that
exist: within one anchor, suffixes are compared by what lies around the anchor. Then the batch joins the family: levels of
the same size are merged, as carries in a binary counter, so each suffix is rewritten a logarithmic number of times.

A suffix's context is the union of the runs that have its anchor. A context that an earlier document has too is covered
as a whole. Where contexts of one anchor differ, their single runs are compared in a second, small pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, partitions, staged

#: Bytes of a match, bytes of an anchor, and runs that compete for one anchor.
SPAN, GRAM = 50, 20
REACH = SPAN - GRAM + 1
#: Batches of a run. Four make two equal levels meet and merge, one more level that stays, and a last batch.
BATCHES = 4
_B = 0x9E3779B97F4A7C15 | 1
_M = (1 << 64) - 1
#: Bits of a context; with an anchor's bits they tell contexts apart.
_CONTEXT = np.uint64((1 << 48) - 1)
#: Texts are hashed in groups of about this many bytes, so memory stays bounded.
_GROUP = 1 << 20

SUFFIX = np.dtype([("anchor", "<u4"), ("context", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("length", "u1")])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done, step = 1, base
    while done < n:
        m = min(done, n - done)
        out[done : done + m] = out[:m] * np.uint64(step)
        done, step = done + m, step * step & _M
    return out


class Hashes:
    """Hashes of any substrings of a byte string, from one running sum modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.inverse = _powers(pow(_B, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_B, n), out=self.sums[1:])

    def of(self, starts: np.ndarray, lengths) -> np.ndarray:
        return _mix((self.sums[starts + lengths] - self.sums[starts]) * self.inverse[starts])

    def every(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def suffixes(data: np.ndarray, docs: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hashes (64 bits) and suffixes of documents that lie one after another in data; ends: where each one ends."""
    empty = np.empty(0, dtype=np.uint64), np.empty(0, dtype=SUFFIX)
    if len(data) < SPAN:
        return empty
    h = Hashes(data)
    grams = h.every(GRAM)
    runs = _least(grams, REACH)  # by start of a run of SPAN bytes
    starts = np.concatenate([[0], ends[:-1]])
    doc_of = np.repeat(np.arange(len(ends)), ends - starts)
    at = np.arange(len(runs))
    inside = doc_of[at] == doc_of[at + SPAN - 1]
    # A context ends where the anchor's hash changes or a document does. Equal grams close by share one context.
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (runs[1:] != runs[:-1]) | (doc_of[at[1:]] != doc_of[at[:-1]])
    opening = np.flatnonzero(first)
    if not len(opening):
        return empty
    group = np.cumsum(first) - 1
    count = np.bincount(group[inside], minlength=len(opening))
    # A context longer than a byte can tell is cut: its parts are contexts by themselves.
    parts = -(-count // 200)
    if parts.max() > 1:
        begin = np.repeat(opening, parts) + 200 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        stop = np.minimum(begin + 200, np.repeat(opening + count, parts))
        opening, count = begin, stop - begin
    out = np.empty(len(opening), dtype=SUFFIX)
    anchors = runs[opening]
    out["context"] = h.of(opening, count + SPAN - 1) & _CONTEXT
    out["doc"] = docs[doc_of[opening]]
    out["start"] = opening - starts[doc_of[opening]]
    out["length"] = count
    return anchors, out


#: kind 0: suffixes of a bucket; 1: (doc, start, length) of covered runs; 2: (doc, start, length) of runs to compare singly.
BLOCK = "bucket int, kind int, level int, body binary"
RANGE = np.dtype([("doc", "<i8"), ("start", "<i4"), ("length", "<i4")])
#: Ranges to compare singly, with their anchor; -1: an anchor of so many contexts that its runs are dealt out one by one.
ASK = np.dtype([*RANGE.descr, ("anchor", "<i8")])
MANY = 64


def _packed(s: np.ndarray) -> bytes:
    """Records as byte planes, so that a block codec finds the runs in ids, places and lengths."""
    planes = []
    for name in s.dtype.names:
        x = s[name]
        if name == "doc":
            x = np.diff(x, prepend=0)
        planes.append(np.ascontiguousarray(x).view(np.uint8).reshape(len(s), x.dtype.itemsize).T.tobytes())
    return b"".join(planes)


def _unpacked(body: bytes, dtype: np.dtype) -> np.ndarray:
    n, at = len(body) // dtype.itemsize, 0
    out = np.empty(n, dtype=dtype)
    for name in dtype.names:
        width = dtype[name].itemsize
        planes = np.frombuffer(body, np.uint8, n * width, at).reshape(width, n)
        x = np.ascontiguousarray(planes.T).view(dtype[name]).reshape(n)
        out[name] = np.cumsum(x) if name == "doc" else x
        at += n * width
    return out


def _ranges(s: np.ndarray, anchor: np.ndarray | None = None) -> bytes:
    out = np.empty(len(s), dtype=RANGE if anchor is None else ASK)
    for name in RANGE.names:
        out[name] = s[name]
    if anchor is not None:
        out["anchor"] = anchor
    out = out[np.lexsort((out["start"], out["doc"]))]
    if anchor is None and len(out):  # neighbours become one range
        stop = out["start"] + out["length"]
        new = np.r_[True, (out["doc"][1:] != out["doc"][:-1]) | (out["start"][1:] != stop[:-1])]
        at = np.flatnonzero(new)
        joined = out[at]
        joined["length"] = stop[np.r_[at[1:], len(out)] - 1] - joined["start"]
        out = joined
    return _packed(out)


def _opens(s: np.ndarray, *keys: str) -> np.ndarray:
    """Flags of the sorted records that open a new key."""
    new = np.zeros(len(s), dtype=bool)
    if len(s):
        new[0] = True
        for k in keys:
            new[1:] |= s[k][1:] != s[k][:-1]
    return new


def _leads(new: np.ndarray) -> np.ndarray:
    """For each record where its key opens."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _joined(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of documents of a batch: bytes one after another, ids, ends."""
    ids, texts, size = [], [], 0
    last = batch.num_rows - 1
    for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
        ids.append(doc)
        texts.append(text.as_py() or b"")
        size += len(texts[-1])
        if size >= _GROUP or i == last:
            yield np.frombuffer(b"".join(texts), np.uint8), np.array(ids, np.int64), np.cumsum([len(t) for t in texts])
            ids, texts, size = [], [], 0


def _blocks(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["bucket", "kind", "level", "body"])


def _dealt(s: np.ndarray, hashes: np.ndarray, buckets: int, seed: int) -> pa.RecordBatch:
    """Blocks of suffixes by bucket. Copies within one task are settled here: only the first document's suffix travels."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int32)
    s["anchor"] = (hashes // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)
    order = np.lexsort((s["doc"], s["context"], s["anchor"], bucket))
    s, bucket = s[order], bucket[order]
    new = _opens(s, "anchor", "context")
    new[1:] |= bucket[1:] != bucket[:-1]
    done = s["doc"][_leads(new)] < s["doc"]
    rows = []
    if done.any():
        rows.append((seed % buckets, 1, 0, _ranges(s[done])))
    s, bucket = s[~done], bucket[~done]
    order = np.lexsort((s["start"], s["doc"], bucket))
    s, bucket = s[order], bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rows += [(int(bucket[a]), 0, 0, _packed(s[a:b])) for a, b in zip(cuts, [*cuts[1:], len(s)], strict=True)]
    return _blocks(rows)


#: Suffixes that a task holds before it deals them out.
HELD = 500_000


def _batch_suffixes(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for data, docs, ends in _joined(batch):
                held.append(suffixes(data, docs, ends))
                if sum(len(x) for _, x in held) >= HELD:
                    yield _dealt(np.concatenate([x for _, x in held]), np.concatenate([a for a, _ in held]), buckets, int(docs[-1]))
                    held = []
        if any(len(x) for _, x in held):
            yield _dealt(np.concatenate([x for _, x in held]), np.concatenate([a for a, _ in held]), buckets, int(docs[-1]))

    return run


def _scan(index: bool, buckets: int):
    """Merge-scan one bucket: the batch (level 0) against levels that it joins (1) and levels that stay (2)."""

    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        bucket = int(blocks["bucket"].iloc[0])
        out = [(bucket, 1, 0, b) for k, b in zip(blocks["kind"], blocks["body"], strict=True) if k == 1]
        held = blocks[blocks["kind"] == 0]
        if len(held):
            parts = [_unpacked(b, SUFFIX) for b in held["body"]]
            level = np.repeat(held["level"].to_numpy(), [len(p) for p in parts])
            s = np.concatenate(parts)
            order = np.lexsort((s["start"], s["doc"], s["context"], s["anchor"]))
            s, level = s[order], level[order]
            new = _opens(s, "anchor", "context")
            first = s["doc"][_leads(new)] == s["doc"]
            # Where an anchor has several contexts, the runs of each context's first document stand for the context.
            group = np.cumsum(_opens(s, "anchor")) - 1
            contexts = np.bincount(group, weights=new)
            ask = first & ((contexts > 1) & (np.bincount(group, weights=level == 0) > 0))[group]
            anchor = np.where(contexts[group] > MANY, -1, s["anchor"].astype(np.int64) * buckets + bucket)
            out += [(bucket, 1, 0, _ranges(s[~first & (level == 0)])), (bucket, 2, 0, _ranges(s[ask], anchor[ask]))]
            if index:
                kept = s[new & (level < 2)]
                out.append((bucket, 0, 1, _packed(kept[np.lexsort((kept["start"], kept["doc"]))])))
        return pd.DataFrame([o for o in out if o[3]], columns=["bucket", "kind", "level", "body"])

    return run


class SuffixFamily:
    """Levels of suffixes in the shared folder. absorb() scans a batch against all of them and adds it.

    A level's files go once it is merged into a larger one; close() deletes those that are left.
    """

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.levels: list[tuple[int, DataFrame]] = []  # (batches held, blocks), largest first

    def absorb(self, batch: DataFrame, last: bool = False) -> DataFrame:
        """Blocks of kinds 1 and 2 for a batch (doc_id, bytes) whose ids are above all earlier ones.

        last: no batch follows, so the batch is scanned only.
        """
        size, joined = 1, []
        while not last and self.levels and self.levels[-1][0] == size:  # carry, as in a binary counter
            joined.append(self.levels.pop()[1])
            size *= 2
        blocks = batch.mapInArrow(_batch_suffixes(self.buckets), BLOCK)
        for level in joined:
            blocks = blocks.unionByName(level)
        for _, level in self.levels:
            blocks = blocks.unionByName(level.withColumn("level", F.lit(2)))
        scanned = staged(blocks.groupBy("bucket").applyInPandas(_scan(not last, self.buckets), BLOCK), "suffix-level", by="kind")
        discard(*joined)
        if not last:
            level = scanned.where("kind = 0")
            level.staged_at = scanned.staged_at + "/kind=0"
            self.levels.append((size, level))
        return scanned.where("kind > 0").select("bucket", "kind", "body")

    def close(self) -> None:
        discard(*[level for _, level in self.levels])
        self.levels = []


def _exploded(dtype: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                s = _unpacked(body.as_py(), dtype)
                for a in range(0, len(s), 100_000):
                    yield pa.record_batch([pa.array(s[n][a : a + 100_000]) for n in dtype.names], names=list(dtype.names))

    return run


def _by_document(blocks: DataFrame, dtype: np.dtype = RANGE) -> DataFrame:
    """(doc, at array<struct>): a document's ranges; their number is bounded by its length."""
    kinds = {"doc": "long", "start": "int", "length": "int", "anchor": "long"}
    ranges = blocks.mapInArrow(_exploded(dtype), ", ".join(f"{n} {kinds[n]}" for n in dtype.names))
    return ranges.groupBy("doc").agg(F.collect_set(F.struct(*dtype.names[1:])).alias("at"))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts travel as zstd frames."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        bodies = [press.compress(t.as_py() or b"") for t in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(bodies, pa.binary())], names=["doc_id", "body"])


def _sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Parts of batches whose lists hold about RANGES entries at most, so what they stand for stays small."""
    for batch in batches:
        before = batch.column(column).offsets.to_numpy()
        at = 0
        while at < batch.num_rows:
            nxt = max(at + 1, int(np.searchsorted(before, before[at] + RANGES, side="right")) - 1)
            nxt = min(nxt, at + 500, batch.num_rows)
            yield batch.slice(at, nxt - at)
            at = nxt


#: Entries of such a part.
RANGES = 20_000
#: Contexts that travel with their bytes: an anchor's contexts meet in one bucket.
TOLD = np.dtype([("doc", "<i8"), ("start", "<i4"), ("length", "<i4"), ("anchor", "<i8")])


def _single_runs(buckets: int):
    """From (doc, body, at) to blocks: kind 3 holds contexts and their bytes, kind 0 single runs of anchors with many."""

    def told(data: np.ndarray, s: np.ndarray, base: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
        bucket = s["anchor"] % buckets
        order = np.lexsort((s["start"], s["doc"], bucket))
        s, base, bucket = s[order], base[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(s) else []
        for a, b in zip(cuts, [*cuts[1:], len(s)], strict=True):
            n = s["length"][a:b] + SPAN - 1
            at = np.repeat(base[a:b], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            head = _packed(s[a:b])
            yield int(bucket[a]), 3, 0, len(head).to_bytes(8, "little") + head + data[at].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in _sliced(batches, "at"):
            texts = [press.decompress(t.as_py()) for t in batch.column("body")]
            data, docs = np.frombuffer(b"".join(texts), np.uint8), batch.column("doc").to_numpy()
            size = np.array([len(t) for t in texts], dtype=np.int64)
            starts = np.cumsum(size) - size
            at = batch.column("at")
            row = np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy()))
            s = np.empty(len(row), dtype=TOLD)
            s["doc"] = docs[row]
            for name in ("start", "length", "anchor"):
                s[name] = at.flatten().field(name).to_numpy()
            fits = s["start"].astype(np.int64) + s["length"] + SPAN - 1 <= size[row]  # not so for another text of the same id
            s, row = s[fits], row[fits]
            one = s["anchor"] < 0
            if not one.all():
                yield _blocks(list(told(data, s[~one], starts[row[~one]] + s["start"][~one])))
            s, row = s[one], row[one]
            if len(s):
                hashes = Hashes(data)
                which = np.repeat(np.arange(len(s)), s["length"])
                place = s["start"][which] + np.arange(len(which)) - np.repeat(np.cumsum(s["length"]) - s["length"], s["length"])
                for a in range(0, len(which), HELD):
                    own, start = which[a : a + HELD], place[a : a + HELD]
                    runs = np.zeros(len(own), dtype=SUFFIX)
                    key = hashes.of(starts[row[own]] + start, SPAN)
                    runs["context"], runs["doc"], runs["start"], runs["length"] = key & _CONTEXT, s["doc"][own], start, 1
                    yield _dealt(runs, key, buckets, int(docs[0]) if docs[0] >= 0 else 0)

    return run


def _compare(blocks: pd.DataFrame) -> pd.DataFrame:
    """Covered single runs of a bucket, from both kinds of blocks."""
    bucket = int(blocks["bucket"].iloc[0])
    out = [(bucket, 1, 0, b) for k, b in zip(blocks["kind"], blocks["body"], strict=True) if k == 1]
    parts = [_unpacked(b, SUFFIX) for k, b in zip(blocks["kind"], blocks["body"], strict=True) if k == 0]
    for body in blocks["body"][blocks["kind"] == 3]:
        n = int.from_bytes(body[:8], "little")
        s, data = _unpacked(body[8 : 8 + n], TOLD), np.frombuffer(body, np.uint8, offset=8 + n)
        width = s["length"].astype(np.int64) + SPAN - 1
        which = np.repeat(np.arange(len(s)), s["length"])
        inner = np.arange(len(which)) - np.repeat(np.cumsum(s["length"]) - s["length"], s["length"])
        key = Hashes(data).of((np.cumsum(width) - width)[which] + inner, SPAN)
        runs = np.zeros(len(which), dtype=SUFFIX)
        runs["anchor"], runs["context"], runs["doc"], runs["start"], runs["length"] = key & np.uint64(0xFFFF), key >> np.uint64(16), s["doc"][which], s["start"][which] + inner, 1
        parts.append(runs)
    # The kinds never meet: a run belongs to one anchor, and an anchor has either few contexts or many.
    for group in ([p for p, k in zip(parts, blocks["kind"][blocks["kind"].isin((0, 3))].sort_values(), strict=True) if k == kind] for kind in (0, 3)):
        if group:
            s = np.concatenate(group)
            s = s[np.lexsort((s["doc"], s["context"], s["anchor"]))]
            lead = s["doc"][_leads(_opens(s, "anchor", "context"))]
            out.append((bucket, 1, 0, _ranges(s[lead < s["doc"]])))
    return pd.DataFrame([o for o in out if o[3]], columns=["bucket", "kind", "level", "body"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for doc, body, at in zip(batch.column("doc_id").to_pylist(), batch.column("body"), batch.column("at"), strict=True):
            text, spans, removed = press.decompress(body.as_py()), 0, 0
            if at.is_valid and len(at.values) and text:
                edge = np.zeros(len(text) + 1, dtype=np.int32)
                start, length = at.values.field("start").to_numpy(), at.values.field("length").to_numpy()
                np.add.at(edge, np.minimum(start, len(text)), 1)
                np.add.at(edge, np.minimum(start + length + SPAN - 1, len(text)), -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed, spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                text = np.frombuffer(text, np.uint8)[~gone].tobytes()
            for column, value in zip(columns, (doc, len(text) + removed, removed, spans, text), strict=True):
                column.append(value)
        yield pa.record_batch(
            [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) for every document.

    A byte goes if it lies in a run of SPAN bytes that also starts in a document with a smaller id; runs are judged on the
    input. A null text is empty. Rows without an id have no place in the order and stay whole. Repeated rows of an id and
    a text get equal results and do not remove each other's bytes; ids with several texts are outside the contract: what is
    found at a place of one text goes from all. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    buckets = 4 * partitions(spark)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body"))
    named = d.where("doc_id IS NOT NULL")
    cuts = [float(c) for c in named.stat.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)] if batches > 1 else []
    edges = [None, *sorted(set(cuts)), None]
    family, found = SuffixFamily(buckets), []
    for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        batch = named
        if low is not None:
            batch = batch.where(F.col("doc_id") > int(low))
        if high is not None:
            batch = batch.where(F.col("doc_id") <= int(high))
        found.append(family.absorb(batch, last=i == len(edges) - 2))
    family.close()
    blocks = found[0]
    for more in found[1:]:
        blocks = blocks.unionByName(more)
    asked = _by_document(blocks.where("kind = 2"), ASK)
    travelling = d.mapInArrow(_compressed, "doc_id long, body binary")
    single = travelling.withColumnRenamed("doc_id", "doc").join(asked, "doc").mapInArrow(_single_runs(buckets), BLOCK)
    single = staged(single.groupBy("bucket").applyInPandas(_compare, BLOCK).select("bucket", "kind", "body"), "suffix-single")
    gone = _by_document(blocks.where("kind = 1").unionByName(single))
    return travelling.join(gone.withColumnRenamed("doc", "doc_id"), "doc_id", "left").mapInArrow(
        _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
