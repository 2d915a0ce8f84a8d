"""N-gram Jaccard self-join by universe partition and pigeonhole, and its connected components.

Documents are sets of hashed 5-word shingles. Sets fall into bands by size; a band cuts the universe of hashes into
segments. Two sets that link differ in at most H shingles, so of any H + 1 error units spread over segments one is free:
one unit asks that a segment is equal, a second one on the same segment lets one shingle differ (one-deletion
neighbourhoods). Every set indexes its segments in its own band and may probe there and in the band below.

Costs are exact: a first pass counts, for every segment, how many other sets share it. A set then spends its units on its
cheapest segments. Segments that nobody shares cost nothing, so a set with enough of these has no partner and asks for
none. Equal sets of one task travel as one, so a large group of copies sends each of its segments once a task.

Pairs are verified by exact intersection, in rounds. First each set with the hub that it meets most often; what links is
merged. Then, where sets that are not connected still meet in a segment, their parity sketches are compared: each bit is
the parity of the shingles that fall on it, so two sketches differ in at most as many bits as their sets differ in
shingles, and a pair whose sketches differ in more than a link allows can't link. Each set is verified with the nearest of
the pairs that are left, what links is merged, and at last all pairs that are left and not connected are verified.

Entries travel as packed blocks, so that sorting and counting work on arrays within tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged
from .graph import components
from .suffix_dedup import Hashes, _mix, _packed, _unpacked

NGRAM = 5
#: A link needs 100 * intersection >= PERCENT * union. The bounds on differences below are those of 75.
PERCENT = 75
_GROUP = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _band_starts() -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 31:
        starts.append(max(starts[-1] + 1, -(-4 * starts[-1] // 3)))
    return np.array(starts, dtype=np.int64)


#: The smallest size of each band. A set's partners of at most its size are in its band or the one below.
STARTS = _band_starts()
LAST = np.r_[STARTS[1:] - 1, STARTS[-1]]
#: Segments of each band, and how many of them have one-deletion neighbourhoods: LAST // 3 + 1 units are always needed.
SEGMENTS = LAST // 3 + 1 + LAST // 20 + (LAST >= 4)
LOOSE = np.where(LAST >= 4, 1 + SEGMENTS // 64, 0)

ENTRY = np.dtype([("sig", "<u8"), ("doc", "<i8"), ("slot", "<u4"), ("band", "u1"), ("flags", "u1")])
INDEX, PROBE, DELETED = 1, 2, 4
_SIG = np.uint64((1 << 40) - 1)
#: What is known of a set: its size, its spare units in its own band and the one below, and the equal set it travels with.
INFO = np.dtype([("doc", "<i8"), ("rep", "<i8"), ("size", "<i4"), ("own", "<i4"), ("below", "<i4")])


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of texts that lie one after another in data, and the number of the text of each."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    space = _SPACE[low]
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    edge = np.ones(len(low), dtype=bool)
    edge[1:] = space[:-1] | (text[1:] != text[:-1])
    start = np.flatnonzero(edge & ~space)
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    stop = np.ones(len(low), dtype=bool)
    stop[:-1] = space[1:] | (text[1:] != text[:-1])
    end = np.flatnonzero(stop & ~space) + 1
    word = Hashes(low).of(start, end - start)
    owner = text[start]
    n = np.bincount(owner, minlength=len(ends))
    first = np.cumsum(n) - n
    # A text of fewer words is one shingle of what it has.
    width = np.minimum(n, NGRAM)
    size = np.maximum(n - NGRAM + 1, (n > 0).astype(n.dtype))
    of = np.repeat(np.arange(len(ends)), size)
    at = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    total = np.zeros(len(of), dtype=np.uint64)
    padded = np.r_[word, np.zeros(NGRAM, np.uint64)]
    factor = 0x9E3779B97F4A7C15
    for k in range(NGRAM):
        use = k < width[of]
        total += np.where(use, padded[np.minimum(at + k, len(word))] * np.uint64(factor), np.uint64(0))
        factor = factor * 0xBF58476D1CE4E5B9 % (1 << 64)
    total = _mix(total + width[of].astype(np.uint64))
    order = np.lexsort((total, of))
    total, of = total[order], of[order]
    new = np.r_[True, (total[1:] != total[:-1]) | (of[1:] != of[:-1])]
    return total[new], of[new]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    ids, texts, size = [], [], 0
    last = batch.num_rows - 1
    for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
        ids.append(doc)
        texts.append(text.as_py() or b"")
        size += len(texts[-1])
        if size >= _GROUP or i == last:
            yield np.frombuffer(b"".join(texts), np.uint8), np.array(ids, np.int64), np.cumsum([len(t) for t in texts])
            ids, texts, size = [], [], 0


def _view(tokens: np.ndarray, of: np.ndarray, docs: np.ndarray, size: np.ndarray, band: np.ndarray, most: np.ndarray, flags: int):
    """Entries of sets in given bands, and the spare units of each set; most: differences that a partner may have."""
    m, loose = SEGMENTS[band], LOOSE[band]
    base = np.cumsum(m) - m
    segment = ((tokens >> np.uint64(32)) * m[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    key = base[of] + segment  # rises with the tokens, which are sorted
    count = np.bincount(key, minlength=int(m.sum()))
    salted = _mix(tokens)
    total = np.zeros(len(count), dtype=np.uint64)
    if len(key):
        opens = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        total[key[opens]] = np.add.reduceat(salted, opens)
    owner = np.repeat(np.arange(len(m)), m)
    slot = np.arange(len(owner)) - base[owner]
    place = (band[owner].astype(np.uint64) << np.uint64(32)) + slot.astype(np.uint64)
    name = _mix(place + np.uint64(0x5851F42D4C957F2D))
    units = np.bincount(owner, weights=(count > 0) * (1 + (slot < loose[owner])), minlength=len(m)).astype(np.int64)
    spare = units - (most + 1)
    # Empty segments are many sets' in common: they are probed only by sets that lack units without them.
    short = (spare < 0)[owner] & (count == 0)
    spare = np.where(spare < 0, spare + np.bincount(owner, weights=(count == 0), minlength=len(m)).astype(np.int64), spare)
    out = np.empty(len(owner), dtype=ENTRY)
    out["sig"], out["doc"], out["band"] = _mix(total + name), docs[owner], band[owner]
    out["slot"] = np.where(slot < loose[owner], slot + 1, 0)  # only the loose ones' numbers matter
    out["flags"] = np.where((count > 0) | short, flags, flags & INDEX)
    in_loose = segment < loose[of]
    gone = np.empty(int(in_loose.sum()), dtype=ENTRY)
    k = key[in_loose]
    gone["sig"], gone["doc"], gone["slot"] = _mix(total[k] - salted[in_loose] + name[k]), docs[of[in_loose]], segment[in_loose] + 1
    gone["band"], gone["flags"] = band[of[in_loose]], flags | DELETED
    out = np.concatenate([out[out["flags"] > 0], gone])
    return out, spare


def set_entries(tokens: np.ndarray, of: np.ndarray, docs: np.ndarray, seen: dict[tuple[int, int], int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All entries and the information rows of sets. seen: sets met before, by hash and size; these send no entries again."""
    size = np.bincount(of, minlength=len(docs)).astype(np.int64)
    info = np.zeros(len(docs), dtype=INFO)
    info["doc"], info["rep"], info["size"] = docs, docs, size
    new = size > 0
    if seen is not None:
        total = np.zeros(len(docs), dtype=np.uint64)
        if len(of):
            opens = np.flatnonzero(_opened(of))
            total[of[opens]] = np.add.reduceat(_mix(tokens), opens)
        for i in np.flatnonzero(new).tolist():
            info["rep"][i] = rep = seen.setdefault((int(total[i]), int(size[i])), int(docs[i]))
            new[i] = rep == docs[i]
    full = np.flatnonzero(new)
    tokens, of = tokens[new[of]], (np.cumsum(new) - 1)[of[new[of]]]
    docs, size = docs[full], size[full]
    band = np.searchsorted(STARTS, size, side="right") - 1
    own, spare = _view(tokens, of, docs, size, band, 2 * size // 7, INDEX | PROBE)
    info["own"][full] = spare
    lower = (band > 0) & (4 * LAST[np.maximum(band - 1, 0)] >= 3 * size)
    below = np.empty(0, dtype=ENTRY)
    if lower.any():
        sub = np.flatnonzero(lower)
        keep = lower[of]
        again = (np.cumsum(lower) - 1)[of[keep]]
        below, spare = _view(tokens[keep], again, docs[sub], size[sub], band[sub] - 1, (size[sub] + LAST[band[sub] - 1]) // 7, PROBE)
        info["below"][full[sub]] = spare
    return np.concatenate([own, below]), info


BLOCK = "bucket int, kind int, body binary"
HELD = 800_000


def _blocks(entries: np.ndarray, info: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = (entries["sig"] % np.uint64(buckets)).astype(np.int64)
    entries["sig"] = (entries["sig"] // np.uint64(buckets)) & _SIG
    # The shuffle of the entries is the largest one; in this order it compresses best.
    rows = _split(entries, bucket, 0, "flags", "band") + _split(info, info["doc"] % buckets, 1)
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["bucket", "kind", "body"])


def _emit(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            for data, docs, ends in _texts(batch):
                held.append(set_entries(*shingle_sets(data, ends), docs, seen))
                if sum(len(e) for e, _ in held) >= HELD:
                    yield _blocks(*map(np.concatenate, zip(*held, strict=True)), buckets)
                    held = []
        if held:
            yield _blocks(*map(np.concatenate, zip(*held, strict=True)), buckets)

    return run


#: Entries that meet others, on their way to their document: unit 1 or 2 (0: index only), and the number of others met.
MET = np.dtype([("sig", "<u8"), ("doc", "<i8"), ("slot", "<u4"), ("cost", "<u4"), ("band", "u1"), ("unit", "u1"), ("index", "u1")])
#: Entries on their way back, with what their document knows. On the way to their documents label holds what the segment
#: tells: the hub, or the bucket in which its pairs are looked at.
KNOWN = np.dtype([("sig", "<u8"), ("doc", "<i8"), ("label", "<i8"), ("size", "<u4"), ("asks", "u1"), ("index", "u1")])


def _split(s: np.ndarray, bucket: np.ndarray, kind: int, *before: str) -> list[tuple[int, int, bytes]]:
    """A packed row for each bucket, its records in order of documents, or of the fields named before these, the last one first."""
    order = np.lexsort((s["doc"], *(s[name] for name in before), bucket))
    s, bucket = s[order], bucket[order]
    if not len(s):
        return []
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    return [(int(bucket[a]), kind, _packed(s[a:b])) for a, b in zip(cuts, [*cuts[1:], len(s)], strict=True)]


def _frame(rows: list[tuple[int, int, bytes]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bucket", "kind", "body"])


def _opened(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), dtype=bool)
    if len(new):
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


def _records(blocks: pd.DataFrame, kind: int, dtype: np.dtype) -> np.ndarray:
    parts = [_unpacked(b, dtype) for b in blocks["body"][blocks["kind"] == kind]]
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def _met_entries(bodies: list[bytes]) -> np.ndarray:
    """The entries whose segment has another entry, in order of segments. Only the segments of all are held at once."""
    sigs = [np.ascontiguousarray(np.frombuffer(b, np.uint8, 8 * (len(b) // ENTRY.itemsize)).reshape(8, -1).T).view("<u8").ravel() for b in bodies]
    sig = np.concatenate(sigs) if sigs else np.empty(0, np.uint64)
    order = np.argsort(sig)
    same = sig[order[1:]] == sig[order[:-1]]
    many = np.zeros(len(sig), dtype=bool)
    many[order[1:][same]] = many[order[:-1][same]] = True
    parts, at = [], 0
    for body, own in zip(bodies, sigs, strict=True):
        parts.append(_unpacked(body, ENTRY)[many[at : at + len(own)]])
        at += len(own)
    s = np.concatenate(parts) if parts else np.empty(0, ENTRY)
    return s[np.argsort(s["sig"], kind="stable")]


def _shared(buckets: int):
    """A bucket of segments: entries that meet entries of other sets go to their documents' buckets (kind 2), with costs.

    Information rows pass through (kind 1).
    """

    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        bucket = int(blocks["bucket"].iloc[0])
        out = [(bucket, 1, b) for b in blocks["body"][blocks["kind"] == 1]]
        s = _met_entries(blocks["body"][blocks["kind"] == 0].tolist())
        if len(s):
            group = np.cumsum(_opened(s["sig"])) - 1
            index, deleted, probe = (s["flags"] & INDEX) > 0, (s["flags"] & DELETED) > 0, (s["flags"] & PROBE) > 0
            exact = np.bincount(group, weights=index & ~deleted).astype(np.int64)[group]
            loose = np.bincount(group, weights=index & deleted).astype(np.int64)[group]
            cost = exact - (index & ~deleted)  # its own entry is no other
            useful = (np.bincount(group, weights=probe) > 0)[group] & ((exact + loose) > 0)
            rows = []
            # an exact segment that meets deletions of others serves its second unit
            for mask, unit, amount in (
                (probe & ~deleted & (cost > 0), 1, cost), (probe & deleted & (exact > 0), 2, exact),
                (probe & ~deleted & (loose > 0) & (s["slot"] > 0), 2, loose), (index & useful, 0, cost * 0),
            ):
                m = np.empty(int(mask.sum()), dtype=MET)
                for name in ("doc", "slot", "band"):
                    m[name] = s[name][mask]
                m["sig"] = s["sig"][mask] * np.uint64(buckets) + np.uint64(bucket)
                m["cost"], m["unit"], m["index"] = amount[mask], unit, unit == 0
                rows.append(m)
            # the index entry of a segment and its first unit travel as one record
            one, own = rows[0], rows[3]
            both = np.isin(_pairkey(own), _pairkey(one))
            one["index"] = np.isin(_pairkey(one), _pairkey(own))
            rows[3] = own[~both]
            m = np.concatenate(rows)
            out += _split(m, m["doc"] % buckets, 2)
        return _frame(out)

    return run


def _pairkey(m: np.ndarray) -> np.ndarray:
    return _mix(m["sig"] * np.uint64(0x9E3779B97F4A7C15) + m["doc"].astype(np.uint64))


def _spend(buckets: int):
    """A bucket of documents: each set spends its units; its entries go back to their segments, with its size (kind 5)."""

    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        m = _records(blocks, 2, MET)
        if not len(m):
            return _frame([])
        info = _records(blocks, 1, INFO)
        info = info[np.argsort(info["doc"], kind="stable")]
        m = m[np.lexsort((m["unit"], m["slot"], m["band"], m["doc"]))]
        i = info[np.searchsorted(info["doc"], m["doc"])]
        asks = np.zeros(len(m), dtype=bool)
        # Units: each first unit is one record; the records of a loose segment's second unit are one unit together.
        at = np.flatnonzero(m["unit"] > 0)
        if len(at):
            u = m[at]
            new = _opened(u["doc"], u["band"], u["slot"], u["unit"]) | (u["unit"] == 1)
            unit = np.cumsum(new) - 1
            cost = np.bincount(unit, weights=u["cost"]).astype(np.int64)
            lead = u[new]
            # Who is equal in a segment is within one deletion too: a second unit costs the first one's amount besides its
            # own, and stands in the list wherever the first one does.
            seg = np.cumsum(_opened(lead["doc"], lead["band"], lead["slot"]) | (lead["slot"] == 0)) - 1
            first = np.bincount(seg, weights=np.where(lead["unit"] == 1, cost, 0)).astype(np.int64)
            second = np.bincount(seg, weights=lead["unit"] == 2) > 0
            cost = np.where(lead["unit"] == 2, cost + first[seg], cost)
            implied = (lead["unit"] == 1) & (lead["slot"] > 0) & ~second[seg]
            own = np.concatenate([i[at][new], i[at][new][implied]])
            every = np.concatenate([lead, lead[implied]])
            every["unit"][len(lead) :] = 2
            cost = np.concatenate([cost, cost[implied]])
            order = np.lexsort((every["sig"], every["unit"], cost, every["band"], every["doc"]))
            group = np.cumsum(_opened(every["doc"][order], every["band"][order])) - 1
            count = np.bincount(group)
            rank = np.arange(len(order)) - (np.cumsum(count) - count)[group]
            above = STARTS[np.minimum(every["band"][order].astype(np.int64) + 1, len(STARTS) - 1)]
            own = own[order]
            spare = np.where(own["size"] < above, own["own"], own["below"])
            chosen = np.empty(len(order), dtype=bool)
            chosen[order] = rank < count[group] - spare
            asks[at] = chosen[unit]
        keep = asks | (m["index"] > 0)
        k = np.empty(int(keep.sum()), dtype=KNOWN)
        for name in ("sig", "doc", "index"):
            k[name] = m[name][keep]
        k["size"], k["asks"], k["label"] = i["size"][keep], asks[keep], k["doc"]
        return _frame(_split(k, (k["sig"] % np.uint64(buckets)).astype(np.int64), 5))

    return run


def _useful(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The records, in order of segments, of those segments that a set asks for, one indexes, and two labels share."""
    k = k[np.lexsort((k["doc"], k["sig"]))]
    group = np.cumsum(_opened(k["sig"])) - 1
    if len(k):
        low, high = np.full(group[-1] + 1, np.iinfo(np.int64).max), np.full(group[-1] + 1, np.iinfo(np.int64).min)
        np.minimum.at(low, group, k["label"])
        np.maximum.at(high, group, k["label"])
        good = (low != high) & (np.bincount(group, weights=k["asks"]) > 0) & (np.bincount(group, weights=k["index"]) > 0)
        k, group = k[good[group]], group[good[group]]
    return k, np.cumsum(_opened(k["sig"])) - 1


#: Records that segments of one smallest document may have in one bucket.
ROUTED = 800_000


def _open(buckets: int, hubs: bool):
    """A bucket of segments: the records of useful segments go to their documents (kind 5), with a note as label.

    hubs: the note is the smallest document of the segment, the hub of those close to it in size, and the document itself for
    others. Else it is the bucket that looks at the segment's pairs. Near copies meet in many segments, and mostly with the
    same smallest document, so its segments go to one bucket: a sketch is then sent to as many buckets as a set has such
    documents, whatever the number of buckets. Segments of a document that has too many for one bucket stay spread.
    """

    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        bucket = int(blocks["bucket"].iloc[0])
        k, group = _useful(_records(blocks, 5, KNOWN))
        if not len(k):
            return _frame([])
        first = np.flatnonzero(_opened(group))[group]
        least = k["doc"][first]
        if hubs:
            small, large = np.minimum(k["size"], k["size"][first]).astype(np.int64), np.maximum(k["size"], k["size"][first]).astype(np.int64)
            k["label"] = np.where(4 * small >= 3 * large, least, k["doc"])
        else:
            _, at, n = np.unique(least, return_inverse=True, return_counts=True)
            few = n[at] <= max(1, ROUTED // buckets)  # this bucket has about one of so many parts of them
            k["label"] = np.where(few, (_mix(least.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64), bucket)
        return _frame(_split(k, k["doc"] % buckets, 5))

    return run


def _hubs_of(blocks: pd.DataFrame) -> pd.DataFrame:
    """The documents of a bucket of documents, each with the hub that it meets most often, the smallest of several, or itself."""
    k = _records(blocks, 5, KNOWN)
    pair, n = np.unique(np.stack([k["doc"], k["label"]], axis=1), axis=0, return_counts=True)
    n[pair[:, 0] == pair[:, 1]] = 0
    pair = pair[np.lexsort((pair[:, 1], -n, pair[:, 0]))]
    return pd.DataFrame(pair[_opened(pair[:, 0])], columns=["doc", "hub"])


def _bits(size: np.ndarray) -> np.ndarray:
    """Logarithm of the width of a set's sketch, about four bits a shingle. Sets that may link differ by one at most."""
    return np.maximum(9, np.ceil(np.log2(4.0 * np.maximum(size, 1))).astype(np.int64))


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the numbers of shingles that fall on each bit; folding it in two gives the narrower one."""
    width = 1 << int(_bits(np.array([len(tokens)]))[0])
    place = _mix(tokens) & np.uint64(width - 1)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=width) & 1, bitorder="little").tobytes()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column(1)
        at, values = tokens.offsets.to_numpy(), tokens.values.to_numpy().view(np.uint64)
        bodies = [sketch(values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.record_batch([batch.column(0), pa.array(bodies, pa.binary())], names=["doc", "sketch"])


def _unsketched(body: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(logarithm of the width, documents, sketches) of each width in a body: a head of two numbers, then both arrays."""
    at = 0
    while at < len(body):
        log, n = np.frombuffer(body, "<i8", 2, at).tolist()
        words = n * ((1 << log) // 64)
        yield log, np.frombuffer(body, "<i8", n, at + 16), np.frombuffer(body, "<u8", words, at + 16 + 8 * n).reshape(n, -1)
        at += 16 + 8 * (n + words)


LABELLED = f"{BLOCK}, sketches binary"


def _labelled(buckets: int, sketches: bool):
    """A bucket of documents: their records with the labels of now go to their segments (kind 5).

    sketches: they go where the pairs of their segments are looked at, and sketches beside them.
    """

    def run(blocks: pd.DataFrame, now: pd.DataFrame) -> pd.DataFrame:
        k = _records(blocks, 5, KNOWN)
        if not len(k):
            return pd.DataFrame([], columns=["bucket", "kind", "body", "sketches"])
        to = k["label"].copy() if sketches else (k["sig"] % np.uint64(buckets)).astype(np.int64)
        k["label"] = k["doc"]
        now = now.sort_values("doc")
        node = now["doc"].to_numpy(dtype=np.int64)
        if len(node):
            place = np.minimum(np.searchsorted(node, k["doc"]), len(node) - 1)
            k["label"] = np.where(node[place] == k["doc"], now["label"].to_numpy(dtype=np.int64)[place], k["doc"])
        told: dict[int, list[bytes]] = {}
        if sketches:
            pair, at = np.unique(np.stack([to, k["doc"]], axis=1), axis=0, return_index=True)
            log, place = _bits(k["size"][at]), place[at]
            bodies = now["sketch"].to_numpy()
            for width in np.unique(log).tolist():
                own = np.flatnonzero(log == width)
                cuts = np.flatnonzero(_opened(pair[own, 0]))
                for a, b in zip(cuts, [*cuts[1:], len(own)], strict=True):
                    i = own[a:b]
                    head = np.array([width, len(i)], dtype="<i8").tobytes()
                    told.setdefault(int(pair[i[0], 0]), []).append(head + pair[i, 1].tobytes() + b"".join(bodies[place[i]]))
        rows = [(b, kind, body, b"".join(told.get(b, []))) for b, kind, body in _split(k, to, 5)]
        return pd.DataFrame(rows, columns=["bucket", "kind", "body", "sketches"])

    return run


class _Sketches:
    """The sketches of a bucket, to be compared in the width of the narrower one."""

    def __init__(self, blocks: pd.DataFrame, docs: np.ndarray):
        self.log = np.zeros(len(docs), dtype=np.int64)
        self.row = np.zeros((2, len(docs)), dtype=np.int64)  # in the matrix of their own width, and of half of it
        own, parts = {}, {}
        for body in blocks["sketches"]:
            for log, node, bits in _unsketched(body):
                parts.setdefault(log, []).append((node, bits))
        for log, held in parts.items():
            node, bits = np.concatenate([d for d, _ in held]), np.concatenate([b for _, b in held])
            at = np.minimum(np.searchsorted(docs, node), len(docs) - 1)
            use = docs[at] == node
            own[log] = at[use], bits[use]
        self.of = {}
        for log, (at, bits) in own.items():
            self.log[at], self.row[0, at] = log, np.arange(len(at))
            if log + 1 in own:  # those twice as wide, folded, come behind
                above, wide = own[log + 1]
                self.row[1, above] = len(at) + np.arange(len(above))
                bits = np.concatenate([bits, wide[:, : bits.shape[1]] ^ wide[:, bits.shape[1] :]])
            self.of[log] = bits

    def differences(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Shingles in which the sets x and y differ, at least."""
        log = np.minimum(self.log[x], self.log[y])
        out = np.empty(len(x), dtype=np.int64)
        for width in np.unique(log).tolist():
            at = np.flatnonzero(log == width)
            step = max(1, (1 << 27) >> width)
            for a in range(0, len(at), step):
                i = at[a : a + step]
                p, q = (self.row[self.log[d[i]] - width, d[i]] for d in (x, y))
                out[i] = np.bitwise_count(self.of[width][p] ^ self.of[width][q]).sum(axis=1, dtype=np.int64)
        return out


NEAR = "doc long, other long, apart long"
#: Pairs that are looked at together.
_TOGETHER = 1 << 20


def _meetings(k: np.ndarray, group: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers x * len(docs) + y of the sets x that ask for a segment and the smaller ones y that index it, not connected and
    close in size; at: the number of each record's document."""
    n = int(at.max()) + 1
    starts = np.flatnonzero(_opened(group))
    held, size = [], 0
    for a, b in zip(starts, [*starts[1:], len(k)], strict=True):
        g, d = k[a:b], at[a:b]
        x, y = np.flatnonzero(g["asks"]), np.flatnonzero(g["index"])
        s, label = g["size"].astype(np.int64), g["label"]
        step = max(1, _TOGETHER // max(1, len(y)))
        for c in range(0, len(x), step):
            i = x[c : c + step, None]
            hit = (label[i] != label[y]) & (4 * s[y] >= 3 * s[i]) & ((s[y] < s[i]) | ((s[y] == s[i]) & (d[y] < d[i])))
            p, q = np.nonzero(hit)
            held.append(d[i[p, 0]] * n + d[y[q]])
            size += len(p)
            if size > _TOGETHER:
                yield np.unique(np.concatenate(held))
                held, size = [], 0
    if held:
        yield np.unique(np.concatenate(held))


def _pairs(nearest: bool):
    """A bucket of segments: pairs whose sketches allow a link, with the difference these show; nearest: one for each set."""

    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        k, group = _useful(_records(blocks, 5, KNOWN))
        found = [np.empty((3, 0), dtype=np.int64)]
        if len(k):
            docs, at = np.unique(k["doc"], return_inverse=True)
            size = np.zeros(len(docs), dtype=np.int64)
            size[at] = k["size"]
            sketches = _Sketches(blocks, docs)
            for number in _meetings(k, group, at):
                x, y = np.divmod(number, int(at.max()) + 1)
                apart = sketches.differences(x, y)
                good = 7 * apart <= size[x] + size[y]
                found.append(np.stack([x[good], y[good], apart[good]]))
                if nearest:
                    both = np.concatenate(found, axis=1)
                    both = np.concatenate([both, both[[1, 0, 2]]], axis=1)
                    both = both[:, np.lexsort((both[1], both[2], both[0]))]
                    found = [both[:, _opened(both[0])]]
            x, y, apart = np.unique(np.concatenate(found, axis=1), axis=1)
            found = [np.stack([docs[x], docs[y], apart])]
        return pd.DataFrame(found[0].T, columns=["doc", "other", "apart"])

    return run


def _exploded(dtype: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                s = _unpacked(body.as_py(), dtype)
                for a in range(0, len(s), 100_000):
                    yield pa.record_batch([pa.array(s[n][a : a + 100_000]) for n in dtype.names], names=list(dtype.names))

    return run


def _docs_of(blocks: pd.DataFrame) -> pd.DataFrame:
    """The documents of a bucket of documents, each once."""
    return pd.DataFrame({"doc": np.unique(_records(blocks, 5, KNOWN)["doc"])})


def _set_rows(bits: np.ndarray, size: int):
    """Token sets of the documents whose hash is in a bitmap; some that are not wanted pass too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy() % size
            batch = batch.filter(pa.array((bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1))
            for data, docs, ends in _texts(batch):
                tokens, of = shingle_sets(data, ends)
                at = np.searchsorted(of, np.arange(len(docs) + 1)).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(at), pa.array(tokens.view(np.int64)))
                yield pa.record_batch([pa.array(docs), sets], names=["doc", "tokens"])

    return run


#: Bits of the bitmap of wanted documents at most; it is sent to all tasks. Beyond what it can tell apart, more sets than
#: wanted are made, and none is missing.
MOST_BITS = 1 << 26


def token_sets(read: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, tokens) of all wanted documents, and of some others, without moving the texts."""
    n = wanted.count()
    size = min(MOST_BITS, 1 << max(10, (16 * n).bit_length()))
    place = F.pmod(F.xxhash64("doc"), F.lit(size))
    words = wanted.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(pmod(p, 64) AS INT))")).alias("m"))
    bits = np.zeros(size // 64, dtype=np.int64)
    rows = words.toArrow()  # at most MOST_BITS / 64
    bits[rows["w"].to_numpy()] = rows["m"].to_numpy()
    place = F.pmod(F.xxhash64("doc"), F.lit(MOST_BITS))
    return read.select("doc", "text", place.alias("place")).mapInArrow(_set_rows(bits.view(np.uint64), size), "doc long, tokens array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link, by exact intersection."""
    pairs = staged(pairs, "ngram-pairs")
    # Both joins read staged tables, so Spark can split a hub that many sets are paired with.
    x = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("doc").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(x, "a").join(y, "b").select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("sum"))
    links = staged(joined.where(100 * F.col("both") >= PERCENT * (F.col("sum") - F.col("both"))).select("a", "b"), "ngram-links")
    discard(pairs)
    return links


#: What a bucket stands for: bytes of text, and so many bytes more for each document. The task that works on a bucket holds
#: its records at once, so their number follows the data and not the shuffle width: a wide shuffle of few data would
#: make as many blocks as there are pairs of buckets, each with next to nothing in it.
BUCKET_BYTES, DOC_BYTES = 6 << 20, 1 << 10


def _buckets(read: DataFrame) -> int:
    n, size = read.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return 1 + (size + DOC_BYTES * n) // BUCKET_BYTES


def _one_text_each(read: DataFrame) -> DataFrame:
    """read (doc, text) with one row for each doc: of several texts the one with the least hash."""
    several = staged(read.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc"), "ngram-several")
    if several.isEmpty():
        return read
    again = read.join(several, "doc", "left_semi").withColumn("h", F.xxhash64("text"))
    least = again.groupBy("doc").agg(F.min("h").alias("h"))
    again = again.join(least, ["doc", "h"], "left_semi").select("doc", "text").dropDuplicates(["doc"])
    return staged(read.join(several, "doc", "left_anti").unionByName(again), "ngram-texts")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every distinct id.

    Documents link when their sets of 5-word shingles have a Jaccard similarity of at least 0.75; a component is what
    links reach. Texts without words, and null ones, have an empty set and link with nothing. Rows without an id are left
    out, as they can't be named; repeated rows of an id are one document (of several texts, the one with the least hash).
    Shingles are told apart by 64-bit hashes: n different ones hold a pair of one hash with a chance of n^2 / 2^65. Very
    long texts are read whole. Other columns are not read; an empty table gives an empty result.
    """
    read = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("binary").alias("text")).where("doc IS NOT NULL")
    read = _one_text_each(read)
    buckets = _buckets(read)
    shared = staged(read.mapInArrow(_emit(buckets), BLOCK).groupBy("bucket").applyInPandas(_shared(buckets), BLOCK), "ngram-shared")
    info = staged(shared.where("kind = 1").mapInArrow(_exploded(INFO), "doc long, rep long, size int, own int, below int").select("doc", "rep", "size"), "ngram-info")
    asked = shared.groupBy("bucket").applyInPandas(_spend(buckets), BLOCK)
    met = staged(asked.groupBy("bucket").applyInPandas(_open(buckets, hubs=True), BLOCK), "ngram-met")
    discard(shared)
    hubs = staged(met.groupBy("bucket").applyInPandas(_hubs_of, "doc long, hub long"), "ngram-hubs")
    sets = staged(token_sets(read, hubs.select("doc")), "ngram-sets")

    ordered = [F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")]
    links = verified(hubs.where("doc <> hub").withColumnRenamed("hub", "other").select(*ordered).distinct(), sets)
    links = links.unionByName(info.where("doc <> rep").select(F.col("rep").alias("a"), F.col("doc").alias("b")))
    label = components(links)
    home = F.pmod("doc", F.lit(buckets)).cast("int").alias("bucket")
    now = label.select(F.col("node").alias("doc"), "label")
    at_segments = met.groupBy("bucket").cogroup(now.select("doc", "label", home).groupBy("bucket")).applyInPandas(_labelled(buckets, sketches=False), LABELLED).drop("sketches")
    apart = staged(at_segments.groupBy("bucket").applyInPandas(_open(buckets, hubs=False), BLOCK), "ngram-apart")
    discard(met)
    left = apart.groupBy("bucket").applyInPandas(_docs_of, "doc long")
    sketches = staged(sets.join(left, "doc", "left_semi").mapInArrow(_sketches, "doc long, sketch binary"), "ngram-sketches")

    for nearest in (True, False):
        known = sketches.join(label.withColumnRenamed("node", "doc"), "doc", "left").select("doc", F.coalesce("label", "doc").alias("label"), "sketch", home)
        at_segments = apart.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(_labelled(buckets, sketches=True), LABELLED)
        pairs = at_segments.groupBy("bucket").applyInPandas(_pairs(nearest), NEAR)
        if nearest:
            pairs = pairs.groupBy("doc").agg(F.min_by("other", F.struct("apart", "other")).alias("other"))
        links = links.unionByName(verified(pairs.select(*ordered).distinct(), sets))
        label = components(links)
    return info.join(label.withColumnRenamed("node", "doc"), "doc", "left").select(
        F.col("doc").alias("doc_id"), F.col("size").cast("long").alias("n_shingles"), F.coalesce("label", "doc").alias("component_id")
    )
