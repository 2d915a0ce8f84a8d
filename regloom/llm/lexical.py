"""Ranked lexical search by pipelined term partitioning.

Postings of the terms that items ask for are owned by STAGES term owners: the rarest terms belong to the first, and each
owns about as many postings as the others. Items travel in bundles. A bundle carries a sparse accumulator of scores by
document for each of its items; each owner in turn adds the integer contributions of its terms (a cogroup of bundles and
postings), and what the last owner hands on is cut to the best documents. Documents are dealt to blocks, and a bundle
meets the postings of one block at a time, so a term that every document holds is spread like all others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

K = 10
STAGES = 4
#: Documents of a block and items of a bundle, on average.
BLOCK, BUNDLE = 4096, 256
#: So many wanted terms are sent to all tasks at most (some MB), to leave out other terms' postings early; else a join does.
MOST_SENT = 100_000
#: Steps of document frequency by which terms are dealt to owners.
_STEPS = 64

#: Bytes of UTF-8: letters and digits of ASCII, lower-cased, and all bytes of other characters make terms; the rest parts them.
_TO_TERMS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_TERMS).split() if text else []


def _term_rows(wanted: frozenset[bytes] | None):
    """For each row (key, text): (key, null, number of terms) and a (key, term, times) for each of its (wanted) terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, terms, times = [], [], []

            def rows():
                return pa.record_batch([pa.array(keys, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], names=["key", "term", "times"])

            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                found = terms_of(text.as_py())
                own = [(t, n) for t, n in Counter(found).items() if wanted is None or t in wanted]
                keys += [key] * (len(own) + 1)
                terms += [None, *(t for t, _ in own)]
                times += [len(found), *(n for _, n in own)]
                if len(keys) > 200_000:
                    yield rows()
                    keys, terms, times = [], [], []
            yield rows()

    return run


def term_counts(texts: DataFrame, wanted: frozenset[bytes] | None = None) -> DataFrame:
    """key, term, times of a table (key long, text): a row with a null term and the number of terms, and one for each term."""
    return texts.mapInArrow(_term_rows(wanted), "key long, term string, times long")


STATE = "g int, b int, item long, terms array<string>, times array<long>, docs array<long>, scores array<long>"


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else np.empty(0, np.int64), pa.int64()))


def _stage(keep: int | None):
    """Add what this owner's terms contribute; keep that many of the best documents of each item, or all."""

    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        terms = postings["term"].combine_chunks().dictionary_encode()
        at, doc, gain = terms.indices.to_numpy(), postings["doc"].to_numpy(), postings["gain"].to_numpy()
        order = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(len(terms.dictionary) + 1))
        of = {t: order[ends[i] : ends[i + 1]] for i, t in enumerate(terms.dictionary.to_pylist())}
        carried = [x.values.to_numpy() for x in bundle["docs"]]
        docs = np.unique(np.concatenate([doc, *carried])) if len(bundle) else np.empty(0, np.int64)
        slot = np.searchsorted(docs, doc)
        total = np.zeros(len(docs), dtype=np.int64)
        out_docs, out_scores = [], []
        for i, (own_terms, own_times) in enumerate(zip(bundle["terms"].to_pylist(), bundle["times"].to_pylist(), strict=True)):
            total[:] = 0
            total[np.searchsorted(docs, carried[i])] = bundle["scores"][i].values.to_numpy()
            for t, n in zip(own_terms, own_times, strict=True):
                if (rows := of.get(t)) is not None:
                    total[slot[rows]] += n * gain[rows]  # a document is once among a term's postings
            use = np.flatnonzero(total)
            if keep and len(use) > keep:
                use = use[total[use] >= np.partition(total[use], len(use) - keep)[len(use) - keep]]
            out_docs.append(docs[use])
            out_scores.append(total[use])
        same = [bundle[n].combine_chunks() for n in ("g", "b", "item", "terms", "times")]
        return pa.table([*same, _lists(out_docs), _lists(out_scores)], names=["g", "b", "item", "terms", "times", "docs", "scores"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = K, stages: int = STAGES, most_sent: int = MOST_SENT, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id, score: for each item the k documents of the highest score above 0, equal scores by ascending doc_id.

    With N documents that hold a term, L terms in them, n terms in a document, tf of a term in it and df documents that
    hold the term: weight w = floor(1000 ln((2N+2)/(2df+1))), m = 25 + (75 n N div L), score = sum over the item's terms,
    repeats included, of w * ((10^9 tf) div (1000 tf + 8 m)), in whole numbers.

    Null and empty texts hold no terms. Each row of docs is a document of its own, repeated rows and null ids too (null
    ids come last among ties). Rows of one item id, null included, are one item with the terms of all its different texts.
    Whole texts are read. An item without terms, or an empty table, gives no rows. Other columns are not read. Ids are whole
    numbers.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("key"), F.col(text_col).alias("text")).distinct()
    asked = term_counts(asked).where("term IS NOT NULL").groupBy("key", "term").agg(F.sum("times").alias("times"))
    asked = staged(asked.withColumnRenamed("key", "item"), "asked")
    wanted = asked.select("term").distinct()
    sent = wanted.limit(most_sent + 1).collect()
    few = frozenset(r["term"].encode() for r in sent) if len(sent) <= most_sent else None

    numbered = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    held = numbered.mapInArrow(_with_id(_term_rows(few)), "doc long, id long, term string, times long, n long")
    if few is None:
        held = held.join(wanted.withColumn("wanted", F.lit(True)), "term", "left").where("term IS NULL OR wanted").drop("wanted")
    held = staged(held, "postings")
    all_docs = held.where("term IS NULL")
    n_docs, with_terms, length = all_docs.agg(F.count("*"), F.count_if(F.col("n") > 0), F.sum("n")).first()
    blocks = max(1, -(-n_docs // BLOCK))
    postings = held.where("term IS NOT NULL")
    df = staged(_owned(postings.groupBy("term").agg(F.count("*").alias("df")), with_terms, stages), "terms")
    gain = F.expr(f"w * ((1000000000 * times) div (1000 * times + 8 * (25 + (75 * n * {with_terms}L) div {length or 1}L)))")
    block = F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int").alias("b")

    # bundles: items by hash; a term goes to the bundles that ask for it
    n_items = asked.select("item").distinct().count()
    bundles = max(1, -(-n_items // BUNDLE))
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int")
    by_item = asked.groupBy("item").agg(F.collect_list(F.struct("term", "times")).alias("asked"))
    nothing = F.array().cast("array<long>")
    state = by_item.select(
        bundle.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), "item", F.col("asked.term").alias("terms"), F.col("asked.times").alias("times"), nothing.alias("docs"), nothing.alias("scores")
    )
    goes_to = asked.select("term", bundle.alias("g")).distinct().join(df, "term")
    for s in range(stages):
        own = postings.join(goes_to.where(F.col("stage") == s), "term").select("g", block, "term", "doc", gain.alias("gain")).where("gain > 0")
        state = state.groupBy("g", "b").cogroup(own.groupBy("g", "b")).applyInArrow(_stage(k if s == stages - 1 else None), STATE)
    found = state.select("item", F.explode(F.arrays_zip("docs", "scores")).alias("x")).select("item", F.col("x.docs").alias("doc"), F.col("x.scores").alias("score"))
    named = found.join(all_docs.select("doc", "id"), "doc")
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    best = named.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def _with_id(term_rows):
    """(doc, id, term, times, n) of rows (key, id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column(0).to_numpy(), batch.column(1)
            n = np.zeros(len(keys), dtype=np.int64)
            for rows in term_rows([pa.record_batch([batch.column(0), batch.column(2)], names=["key", "text"])]):
                at = np.searchsorted(keys, rows.column(0).to_numpy())  # keys ascend
                head = np.flatnonzero(rows.column(1).is_null().to_numpy(zero_copy_only=False))
                n[at[head]] = rows.column(2).to_numpy()[head]
                yield pa.record_batch([rows.column(0), ids.take(pa.array(at)), rows.column(1), rows.column(2), pa.array(n[at])], names=["doc", "id", "term", "times", "n"])

    return run


def _owned(df: DataFrame, with_terms: int, stages: int) -> DataFrame:
    """term, w, stage: terms in steps of their document frequency, rarest first, cut where the postings before are a share of all.

    The steps are powers, so that their number is fixed; one table of at most _STEPS rows says which owner has a step.
    """
    step = F.least(F.lit(_STEPS - 1), F.floor(F.log2("df") * 2)).cast("int")
    w = F.floor(1000 * F.log((2.0 * with_terms + 2) / (2.0 * F.col("df") + 1))).cast("long")
    df = df.select("term", "df", w.alias("w"), step.alias("step"))
    sizes = df.groupBy("step").agg(F.sum("df").alias("held"))
    before = F.sum("held").over(W.orderBy("step").rowsBetween(W.unboundedPreceding, -1))
    all_ = F.sum("held").over(W.orderBy("step").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    owner = F.least(F.lit(stages - 1), F.floor(F.coalesce(before, F.lit(0)) * stages / all_)).cast("int")
    return df.join(F.broadcast(sizes.select("step", owner.alias("stage"))), "step").select("term", "w", "stage")
