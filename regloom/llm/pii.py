"""Personal data by candidate gradient boosting, in DataFrame functions only.

Two layers find spans. Base rules are exact formats with checks; their spans always stay. High-recall generators propose
further, overlapping spans; boosted trees score each from its format and context, and a threshold calibrated for each
kind on the documents outside the fit selects what is added. The trees are fitted by Spark ML on weak labels and applied
as plain `when` expressions within each document's row.

A candidate is labelled good if its normal form (separators, at/dot words and prefixes rewritten) passes the base checks.
The trees see the normal form and the context, so that rewritten forms score like plain ones; of the surface form they see
only whether it is a bare run of digits.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Base formats. The lookbehinds and possessive quantifiers match the same spans as the plain patterns, without retries
#: from within a run of characters and without recursion on long ones.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of wider candidates.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]{1,63}){1,4}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:[.:][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20./-]?[0-9]{3,6}){2,4}(?![0-9])",
    "phone": r"(?<![0-9+])(?:(?:(?:\+[0-9]{1,4}|00[1-9][0-9]{0,2})(?:\x20?\(0\))?|\([0-9]{2,5}\)|0[1-9][0-9]{1,3})(?:(?:[\x20./-]{1,2}\(?|\()[0-9]{2,8}\)?){1,4}|\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,4}){2,4}|00[1-9][0-9]{7,13})(?![0-9])",
}
#: What a text must hold for a kind's patterns to be tried at all: one cheap scan for most texts.
HINT = {
    "email": r"@|[(\[{]at[)\]}]",
    "ip": r"[0-9][.:][0-9]",
    "card": r"[0-9](?:[\x20./-]?[0-9]){9}",
    "phone": r"\+[0-9]|[0-9)][\x20./-]{1,2}\(?[0-9]|00[1-9][0-9]{7}|\([0-9]{2,5}\)[\x20./-]",
}
CONTEXT = 24
WORDS = {"email": "mail|contact|write|@", "ip": "ip|addr|host|server|from", "card": "card|visa|pay|credit|account", "phone": "phone|tel|call|mobile|fax"}
#: The fit: at most this many documents, by hash, without every fifth of them. All other documents calibrate.
SAMPLE_DOCS = 20_000
#: Tasks that hold the bounded sample; the scan that finds it has as many as its table.
FIT_TASKS = 6
TREES, DEPTH = 20, 3
#: A kind's precision is drawn to that of all kinds by as much as this many candidates weigh.
PRECISION, WEIGHT = 0.99, 20


def located(text: Column, pattern: str) -> Column:
    """array<struct<s, e, v>> of the non-overlapping matches of pattern, offsets in code points."""
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("v")
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,v:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["gap"])
        e = s + F.length(x["v"])
        return F.struct(e.alias("at"), F.array_append(acc["out"], F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v"))).alias("out"))

    return F.aggregate(F.filter(found, lambda x: x["v"].isNotNull()), zero, step, lambda acc: acc["out"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(v: Column) -> Column:
    d = F.reverse(_digits(v))

    def add(acc: Column, i: Column) -> Column:
        x = d.substr(i, F.lit(1)).cast("int")
        twice = x * 2
        return acc + F.when(i % 2 == 1, x).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    n = F.length(_digits(v))
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= "255")
        return F.forall(F.split(v, r"\."), small)
    if kind == "card":
        return n.between(16, 19) & _luhn(v)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


SPAN = "array<struct<k:int,s:int,e:int>>"
FEATURES = (
    "is_email", "is_ip", "is_card", "is_phone", "chars", "digits", "letters", "dots", "dashes", "checked", "year", "bare",
    "before_word", "after_word", "before_digit", "after_digit", "keyword", "line_start",
)
AT, DOT = r"\x20?[(\[{]at[)\]}]\x20?", r"\x20?[(\[{]dot[)\]}]\x20?"
YEAR = r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])"
#: Digits of a phone without a country code.
NATIONAL = (9, 12)


def _normal(kind: str, v: Column) -> Column:
    """A candidate's value without what rewritten forms change: separators, words for signs, prefixes."""
    if kind == "email":
        return F.regexp_replace(F.regexp_replace(v, AT, "@"), DOT, ".")
    if kind == "ip":
        return F.translate(v, ":", ".")
    if kind == "card":
        return _digits(v)
    return F.regexp_replace(_digits(F.regexp_replace(v, r"\(0\)", "")), "^00", "")


def _good(kind: str, v: Column, before: Column) -> Column:
    """The weak label: does the normal form pass the base checks, with signs of its kind?"""
    n = _normal(kind, v)
    if kind == "email":  # blanks are left where no word for a sign explains them
        return n.rlike("^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+$")
    if kind == "ip":  # one separator throughout: 10:20:30.400 is a time
        return ~(v.contains(":") & v.contains(".")) & _valid("ip", n)
    if kind == "card":
        return _valid("card", n)
    said = F.lower(before).rlike(f"({WORDS['phone']})[^0-9\n]{{0,12}}$")
    # a bare run of digits that happens to start with 00 is no phone unless a word says so
    abroad = (v.rlike("^[+]") | (v.rlike("^00[1-9]") & (v.rlike("[^0-9]") | said))) & _valid("phone", n)
    sign = v.rlike("^([(]|0[1-9])") | said
    return abroad | (sign & F.length(n).between(*NATIONAL) & ~v.rlike(YEAR) & ~v.rlike("^[0-9]+([.][0-9]+){3}$"))


def _before(x: Column, text: Column) -> Column:
    start = F.greatest(x["s"] - CONTEXT, F.lit(0))
    return text.substr(start + 1, x["s"] - start)


def _features(k: int, x: Column, text: Column) -> Column:
    v = _normal(KINDS[k], x["v"])
    before, after = _before(x, text), text.substr(x["e"] + 1, F.lit(2))
    count = lambda p: F.length(F.regexp_replace(v, f"[^{p}]", ""))
    flag = lambda c: c.cast("double")
    return F.struct(
        *[F.lit(float(k == i)).alias(f"is_{kind}") for i, kind in enumerate(KINDS)],
        F.length(v).cast("double").alias("chars"),
        count("0-9").cast("double").alias("digits"),
        count("A-Za-z").cast("double").alias("letters"),
        count(".").cast("double").alias("dots"),
        count("-").cast("double").alias("dashes"),
        flag(v.rlike("[.][A-Za-z]{2,}$") if KINDS[k] == "email" else _valid(KINDS[k], v)).alias("checked"),
        flag(x["v"].rlike(YEAR)).alias("year"),
        flag(x["v"].rlike("^[0-9]+$")).alias("bare"),
        flag(before.rlike(r"[A-Za-z_]$")).alias("before_word"),
        flag(after.rlike(r"^[A-Za-z_]")).alias("after_word"),
        flag(before.rlike(r"[0-9][^A-Za-z0-9]?$")).alias("before_digit"),
        flag(after.rlike(r"^[^A-Za-z0-9]?[0-9]")).alias("after_digit"),
        flag(F.lower(before).rlike(WORDS[KINDS[k]])).alias("keyword"),
        flag((before == "") | before.endswith("\n")).alias("line_start"),
    )


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add __base (array<k, s, e>, in the order of kind and start) and __wide (array<k, s, e, same, known, good, f>) to documents.

    __wide holds the generators' candidates; same: it equals a base span of its kind; known: it equals or overlaps a base
    span; good: its weak label.
    """
    text = F.col("__text")
    none = F.array().cast("array<struct<s:int,e:int,v:string>>")
    d = docs.withColumn("__text", text_or_empty(text_col))
    d = d.withColumns({f"__h{k}": text.rlike(HINT[kind]) for k, kind in enumerate(KINDS)})
    d = d.withColumns({f"__b{k}": F.when(F.col(f"__h{k}") if kind != "card" else text.rlike("[0-9]"), located(text, BASE[kind])).otherwise(none) for k, kind in enumerate(KINDS)})
    d = d.withColumns({f"__w{k}": F.when(F.col(f"__h{k}"), located(text, WIDE[kind])).otherwise(none) for k, kind in enumerate(KINDS)})

    def kept(k: int) -> Column:
        valid = F.filter(f"__b{k}", lambda x: _valid(KINDS[k], x["v"]))
        return F.transform(valid, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    d = d.withColumn("__base", F.concat(*map(kept, range(len(KINDS)))).cast(SPAN))

    def candidate(k: int, base: Column, x: Column) -> Column:
        same = F.exists(base, lambda b: (b["k"] == k) & (b["s"] == x["s"]) & (b["e"] == x["e"]))
        meets = F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
        return F.struct(
            F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), same.alias("same"), meets.alias("known"),
            (same | _good(KINDS[k], x["v"], _before(x, text))).alias("good"), _features(k, x, text).alias("f"),
        )

    # As the variable of an outer lambda the base spans are found once for a text, not once for each candidate.
    every = lambda base: F.concat(*[F.transform(f"__w{k}", partial(candidate, k, base)) for k in range(len(KINDS))])
    wide = F.get(F.transform(F.array("__base"), every), 0)
    return d.withColumn("__wide", wide).drop("__text", *[f"__{p}{k}" for p in "hbw" for k in range(len(KINDS))])


class SpanModel:
    """Boosted trees as expressions over the feature struct, and a threshold for each kind (above 1: adds nothing)."""

    def __init__(self, score: Callable[[Column], Column] | None, thresholds: tuple[float, ...]):
        self.score, self.thresholds = score, thresholds

    def added(self, wide: Column) -> Column:
        """The candidates above their thresholds that meet no base span and no better candidate."""
        if self.score is None or min(self.thresholds) > 1:
            return F.array().cast(SPAN)
        limit = F.array(*map(F.lit, self.thresholds))
        scored = F.transform(
            F.filter(wide, lambda x: ~x["known"]),
            lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"), self.score(x["f"]).alias("p")),
        )
        good = F.filter(scored, lambda x: x["p"] >= F.get(limit, x["k"]))
        better = lambda y, x: (y["s"] < x["e"]) & (x["s"] < y["e"]) & (F.struct(y["p"], -y["s"], y["e"], -y["k"]) > F.struct(x["p"], -x["s"], x["e"], -x["k"]))
        best = F.filter(good, lambda x: ~F.exists(good, lambda y: better(y, x)))
        return F.transform(best, lambda x: F.struct(x["k"], x["s"], x["e"])).cast(SPAN)


def _tree(node, f: Column) -> Column:
    """A fitted regression tree as nested conditions."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    s = node.split()
    return F.when(f[FEATURES[s.featureIndex()]] <= float(s.threshold()), _tree(node.leftChild(), f)).otherwise(_tree(node.rightChild(), f))


def _judged(docs: DataFrame) -> DataFrame:
    """k, label, free, f of the candidates that are base spans or meet none; free: it meets none, so it can be added."""
    rows = with_candidates(docs).select(F.inline("__wide")).where("same OR NOT known")
    return rows.select("k", F.col("good").cast("double").alias("label"), (~F.col("known")).alias("free"), "f")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> SpanModel:
    """Fit the trees on the candidates of at most sample_docs documents, chosen by hash of the id, and the thresholds on all others.

    The thresholds follow from all other documents, see thresholds_of(). Null texts are empty ones; rows without an id are not
    fitted on but calibrate; rows of one id are fitted on together; an empty table gives a model that adds nothing.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    nothing = SpanModel(None, (2.0,) * len(KINDS))
    docs = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    chosen = docs.select("__id").where(F.col("__id").isNotNull()).distinct().orderBy(F.xxhash64("__id")).limit(sample_docs)
    fitted = staged(chosen.where(F.pmod(F.xxhash64(F.lit("fold"), "__id"), F.lit(5)) != 0), "pii-fitted")
    rows = _judged(docs.join(F.broadcast(fitted), "__id", "left_semi")).select("label", "f.*")
    train = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("features", "label").repartition(FIT_TASKS).cache()
    seen = {r["label"] for r in train.select("label").distinct().collect()}
    if 1.0 not in seen:
        train.unpersist()
        return nothing
    trees, weights = [], []
    if 0.0 in seen:  # else nothing tells the candidates apart, and all score 1
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(train)
        trees, weights = [t._call_java("rootNode") for t in model.trees], list(model.treeWeights)
    train.unpersist()

    def score(f: Column) -> Column:
        if not trees:
            return F.lit(1.0)
        raw = sum((w * _tree(t, f) for w, t in zip(weights, trees, strict=True)), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * raw))

    held = _judged(docs.join(F.broadcast(fitted), "__id", "left_anti")).select("k", "label", "free", F.floor(score(F.col("f")) * 100).alias("bin"))
    counts = held.groupBy("k", "free", "bin").agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()  # 8 x 101 rows at most
    return SpanModel(score, thresholds_of([(r["k"], r["free"], r["bin"], r["good"], r["n"]) for r in counts]))


def thresholds_of(counts: list[tuple[int, bool, int, float, int]]) -> tuple[float, ...]:
    """A threshold for each kind from (kind, free, hundredth of the score, good ones, all) of the calibrating candidates.

    The lowest score from which on a kind's candidates are good often enough, its rate being drawn to that of all kinds by as
    much as WEIGHT candidates weigh, and those of them that can be added are too. So a kind with few candidates, or none,
    leans on the others, by the same rule at every size. Above 1, so that nothing is added, where no score is good enough.
    """
    rate = lambda rows: (sum(r[3] for r in rows), sum(r[4] for r in rows))
    out = []
    for k in range(len(KINDS)):
        best = 2.0
        for at in sorted({r[2] for r in counts}, reverse=True):
            above = [r for r in counts if r[2] >= at]
            good, n = rate(above)
            own_good, own = rate([r for r in above if r[0] == k])
            free_good, free = rate([r for r in above if r[0] == k and r[1]])
            if own_good + WEIGHT * good / n >= PRECISION * (own + WEIGHT) and free_good >= PRECISION * free:
                best = at / 100
        out.append(best)
    return tuple(out)


def find(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """Add __base and __spans (base and added ones), arrays of (k, s, e) in the order of kind and start, to documents.

    All rows and columns stay as they are; a null or empty text has no spans; names that start with two underscores are
    this module's own.
    """
    d = with_candidates(docs, text_col)
    spans = F.array_sort(F.concat("__base", model.added(F.col("__wide"))))
    return d.withColumn("__spans", spans).drop("__wide")


def _told(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_<kind> of the base spans, base_sha256 and spans for each row.

    A null text is an empty one and has no spans; null ids and repeated rows are rows of their own; other columns are not
    read; an empty table gives an empty result.
    """
    d = find(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    of_kind = lambda k: F.filter("__base", lambda x: x["k"] == k)
    n = [F.size(of_kind(k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return d.select("doc_id", *n, F.sha2(_told("__base"), 256).alias("base_sha256"), _told("__spans").alias("spans"))


def redact(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """Replace every span of a text by its kind in brackets; overlapping spans are replaced by the first one's.

    All rows stay, repeated ones and those with null ids too, in texts of any length; null and empty texts stay as they
    are; other columns stay, whatever their names; an empty table gives an empty result.
    """
    columns = docs.columns
    d = find(docs, model, text_col)
    by_place = F.array_sort(F.transform("__spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    text = F.col(text_col)

    def step(acc: Column, x: Column) -> Column:
        new = x["s"] >= acc["at"]
        gap = text.substr(acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        parts = F.when(new, F.concat(acc["out"], F.array(gap, F.get(names, x["k"])))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), parts.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    whole = lambda acc: F.concat(F.array_join(acc["out"], ""), text.substr(acc["at"] + 1, F.length(text)))
    clean = F.when(F.size("__spans") > 0, F.aggregate(by_place, zero, step, whole)).otherwise(text)
    return d.withColumn(text_col, clean).select(*columns)
