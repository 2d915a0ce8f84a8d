"""Content-hashed evidence ids, fingerprints and field-level references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(columns: Mapping[str, Column]) -> Column:
    """Compact JSON with sorted keys; nulls stay as null."""
    return F.to_json(F.struct(*[columns[k].alias(k) for k in sorted(columns)]), {"ignoreNullFields": "false"})


def evidence_id(columns: Mapping[str, Column], prefix: str = "ev_", digits: int = 24) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(canonical_json(columns)), 1, digits))


def row_fingerprint(columns: Mapping[str, Column]) -> Column:
    return F.sha2(canonical_json(columns), 256)


def git_blob_sha1(content: Column) -> Column:
    """Blob id of bytes with line endings as \\n. ISO-8859-1 keeps every byte through the replacement."""
    body = F.encode(F.replace(F.decode(content, "ISO-8859-1"), F.lit("\r\n"), F.lit("\n")), "ISO-8859-1")
    head = F.encode(F.concat(F.lit("blob "), F.octet_length(body).cast("string")), "UTF-8")
    return F.sha1(F.concat(head, F.unhex(F.lit("00")), body))


def bundle_fingerprint(path: Column, blob: Column) -> Column:
    """Aggregate: sha1 over the sorted path, NUL, blob lines of a bundle."""
    lines = F.collect_list(F.concat(path, F.lit("\0"), blob, F.lit("\n")))
    return F.sha1(F.array_join(F.sort_array(lines), ""))


def infer_role(role: Column, u_host: Column, by_suffix: Sequence[tuple[str, str]], default: str) -> Column:
    """The explicit role, else that of the first host suffix that fits."""
    out = F.when(role.isNotNull() & (role != ""), role)
    for suffix, value in by_suffix:
        out = out.when((u_host == suffix) | u_host.endswith("." + suffix), value)
    return out.otherwise(default)


def resolve_refs(refs: Column, id_of: Column, evidence: Column, role: str | None = None) -> Column:
    """Source ids to evidence ids by a map, kept to a role; without any left, all of the role."""
    good = F.transform(F.filter(evidence, lambda e: F.lit(role is None) | (e["role"] == role)), lambda e: e["id"])
    got = F.array_distinct(F.filter(F.transform(refs, lambda r: F.try_element_at(id_of, r)), lambda x: x.isNotNull() & F.array_contains(good, x)))
    return F.when(F.size(got) > 0, got).otherwise(good)


def dangling(refs: Column, ids: Column) -> Column:
    """References without evidence."""
    return F.array_except(refs, ids)


def first_by_id(evidence: Column) -> Column:
    """Evidence structs, the first of each id, in order."""
    ids = F.transform(evidence, lambda e: e["id"])
    return F.filter(evidence, lambda e, i: F.array_position(ids, e["id"]) == i + 1)


def effective_from(evidence: Column, role: str) -> Column:
    """Latest date of evidence of a role that does not repeal."""
    legal = F.filter(evidence, lambda e: (e["role"] == role) & ~e["repeal"] & (e["date"] != ""))
    return F.array_max(F.transform(legal, lambda e: e["date"]))


def field_sources(values: Mapping[str, Column], ids: Column) -> Column:
    """map(field -> ids) of the fields that are filled."""
    entries = F.array(*[F.when(v.isNotNull() & (v.cast("string") != ""), F.struct(F.lit(k).alias("key"), ids.alias("value"))) for k, v in values.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e.isNotNull()))


def changes(before: Mapping[str, Column], after: Mapping[str, Column]) -> Column:
    """array<struct<field, before, after>> of what differs, nulls compared as values."""
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), before[k].cast("string").alias("before"), after[k].cast("string").alias("after")) for k in before])
    return F.filter(pairs, lambda p: ~p["before"].eqNullSafe(p["after"]))


def change_json(changed: Column, side: str) -> Column:
    """JSON object of one side of changes()."""
    return F.to_json(F.map_from_entries(F.transform(changed, lambda p: F.struct(p["field"], p[side]))), {"ignoreNullFields": "false"})
