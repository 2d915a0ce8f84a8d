"""URL predicates, parameters and builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))


def param(u: Column, name: str) -> Column:
    """Decoded value of a query parameter, the first that is not blank; null without it."""
    pattern = rf"^[^?#]*\?(?:[^#]*?&)??{name}=([^&#]+)"
    return F.try_url_decode(F.get(F.regexp_extract_all(u, F.lit(pattern), F.lit(1)), F.lit(0)))


def official(u: Column, suffixes: Sequence[str]) -> Column:
    """https, and the host is or ends with an allowed suffix."""
    h = host(u)
    ok = F.lit(False)
    for s in suffixes:
        ok = ok | (h == s) | h.endswith("." + s)
    return F.coalesce((scheme(u) == "https") & ok, F.lit(False))


def scoped_route(u: Column, level: Column, host_: str, province: str, ward: str, province_level: str = "cấp tỉnh") -> Column:
    """struct(ok, route): the route that a submission link takes, ward or province, else the first reason why it takes none.

    Reasons in order: invalid_url, invalid_host, wrong_province, and for a record of province level
    province_missing_isProvince, province_forced_to_ward, for others wrong_ward, wrong_commune, ward_wrong_isProvince.
    """
    u = F.trim(F.coalesce(u, F.lit("")))
    par = lambda name: F.coalesce(param(u, name), F.lit(""))
    authority = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    torn = authority.contains("[") != authority.contains("]")
    above = F.lower(F.trim(F.coalesce(level, F.lit("")))).startswith(province_level)
    forced = F.lit(False)
    for name in ("wardCode", "ward", "agency", "departmentId", "commune"):
        forced = forced | (par(name) != "")
    reason = (
        F.when(torn, "invalid_url")
        .when((scheme(u) != "https") | (host(u) != host_), "invalid_host")
        .when(par("provinceCode") != province, "wrong_province")
        .when(above & (par("isProvince") != "1"), "province_missing_isProvince")
        .when(above & forced, "province_forced_to_ward")
        .when(~above & (par("wardCode") != ward), "wrong_ward")
        .when(~above & (par("commune") != "WARD"), "wrong_commune")
        .when(~above & (par("isProvince") != "0"), "ward_wrong_isProvince")
    )
    return F.struct(reason.isNull().alias("ok"), F.coalesce(reason, F.when(above, "province").otherwise("ward")).alias("route"))


def encoded(x: Column) -> Column:
    """A component of a url: all but letters, digits and -_.!~*'() as percent codes of UTF-8, blanks too."""
    out = F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))
    for c in "!'()~":
        out = F.replace(out, F.lit(f"%{ord(c):X}"), F.lit(c))
    return out


def build(base: str, params: Mapping[str, Column]) -> Column:
    """base?name=value&…, values encoded; parameters with a blank value are left out."""
    parts = [F.when(v.isNotNull() & (v != ""), F.concat(F.lit(f"{k}="), F.url_encode(v))) for k, v in params.items()]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *parts))


def submission_url(base: str, common: Mapping[str, str], scope: Column, by_scope: Mapping[str, Mapping[str, str]], id_param: str, fid: Column, word_param: str, word: Column) -> Column:
    """A scoped link: fixed parameters, those of the row's scope, and the id or else the keyword."""
    out = None
    for name, own in by_scope.items():
        fixed = {k: F.lit(v) for k, v in {**common, **own}.items()}
        url = F.when(fid.isNotNull() & (fid != ""), build(base, {**fixed, id_param: fid})).otherwise(build(base, {**fixed, word_param: word}))
        out = F.when(scope == name, url) if out is None else out.when(scope == name, url)
    return out
