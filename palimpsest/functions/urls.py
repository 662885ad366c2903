"""URL functions.  All but ``canonical_url`` and ``resolve_references`` are Column expressions."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import SplitResult, parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.profile import ASSETS, ATTACHMENTS, FORUM, PAGES, SiteProfile

#: Replay addresses, paths of attachments.
REPLAY = r"(?i)^https?://web\.archive\.org/web/\d+(?:id_|im_|js_|cs_)?/(https?://.+)$"
ATTACHMENT_PATH = r"(?i)/(attach(ment)?|download|files?)(/|\.|$)"


def unwrap_replay(url: Column) -> Column:
    """The archived address inside a replay address; other addresses as they are."""
    inner = F.regexp_extract(url, REPLAY, 1)
    return F.when(inner == "", url).otherwise(inner)


def host(url: Column) -> Column:
    """Host in lower case, without port, trailing dots and a leading ``www.``."""
    raw = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.regexp_replace(F.lower(raw), r"\.+$", ""), r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query_string(url: Column) -> Column:
    return F.regexp_extract(url, r"\?([^#]*)", 1)


def extension(p: Column) -> Column:
    return F.regexp_extract(F.lower(p), r"\.([^./]*)$", 1)


def in_scope(url: Column, profile: SiteProfile = FORUM, timestamp: Column | None = None) -> Column:
    """Is this an address of the archived forum?"""
    h, p = host(url), F.lower(path(url))
    under = F.lit(False)
    for era in profile.eras:
        for prefix in era.prefixes:
            under |= p.startswith(prefix)
    bare = p.isin(*profile.bare_paths)
    for prefix in profile.bare_prefixes:
        bare |= p.startswith(prefix)
    early = F.lit(False) if timestamp is None else F.coalesce(F.substring(timestamp, 1, 4) < "2000", F.lit(False))
    return h.isin(*profile.hosts) & (under | ((h == profile.bare_host) & ~early & bare))


def era(url: Column, profile: SiteProfile = FORUM, timestamp: Column | None = None) -> Column:
    """Name of the generation of software, null outside the site."""
    h, p = host(url), F.lower(path(url))
    early = F.lit(False) if timestamp is None else F.coalesce((timestamp != "") & (timestamp < profile.bare_until), F.lit(False))
    out = F.when(h == profile.bare_host, F.when(early, profile.bare_before).otherwise(profile.bare_after))
    for e in reversed(profile.eras):
        starts = F.lit(False)
        for prefix in e.prefixes:
            starts |= p.startswith(prefix)
        out = F.when(starts, F.lit(e.name)).otherwise(out)
    return F.when(h.isin(*profile.hosts), out)


def resource_kind(url: Column, scope: Column | None = None) -> Column:
    """attachment, asset, page or external; ``scope`` says which addresses can be pages."""
    p = path(url)
    ext = extension(p)
    last = F.regexp_extract(F.regexp_replace(p, "/+$", ""), r"([^/]*)$", 1)
    odd = F.try_url_decode(p).rlike(r"""[\s*<>"{}|]""")
    navigable = (scope if scope is not None else in_scope(url)) & ((last == "") | p.endswith("/") | F.when(last.contains("."), ext.isin(*PAGES)).otherwise(~F.coalesce(odd, F.lit(False))))
    return (
        F.when(F.lower(p).rlike(ATTACHMENT_PATH) | ext.isin(*ATTACHMENTS), "attachment")
        .when(ext.isin(*ASSETS), "asset")
        .when(navigable, "page")
        .otherwise("external")
    )


def _identity_host(parts: SplitResult) -> str:
    """Bare host, with a port that isn't a web server's usual one."""
    name = (parts.hostname or "").lower().rstrip(".").removeprefix("www.")
    return f"{name}:{parts.port}" if name and parts.port not in (None, 80, 443) else name


def _identity_path(path: str, fold: bool) -> str:
    """Single slashes; on the archived hosts lower case, but for files whose names may differ by case."""
    path = re.sub("/{2,}", "/", path or "/")
    last = path.rpartition("/")[2]
    ending = last.rpartition(".")[2].lower() if "." in last else ""
    return path.lower() if fold and ending not in {*ASSETS, *ATTACHMENTS} else path


def _identity_query(query: str, profile: SiteProfile) -> str:
    """Sorted pairs without sessions and without the start of a first page."""

    def matters(pair: tuple[str, str]) -> bool:
        key = pair[0].lower()
        return key not in profile.session_keys and (key != profile.start_key or pair[1] not in ("", "0"))

    pairs = filter(matters, parse_qsl(query, keep_blank_values=True))
    return urlencode(sorted(pairs, key=lambda pair: (pair[0].casefold(), pair[1])))


def canonical(url: str, profile: SiteProfile = FORUM) -> str:
    """One spelling for an address: ``http``, bare host, sorted query without session keys, no fragment."""
    url = html.unescape(url.strip())
    replayed = re.match(REPLAY, url)
    url = re.sub(r"%5C075|\\075", "=", replayed[1] if replayed else url, flags=re.I)
    try:
        parts = urlsplit(url)
        host = _identity_host(parts)
    except ValueError:
        return ""
    if not host:
        return url
    path = _identity_path(parts.path, host.partition(":")[0] in profile.hosts)
    return urlunsplit(("http", host, path, _identity_query(parts.query, profile), ""))


def canonical_url(profile: SiteProfile = FORUM):
    """Arrow-batched ``canonical`` as a column function."""

    @F.pandas_udf(T.StringType())
    def run(urls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in urls:
            yield s.map(lambda u: None if u is None else canonical(u, profile))

    return run


REFERENCES = T.ArrayType(T.StructType([T.StructField("url", T.StringType()), T.StructField("is_asset", T.BooleanType())]))


def resolve(base: str, references: list[tuple[str, bool]], profile: SiteProfile = FORUM) -> list[tuple[str, bool]]:
    """Canonical absolute addresses of references, once each in order; an asset stays one."""
    found: dict[str, bool] = {}
    for raw, asset in references:
        raw = html.unescape(raw.strip())
        if not raw or raw.startswith("#") or raw.lower().startswith(("data:", "javascript:", "mailto:", "tel:")):
            continue
        try:
            url = urljoin(base, raw)
        except ValueError:
            continue
        if url.lower().startswith(("http://", "https://")) and (url := canonical(url, profile)):
            found[url] = found.get(url, False) or asset
    return list(found.items())
