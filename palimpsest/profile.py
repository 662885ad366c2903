"""What is known about the archived sites; all site-specific rules are data here."""

from __future__ import annotations

from dataclasses import dataclass

#: Extensions by kind.
ASSETS = ("avif", "bmp", "css", "cur", "eot", "gif", "ico", "jpeg", "jpg", "js", "mjs", "mp3", "mp4", "ogg", "png", "svg", "ttf", "wav", "webp", "woff", "woff2")
ATTACHMENTS = ("001", "7z", "bz2", "doc", "docx", "gz", "odt", "pdf", "rar", "tar", "txt", "xls", "xlsx", "zip")
PAGES = ("asp", "aspx", "htm", "html", "php")


@dataclass(frozen=True)
class Era:
    """A generation of forum software: where its paths begin and the namespace of its routes."""

    name: str
    prefixes: tuple[str, ...]
    namespace: str


@dataclass(frozen=True)
class SiteProfile:
    """Hosts, eras and query keys of a site.

    On ``bare_host`` paths outside all eras belong to ``bare_before`` up to ``bare_until``
    (a prefix of a 14-digit time) and to ``bare_after`` from then on.
    """

    hosts: tuple[str, ...]
    eras: tuple[Era, ...]
    session_keys: tuple[str, ...] = ("sid", "phpbb3_sid")
    start_key: str = "start"
    bare_host: str = ""
    bare_before: str = ""
    bare_after: str = ""
    bare_until: str = "200706"
    bare_paths: tuple[str, ...] = ("", "/", "/default.aspx", "/index.php")
    bare_prefixes: tuple[str, ...] = ("/feed/", "/languages/", "/recentes/", "/search/")


FORUM = SiteProfile(
    hosts=("forum.example.net", "example.net"),
    eras=(
        Era("snitz", ("/forum/",), "forum"),
        Era("phpbb2", ("/phpbb2/",), "phpbb2"),
        Era("phpbb3", ("/phpbb3/",), "phpbb3"),
        Era("community-server", ("/forums/", "/members/", "/user/"), "comunidade"),
    ),
    bare_host="forum.example.net",
    bare_before="community-server",
    bare_after="phpbb2",
)
