"""Column-expression text parsing for the canonicalize stage.

Everything here is a built-in Spark expression (regex, trim, split), so it runs
inside whole-stage codegen; there is no Python UDF on the hot path. The rules
follow Python's string and ``urllib.parse`` behaviour, which is what the
package-registry records were first parsed with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import ColumnOrName, _col

# --- fixed values -----------------------------------------------------------
# Python's str.isspace() set = Unicode White_Space plus the four C0
# separators U+001C..U+001F; (?U) makes Java's \s Unicode-aware.
PY_SPACE = r"[\s\x{1c}-\x{1f}]"
# RFC 3986 appendix B split: 1 = scheme, 2 = authority, 3 = path.
URL_PATTERN = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"
# Schemes for which urllib.parse.urlparse splits ";params" off the last
# path segment ('' = no scheme).
PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp",
                 "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")
# "name <address>"; (?d): '.' stops only at '\n', as in Python.
EMAIL_PATTERN = r"(?Ud)^(.*?)" + PY_SPACE + r"*<([^>]+)"
# GitHub account texts that are not accounts.
GITHUB_NON_ACCOUNTS = ("...", "..", "*.zip")
GITHUB_DOMAIN = "github.com"
# -----------------------------------------------------------------------------


def py_strip(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(_col(c), rf"(?U)^{PY_SPACE}+|{PY_SPACE}+$", "")


def strip_chars(c: ColumnOrName, chars: str) -> Column:
    """Python ``str.strip(chars)``: remove any of ``chars`` at both ends."""
    return F.btrim(_col(c), F.lit(chars))


def after_last(c: ColumnOrName, sep: str) -> Column:
    """Text after the last ``sep``; the whole text if ``sep`` is absent."""
    return F.substring_index(_col(c), sep, -1)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often ``body`` uses it
    (the optimizer would otherwise copy its regexes to every use)."""
    return F.transform(F.array(value), body)[0]


def top_level_domain(domain: ColumnOrName) -> Column:
    """Text after the last '.' of a domain; NULL without a dot."""
    d = _col(domain)
    return F.when(d.contains("."), after_last(d, "."))


def url_features(url: ColumnOrName) -> Column:
    """Struct (domain, top_level_domain, path) of a URL, as ``urlparse`` sees it.

    domain = the whole authority (user info and port kept), path has ``//``
    folded to ``/`` once; empty parts are NULL. An authority with an unpaired
    IPv6 bracket, which ``urlparse`` rejects, yields NULL parts.
    """
    def parts(u: Column) -> Column:
        """scheme, authority and path in one match; a cleaned URL has no line
        end, so one can separate them."""
        return F.split(F.regexp_replace(u, URL_PATTERN + ".*$", "$1\n$2\n$3"), "\n", -1)

    def features(p: Column) -> Column:
        netloc, raw_path = p[1], p[2]
        path = F.when(F.lower(p[0]).isin(*PARAM_SCHEMES) & raw_path.contains(";"),
                      F.regexp_replace(raw_path, r";[^/]*$", "")).otherwise(raw_path)
        bad = netloc.contains("[") != netloc.contains("]")
        domain = F.when(~bad & (netloc != ""), netloc)
        path = F.when(~bad & (path != ""), F.replace(path, F.lit("//"), F.lit("/")))
        return F.struct(domain.alias("domain"),
                        top_level_domain(domain).alias("top_level_domain"),
                        path.alias("path"))

    raw = _col(url)
    stripped = F.regexp_replace(raw, r"^[\x{00}-\x{20}]+", "")
    clean = F.when(raw.rlike(r"[\x{00}-\x{20}]"), F.regexp_replace(stripped, r"[\t\r\n]", "")).otherwise(raw)
    return bind(clean, lambda u: bind(parts(u), features))


def github_parts(domain: ColumnOrName, path: ColumnOrName) -> Column:
    """Struct (github_repo, github_account) for github.com URLs, else NULLs.

    The path is stripped of '/' and, when it ends in '.git', of the characters
    '.', 'g', 'i', 't' at both ends (Python ``strip`` semantics, kept as is).
    """
    d, p0 = _col(domain), _col(path)
    p = strip_chars(p0, "/")
    p = F.when(p.endswith(".git"), strip_chars(p, ".git")).otherwise(p)
    on_github = F.coalesce((d == GITHUB_DOMAIN) & p0.isNotNull(), F.lit(False))
    nested = p.contains("/")
    repo = F.when(on_github & nested, F.substring_index(p, "/", 2))
    account = (F.when(on_github & nested, F.substring_index(p, "/", 1))
               .when(on_github & ~p.isin(*GITHUB_NON_ACCOUNTS), p))
    return F.struct(repo.alias("github_repo"), account.alias("github_account"))


def person_and_email(person: ColumnOrName, email: ColumnOrName) -> Column:
    """Struct (person_name, email_record) after reading ``Name <address>``.

    Only when the email text holds '<' and matches: the address becomes the
    first bracketed address (trimmed), and the name taken from the text
    replaces the person when the person is NULL or itself holds '<'.
    """
    p, e = _col(person), _col(email)
    matched = F.coalesce(e.contains("<") & e.rlike(EMAIL_PATTERN), F.lit(False))
    name = py_strip(F.regexp_extract(e, EMAIL_PATTERN, 1))
    addr = py_strip(F.regexp_extract(e, EMAIL_PATTERN, 2))
    new_person = F.when(matched & (p.isNull() | p.contains("<")), name).otherwise(p)
    return F.struct(new_person.alias("person_name"),
                    F.when(matched, addr).otherwise(e).alias("email_record"))


def keyword_tokens(keywords: ColumnOrName) -> Column:
    """Raw keyword tokens of a keywords text (empty ones included).

    Strip '[' / ']' then '"' from the ends; split on ',' when there is one,
    else on ' '.
    """
    k = strip_chars(strip_chars(keywords, "[]"), '"')
    return F.when(k.contains(","), F.split(k, ",", -1)).otherwise(F.split(k, " ", -1))


def clean_keyword(token: ColumnOrName) -> Column:
    """strip, lower, strip '[]', strip '"' (in that order)."""
    return strip_chars(strip_chars(F.lower(py_strip(token)), "[]"), '"')
