"""DuckDB SQL for the correctness gate: one statement per query key.

Written independently of the DataFrame code, straight from the semantics:
``DISTINCT ON`` with an explicit ``ORDER BY .. NULLS FIRST`` (the row Spark's
``min(struct)`` keeps), md5 ids over DuckDB's NULL-skipping ``concat``, a
population of keys left-joined with each child, ``row_number`` for the order
rules. Inputs are the fixture views as CTEs over the driver's tables.
"""

from __future__ import annotations

from .sources.fixtures import DAMAGED, VIEWS, duckdb_ctes

URL_RE = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"
EMAIL_RE = r"^(.*?)\s*<([^>]+)"
PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp",
                 "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")


def _strip_ws(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------- canonical
CANON: dict[str, tuple[str, tuple[str, ...]]] = {}

CANON["c_package"] = ("""
SELECT name AS pkg_name, info_name AS name, package_url, requires_python, version,
  num_releases, num_info_dependencies AS num_requires_dist, license
FROM raw_fields""", ("raw_fields",))

CANON["c_license"] = ("""
SELECT name AS pkg_name, info_name AS name, package_url, requires_python, version,
  num_releases, num_info_dependencies AS num_requires_dist,
  CASE WHEN row_number() OVER (PARTITION BY license ORDER BY ord) = 1 THEN NULL
       ELSE license END AS license
FROM raw_fields""", ("raw_fields",))

CANON["c_requirement"] = ("SELECT * FROM latest_requirement", ("latest_requirement",))

CANON["c_url_rows"] = ("""
SELECT pkg_name, trim(u, '<>') AS url, url_type FROM (
  SELECT name AS pkg_name, pu_source AS u, 'Source' AS url_type FROM raw_fields WHERE pu_source IS NOT NULL
  UNION ALL SELECT name, home_page, 'home_page' FROM raw_fields
  UNION ALL SELECT name, docs_url, 'docs_url' FROM raw_fields)""", ("raw_fields",))


def url_feature_sql(src: str, keep: str) -> str:
    """SQL adding domain, top_level_domain, path, github_repo, github_account
    to ``src`` (which has a ``url`` column); ``keep`` = columns kept first."""
    schemes = ", ".join(_q(s) for s in PARAM_SCHEMES)
    return f"""
SELECT {keep}, domain, top_level_domain, path,
  CASE WHEN gh AND contains(g, '/') THEN split_part(g, '/', 1) || '/' || split_part(g, '/', 2) END AS github_repo,
  CASE WHEN gh AND contains(g, '/') THEN split_part(g, '/', 1)
       WHEN gh AND g NOT IN ('...', '..', '*.zip') THEN g END AS github_account
FROM (
  SELECT *, coalesce(domain = 'github.com' AND path IS NOT NULL, false) AS gh,
    CASE WHEN ends_with(trim(path, '/'), '.git') THEN trim(trim(path, '/'), '.git')
         ELSE trim(path, '/') END AS g,
    CASE WHEN contains(domain, '.') THEN regexp_extract(domain, '[^.]*$') END AS top_level_domain
  FROM (
    SELECT *, CASE WHEN NOT bad AND net <> '' THEN net END AS domain,
      CASE WHEN NOT bad AND p1 <> '' THEN replace(p1, '//', '/') END AS path
    FROM (
      SELECT *, CASE WHEN scheme IN ({schemes}) THEN regexp_replace(p0, ';[^/]*$', '') ELSE p0 END AS p1,
        contains(net, '[') <> contains(net, ']') AS bad
      FROM (
        SELECT *, lower(regexp_extract(uu, {_q(URL_RE)}, 1)) AS scheme,
          regexp_extract(uu, {_q(URL_RE)}, 2) AS net, regexp_extract(uu, {_q(URL_RE)}, 3) AS p0
        FROM (SELECT *, regexp_replace(regexp_replace(url, '^[\\x00-\\x20]+', ''), '[\\t\\r\\n]', '', 'g') AS uu
              FROM {src}) a) b) c) d) e"""


CANON["c_url"] = (url_feature_sql("c_url_rows", "pkg_name, url, url_type"), ("c_url_rows",))

CANON["c_person"] = (f"""
SELECT pkg_name, role,
  CASE WHEN m AND (person IS NULL OR contains(person, '<'))
       THEN {_strip_ws(f"regexp_extract(pe, {_q(EMAIL_RE)}, 1)")} ELSE person END AS person_name,
  CASE WHEN m THEN {_strip_ws(f"regexp_extract(pe, {_q(EMAIL_RE)}, 2)")} ELSE pe END AS email_record
FROM (
  SELECT *, coalesce(contains(pe, '<') AND regexp_matches(pe, {_q(EMAIL_RE)}), false) AS m
  FROM (SELECT name AS pkg_name, 'author' AS role, author AS person, author_email AS pe FROM raw_fields
        UNION ALL
        SELECT name, 'maintainer', maintainer, maintainer_email FROM raw_fields) r
  WHERE pe IS NOT NULL) s""", ("raw_fields",))

CANON["c_email"] = ("""
SELECT pkg_name, person_name, email_record, email, domain,
  CASE WHEN contains(domain, '.') THEN regexp_extract(domain, '[^.]*$') END AS top_level_domain, role
FROM (SELECT *, regexp_extract(email, '[^@]*$') AS domain FROM (
  SELECT pkg_name, role, person_name, email_record, unnest(string_split(email_record, ',')) AS email
  FROM c_person) a) b""", ("c_person",))

CANON["c_kwtok"] = (f"""
SELECT ord, pos, pkg_name, keyword FROM (
  SELECT ord, pos, pkg_name, trim(trim(lower({_strip_ws("tok")}), '[]'), '"') AS keyword FROM (
    SELECT ord, pkg_name, unnest(toks) AS tok,
      CAST(unnest(generate_series(0, len(toks) - 1)) AS INTEGER) AS pos FROM (
      SELECT ord, pkg_name, string_split(k, CASE WHEN contains(k, ',') THEN ',' ELSE ' ' END) AS toks
      FROM (SELECT ord, name AS pkg_name, trim(trim(keywords, '[]'), '"') AS k
            FROM raw_fields WHERE keywords IS NOT NULL) a) b) c) d
WHERE keyword <> ''""", ("raw_fields",))

CANON["c_keyword"] = ("""
SELECT pkg_name, keyword FROM (
  SELECT pkg_name, keyword, row_number() OVER (PARTITION BY keyword ORDER BY ord, pos) AS rn FROM c_kwtok) a
WHERE rn > 300""", ("c_kwtok",))

# The raw snapshot as JSON text, byte for byte what the Spark side writes:
# same key order, NULL fields kept, requires entries sorted by key.
CANON["raw_latest"] = ("""
SELECT f.ord, f.name, to_json(struct_pack(
  num_releases := f.num_releases, num_info_dependencies := f.num_info_dependencies,
  info := struct_pack(name := f.info_name, package_url := f.package_url,
    requires_python := f.requires_python, version := f.version, license := f.license,
    home_page := f.home_page, docs_url := f.docs_url, keywords := f.keywords,
    author := f.author, author_email := f.author_email, maintainer := f.maintainer,
    maintainer_email := f.maintainer_email,
    project_urls := CASE WHEN f.pu_source IS NOT NULL
                         THEN MAP {'Source': f.pu_source, 'None': CAST(NULL AS VARCHAR)} END),
  requires := r.requires))::VARCHAR AS latest
FROM raw_fields f LEFT JOIN (
  SELECT name, map_from_entries(list(struct_pack(k := req_name, v :=
      CASE WHEN kind = 'null' THEN NULL ELSE struct_pack(
        releases := CASE WHEN kind = 'two' THEN [rel_a, rel_b] ELSE CAST([] AS VARCHAR[]) END,
        requirement := requirement) END) ORDER BY req_name)) AS requires
  FROM raw_requires GROUP BY name) r ON f.name = r.name""", ("raw_fields", "raw_requires"))

CANON["raw_damaged"] = (DAMAGED.format(raw="raw_latest"), ("raw_latest",))

# --- fixed values: the keys of a record --------------------------------------------
RECORD_COUNTS = ("num_releases", "num_info_dependencies")
RECORD_TEXTS = ("name", "package_url", "requires_python", "version", "license", "home_page", "docs_url")
RECORD_OTHERS = ("keywords", "project_urls", "author", "author_email", "maintainer", "maintainer_email")
# -------------------------------------------------------------------------------------


def quarantine_sql() -> str:
    """The records that violate the contract, from the JSON types of their values."""
    def t(path: str) -> str:
        return f"json_type(j, '$.{path}')"

    text, number = "('VARCHAR', 'NULL')", "('UBIGINT', 'BIGINT', 'HUGEINT', 'DOUBLE', 'NULL')"
    has_info = f"{t('info')} = 'OBJECT'"
    entry = "len(list_filter(entries, lambda e: json_type(e) = 'OBJECT' AND {0})) > 0"
    rules = [("latest:absent", "latest IS NULL"), ("latest:not json", "latest IS NOT NULL AND j IS NULL"),
             ("latest:not object", "json_type(j) <> 'OBJECT'"),
             ("info:not object", f"{t('info')} NOT IN ('OBJECT', 'NULL')"),
             ("requires:not object", f"{t('requires')} NOT IN ('OBJECT', 'NULL')")]
    rules += [(f"{c}:absent", f"usual AND {t(c)} IS NULL") for c in RECORD_COUNTS]
    rules += [(f"{c}:not number", f"{t(c)} NOT IN {number}") for c in RECORD_COUNTS]
    rules.append(("info:absent", f"usual AND coalesce({t('info')}, 'NULL') = 'NULL'"))
    rules += [(f"info.{c}:absent", f"usual AND {has_info} AND {t('info.' + c)} IS NULL") for c in RECORD_TEXTS + RECORD_OTHERS]
    rules += [(f"info.{c}:not text", f"{t('info.' + c)} NOT IN {text}") for c in RECORD_TEXTS]
    rules += [(f"info.{c}:not text", f"{t(f'info.{c}_email')} = 'VARCHAR' AND {t('info.' + c)} NOT IN {text}")
              for c in ("author", "maintainer")]
    rules += [("info.project_urls:not text", f"len(list_filter(urls, lambda u: json_type(u) NOT IN {text})) > 0"),
              ("requires:absent", f"usual AND {t('requires')} IS NULL"),
              ("requires.entry:not object", "len(list_filter(entries, lambda e: json_type(e) NOT IN ('OBJECT', 'NULL'))) > 0")]
    rules += [(f"requires.{c}:absent", entry.format(f"json_type(e, '$.{c}') IS NULL")) for c in ("releases", "requirement")]
    rules += [("requires.releases:not texts", entry.format(
        "(json_type(e, '$.releases') <> 'ARRAY' OR len(list_filter(json_extract(e, '$.releases[*]'), "
        "lambda x: json_type(x) <> 'VARCHAR')) > 0)")),
        ("requires.requirement:not text", entry.format(f"json_type(e, '$.requirement') NOT IN {text}"))]
    codes = ", ".join(f"CASE WHEN {cond} THEN {_q(code)} END" for code, cond in rules)
    return f"""
SELECT ord, name, array_to_string(reasons, ', ') AS reason, latest FROM (
  SELECT ord, name, latest, list_filter([{codes}], lambda r: r IS NOT NULL) AS reasons FROM (
    SELECT *, coalesce(json_type(j) = 'OBJECT' AND coalesce({t('info')}, 'NULL') IN ('OBJECT', 'NULL')
             AND coalesce({t('requires')}, 'NULL') IN ('OBJECT', 'NULL'), false) AS usual,
      json_extract(j, '$.requires.*') AS entries, json_extract(j, '$.info.project_urls.*') AS urls
    FROM (SELECT *, CASE WHEN json_valid(latest) THEN latest END AS j FROM raw_damaged) a) b) c
WHERE len(reasons) > 0"""


FIXTURE_INPUTS = {"latest_package": "latest_package", "latest_requirement": "latest_requirement",
                  "latest_url": "latest_url", "latest_keyword": "latest_keyword",
                  "latest_email": "latest_email"}
RAW_INPUTS = {"latest_package": "c_license", "latest_requirement": "c_requirement",
              "latest_url": "c_url", "latest_keyword": "c_keyword", "latest_email": "c_email"}

# ---------------------------------------------------------------- extraction
PERSON_OK = ("NOT ((person_name IS NULL OR person_name = '') "
             "AND (email_record IS NULL OR email_record = ''))")


def _nb(c: str) -> str:
    return f"{c} IS NOT NULL AND {c} <> ''"


# name: (source, keys, [(out, expr)], where)
# --- fixed values: tables, keys, attributes, filters, link ends -----------------
NODES = {
    "package": ("latest_package", ["pkg_name"],
                [("name", "name"), ("package_url", "package_url"),
                 ("requires_python", "requires_python"), ("version", "version"),
                 ("num_releases", "TRY_CAST(num_releases AS INTEGER)")], None),
    "requirement": ("latest_requirement", ["required_pkg_name"],
                    [("name", "required_pkg_name")], None),
    "author": ("latest_email", ["person_name", "email_record"],
               [("name", "person_name"), ("email", "email_record")],
               f"{PERSON_OK} AND role = 'author'"),
    "maintainer": ("latest_email", ["person_name", "email_record"],
                   [("name", "person_name"), ("email", "email_record")],
                   f"{PERSON_OK} AND role = 'maintainer'"),
    "license": ("latest_package", ["license"], [("name", "license")],
                f"{_nb('license')} AND license NOT IN ('UNKNOWN', 'LICENSE.txt')"),
    "keyword": ("latest_keyword", ["keyword"], [("keyword", "keyword")], _nb("keyword")),
    "email": ("latest_email", ["email"],
              [("email", "email"), ("domain", "domain"), ("top_level_domain", "top_level_domain")],
              _nb("email")),
    "url": ("latest_url", ["url"],
            [("url", "url"), ("domain", "domain"), ("top_level_domain", "top_level_domain"),
             ("path", "path")], f"{_nb('url')} AND url <> 'UNKNOWN'"),
    "email_domain": ("latest_email", ["domain"],
                     [("domain", "domain"), ("top_level_domain", "top_level_domain")], _nb("domain")),
    "url_domain": ("latest_url", ["domain"],
                   [("domain", "domain"), ("top_level_domain", "top_level_domain")],
                   f"{_nb('domain')} AND domain <> 'UNKNOWN'"),
    "github_repo": ("latest_url", ["github_repo"], [("github_repo", "github_repo")], _nb("github_repo")),
    "github_account": ("latest_url", ["github_account"], [("github_account", "github_account")],
                       _nb("github_account")),
}

# name: (source, keys, from keys, to keys, [(out, expr)], where)
LINKS = {
    "has_requirement": ("latest_requirement", ["pkg_name", "required_pkg_name"], ["pkg_name"],
                        ["required_pkg_name"],
                        [("num_match_dist", "TRY_CAST(num_match_dist AS INTEGER)"),
                         ("newest_dist", "newest_dist"), ("oldest_dist", "oldest_dist"),
                         ("requirement_string", "requirement_string")], None),
    "has_keyword": ("latest_keyword", ["pkg_name", "keyword"], ["pkg_name"], ["keyword"], [],
                    _nb("keyword")),
    "has_author": ("latest_email", ["pkg_name", "person_name", "email_record"], ["pkg_name"],
                   ["person_name", "email_record"], [], f"{PERSON_OK} AND role = 'author'"),
    "has_maintainer": ("latest_email", ["pkg_name", "person_name", "email_record"], ["pkg_name"],
                       ["person_name", "email_record"], [], f"{PERSON_OK} AND role = 'maintainer'"),
    "author_has_email": ("latest_email", ["person_name", "email_record", "email"],
                         ["person_name", "email_record"], ["email"], [],
                         f"{PERSON_OK} AND {_nb('email')} AND role = 'author'"),
    "maintainer_has_email": ("latest_email", ["person_name", "email_record", "email"],
                             ["person_name", "email_record"], ["email"], [],
                             f"{PERSON_OK} AND {_nb('email')} AND role = 'maintainer'"),
    "has_license": ("latest_package", ["pkg_name", "license"], ["pkg_name"], ["license"], [],
                    f"{_nb('license')} AND license NOT IN ('UNKNOWN', 'LICENSE.txt')"),
    "has_url": ("latest_url", ["pkg_name", "url"], ["pkg_name"], ["url"],
                [("url_type", "url_type")], f"{_nb('url')} AND url <> 'UNKNOWN'"),
    "released_from": ("latest_url", ["pkg_name", "github_repo"], ["pkg_name"], ["github_repo"], [],
                      _nb("github_repo")),
    "released_by": ("latest_url", ["pkg_name", "github_account"], ["pkg_name"], ["github_account"],
                    [], _nb("github_account")),
    "owned_by": ("latest_url", ["github_repo", "github_account"], ["github_repo"],
                 ["github_account"], [], f"{_nb('github_repo')} AND {_nb('github_account')}"),
    "url_hosted_by": ("latest_url", ["url", "domain"], ["url"], ["domain"], [],
                      f"url IS NOT NULL AND url <> 'UNKNOWN' AND {_nb('domain')}"),
    "email_hosted_by": ("latest_email", ["email", "domain"], ["email"], ["domain"], [],
                        f"{_nb('email_record')} AND {_nb('email')} AND {_nb('domain')}"),
}

SUBGRAPHS = {
    "has_requirement": ("package", "requirement"), "has_author": ("package", "author"),
    "has_maintainer": ("package", "maintainer"), "has_license": ("package", "license"),
    "has_url": ("package", "url"), "has_keyword": ("package", "keyword"),
    "author_has_email": ("author", "email"), "maintainer_has_email": ("maintainer", "email"),
    "email_hosted_by": ("email", "email_domain"), "url_hosted_by": ("url", "url_domain"),
    "released_by": ("package", "github_account"), "released_from": ("package", "github_repo"),
    "owned_by": ("github_repo", "github_account"),
}


def _id(cols: list[str]) -> str:
    if len(cols) == 1:
        return f"coalesce(md5({cols[0]}), 'null')"
    joined = ", '|', ".join(cols)
    return f"coalesce(md5(concat({joined})), 'null')"


def _order(keys: list[str], exprs: list[str]) -> str:
    return ", ".join(keys + [f"{e} NULLS FIRST" for e in exprs])


def node_sql(name: str, src: str) -> str:
    """DISTINCT ON statement of one node table over ``src``."""
    _, keys, attrs, where = NODES[name]
    sel = ", ".join([f"{_id(keys)} AS node_id"] + [f"{e} AS {o}" for o, e in attrs])
    w = f" WHERE {where}" if where else ""
    return (f"SELECT DISTINCT ON ({', '.join(keys)}) {sel} FROM {src}{w} "
            f"ORDER BY {_order(keys, [e for _, e in attrs])}")


def link_sql(name: str, src: str) -> str:
    """DISTINCT ON statement of one link table over ``src``."""
    _, keys, fk, tk, attrs, where = LINKS[name]
    sel = ", ".join([f"{_id(keys)} AS link_id", f"{_id(fk)} AS from_id", f"{_id(tk)} AS to_id"]
                    + [f"{e} AS {o}" for o, e in attrs])
    w = f" WHERE {where}" if where else ""
    return (f"SELECT DISTINCT ON ({', '.join(keys)}) {sel} FROM {src}{w} "
            f"ORDER BY {_order(keys, [e for _, e in attrs])}")


NODE_COLS = {n: ["node_id"] + [o for o, _ in v[2]] for n, v in NODES.items()}
LINK_COLS = {n: ["link_id", "from_id", "to_id"] + [o for o, _ in v[4]] for n, v in LINKS.items()}

# ---------------------------------------------------------------- grouping
# group: (children, [(out, expr over t0 (population) and t1..tn)], distinct)
NODE_GROUPS = {
    "package": (["package", "requirement"],
                [("node_id", "t0.node_id"), ("name", "coalesce(t1.name, t2.name)"),
                 ("package_url", "t1.package_url"), ("requires_python", "t1.requires_python"),
                 ("version", "t1.version"), ("num_releases", "t1.num_releases")], True),
    "person": (["author", "maintainer"],
               [("node_id", "t0.node_id"), ("name", "coalesce(t1.name, t2.name)"),
                ("email", "coalesce(t1.email, t2.email)")], True),
    "domain": (["email_domain", "url_domain"],
               [("node_id", "t0.node_id"), ("domain", "coalesce(t1.domain, t2.domain)"),
                ("top_level_domain", "coalesce(t1.top_level_domain, t2.top_level_domain)")], True),
}
LINK_GROUPS = {
    "has_email": (["author_has_email", "maintainer_has_email"],
                  [("link_id", "t1.link_id"), ("from_id", "t0.from_id"), ("to_id", "t0.to_id")],
                  False),
}
PASS_NODES = ["license", "keyword", "email", "url", "github_repo", "github_account"]
PASS_LINKS = ["has_requirement", "has_author", "has_maintainer", "has_license", "has_url",
              "has_keyword", "email_hosted_by", "url_hosted_by", "released_by",
              "released_from", "owned_by"]
FINAL_NODES = list(NODE_GROUPS) + PASS_NODES
FINAL_LINKS = list(LINK_GROUPS) + PASS_LINKS
TRIPLETS = {
    "has_email": ("person", "email"), "has_requirement": ("package", "package"),
    "has_author": ("package", "person"), "has_maintainer": ("package", "person"),
    "has_license": ("package", "license"), "has_url": ("package", "url"),
    "has_keyword": ("package", "keyword"), "email_hosted_by": ("email", "domain"),
    "url_hosted_by": ("url", "domain"), "released_by": ("package", "github_account"),
    "released_from": ("package", "github_repo"), "owned_by": ("github_repo", "github_account"),
}
# --------------------------------------------------------------------------------


def _dedup(table: str, key: list[str], cols: list[str]) -> str:
    rest = [c for c in cols if c not in key]
    return f"SELECT DISTINCT ON ({', '.join(key)}) * FROM {table} ORDER BY {_order(key, rest)}"


def group_sql(children: list[str], child_cols: list[list[str]], key: list[str],
              select: list[tuple[str, str]], distinct: bool) -> str:
    """Key population LEFT JOIN each child (deduped first when ``distinct``)."""
    pop = "SELECT DISTINCT * FROM (" + " UNION ALL ".join(
        f"SELECT {', '.join(key)} FROM {c}" for c in children) + ") u"
    joins = []
    for i, (c, cols) in enumerate(zip(children, child_cols), start=1):
        src = f"({_dedup(c, key, cols)})" if distinct else c
        on = " AND ".join(f"t0.{k} = t{i}.{k}" for k in key)
        joins.append(f"LEFT JOIN {src} AS t{i} ON {on}")
    sel = ", ".join(f"{e} AS {o}" for o, e in select)
    return f"SELECT {sel} FROM ({pop}) AS t0 {' '.join(joins)}"


class Oracle:
    """Builds ``WITH ... SELECT`` statements over named CTEs."""

    def __init__(self) -> None:
        self.ctes: dict[str, tuple[str, tuple[str, ...]]] = dict(CANON)
        for prefix, inputs in (("", FIXTURE_INPUTS), ("r", RAW_INPUTS)):
            for n, v in NODES.items():
                self.ctes[f"{prefix}n_{n}"] = (node_sql(n, inputs[v[0]]), (inputs[v[0]],))
            for n, v in LINKS.items():
                self.ctes[f"{prefix}l_{n}"] = (link_sql(n, inputs[v[0]]), (inputs[v[0]],))
            for g, (children, select, distinct) in NODE_GROUPS.items():
                self.ctes[f"{prefix}fn_{g}"] = (
                    group_sql([f"{prefix}n_{c}" for c in children], [NODE_COLS[c] for c in children],
                              ["node_id"], select, distinct),
                    tuple(f"{prefix}n_{c}" for c in children))
            for g, (children, select, distinct) in LINK_GROUPS.items():
                self.ctes[f"{prefix}fl_{g}"] = (
                    group_sql([f"{prefix}l_{c}" for c in children], [LINK_COLS[c] for c in children],
                              ["from_id", "to_id"], select, distinct),
                    tuple(f"{prefix}l_{c}" for c in children))
            for n in PASS_NODES:
                self.ctes[f"{prefix}fn_{n}"] = (_dedup(f"{prefix}n_{n}", ["node_id"], NODE_COLS[n]),
                                                (f"{prefix}n_{n}",))
            for n in PASS_LINKS:
                self.ctes[f"{prefix}fl_{n}"] = (
                    _dedup(f"{prefix}l_{n}", ["from_id", "to_id"], LINK_COLS[n]), (f"{prefix}l_{n}",))

    def sql(self, body: str, needs: list[str]) -> str:
        order: list[str] = []
        fixtures: list[str] = []

        def visit(n: str) -> None:
            if n in order or n in fixtures:
                return
            if n in VIEWS:
                fixtures.append(n)
                return
            if n not in self.ctes:
                return  # a driver table
            for d in self.ctes[n][1]:
                visit(d)
            order.append(n)

        for n in needs:
            visit(n)
        parts = duckdb_ctes(fixtures) + [(n, self.ctes[n][0].strip()) for n in order]
        if not parts:
            return body.strip()
        return "WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in parts) + "\n" + body.strip()


def _counts(tables: list[tuple[str, str]], label: str = "table") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {_q(name)} AS {label}, CAST(count(*) AS BIGINT) AS n_rows FROM {cte}"
        for name, cte in tables)


def _digests(tables: list[tuple[str, str, list[str]]], lead: str = "") -> str:
    """(table, n_rows, digest_sum, digest_xor) of (name, cte, columns) tables."""
    parts = []
    for name, cte, cols in tables:
        text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>'), chr(31)" for c in sorted(cols))
        parts.append(
            f"SELECT {lead}{_q(name)} AS \"table\", CAST(count(*) AS BIGINT) AS n_rows, "
            "CAST(coalesce(sum(CAST('0x' || substr(h, 1, 8) AS BIGINT)), 0) AS BIGINT) AS digest_sum, "
            "coalesce(bit_xor(CAST('0x' || substr(h, 9, 15) AS BIGINT)), 0) AS digest_xor "
            f"FROM (SELECT md5(concat({text})) AS h FROM {cte}) d")
    return "\nUNION ALL\n".join(parts)


def _with_cols(tables: list[tuple[str, str]]) -> list[tuple[str, str, list[str]]]:
    return [(t, cte, FINAL_COLS[t]) for t, cte in tables]


CANON_COLS = {
    "latest_package": ["pkg_name", "name", "package_url", "requires_python", "version", "num_releases",
                       "num_requires_dist", "license"],
    "latest_requirement": ["pkg_name", "required_pkg_name", "num_match_dist", "requirement_string",
                           "newest_dist", "oldest_dist"],
    "latest_url": ["pkg_name", "url", "url_type", "domain", "top_level_domain", "path", "github_repo",
                   "github_account"],
    "latest_keyword": ["pkg_name", "keyword"],
    "latest_email": ["pkg_name", "person_name", "email_record", "email", "domain", "top_level_domain",
                     "role"],
}


def _final_tables(prefix: str) -> list[tuple[str, str]]:
    return ([(f"node_{n}", f"{prefix}fn_{n}") for n in FINAL_NODES]
            + [(f"link_{n}", f"{prefix}fl_{n}") for n in FINAL_LINKS])


FINAL_COLS = {**{f"node_{g}": [o for o, _ in v[1]] for g, v in NODE_GROUPS.items()},
              **{f"node_{n}": NODE_COLS[n] for n in PASS_NODES},
              **{f"link_{g}": [o for o, _ in v[1]] for g, v in LINK_GROUPS.items()},
              **{f"link_{n}": LINK_COLS[n] for n in PASS_LINKS}}
INT_COLUMNS = {"num_releases", "num_match_dist"}


def _attrs_text(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in cols)
    return f"concat_ws(' | ', {parts})" if cols else "''"


def check_sql(o: Oracle, side: str | None) -> str:
    """The referential check table, for one side or both."""
    rows = []
    for link, (src, dst) in SUBGRAPHS.items():
        for s, node in (("from_id", src), ("to_id", dst)):
            if side and s != side:
                continue
            rows.append(f"""SELECT {_q(link)} AS link, {_q(s)} AS side, {_q(node)} AS node,
  (SELECT CAST(count(*) AS BIGINT) FROM l_{link}) AS n_links,
  (SELECT CAST(count(*) AS BIGINT) FROM n_{node}) AS n_nodes,
  (SELECT CAST(count(DISTINCT {s}) AS BIGINT) FROM l_{link}) AS n_ids,
  (SELECT CAST(count(DISTINCT {s}) AS BIGINT) FROM l_{link}
     WHERE {s} NOT IN (SELECT node_id FROM n_{node})) AS n_orphans""")
    body = ("SELECT *, n_orphans = 0 AS ok FROM (\n" + "\nUNION ALL\n".join(rows) + "\n) c")
    needs = [f"l_{l}" for l in SUBGRAPHS] + [f"n_{n}" for n in NODES]
    return o.sql(body, needs)


def catalog_sql(o: Oracle) -> str:
    """Per final table and column: type, attribute flag, rows, NULLs."""
    parts = []
    for table, cols in FINAL_COLS.items():
        kind, label = table.split("_", 1)
        cte = ("fn_" if kind == "node" else "fl_") + label
        src, dst = TRIPLETS.get(label, (None, None)) if kind == "link" else (None, None)
        ids = ("node_id",) if kind == "node" else ("link_id", "from_id", "to_id")
        for i, c in enumerate(cols):
            typ = "Int" if c in INT_COLUMNS else "String"
            parts.append(
                f"SELECT {_q(kind)} AS kind, {_q(label)} AS label, {_q(table)} AS \"table\", "
                f"{_q(src) if src else 'CAST(NULL AS VARCHAR)'} AS \"from\", "
                f"{_q(dst) if dst else 'CAST(NULL AS VARCHAR)'} AS \"to\", {_q(c)} AS \"column\", "
                f"{_q(typ)} AS type, {'false' if c in ids else 'true'} AS attribute, "
                f"CAST({i} AS INTEGER) AS position, CAST(count(*) AS BIGINT) AS n_rows, "
                f"CAST(count(*) - count({c}) AS BIGINT) AS n_nulls FROM {cte}")
    body = ("SELECT kind, label, \"table\", \"from\", \"to\", \"column\", type, attribute, position, "
            "n_rows, n_nulls FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) c")
    return o.sql(body, [t for _, t in _final_tables("")])


def oracle_queries() -> dict[str, str]:
    """The DuckDB statement for every query key."""
    o = Oracle()
    q: dict[str, str] = {}
    q["scan_raw"] = o.sql("SELECT * FROM raw_latest", ["raw_latest"])
    q["canon_parse"] = o.sql("SELECT * FROM raw_fields", ["raw_fields"])
    q["canon_quarantine"] = o.sql(quarantine_sql(), ["raw_damaged"])
    q["canon_package"] = o.sql("SELECT * FROM c_package", ["c_package"])
    q["canon_license"] = o.sql("SELECT * FROM c_license", ["c_license"])
    q["canon_requirement"] = o.sql("SELECT * FROM c_requirement", ["c_requirement"])
    q["canon_url"] = o.sql("SELECT * FROM c_url", ["c_url"])
    q["url_github"] = o.sql(
        "SELECT pkg_name, url, url_type, github_repo, github_account FROM c_url", ["c_url"])
    q["canon_person"] = o.sql("SELECT * FROM c_person", ["c_person"])
    q["canon_email"] = o.sql("SELECT * FROM c_email", ["c_email"])
    q["canon_keyword"] = o.sql("SELECT * FROM c_kwtok", ["c_kwtok"])
    q["keyword_running"] = o.sql("SELECT * FROM c_keyword", ["c_keyword"])
    canon_raw = [("latest_package", "c_license"), ("latest_requirement", "c_requirement"),
                 ("latest_url", "c_url"), ("latest_keyword", "c_keyword"),
                 ("latest_email", "c_email")]
    q["expect_nonempty"] = o.sql(
        f"SELECT *, n_rows > 0 AS ok FROM ({_counts(canon_raw)}) c", [c for _, c in canon_raw])
    # url features on the raw web pages' URLs
    pages_feat = url_feature_sql("pages", "page_id, url")
    q["url_features"] = ("SELECT page_id, url, domain, top_level_domain, path FROM (\n"
                         + pages_feat + "\n) f")

    for n in NODES:
        q[f"node_{n}"] = o.sql(f"SELECT * FROM n_{n}", [f"n_{n}"])
    for n in LINKS:
        q[f"link_{n}"] = o.sql(f"SELECT * FROM l_{n}", [f"l_{n}"])

    node_pop = "\nUNION ALL\n".join(
        f"SELECT DISTINCT {_q(g)} AS \"group\", node_id FROM ("
        + " UNION ALL ".join(f"SELECT node_id FROM n_{c}" for c in ch) + ") p"
        for g, (ch, _, _) in {**NODE_GROUPS, **{n: ([n], None, None) for n in PASS_NODES}}.items())
    q["node_population"] = o.sql(node_pop, [f"n_{n}" for n in NODES])
    link_pop = "\nUNION ALL\n".join(
        f"SELECT DISTINCT {_q(g)} AS \"group\", from_id, to_id FROM ("
        + " UNION ALL ".join(f"SELECT from_id, to_id FROM l_{c}" for c in ch) + ") p"
        for g, (ch, _, _) in {**LINK_GROUPS, **{n: ([n], None, None) for n in PASS_LINKS}}.items())
    q["link_population"] = o.sql(link_pop, [f"l_{n}" for n in LINKS])

    q["group_nodes"] = o.sql("\nUNION ALL\n".join(
        f"SELECT 'node_{n}' AS \"table\", node_id FROM fn_{n}" for n in FINAL_NODES),
        [f"fn_{n}" for n in FINAL_NODES])
    q["group_links"] = o.sql("\nUNION ALL\n".join(
        f"SELECT 'link_{n}' AS \"table\", link_id, from_id, to_id FROM fl_{n}" for n in FINAL_LINKS),
        [f"fl_{n}" for n in FINAL_LINKS])
    q["group_package"] = o.sql("SELECT * FROM fn_package", ["fn_package"])
    q["group_person"] = o.sql("SELECT * FROM fn_person", ["fn_person"])
    q["group_domain"] = o.sql("SELECT * FROM fn_domain", ["fn_domain"])
    q["group_has_email"] = o.sql("SELECT * FROM fl_has_email", ["fl_has_email"])
    ch, _, distinct = LINK_GROUPS["has_email"]
    q["group_has_email_coalesce"] = o.sql(group_sql(
        [f"l_{c}" for c in ch], [LINK_COLS[c] for c in ch], ["from_id", "to_id"],
        [("link_id", "coalesce(t1.link_id, t2.link_id)"), ("from_id", "t0.from_id"),
         ("to_id", "t0.to_id")], distinct), [f"l_{c}" for c in ch])
    q["passthrough_nodes"] = o.sql("\nUNION ALL\n".join(
        f"SELECT 'node_{n}' AS \"table\", node_id, {_attrs_text(NODE_COLS[n][1:])} AS attrs FROM fn_{n}"
        for n in PASS_NODES), [f"fn_{n}" for n in PASS_NODES])
    q["passthrough_links"] = o.sql("\nUNION ALL\n".join(
        f"SELECT 'link_{n}' AS \"table\", link_id, from_id, to_id, "
        f"{_attrs_text(LINK_COLS[n][3:])} AS attrs FROM fl_{n}"
        for n in PASS_LINKS), [f"fl_{n}" for n in PASS_LINKS])
    # a resolved table grouped in the place of one child: all other tables stay as they are
    o.ctes["n_author_resolved"] = ("SELECT node_id, upper(name) AS name, email FROM n_author", ("n_author",))
    o.ctes["l_author_has_email_resolved"] = (
        "SELECT reverse(link_id) AS link_id, from_id, to_id FROM l_author_has_email", ("l_author_has_email",))
    ch, select, distinct = NODE_GROUPS["person"]
    o.ctes["fn_person_swapped"] = (group_sql(["n_author_resolved", "n_maintainer"], [NODE_COLS["author"]] * 2,
                                             ["node_id"], select, distinct), ("n_author_resolved", "n_maintainer"))
    ch, select, distinct = LINK_GROUPS["has_email"]
    o.ctes["fl_has_email_swapped"] = (
        group_sql(["l_author_has_email_resolved", "l_maintainer_has_email"], [LINK_COLS[c] for c in ch],
                  ["from_id", "to_id"], select, distinct),
        ("l_author_has_email_resolved", "l_maintainer_has_email"))
    for key, table in (("group_override", "node_person"), ("group_override_link", "link_has_email")):
        swapped = [(t, cte + "_swapped" if t == table else cte) for t, cte in _final_tables("")]
        q[key] = o.sql(_digests(_with_cols(swapped)), [c for _, c in swapped])
    # persons resolved by brute force: all pairs that share a key, then all that can be reached
    o.ctes["person_named"] = ("""SELECT DISTINCT node_id, email,
  trim(regexp_replace(lower(coalesce(name, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS name
FROM (SELECT node_id, name, email FROM n_author UNION ALL SELECT node_id, name, email FROM n_maintainer) p""",
                              ("n_author", "n_maintainer"))
    o.ctes["person_key"] = ("""
WITH uses AS (
  SELECT DISTINCT node_id, name, address FROM (
    SELECT node_id, name, trim(unnest(string_split(lower(coalesce(email, '')), ','))) AS address FROM person_named) u
  WHERE contains(address, '@')),
team AS (SELECT address, count(DISTINCT CASE WHEN name <> '' THEN name END) > 1 AS many FROM uses GROUP BY address)
SELECT node_id, 'address|' || address || CASE WHEN many THEN '|' || name ELSE '' END AS key FROM uses JOIN team USING (address)
UNION ALL
SELECT DISTINCT p.node_id, 'package|' || l.from_id || '|' || p.name
FROM person_named p JOIN (SELECT from_id, to_id FROM l_has_author UNION ALL SELECT from_id, to_id FROM l_has_maintainer) l
  ON l.to_id = p.node_id WHERE p.name <> ''""", ("person_named", "l_has_author", "l_has_maintainer"))
    o.ctes["person_resolved"] = ("""
WITH RECURSIVE pair AS (SELECT DISTINCT a.node_id AS u, b.node_id AS v FROM person_key a JOIN person_key b USING (key)),
reach(u, v) AS (SELECT node_id, node_id FROM person_named UNION SELECT r.u, p.v FROM reach r JOIN pair p ON r.v = p.u)
SELECT u AS node_id, min(v) AS resolved_id FROM reach GROUP BY u""", ("person_named", "person_key"))
    q["resolve_person"] = o.sql("SELECT * FROM person_resolved", ["person_resolved"])
    for n in ("author", "maintainer"):
        attrs = ", ".join(f"arg_min({c}, n.node_id) FILTER (WHERE {_nb(c)}) AS {c}" for c in NODE_COLS[n][1:])
        o.ctes[f"n_{n}_one"] = (f"SELECT resolved_id AS node_id, {attrs} FROM n_{n} n JOIN person_resolved r "
                                "ON n.node_id = r.node_id GROUP BY resolved_id", (f"n_{n}", "person_resolved"))
    for n, side in (("has_author", "to_id"), ("has_maintainer", "to_id"),
                    ("author_has_email", "from_id"), ("maintainer_has_email", "from_id")):
        ends = ", ".join(f"coalesce(r.resolved_id, l.{c}) AS {c}" if c == side else f"l.{c}" for c in LINK_COLS[n])
        o.ctes[f"l_{n}_moved"] = (f"SELECT {ends} FROM l_{n} l LEFT JOIN person_resolved r ON l.{side} = r.node_id",
                                  (f"l_{n}", "person_resolved"))
        o.ctes[f"l_{n}_one"] = (_dedup(f"l_{n}_moved", ["from_id", "to_id"], LINK_COLS[n]), (f"l_{n}_moved",))
    ch, select, distinct = NODE_GROUPS["person"]
    o.ctes["fn_person_one"] = (group_sql([f"n_{c}_one" for c in ch], [NODE_COLS[c] for c in ch], ["node_id"], select,
                                         distinct), tuple(f"n_{c}_one" for c in ch))
    ch, select, distinct = LINK_GROUPS["has_email"]
    o.ctes["fl_has_email_one"] = (group_sql([f"l_{c}_one" for c in ch], [LINK_COLS[c] for c in ch],
                                            ["from_id", "to_id"], select, distinct), tuple(f"l_{c}_one" for c in ch))
    one = {"node_person": "fn_person_one", "link_has_email": "fl_has_email_one",
           "link_has_author": "l_has_author_one", "link_has_maintainer": "l_has_maintainer_one"}
    swapped = [(t, one.get(t, cte)) for t, cte in _final_tables("")]
    q["group_resolved"] = o.sql(_digests(_with_cols(swapped)), [c for _, c in swapped])
    q["distinct_on"] = o.sql(
        "SELECT DISTINCT ON (pkg_name, url) * FROM latest_url ORDER BY pkg_name, url, "
        "url_type NULLS FIRST, domain NULLS FIRST, top_level_domain NULLS FIRST, path NULLS FIRST, "
        "github_repo NULLS FIRST, github_account NULLS FIRST", ["latest_url"])
    q["key_id"] = o.sql(
        "SELECT pkg_name, person_name, email_record, email, "
        f"{_id(['person_name', 'email_record'])} AS person_id, {_id(['email'])} AS email_id, "
        f"{_id(['pkg_name', 'person_name', 'email_record'])} AS link_id FROM latest_email",
        ["latest_email"])
    q["not_both_blank"] = o.sql(
        f"SELECT role, {PERSON_OK} AS ok, CAST(count(*) AS BIGINT) AS n_rows FROM latest_email "
        "GROUP BY ALL", ["latest_email"])
    q["check_from_id"] = check_sql(o, "from_id")
    q["check_to_id"] = check_sql(o, "to_id")
    q["check_graph"] = check_sql(o, None)
    q["edge_type_summary"] = o.sql("\nUNION ALL\n".join(
        f"SELECT {_q(l)} AS link, {_q(TRIPLETS[l][0])} AS source, {_q(TRIPLETS[l][1])} AS target, "
        "CAST(count(*) AS BIGINT) AS n_links, CAST(count(DISTINCT from_id) AS BIGINT) AS n_sources, "
        f"CAST(count(DISTINCT to_id) AS BIGINT) AS n_targets FROM fl_{l}" for l in FINAL_LINKS),
        [f"fl_{l}" for l in FINAL_LINKS])
    q["graph_catalog"] = catalog_sql(o)
    q["build_graph"] = o.sql(_digests(_with_cols(_final_tables("r"))), [t for _, t in _final_tables("r")])
    q["update_graph"] = q["build_graph"]       # an update gives what a full build gives
    layers = {"canon": [(n, c, CANON_COLS[n]) for n, c in canon_raw],
              "subgraph": [(n, f"rn_{n}", NODE_COLS[n]) for n in NODES] + [(n, f"rl_{n}", LINK_COLS[n]) for n in LINKS],
              "graph": [(f"{t}_final", c, FINAL_COLS[t]) for t, c in _final_tables("r")]}
    q["write_layers"] = o.sql(
        "\nUNION ALL\n".join(_digests(ts, f"{_q(layer)} AS layer, ") for layer, ts in layers.items()),
        [c for ts in layers.values() for _, c, _ in ts])
    q["publish"] = o.sql(_digests(_with_cols(_final_tables(""))), [t for _, t in _final_tables("")])
    return q
