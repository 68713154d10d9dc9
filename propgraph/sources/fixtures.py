"""Registry-shaped input views derived from the driver's TPC-H-ish tables.

Each view is one SQL text that runs unchanged on Spark and on DuckDB. Table
references are ``{placeholders}``: Spark fills them with DataFrames
(``spark.sql(text, part=df)``, no global temp views), the DuckDB oracle with
CTE names. Every view grows with the given tables, in rows and in keys:
packages, persons, addresses, URLs and domains follow the parts, orders and
customers, next to a few hot ones (a third of the addresses share a domain).

The ``%`` expressions shape values, to produce the cases the rules must
handle (NULL and '' twins, unknown markers, URLs with two types, orphans);
no view drops rows to save work: every row of part, lineitem, orders, pages
and supplier feeds them (``p_partkey % 10 = 0`` adds a second URL row for a
tenth of the packages on top of the row every package gets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("part", "lineitem", "orders", "pages", "supplier")

VIEWS: dict[str, str] = {}

VIEWS["raw_fields"] = """
SELECT p_partkey AS ord, concat('pkg-', p_partkey) AS name, p_name AS info_name,
  concat('https://pkg.example.org/', p_partkey) AS package_url,
  concat('>=', p_size) AS requires_python, concat('1.', p_size) AS version,
  p_size AS num_releases, p_size % 7 AS num_info_dependencies,
  CASE WHEN p_type = 'ECONOMY' THEN 'UNKNOWN' WHEN p_type = 'LARGE' THEN NULL
       WHEN p_partkey % 50 = 0 THEN concat('LIC-', p_partkey)
       ELSE concat(p_brand, '/', p_type) END AS license,
  CASE p_partkey % 6
    WHEN 0 THEN concat('<https://github.com/', replace(p_brand, '#', ''), '/', replace(p_name, ' ', '-'), '.git>')
    WHEN 1 THEN concat('https://github.com/acct', p_partkey - p_partkey % 4, '/')
    WHEN 2 THEN 'github.com/no/scheme'
    WHEN 3 THEN 'UNKNOWN'
    WHEN 4 THEN concat('http://user@h_', p_partkey - p_partkey % 30, '.com:80//a///b', p_size, ';p?q#f')
    ELSE NULL END AS home_page,
  CASE WHEN p_partkey % 3 = 0 THEN concat('https://docs.example.org/', p_partkey) END AS docs_url,
  CASE WHEN p_partkey % 5 = 0 THEN concat('https://github.com/tiangolo/t', p_partkey, '.git') END AS pu_source,
  CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Ann <old>'
    ELSE CASE WHEN p_partkey % 8 = 3 THEN 'Cara' ELSE concat('Cara ', p_partkey) END END AS author,
  CASE p_partkey % 5 WHEN 0 THEN NULL
    WHEN 1 THEN concat('Jane ', p_partkey, ' <j', p_partkey, '@x.org>, Bob <b@y.org>')
    WHEN 2 THEN concat('a', p_partkey, '@x', p_partkey - p_partkey % 40, '.org, b@y.net')
    WHEN 3 THEN 'nodomain' ELSE '' END AS author_email,
  CASE p_partkey % 4 WHEN 0 THEN 'Mo <mo@old.org>' WHEN 1 THEN concat('Mo ', p_partkey) END AS maintainer,
  CASE p_partkey % 6 WHEN 0 THEN concat('Mia ', p_partkey, ' <m', p_partkey, '@z.io>')
    WHEN 2 THEN concat('m', p_partkey, '@z.io') WHEN 4 THEN 'hot@z.io' END AS maintainer_email,
  CASE p_partkey % 3
    WHEN 0 THEN concat('["', p_type, '", "', replace(p_name, ' ', '", "'), '"]')
    WHEN 1 THEN concat(p_type, ' ', p_name) END AS keywords
FROM {part}
"""

VIEWS["raw_requires"] = """
SELECT concat('pkg-', l_partkey) AS name,
  concat('pkg-', l_partkey * 7 + l_linenumber) AS req_name,
  CASE WHEN l_linenumber = 1 THEN 'null' WHEN l_linenumber = 2 THEN 'empty' ELSE 'two' END AS kind,
  concat('>', l_linenumber) AS requirement,
  concat('1.', l_linenumber) AS rel_a, concat('1.', l_linenumber + 8) AS rel_b
FROM {lineitem} GROUP BY l_partkey, l_linenumber
"""

VIEWS["latest_package"] = """
SELECT name AS pkg_name, info_name AS name, package_url, requires_python, version,
  num_releases, num_info_dependencies AS num_requires_dist, license
FROM {raw_fields}
"""

VIEWS["latest_requirement"] = """
SELECT name AS pkg_name, req_name AS required_pkg_name,
  CASE WHEN kind = 'two' THEN 2 ELSE 0 END AS num_match_dist,
  CASE WHEN kind = 'null' THEN req_name ELSE requirement END AS requirement_string,
  CASE WHEN kind = 'two' THEN greatest(rel_a, rel_b) END AS newest_dist,
  CASE WHEN kind = 'two' THEN least(rel_a, rel_b) END AS oldest_dist
FROM {raw_requires}
"""

VIEWS["latest_url"] = """
SELECT concat('pkg-', page_id) AS pkg_name, url, 'home_page' AS url_type,
  nullif(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '') AS domain,
  nullif(regexp_extract(url, '^[a-z]+://[^/?#]*[.]([^./?#]*)', 1), '') AS top_level_domain,
  nullif(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '') AS path,
  CAST(NULL AS VARCHAR(10)) AS github_repo, CAST(NULL AS VARCHAR(10)) AS github_account
FROM {pages}
UNION ALL
SELECT concat('pkg-', p_partkey), concat('https://github.com/', lower(p_type), '/', replace(p_name, ' ', '-')),
  CASE WHEN p_partkey % 2 = 0 THEN 'Source' ELSE 'Code' END, 'github.com', 'com',
  concat('/', lower(p_type), '/', replace(p_name, ' ', '-')),
  concat(lower(p_type), '/', replace(p_name, ' ', '-')), lower(p_type)
FROM {part}
UNION ALL
SELECT concat('pkg-', p_partkey), concat('https://github.com/', lower(p_type), '/', replace(p_name, ' ', '-')),
  'docs_url', 'github.com', 'com', concat('/', lower(p_type), '/', replace(p_name, ' ', '-')),
  concat(lower(p_type), '/', replace(p_name, ' ', '-')), lower(p_type)
FROM {part} WHERE p_partkey % 10 = 0
UNION ALL
SELECT concat('pkg-', s_suppkey), CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'UNKNOWN' ELSE '' END,
  'docs_url', NULL, NULL, NULL, NULL, NULL
FROM {supplier}
"""

VIEWS["latest_keyword"] = """
SELECT concat('pkg-', p_partkey) AS pkg_name, lower(p_type) AS keyword FROM {part}
UNION ALL
SELECT concat('pkg-', p_partkey), lower(p_name) FROM {part} WHERE p_size > 25
"""

VIEWS["latest_email"] = """
SELECT concat(CASE WHEN o_custkey % 61 = 5 THEN 'gone-' ELSE 'pkg-' END, o_custkey) AS pkg_name,
  CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 = 1 THEN '' ELSE concat('Cust ', o_custkey) END AS person_name,
  CASE WHEN o_custkey % 50 = 7 THEN NULL ELSE concat('u', o_custkey - o_custkey % 2, '@mail', CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey - o_custkey % 20 END, '.example.com') END AS email_record,
  CASE WHEN o_custkey % 50 = 7 THEN NULL ELSE concat('u', o_custkey - o_custkey % 2, '@mail', CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey - o_custkey % 20 END, '.example.com') END AS email,
  CASE WHEN o_custkey % 50 = 7 THEN NULL ELSE concat('mail', CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey - o_custkey % 20 END, '.example.com') END AS domain,
  'com' AS top_level_domain,
  CASE WHEN o_orderkey % 2 = 0 THEN 'author' ELSE 'maintainer' END AS role
FROM {orders}
"""

#: Records of every kind of contract violation, next to good ones, from the snapshot ``{raw}``.
DAMAGED = """
SELECT ord, name, CASE ord % 29
  WHEN 1 THEN NULL
  WHEN 2 THEN substr(latest, 1, length(latest) - 1)
  WHEN 3 THEN replace(latest, '"info":', '"inf":')
  WHEN 4 THEN replace(latest, '"version":', '"versio":')
  WHEN 5 THEN replace(latest, '"license":', '"license":["a"],"licence":')
  WHEN 6 THEN replace(latest, '"requires":', '"requires":"x","required":')
  WHEN 7 THEN replace(latest, '"home_page":', '"home_page":5,"home":')
  WHEN 8 THEN replace(latest, '"author_email":', '"author_email":["a@x"],"email":')
  WHEN 9 THEN replace(latest, '"requirement":', '"requirements":')
  WHEN 10 THEN replace(latest, '"releases":["', '"releases":[1,"')
  WHEN 11 THEN replace(latest, '"num_releases":', '"num_releases":"many","n":')
  WHEN 12 THEN replace(latest, '"project_urls":{{"Source":', '"project_urls":{{"Home":7,"Source":')
  WHEN 13 THEN '[1]'
  WHEN 14 THEN replace(latest, '"requires":', '"required":')
  WHEN 15 THEN replace(latest, '"keywords":', '"keywords":["a"],"words":')
  WHEN 16 THEN replace(latest, '"author":', '"author":3,"writer":')
  WHEN 17 THEN replace(latest, '"requires":{{', '"requires":{{"extra":"text",')
  WHEN 18 THEN replace(replace(latest, '"info":', '"info":null,"inf":'), '"num_info_dependencies":', '"n":')
  WHEN 19 THEN replace(latest, '"releases":', '"released":')
  ELSE latest END AS latest
FROM {raw}
"""

DEPENDS = {
    "raw_fields": ("part",),
    "raw_requires": ("lineitem",),
    "latest_package": ("raw_fields",),
    "latest_requirement": ("raw_requires",),
    "latest_url": ("pages", "part", "supplier"),
    "latest_keyword": ("part",),
    "latest_email": ("orders",),
}

CANONICAL = ("latest_package", "latest_requirement", "latest_url", "latest_keyword", "latest_email")


class Fixtures:
    """Lazily built fixture views over the parquet tables of one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                args = {d: self.table(d) for d in DEPENDS[name]}
                df = self.spark.sql(VIEWS[name], **args)
            self._cache[name] = df
        return self._cache[name]

    def canonical(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in CANONICAL}

    def raw_snapshot(self) -> DataFrame:
        """The raw snapshot (ord, name, latest JSON) built from the views."""
        from .raw import raw_snapshot
        return raw_snapshot(self.table("raw_fields"), self.table("raw_requires"))

    def raw_damaged(self) -> DataFrame:
        """The raw snapshot with contract violations of every kind."""
        return self.spark.sql(DAMAGED, raw=self.raw())

    def raw(self) -> DataFrame:
        """The raw snapshot as the pipeline meets it: a parquet input file.

        Synthesized once per Spark application and scale, written under the
        shared checkpoint folder as one file per core (as a registry dump comes
        in many files; a single file would make the decode one task), then read
        with ``scan_raw``. Records are spread by a hash of ``ord``: ranges would
        be sampled first, which makes the whole snapshot twice.
        """
        from ..session import path_exists, scratch_path
        from .layers import write_table
        from .raw import scan_raw
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        path = _RAW_FILES.get(key)
        if path is None or not path_exists(self.spark, path):
            path = scratch_path(self.spark, "raw", "latest")
            n = self.spark.sparkContext.defaultParallelism
            write_table(self.raw_snapshot().repartition(n, "ord"), path)
            _RAW_FILES[key] = path
        return scan_raw(self.spark, path)


_RAW_FILES: dict[tuple[str, str], str] = {}



def duckdb_ctes(names: list[str]) -> list[tuple[str, str]]:
    """(name, SQL) for the views ``names`` need, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in order:
            return
        for d in DEPENDS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    fmt = {n: n for n in list(BASE_TABLES) + list(VIEWS)}
    return [(n, VIEWS[n].format(**fmt).strip()) for n in order]
