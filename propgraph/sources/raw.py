"""The raw snapshot: one row per package, ``latest`` = the registry's JSON text.

The JSON is decoded once with an explicit schema (no inference pass) whose
leaves are VARIANT, so a value keeps its JSON type and an absent key differs
from a null. The record contract (``CONTRACT``) is checked on them: which keys a
record must have and of which type. Each violation is a reason code
(``info.license:not text``); the typed record is made only from what passed.

Two fields may hold anything by the registry's rules: a ``keywords`` or
``*_email`` value that is no text, and a ``project_urls`` that is no object,
yield no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the record contract -----------------------------------------
TEXTS = ("name", "package_url", "requires_python", "version", "license", "home_page", "docs_url")
ANYTHING = ("keywords", "project_urls", "author", "author_email", "maintainer", "maintainer_email")
COUNTS = ("num_releases", "num_info_dependencies")
PERSONS = ("author", "maintainer")
#: JSON types of ``requires`` entries that break no rule (those of others are looked into).
PLAIN_ENTRIES = ("VOID", *(f"OBJECT<releases: ARRAY<{r}>, requirement: {t}>"
                           for r in ("STRING", "VOID") for t in ("STRING", "VOID")))
# ---------------------------------------------------------------------------------

RAW_SCHEMA = (
    ", ".join(f"{c} variant" for c in COUNTS)
    + ", info struct<" + ", ".join(f"{c} variant" for c in TEXTS + ANYTHING) + ">"
    + ", requires map<string, variant>, _corrupt string"
)


def scan_raw(spark: SparkSession, path: str, ord_col: str | None = "ord") -> DataFrame:
    """Read the snapshot; column ``ord_col`` gives the input order, ``None``
    takes ``name`` for it. A named column that is not there is an error."""
    df = spark.read.parquet(path)
    if ord_col is not None and ord_col not in df.columns:
        raise ValueError(f"no order column {ord_col!r} in {path}; it has {df.columns}")
    return df.select(F.col(f"`{ord_col or 'name'}`").alias("ord"), "name", "latest")


def _kind(v: Column) -> Column:
    """The JSON type of a value; NULL when the key is absent."""
    return F.schema_of_variant(v)


def _is_text(v: Column) -> Column:
    return F.coalesce(_kind(v) == "STRING", F.lit(False))


def _text(v: Column) -> Column:
    """The text of a JSON string; NULL for any other JSON value."""
    return F.when(_is_text(v), F.try_variant_get(v, "$", "string"))


def _wrong(v: Column, *kinds: str) -> Column:
    """Present, not null and of none of the JSON types ``kinds`` (or prefixes of them)."""
    fine = _kind(v) == "VOID"
    for k in kinds:
        fine = fine | _kind(v).startswith(k)
    return v.isNotNull() & ~fine


def _entry(e: Column, key: str) -> Column:
    return F.try_variant_get(e, f"$.{key}", "variant")


def _entry_values(j: Column, test) -> Column:
    """Whether some entry of ``requires`` that is an object fails ``test``."""
    return F.coalesce(F.exists(F.map_values(j["requires"]),
                               lambda e: _kind(e).startswith("OBJECT") & test(e)), F.lit(False))


def _unread(latest: Column, j: Column) -> list[tuple[str, Column]]:
    """Why a text could not be read as a record. Only such texts are parsed again: for
    others the parsers get NULL, as a shared expression is computed for every row."""
    unread = latest.isNotNull() & (j["_corrupt"].isNotNull() | j.isNull())
    text = F.when(unread, latest)
    whole = F.try_parse_json(text)
    part = lambda path: F.schema_of_variant(F.try_variant_get(whole, path, "variant"))
    valid = F.get_json_object(text, "$").isNotNull()
    twice = unread & whole.isNull() & valid
    is_object = F.schema_of_variant(whole).startswith("OBJECT")
    return [("latest:absent", latest.isNull()),
            ("latest:not json", unread & whole.isNull() & ~valid),
            ("latest:repeated key", twice),
            ("latest:not object", unread & ~is_object),
            ("info:not object", unread & is_object & (part("$.info") != "VOID") & ~part("$.info").startswith("OBJECT")),
            ("requires:not object", unread & is_object & (part("$.requires") != "VOID")
             & ~part("$.requires").startswith("OBJECT"))]


def contract(latest: Column, j: Column) -> list[tuple[str, Column]]:
    """(reason code, whether a record violates it), in order."""
    info = j["info"]
    read = latest.isNotNull() & j.isNotNull() & j["_corrupt"].isNull()
    out = _unread(latest, j)
    out += [(f"{c}:absent", read & j[c].isNull()) for c in COUNTS]
    out += [(f"{c}:not number", _wrong(j[c], "BIGINT", "DECIMAL", "DOUBLE", "FLOAT")) for c in COUNTS]
    # a record whose info is JSON null has no keys either
    out.append(("info:absent", read & info.isNull()))
    out += [(f"info.{c}:absent", read & info.isNotNull() & info[c].isNull()) for c in TEXTS + ANYTHING]
    out += [(f"info.{c}:not text", _wrong(info[c], "STRING")) for c in TEXTS]
    out += [(f"info.{c}:not text", _is_text(info[f"{c}_email"]) & _wrong(info[c], "STRING")) for c in PERSONS]
    urls = F.try_variant_get(info["project_urls"], "$", "map<string,variant>")
    out.append(("info.project_urls:not text", F.coalesce(
        _kind(info["project_urls"]).startswith("OBJECT") & F.exists(F.map_values(urls), lambda u: _wrong(u, "STRING")),
        F.lit(False))))
    keys = F.map_keys(j["requires"])
    # one look at each entry; the rules on entries are only tried where some entry is not plain
    odd = F.size(F.array_except(F.transform(F.map_values(j["requires"]), _kind), F.array(*map(F.lit, PLAIN_ENTRIES)))) > 0
    out += [("requires:absent", read & j["requires"].isNull()
             & ~F.array_contains(F.json_object_keys(latest), "requires")),
            ("requires:repeated key", F.coalesce(F.size(keys) != F.size(F.array_distinct(keys)), F.lit(False))),
            ("requires.entry:not object", odd & F.exists(F.map_values(j["requires"]), lambda e: _wrong(e, "OBJECT")))]
    out += [(f"requires.{c}:absent", odd & _entry_values(j, lambda e, c=c: _entry(e, c).isNull()))
            for c in ("releases", "requirement")]
    out += [("requires.releases:not texts", odd & _entry_values(j, lambda e: _entry(e, "releases").isNotNull()
                                                                & ~_kind(_entry(e, "releases")).isin("ARRAY<STRING>", "ARRAY<VOID>"))),
            ("requires.requirement:not text", odd & _entry_values(j, lambda e: _wrong(_entry(e, "requirement"), "STRING")))]
    return [(code, F.coalesce(bad, F.lit(False))) for code, bad in out]


def _typed(j: Column) -> Column:
    """The record with its types: values of another JSON type are NULL."""
    info = j["info"]
    number = lambda c: F.try_variant_get(j[c], "$", "double").alias(c)
    urls = F.try_variant_get(info["project_urls"], "$", "map<string,variant>")
    urls = F.when(_kind(info["project_urls"]).startswith("OBJECT"), F.transform_values(urls, lambda _, u: _text(u)))
    texts = [c for c in TEXTS + ANYTHING if c != "project_urls"]
    # not a map: a key given twice would stop the job here
    entries = F.transform(F.map_entries(j["requires"]), lambda e: F.struct(
        e["key"].alias("key"), F.when(_kind(e["value"]).startswith("OBJECT"), F.struct(
            F.try_variant_get(e["value"], "$.releases", "array<string>").alias("releases"),
            _text(_entry(e["value"], "requirement")).alias("requirement"))).alias("value")))
    return F.struct(*[number(c) for c in COUNTS],
                    F.struct(*[_text(info[c]).alias(c) for c in texts], urls.alias("project_urls")).alias("info"),
                    entries.alias("requires"))


def _once(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` with ``cols`` computed once per row, whatever is done with them later. The
    optimizer copies a column's expression into every filter and most projections above
    it (a filter on ``reasons`` would decode the JSON again for each reason); it copies
    nothing through a generator, and an array of one row gives that row."""
    one = F.explode(F.array(F.struct(*cols))).alias("_one")
    return df.select(*[c for c in df.columns if c not in cols], one).select(
        *[F.col(f"_one.{c}") if c in cols else F.col(c) for c in df.columns])


def judge_raw(raw: DataFrame) -> DataFrame:
    """(ord, name, latest, reasons, j): the reason codes of every record (an empty
    list for a good one) and what could be read of it; ``digest``, if ``raw`` has one,
    follows ``latest``."""
    read = F.from_json(F.col("latest"), RAW_SCHEMA,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    given = ["ord", "name", "latest", *(["digest"] if "digest" in raw.columns else [])]
    df = raw.select(*given, read.alias("_j"))
    # joined as a text: an array function with a lambda around the codes (array_compact)
    # would have all of them interpreted instead of compiled
    codes = F.concat_ws("\n", *[F.when(bad, F.lit(code)) for code, bad in contract(F.col("latest"), F.col("_j"))])
    judged = _once(df.select(*given, codes.alias("reasons"), _typed(F.col("_j")).alias("j")), "reasons", "j")
    listed = F.when(F.col("reasons") == "", F.array().cast("array<string>")).otherwise(F.split("reasons", "\n"))
    return judged.withColumn("reasons", listed)


def parse_raw(raw: DataFrame, on_malformed: str = "fail") -> DataFrame:
    """(ord, name, j) with ``j`` the typed record, and ``raw``'s ``digest`` if it has one.

    A record that violates the contract stops the job (``on_malformed='fail'``,
    with its reasons), is dropped ('drop'; ``quarantine`` has those) or kept ('keep')
    with what could be read: values of a wrong type are NULL, the last of repeated
    ``requires`` entries counts, and ``project_urls`` with a repeated key gives none.
    """
    df = judge_raw(raw)
    bad = F.size("reasons") > 0
    if on_malformed == "fail":
        # Folded into `name`, which every canonical table reads, so the check
        # rides on the same pass and the JSON is decoded once.
        name = F.when(bad, F.raise_error(F.concat(
            F.lit("malformed record: "), F.coalesce(F.col("name"), F.lit("NULL")), F.lit(" ("),
            F.array_join("reasons", ", "), F.lit(")"))))
        df = df.withColumn("name", name.otherwise(F.col("name")))
    elif on_malformed == "drop":
        df = df.where(~bad)
    elif on_malformed != "keep":
        raise ValueError(on_malformed)
    return df.drop("latest", "reasons")


def quarantine(raw: DataFrame) -> DataFrame:
    """(ord, name, reason, latest) of the records that violate the contract;
    ``reason`` joins their codes."""
    bad = judge_raw(raw).where(F.size("reasons") > 0)
    return bad.select("ord", "name", F.array_join("reasons", ", ").alias("reason"), "latest")


def raw_snapshot(raw_fields: DataFrame, raw_requires: DataFrame) -> DataFrame:
    """Pack flat package fields and requirement rows into (ord, name, latest).

    ``raw_requires`` has one row per requirement entry with ``kind`` = 'null'
    (NULL entry), 'empty' (no releases) or 'two' (releases rel_a, rel_b).
    NULL map values are written out (``ignoreNullFields=false``); entries
    are sorted by key, so the text is reproducible. One package's entries are
    one record's map, so the per-package collect is bounded by the record.
    """
    value = F.when(F.col("kind") == "null", F.lit(None)).otherwise(F.struct(
        F.when(F.col("kind") == "two", F.array("rel_a", "rel_b"))
         .otherwise(F.array().cast("array<string>")).alias("releases"),
        F.col("requirement").alias("requirement")))
    # entries of a name do not meet before the shuffle: collected once, after it
    requires = (raw_requires
                .repartition("name").groupBy("name")
                .agg(F.map_from_entries(F.array_sort(F.collect_list(
                    F.struct(F.col("req_name"), value)))).alias("requires")))
    f = raw_fields.join(requires, "name", "left")
    project_urls = F.when(F.col("pu_source").isNotNull(), F.create_map(
        F.lit("Source"), F.col("pu_source"), F.lit("None"), F.lit(None).cast("string")))
    info = F.struct(
        F.col("info_name").alias("name"), "package_url", "requires_python", "version",
        "license", "home_page", "docs_url", "keywords", "author", "author_email",
        "maintainer", "maintainer_email", project_urls.alias("project_urls"))
    record = F.struct("num_releases", "num_info_dependencies", info.alias("info"), "requires")
    return f.select("ord", "name",
                    F.to_json(record, {"ignoreNullFields": "false"}).alias("latest"))
