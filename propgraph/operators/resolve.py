"""Entity resolution: which persons of a graph are the same one.

Evidence comes as keys; persons that share a key are the same:

* an e-mail address, if the persons that use it have at most one name between
  them (a person without a name counts as the named one); if they have several
  names (a team's address), only those of the same name;
* the same name on the same package, whatever the addresses.

Addresses are compared in lower case without blanks around, names in lower case
with everything but letters and digits as one blank. A key's members are linked
to its smallest one (``star_edges``), never pairwise, so a hot address needs no
cap and loses no link; components are contracted (``connected_components``).

The resolved id of a person is the smallest node id of its component. Resolved
tables have one row per resolved id (each attribute from the smallest node
id that has it), and links at persons end at resolved ids; all are swapped into
the graph through ``GraphSpec.with_swap``, so groups, final tables and checks
stay as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import not_blank
from ..session import reliable_checkpoint
from .components import connected_components, star_edges
from .distinct import distinct_on
from .skew import spread_join


def normal_name(name: Column) -> Column:
    """Lower case, letters and digits with single blanks between; '' for none."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def addresses(record: Column) -> Column:
    """The addresses of an e-mail text: lower case, trimmed, with an @."""
    return F.filter(F.transform(F.split(F.lower(F.coalesce(record, F.lit(""))), ","), F.trim),
                    lambda a: F.contains(a, F.lit("@")))


def person_evidence(persons: DataFrame, packages: DataFrame) -> DataFrame:
    """(node_id, key) from ``persons`` (node_id, name, email) and ``packages``
    (package_id, node_id)."""
    named = persons.select("node_id", normal_name(F.col("name")).alias("name"), "email").distinct()
    uses = reliable_checkpoint(named.select("node_id", "name", F.explode(addresses(F.col("email"))).alias("address")).distinct())
    # one name at most: the smallest and the largest agree (combined map-side)
    said = F.when(F.col("name") != "", F.col("name"))
    shared = uses.groupBy("address").agg((F.coalesce(F.min(said) != F.max(said), F.lit(False))).alias("team"))
    by_address = spread_join(uses, shared, "address").select("node_id", F.concat(
        F.lit("address|"), "address", F.when(F.col("team"), F.concat(F.lit("|"), "name")).otherwise(F.lit(""))).alias("key"))
    on_package = reliable_checkpoint(packages.select("package_id", "node_id").distinct())
    by_package = (spread_join(on_package, distinct_on(named.where("name <> ''").select("node_id", "name"), ["node_id"]), "node_id")
                  .select("node_id", F.concat(F.lit("package|"), "package_id", F.lit("|"), "name").alias("key")))
    return by_address.unionByName(by_package)


def resolve_persons(persons: DataFrame, packages: DataFrame) -> DataFrame:
    """(node_id, resolved_id) of every person."""
    persons = reliable_checkpoint(persons.select("node_id", "name", "email"))     # read three times
    found = connected_components(star_edges(person_evidence(persons, packages)))
    return (persons.select("node_id").distinct()
            .join(found.withColumnRenamed("node", "node_id"), "node_id", "left")
            .select("node_id", F.coalesce("component", "node_id").alias("resolved_id")))


def resolved_nodes(nodes: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row per resolved id; an attribute comes from the smallest node id with a
    non-blank one."""
    attrs = [c for c in nodes.columns if c != "node_id"]
    rows = nodes.join(resolved, "node_id")
    picked = [F.min(F.when(not_blank(c), F.struct("node_id", c)))[c].alias(c) for c in attrs]
    return rows.groupBy("resolved_id").agg(*picked).select(F.col("resolved_id").alias("node_id"), *attrs)


def resolved_links(links: DataFrame, side: str, resolved: DataFrame) -> DataFrame:
    """Links whose ``side`` ends at resolved ids, one per pair of ends; an end that is
    no known person stays."""
    at = resolved.select(F.col("node_id").alias(side), F.col("resolved_id").alias("_to"))
    moved = spread_join(reliable_checkpoint(links), at, side, "left")
    return distinct_on(moved.select(*[F.coalesce("_to", side).alias(side) if c == side else F.col(c)
                                      for c in links.columns]), ["from_id", "to_id"])


#: The registry graph's person tables: node tables, (link, person side), links from packages.
PERSON_NODES = ("author", "maintainer")
PERSON_LINKS = (("has_author", "to_id"), ("has_maintainer", "to_id"),
                ("author_has_email", "from_id"), ("maintainer_has_email", "from_id"))
PACKAGE_LINKS = ("has_author", "has_maintainer")


def person_resolution(view) -> DataFrame:
    """(node_id, resolved_id) over the person tables of a graph view."""
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    persons = union([view.sub_node(n).select("node_id", "name", "email") for n in PERSON_NODES])
    packages = union([view.sub_link(n).select(F.col("from_id").alias("package_id"), F.col("to_id").alias("node_id"))
                      for n in PACKAGE_LINKS])
    return resolve_persons(persons, packages)


def resolved_tables(view, resolved: DataFrame) -> dict[str, DataFrame]:
    """The tables to swap in, by name: ``author_resolved``, ``has_author_resolved``, ..."""
    out = {f"{n}_resolved": resolved_nodes(view.sub_node(n), resolved) for n in PERSON_NODES}
    out.update({f"{n}_resolved": resolved_links(view.sub_link(n), side, resolved) for n, side in PERSON_LINKS})
    return out


def with_resolved_persons(spec):
    """``spec`` with the resolved tables in the place of the person tables."""
    for n in PERSON_NODES:
        spec = spec.with_swap("node", n, f"{n}_resolved")
    for n, _ in PERSON_LINKS:
        spec = spec.with_swap("link", n, f"{n}_resolved")
    return spec
