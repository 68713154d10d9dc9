"""The next version of a graph from the last one and a new snapshot.

``build_graph(versioned=True, keep_records=True)`` leaves the canonical entries of every
record beside the layers (``records``: ord, name, digest of the JSON, entries).
``update_graph`` compares the new snapshot with them and works on the difference:

1. records are compared by (ord, name, digest), a full outer join of narrow rows; only the
   JSON of new and changed records is decoded, the others' entries are carried over.
   With ``stamp``, a column that changes whenever a record does, the texts of the others
   are not even hashed;
2. the canonical tables are made from the entries again: projections, but for the two
   order rules, which are aggregates with map-side combine;
3. affected canonical rows are those of the changed records, before and after, and those
   whose value an order rule flipped (``_flipped_packages``, ``_flipped_keywords``);
4. a subgraph table keeps the rows whose ids no affected row has; the other ids' rows are
   extracted again from all canonical rows that have them, so a value that several
   records hold stays as long as one of them does, and its attributes are those a full
   build picks. Final tables likewise, by the ids of their children; those that are
   their child as it is are copied from it;
5. all of it is a new version, checked and committed like any other.

The result equals a full build of the same snapshot. Changed records and affected ids are
bits of a set that is broadcast (``operators.marks``), so unaffected rows are copied by a
scan and are never shuffled; the few rows a set touches besides are made again too, which
gives the same rows. Shuffles grow with the change, except for the comparison of step 1, the
order rules' aggregates and the referential check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import key_id
from ..operators.checks import assert_valid, check_graph
from ..operators.extract import extract_link, extract_node
from ..operators.group import LINK_KEY, NODE_KEY, group_links, group_nodes
from ..operators.marks import Marks, key_hash, touched, untouched, write_marks
from ..operators.profile import assert_nonempty, expect_nonempty
from ..operators.running import kth_occurrence, require_order
from ..session import remove_path
from ..sources.layers import (commit_version, current_version, differing, new_version, write_layer,
                              write_manifest, write_table)
from ..sources.raw import judge_raw, parse_raw
from .canon import KEYWORD_MIN_COUNT, canonical_entries, canonical_from_entries, entry_rows, quarantined
from .graph import QUARANTINE, RECORDS, Graph, SubgraphView, with_digest
from .spec import GraphSpec, LinkSpec, NodeSpec, package_registry_spec

IDS = "sub int, final int, id long, pair long"


def compare_records(records: DataFrame, raw: DataFrame) -> DataFrame:
    """(ord, was, now) of the records that differ: ``was`` in the kept ``records``, ``now``
    in ``raw`` (both have ord, name, digest). An unchanged record is in neither state."""
    old = records.select("ord", F.struct("name", "digest").alias("_was"))
    new = raw.select("ord", F.struct("name", "digest").alias("_now"))
    both = old.join(new, "ord", "full")
    return both.where(~F.col("_was").eqNullSafe(F.col("_now"))).select(
        "ord", F.col("_was").isNotNull().alias("was"), F.col("_now").isNotNull().alias("now"))


def _flipped_packages(old: DataFrame, new: DataFrame, changed: DataFrame) -> DataFrame:
    """ords of the records that hold, or held, the first occurrence of a license whose first
    occurrence moved. Only licenses of ``changed`` package entries can move."""
    some = changed.select("license").where("license IS NOT NULL").distinct()
    first = [df.select("ord", "license").join(some, "license", "left_semi")
             .groupBy("license").agg(F.min("ord").alias(f"_o{i}")) for i, df in enumerate((old, new))]
    moved = first[0].join(first[1], "license", "full").where("NOT (_o0 <=> _o1)")
    return moved.select(F.explode(F.array("_o0", "_o1")).alias("ord")).where("ord IS NOT NULL").distinct()


def _flipped_keywords(old: DataFrame, new: DataFrame, changed: DataFrame, threshold: int) -> DataFrame:
    """Keyword rows of ``new`` between the places where their keyword's running count passes
    the threshold before and after. Only keywords of ``changed`` entries can move."""
    if threshold <= 0:
        return new.limit(0)
    some = changed.select("keyword").distinct()
    at = [kth_occurrence(df.join(some, "keyword", "left_semi"), "keyword", ["ord", "pos"], threshold)
          .withColumnRenamed("at", f"_a{i}") for i, df in enumerate((old, new))]
    moved = at[0].join(at[1], "keyword", "full").where("NOT (_a0 <=> _a1)")
    place = F.struct("ord", "pos")
    # a keyword that never gets there has its place after every row
    after = F.least("_a0", "_a1")
    until = F.when(F.col("_a0").isNotNull() & F.col("_a1").isNotNull(), F.greatest("_a0", "_a1"))
    return (new.join(moved, "keyword").where((place > after) & (until.isNull() | (place <= until)))
            .select(*new.columns))


def affected_rows(records: DataFrame, fresh: DataFrame, gone: DataFrame, now: DataFrame,
                  threshold: int) -> dict[str, DataFrame]:
    """Canonical rows, by table, among them all that differ between two snapshots.

    ``records`` are the kept ones, ``now`` the new ones, ``gone`` those of ``records`` that
    are not there any more as they were, ``fresh`` those of ``now`` that are new.
    """
    changed = gone.unionByName(fresh)
    tables = canonical_from_entries(changed, 0)
    before, after, moved = (entry_rows(df, "package") for df in (records, now, changed))
    ords = _flipped_packages(before, after, moved)
    packages = moved.unionByName(before.join(ords, "ord", "left_semi")).unionByName(after.join(ords, "ord", "left_semi"))
    # with its license and without: one is what was there, the other what is
    both = F.explode(F.array(F.col("license"), F.lit(None).cast("string")))
    columns = tables["latest_package"].columns
    tables["latest_package"] = packages.select(*[c for c in columns if c != "license"], both.alias("license")).select(*columns)
    words = [entry_rows(df, "keyword") for df in (records, now, changed)]
    flipped = _flipped_keywords(*words, threshold)
    tables["latest_keyword"] = words[2].unionByName(flipped).select("pkg_name", "keyword")
    return tables


def _ids(rows: DataFrame, spec: NodeSpec | LinkSpec, sub: int, final: int | None) -> DataFrame:
    """The ids that ``rows`` of the source give a subgraph table, hashed (``IDS``): its set,
    the set of the final table it is a child of, and for a link the hash of its ends."""
    df = rows.where(spec.where()) if spec.where is not None else rows
    made = key_hash(key_id(*spec.keys))
    pair = key_hash(key_id(*spec.src_key), key_id(*spec.dst_key)) if isinstance(spec, LinkSpec) else made
    return df.select(F.lit(sub).alias("sub"), F.lit(final).cast("int").alias("final"), made.alias("id"), pair.alias("pair"))


def _again(old: DataFrame, source: DataFrame, ids: Marks, spec: NodeSpec | LinkSpec) -> DataFrame:
    """``old`` with the rows of ``ids`` extracted again."""
    link = isinstance(spec, LinkSpec)
    rows = source.where(spec.where()) if spec.where is not None else source
    made = (extract_link if link else extract_node)(touched(rows, ids, key_id(*spec.keys)), spec)
    return untouched(old, ids, "link_id" if link else "node_id").unionByName(made)


def _regroup(old: DataFrame, children: list[DataFrame], keys: tuple[str, ...], ids: Marks, group) -> DataFrame:
    """``old`` with the rows of the keys in ``ids`` grouped again."""
    return untouched(old, ids, *keys).unionByName(group([touched(c, ids, *keys) for c in children]))


def update_graph(raw: DataFrame, layer_root: str, spec: GraphSpec | None = None, validate: str = "raise",
                 keyword_threshold: int = KEYWORD_MIN_COUNT, on_malformed: str = "fail",
                 stamp: str | None = None) -> Graph:
    """The graph of snapshot ``raw`` (ord, name, latest) as a new version below ``layer_root``.

    The current version there must have been made with ``keep_records`` (or by this
    function) and with the same ``spec``, ``keyword_threshold``, ``on_malformed`` and
    ``stamp``; of those, all but the spec are checked. ``ord`` says which record is which:
    if a snapshot numbers its records anew, they all count as changed, which is right
    but not quick. Resolved persons are not kept up: components are global, so such a
    graph is built in full. An unchanged snapshot gives an equal version.
    """
    if validate not in ("raise", "report"):
        raise ValueError(validate)
    spark, spec = raw.sparkSession, spec or package_registry_spec()
    last = current_version(spark, layer_root)
    read = lambda path: spark.read.parquet(f"{last}/{path}")
    said = tuple(read(f"{RECORDS}/settings").first())
    if said != (on_malformed, keyword_threshold, stamp or ""):
        raise ValueError(f"the kept version was made with (on_malformed, keyword_threshold, stamp) = {said}")
    require_order(raw, ["ord"])
    version, root = new_version(layer_root)

    # 1. records: only what changed is decoded
    records, marked = read(f"{RECORDS}/entries"), with_digest(raw, stamp)
    delta_path, gone_path, fresh_path = (f"{root}/delta/{n}" for n in ("records", "gone", "fresh"))
    write_table(compare_records(records, marked), delta_path)
    delta = spark.read.parquet(delta_path)
    states, key = ("was", "now"), F.col("ord").cast(delta.schema["ord"].dataType)
    sides = [delta.where(state).select(F.lit(i).alias("set"), key_hash("ord").alias("hash")) for i, state in enumerate(states)]
    moved = write_marks(sides[0].unionByName(sides[1]), len(states), f"{root}/delta/ords")
    was, new = (delta.where(state).select("ord") for state in states)
    some = touched(marked, moved[1], key).join(new, "ord", "left_semi").select(*marked.columns)
    parsed = judge_raw(some) if on_malformed == "drop" else parse_raw(some, on_malformed)
    write_table(canonical_entries(parsed, keep=("ord", "name", "digest")), fresh_path)
    fresh = spark.read.schema(records.schema).parquet(fresh_path)
    perhaps = touched(records, moved[0], key)
    write_table(perhaps.join(was, "ord", "left_semi").select(*records.columns), gone_path)
    gone = spark.read.schema(records.schema).parquet(gone_path)
    stayed = untouched(records, moved[0], key).unionByName(perhaps.join(was, "ord", "left_anti").select(*records.columns))
    now = write_layer({"entries": stayed.unionByName(fresh),
                       "settings": read(f"{RECORDS}/settings")}, f"{root}/{RECORDS}")["entries"]

    # 2. canonical tables, 3. affected ids
    split = on_malformed == "drop"
    canon = write_layer({**canonical_from_entries(now, keyword_threshold, deferred=True),
                         **({QUARANTINE: quarantined(now)} if split else {})}, f"{root}/canon")
    left_out = canon.pop(QUARANTINE, None)
    if validate == "raise":
        assert_nonempty(expect_nonempty(canon))
    rows = affected_rows(records, fresh, gone, now, keyword_threshold)
    rows = write_layer(rows, f"{root}/delta/rows")
    specs = {**{f"node/{n}": s for n, s in spec.nodes.items()}, **{f"link/{n}": s for n, s in spec.links.items()}}
    groups = {**{f"node/{n}": g for n, g in spec.all_node_groups().items()},
              **{f"link/{n}": g for n, g in spec.all_link_groups().items()}}
    sets = {n: i for i, n in enumerate([*specs, *(f"final/{n}" for n in groups)])}
    home = {f"{n.split('/')[0]}/{c}": sets[f"final/{n}"] for n, g in groups.items() for c in g.children}
    ids_path = f"{root}/delta/ids"
    write_table(reduce(DataFrame.unionByName, [_ids(rows[s.source], s, sets[n], home.get(n)) for n, s in specs.items()]), ids_path)
    both = F.array(F.struct(F.col("sub").alias("set"), F.col("id").alias("hash")),
                   F.struct(F.col("final").alias("set"), F.col("pair").alias("hash")))
    hashes = spark.read.schema(IDS).parquet(ids_path).select(F.explode(both).alias("e")).select("e.*")
    marks = write_marks(hashes.where("set IS NOT NULL"), len(sets), f"{root}/delta/marks")
    ids = {n: marks[i] for n, i in sets.items()}

    # 4. subgraph and final tables
    sub = write_layer({n: _again(read(f"subgraph/{n}"), canon[s.source], ids[n], s) for n, s in specs.items()},
                      f"{root}/subgraph")
    sub_nodes, sub_links = ({n: sub[f"{k}/{n}"] for n in of} for k, of in (("node", spec.nodes), ("link", spec.links)))
    check = check_graph(sub_nodes, sub_links, spec.subgraphs)
    if validate == "raise":
        assert_valid(check)
    view, final = SubgraphView(sub_nodes, sub_links, spec), {}
    for name, g in groups.items():
        kind, table = name.split("/")
        given, keys, group = (sub_nodes, NODE_KEY, group_nodes) if kind == "node" else (sub_links, LINK_KEY, group_links)
        final[f"{kind}_{table}_final"] = given[g.children[0]] if view.passes(kind, g) else _regroup(
            read(f"graph/{kind}_{table}_final"), [given[c] for c in g.children], keys, ids[f"final/{name}"],
            lambda children, g=g, group=group: group(children, g.select, g.distinct))
    metrics: dict[str, dict] = {}
    made = write_layer(final, f"{root}/graph", metrics=metrics)
    write_manifest(spark, {n.removesuffix("_final"): n for n in final}, f"{root}/graph", metrics)

    # 5. commit
    wrong = differing(spark, f"{root}/graph")
    if wrong:
        raise RuntimeError(f"tables that do not read back as written: {wrong}")
    commit_version(spark, layer_root, version)
    remove_path(spark, f"{root}/delta")          # its readers are written
    pick = lambda kind: {n.split("_", 1)[1].removesuffix("_final"): df
                         for n, df in made.items() if n.startswith(kind)}
    return Graph(canon, sub_nodes, sub_links, check, pick("node_"), pick("link_"), spec,
                 layer_root=root, quarantine=left_out)
