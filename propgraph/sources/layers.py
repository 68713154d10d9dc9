"""Stage outputs as named tables: parquet layers and a published catalog.

Writing a layer also cuts the lineage: later stages read the written files,
so a lost executor never forces a recomputation back to the raw JSON, and
their scans prune to the columns each statement needs. The tables of one
layer are independent, so their write jobs are submitted concurrently (the
scheduler interleaves their tasks instead of running 25 small jobs in a row).

Versions. ``new_version`` names a fresh folder below a root, and ``commit_version``
makes it current by one empty marker file whose name says all
(``_commits/<number>.<version>``): creating it is atomic on every file system, and
there is nothing to read half of. Readers resolve the current version once
(``current_version``), so a run killed at any point leaves the last good version as
it was, and a reader never sees two versions mixed.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.profile import column_metrics
from ..session import remove_path

MAX_CONCURRENT_JOBS = 16

#: Ids are hex digits: half a byte each, which snappy does not find and zstd does.
CODEC = "zstd"

#: While tables are written: a write's shuffle files go with it (else they stay until the
#: driver happens to collect its garbage), and a broadcast waits for its turn among the jobs.
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                 "spark.sql.broadcastTimeout": "-1"}
_writing: dict[str, tuple[int, dict[str, str | None]]] = {}     # by session: how many write, what held before
_lock = threading.Lock()


@contextmanager
def _while_writing(spark: SparkSession) -> Iterator[None]:
    """``WHILE_WRITING`` holds; what held before does again after the last of the session's
    writers."""
    key = spark._jsparkSession.sessionUUID()
    with _lock:
        n, before = _writing.get(key) or (0, {k: spark.conf.get(k, None) for k in WHILE_WRITING})
        _writing[key] = (n + 1, before)
        for k, v in WHILE_WRITING.items():
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _lock:
            n, before = _writing.pop(key)
            if n > 1:
                _writing[key] = (n - 1, before)
            else:
                for k, v in before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_table(df: DataFrame, path: str, mode: str = "error", by: Sequence[str] = ()) -> None:
    """Write one table as the layers' tables are, ``by`` folders of those columns."""
    with _while_writing(df.sparkSession):
        df.write.mode(mode).option("compression", CODEC).partitionBy(*by).parquet(path)


def _run_all(tasks: dict[str, Callable[[], object]]) -> dict[str, object]:
    if len(tasks) <= 1:
        return {k: t() for k, t in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT_JOBS, len(tasks))) as pool:
        futures = {k: pool.submit(t) for k, t in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def write_layer(tables: dict[str, DataFrame | Callable[[], DataFrame]], root: str,
                mode: str = "overwrite", metrics: dict[str, dict] | None = None) -> dict[str, DataFrame]:
    """Write each table to ``{root}/{name}`` and return the read-back tables.

    A table may be given as a function building it, for tables whose
    building itself runs jobs: it then runs concurrently with the others.
    ``metrics`` gets, by table, the ``column_metrics`` of the rows as they were
    written (an ``Observation`` on the write, no further pass).
    """
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}

    def task(t, path):
        def run():
            df = t() if callable(t) else t
            if metrics is None:
                write_table(df, path, mode)
            else:
                seen = Observation()
                write_table(df.observe(seen, *column_metrics(df)), path, mode)
                metrics[path.removeprefix(f"{root.rstrip('/')}/")] = seen.get
            # the schema is known: no job to read it from the files
            return df.sparkSession.read.schema(df.schema).parquet(path)
        return run

    return _run_all({name: task(t, paths[name]) for name, t in tables.items()})


MANIFEST = "_tables"


def write_manifest(spark, tables: dict[str, str], root: str, metrics: dict[str, dict] | None = None) -> None:
    """Record the folder of each table below ``root`` (a small (table, path,
    metrics) table; paths are relative, so a layer can be moved). ``metrics``, by
    folder, come from ``write_layer``."""
    rows = [(t, path, {k: int(v or 0) for k, v in metrics[path].items()} if metrics else None)
            for t, path in sorted(tables.items())]
    (spark.createDataFrame(rows, "table string, path string, metrics map<string,bigint>").coalesce(1)
          .write.mode("overwrite").parquet(f"{root.rstrip('/')}/{MANIFEST}"))


def read_metrics(spark, root: str) -> dict[str, dict[str, int]]:
    """The metrics of a graph layer's tables as they were written, by name (none if
    the layer was written without)."""
    rows = spark.read.parquet(f"{_current(spark, root)}/{MANIFEST}").collect()
    return {r.table: r.metrics for r in rows if "metrics" in r and r.metrics}


def differing(spark, root: str) -> list[str]:
    """The tables of a graph layer whose files do not hold what was written: their
    metrics, read back, against the manifest's."""
    said, tables = read_metrics(spark, root), read_graph(spark, root)
    found = _run_all({n: (lambda df=df: df.agg(*column_metrics(df)).first().asDict()) for n, df in tables.items()})
    return sorted(n for n in tables if n in said and {k: int(v or 0) for k, v in found[n].items()} != said[n])


# ----------------------------------------------------------------- versions
VERSIONS, COMMITS = "versions", "_commits"


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, version) of every commit below ``root``, oldest first."""
    path, fs = _folder(spark, f"{root.rstrip('/')}/{COMMITS}")
    if not fs.exists(path):
        return []
    names = [f.getPath().getName().split(".", 1) for f in fs.listStatus(path)]
    return sorted((int(n[0]), n[1]) for n in names if len(n) == 2 and n[0].isdigit())


def new_version(root: str) -> tuple[str, str]:
    """A fresh version name and its folder; nothing is written yet."""
    version = uuid.uuid4().hex[:16]
    return version, f"{root.rstrip('/')}/{VERSIONS}/{version}"


def commit_version(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the current one."""
    done = commits(spark, root)
    path, fs = _folder(spark, f"{root.rstrip('/')}/{COMMITS}/{(done[-1][0] if done else 0) + 1:09d}.{version}")
    fs.mkdirs(path.getParent())
    if not fs.createNewFile(path):
        raise RuntimeError(f"{path} is there already")


def current_version(spark: SparkSession, root: str) -> str:
    """The folder of the current version; ``root`` itself where no versions are kept."""
    done = commits(spark, root)
    return f"{root.rstrip('/')}/{VERSIONS}/{done[-1][1]}" if done else root.rstrip("/")


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders of all versions but the last ``keep`` committed ones, and
    the leftovers of runs that were never committed; the versions removed. Not to be
    run beside a build on the same root."""
    kept = {v for _, v in commits(spark, root)[-max(1, keep):]}
    path, fs = _folder(spark, f"{root.rstrip('/')}/{VERSIONS}")
    there = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    gone = sorted(v for v in there if v not in kept)
    for v in gone:
        remove_path(spark, f"{root.rstrip('/')}/{VERSIONS}/{v}")
    return gone


def _current(spark: SparkSession, layer: str) -> str:
    """``ROOT/graph`` as the layer of ROOT's current version, if versions are kept there."""
    root, _, name = layer.rstrip("/").rpartition("/")
    return f"{current_version(spark, root)}/{name}"


def read_graph(spark, root: str) -> dict[str, DataFrame]:
    """The final tables of a graph layer, by name (``node_package``, ...): all of one
    version, the current one when called."""
    root = _current(spark, root)
    rows = spark.read.parquet(f"{root}/{MANIFEST}").collect()   # one row per table
    return {r.table: spark.read.parquet(f"{root}/{r.path}") for r in rows}


def publish(final: dict[str, DataFrame], database: str = "graph",
            location: str | None = None) -> dict[str, DataFrame]:
    """Save every final table as ``{database}.{name}`` (full overwrite)."""
    if not final:
        return {}
    spark = next(iter(final.values())).sparkSession
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
    _run_all({name: (lambda df=df, n=name: df.write.mode("overwrite").format("parquet")
                     .saveAsTable(f"`{database}`.`{n}`"))
              for name, df in final.items()})
    return {name: spark.table(f"`{database}`.`{name}`") for name in final}
