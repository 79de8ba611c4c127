"""Registry of runnable queries with their comparison SQL.

A query is a function of :class:`Tables`.  Its SQL text may use any view of
``views.VIEWS``; the views are put in front of it as common table expressions,
and Spark reads the very same view text.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import run_dir, true_sizes, write_by
from .views import VIEWS

BASE = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The table that all graph views start from; written once per session and folder.  The views over it
# are worked out by those who read them, with the columns that they need: edges are arithmetic on a
# row of it, and joins of edges moved and wrote every column for each query before.
STAGED = ("v_seg",)
# Rows of the given table for a file of a staged view, about; a task of a join on its key holds as many.
ROWS_A_FILE = 500_000
# The same rows as the view's, made so that they stay where the staged table laid them out: a union does not.
READ_AS = {
    "v_half": """
select gid, pk, sk, dir, case when dir = 0 then near_node else far_node end as start_node, case when dir = 0 then far_node else near_node end as end_node
from v_span lateral view explode(array(0, 1)) d as dir
"""
}
_STAGE: dict[tuple[str, str, str], str] = {}
_HELD: dict[tuple[str, str, str], dict[str, str]] = {}
_STAGE_LOCK = threading.RLock()

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def _uses(text: str, known=VIEWS) -> list[str]:
    names = set(re.findall(r"[a-z_0-9]+", text))
    return [v for v in known if v in names]


def with_views(body: str) -> str:
    """Put the views that ``body`` needs, and those they need, in front of it."""
    needed: set[str] = set()
    todo = _uses(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [n for n in _uses(VIEWS[name]) if n != name]
    ctes = [f"{name} as (\n{VIEWS[name].strip()}\n)" for name in VIEWS if name in needed]
    body = body.strip()
    lead = re.match(r"with(\s+recursive)?\s+", body, re.I)
    if not ctes:
        return body
    if lead:
        word = "with recursive" if lead.group(1) else "with"
        return f"{word} " + ",\n".join(ctes) + ",\n" + body[lead.end():]
    return "with " + ",\n".join(ctes) + "\n" + body


class Tables:
    """The given tables and the test views over them, for one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        true_sizes(spark)
        self._seen: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._seen:
            if name in BASE:
                self._seen[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in STAGED:
                self._seen[name] = self._staged(name)
            else:
                self._seen[name] = self.sql(READ_AS.get(name, VIEWS[name]))
        return self._seen[name]

    def _staged(self, name: str) -> DataFrame:
        """Write the view to the shared folder once, laid out by its first column, then read it as a table.

        Edges keep the key, so edges of both graphs meet on it where they lie.
        """
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        with _STAGE_LOCK:
            if key not in _STAGE:
                rows = self.sql(VIEWS[name])
                largest = max(self(base).count() for base in _uses(VIEWS[name], BASE))
                _STAGE[key] = write_by(rows, f"stage-{name}", rows.columns[0], parts=-(-largest // ROWS_A_FILE))
        return self.spark.table(_STAGE[key])

    def held(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """An intermediate result that many queries share, worked out and written once."""
        return self.held_all(name, lambda: {name: make()})[name]

    def held_all(self, name: str, make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """Like ``held`` for several results that one operator gives together."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        with _STAGE_LOCK:
            if key not in _HELD:
                _HELD[key] = {}
                try:
                    for part, df in make().items():
                        path = run_dir(self.spark, f"held-{name}")
                        df.write.option("compression", "zstd").parquet(path)
                        _HELD[key][part] = path
                except BaseException:
                    del _HELD[key]
                    raise
        return {part: self.spark.read.parquet(path) for part, path in _HELD[key].items()}

    def starting_at(self, view: str, ids: DataFrame) -> DataFrame:
        """The rows of a view "from <edges> e join ..." whose edge e is one of ``ids`` (graph_id).

        The edges are chosen before the join, so that no other row is made and moved.  If the
        ids come with their gid, they are chosen where they lie: the id decides between the few
        edges of a gid, but is no key.
        """
        edges = re.search(r"from (\w+) e join", VIEWS[view])[1]
        part = f"{view}_part"
        if "gid" in ids.columns:
            wanted = ids.select(F.col("gid").alias("_gid"), F.col("graph_id").alias("_id"))
            of_one = (F.col("gid") == F.col("_gid")) & F.col("graph_id").between(F.col("_id"), F.col("_id"))
            chosen = self(edges).join(wanted, of_one, "left_semi")
        else:
            chosen = self(edges).join(ids.select("graph_id"), "graph_id", "left_semi")
        chosen.createOrReplaceTempView(part)
        return self.sql(VIEWS[view].replace(f"from {edges} e join", f"from {part} e join"))

    def sql(self, body: str) -> DataFrame:
        """Run SQL over views; each becomes a temporary view, analysed once."""
        for name in set(re.findall(r"[a-z_0-9]+", body)) & (set(BASE) | set(VIEWS)):
            self(name).createOrReplaceTempView(name)
        return self.spark.sql(body)


def query(name: str, oracle: str | None = None):
    def keep(fn):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return fn

    return keep
