"""Walks over category and link tables, level by level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.constants import MAX_CATEGORY_DEPTH, NS_CATEGORY, NS_MAIN
from corpusmill.operators.categories import strip_category_prefix
from corpusmill.session import bucketed, materialize


SALTS = 8  # parts into which the edges of one page are dealt


def _laid_out(edges: DataFrame, key: str, target: str, name: str) -> DataFrame:
    """Edges bucketed once by their source, so that each level of a walk moves only the frontier.

    The edges of one source are dealt over ``SALTS`` parts by their target, as a hub may have a large share of all edges.
    """
    return bucketed(edges.withColumn("salt", F.pmod(F.xxhash64(target), F.lit(SALTS))), [key, "salt"], name)


def _salted(frontier: DataFrame) -> DataFrame:
    """The frontier once for each part."""
    return frontier.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))


def category_members(
    membership: DataFrame,
    roots: DataFrame,
    max_depth: int = MAX_CATEGORY_DEPTH,
    cap: int | None = None,
) -> DataFrame:
    """Pages below each root category: (root, title, url, category, depth).

    ``membership``: parent, member, ns, url, pos. ``roots``: root. A page carries the category that contains
    it and that category's depth; subcategories are followed down to ``max_depth``. Within a root each title
    counts once, at its first level and there on its first path of member positions. ``cap`` keeps the first
    pages of a root by path.
    """
    edges = _laid_out(membership.select(F.col("parent").alias("category"), "member", "ns", "url", "pos"), "category", "member", "members")
    frontier = roots.select("root").distinct().select(
        "root", F.col("root").alias("category"), F.array().cast("array<int>").alias("path")
    )
    visited = None
    levels: list[DataFrame] = []
    for depth in range(max_depth + 1):
        reached = _salted(frontier).join(edges, ["category", "salt"]).select(
            "root", "category", "member", "ns", "url", F.concat("path", F.array("pos")).alias("path")
        )
        first = reached.groupBy("root", "member").agg(
            F.min(F.struct("path", "category", "ns", "url")).alias("m")
        ).select("root", "member", "m.path", "m.category", "m.ns", "m.url")
        if visited is not None:
            first = first.join(visited, ["root", "member"], "left_anti")
        level = materialize(first.withColumn("depth", F.lit(depth)), "level")
        levels.append(level)
        frontier = level.filter(F.col("ns") == NS_CATEGORY).select(
            "root", strip_category_prefix(F.col("member")).alias("category"), "path"
        )
        if depth == max_depth or frontier.isEmpty():
            break
        seen = level.select("root", "member")
        visited = seen if visited is None else visited.unionByName(seen)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    pages = out.filter(F.col("ns") == NS_MAIN)
    if cap is not None:
        # A row_number bound is applied before the shuffle too, so a root with very many pages stays cheap.
        rank = F.row_number().over(W.partitionBy("root").orderBy("path"))
        pages = pages.withColumn("rank", rank).filter(F.col("rank") <= cap).drop("rank")
    return pages.select("root", F.col("member").alias("title"), "url", "category", "depth", "path")


def crawl_links(
    links: DataFrame,
    starts: DataFrame,
    depth: int = 1,
    visited: Sequence[str] | DataFrame = (),
    cap: int | None = None,
) -> DataFrame:
    """Breadth-first link rows from each start page: (start, src, pos, title, url, depth, path).

    ``links``: src, pos, url, dst. Pages reached within ``depth`` links are opened, in breadth-first order,
    each once. An opened page yields every link whose target was not opened before it and is not in
    ``visited`` (titles, or a table of them in the column ``title``); a target can therefore appear more than once. ``cap`` keeps the first rows of a start.

    ``path`` is the list of link positions on a page's first path; (depth, path) is the order of opening.
    """
    if isinstance(visited, DataFrame):
        shut = visited.select("title").distinct()
    else:
        shut = links.sparkSession.createDataFrame([(t,) for t in visited], "title string") if visited else None
    allowed = lambda df: df if shut is None else df.join(shut, "title", "left_anti")
    edges = links.filter(F.col("dst").isNotNull()).select("src", "pos", "url", F.col("dst").alias("title"))
    edges = _laid_out(allowed(edges), "src", "title", "links")
    opened = (
        allowed(starts.select("start").distinct().select("start", F.col("start").alias("title")))
        .select("start", "title", F.lit(0).alias("depth"), F.array().cast("array<int>").alias("path"))
    )
    frontier = opened
    for level in range(1, depth + 1):
        reached = (
            _salted(frontier.select("start", F.col("title").alias("src"), "path"))
            .join(edges, ["src", "salt"])
            .groupBy("start", "title")
            .agg(F.min(F.concat("path", F.array("pos"))).alias("path"))
            .join(opened.select("start", "title"), ["start", "title"], "left_anti")
        )
        frontier = materialize(
            reached.select("start", "title", F.lit(level).alias("depth"), "path"), "level"
        )
        if frontier.isEmpty():
            break
        opened = opened.unionByName(frontier)
    sources = opened.select("start", F.col("title").alias("src"), "depth", "path")
    targets = opened.select(
        "start", "title", F.struct("depth", "path").alias("target")
    )
    emitted = (
        _salted(sources).join(edges, ["src", "salt"])
        .join(targets, ["start", "title"], "left")
        .filter(F.col("target").isNull() | (F.col("target") > F.struct("depth", "path")))
        .select("start", "src", "pos", "title", "url", "depth", "path")
    )
    if cap is None:
        return emitted
    rank = F.row_number().over(W.partitionBy("start").orderBy("depth", "path", "pos"))
    return emitted.withColumn("rank", rank).filter(F.col("rank") <= cap).drop("rank")
