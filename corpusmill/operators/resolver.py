"""First-come duplicate removal over a "duplicate of" graph.

Rows are visited in order; a row is removed when an earlier row *that was kept* is its duplicate. This is
not the same as keeping one row per connected component: a removed row removes nobody.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialize


def removed_by_first_come(edges: DataFrame, cliques: DataFrame | None = None) -> DataFrame:
    """Order numbers (column ``seq``) of the removed rows.

    ``edges`` has columns ``lo < hi``. ``cliques`` (``clique``, ``seq``) names groups whose members are all
    duplicates of each other, so that a group of m copies costs m rows instead of m² edges.

    Each round settles every undecided row without an undecided earlier duplicate, in parallel: it stays, and
    its later duplicates go. Of a clique only the edges from its first undecided member are needed in a round.
    Rounds follow the longest chain of decisions, which is short unless duplicates form long ordered chains.
    """
    edges = materialize(edges.select("lo", "hi"), "edges")
    removed_parts: list[DataFrame] = []
    while True:
        current = edges.withColumn("listed", F.lit(True))
        if cliques is not None:
            first = cliques.groupBy("clique").agg(F.min("seq").alias("lo"))
            star = cliques.join(first, "clique").filter("seq > lo")
            current = current.unionByName(star.select("lo", F.col("seq").alias("hi"), F.lit(False).alias("listed")))
        blocked = current.select(F.col("hi").alias("lo")).distinct()
        kept = current.select("lo").distinct().join(blocked, "lo", "left_anti").withColumn("stays", F.lit(True))
        marked = materialize(
            current.join(kept, "lo", "left").select("lo", "hi", "listed", F.col("stays").isNotNull().alias("stays")),
            "round",
        )
        settled = marked.filter("stays")
        removed = settled.select(F.col("hi").alias("seq")).distinct()
        removed_parts.append(removed)
        edges = (
            marked.filter("listed AND NOT stays").select("lo", "hi")
            .join(removed.select(F.col("seq").alias("lo")), "lo", "left_anti")
            .join(removed.select(F.col("seq").alias("hi")), "hi", "left_anti")
        )
        if cliques is not None:
            gone = removed.unionByName(settled.select(F.col("lo").alias("seq")).distinct())
            left = cliques.join(gone, "seq", "left_anti")
            several = left.groupBy("clique").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("clique")
            cliques = materialize(left.join(several, "clique").select("clique", "seq"), "cliques")
            if cliques.isEmpty():
                cliques = None
        if cliques is None and marked.filter("listed AND NOT stays").isEmpty():
            break
    out = removed_parts[0]
    for part in removed_parts[1:]:
        out = out.unionByName(part)
    return out
