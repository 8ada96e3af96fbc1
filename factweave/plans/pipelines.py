"""End-to-end compositions of the operators (E3 of SURVEY §3)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from factweave.operators import grouping as G
from factweave.operators import linking as L


def group_and_link(extractions: DataFrame, link: bool = False, min_freq: int = 0, max_freq: int = 2**31 - 1,
                   anchors: DataFrame | None = None, entities: DataFrame | None = None) -> DataFrame:
    """JN7/JN8: group, frequency-filter and (optionally) link. The original's group+link job
    never links (Q4); ``link=True`` runs JN6 on the kept groups."""
    summary = G.frequency_filter(G.summarize(extractions), min_freq, max_freq)
    if not link:
        return summary
    inst = G.group_instances(extractions)
    keep = summary.select(*G.KEY)
    inst = inst.join(keep, G.KEY, "left_semi")
    parts = G.first_instance_parts(extractions.withColumn("inst_id", G.instance_hash()), G.KEY) \
        .join(keep, G.KEY, "left_semi")
    return summary.join(L.link_groups(inst, parts, anchors, entities), G.KEY)
