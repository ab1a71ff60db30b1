"""Connected components of a table of links, by smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.session import stored


def components(links: DataFrame) -> DataFrame:
    """(v, comp) for every end of ``links`` (a, b): the smallest vertex that can be reached.

    Each round takes the smallest label among a vertex and its neighbours, then the label of
    that label. A round ends in a table of the shared folder, so plans stay short and a lost
    executor costs no more than a round. Links and labels never come to the driver. An empty
    table of links gives an empty result; a link from a vertex to itself changes nothing.
    """
    both = stored(
        links.select(F.col("a").alias("v"), F.col("b").alias("w"))
        .union(links.select("b", "a")).distinct(),
        "links",
    )
    labels = stored(
        both.groupBy("v").agg(F.least("v", F.min("w")).alias("comp")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("v").alias("w"), F.col("comp").alias("c")), "w")
        seen = near.groupBy("v").agg(F.min("c").alias("c"))
        best = labels.join(seen, "v").select(
            "v", F.col("comp").alias("old"), F.least("comp", "c").alias("comp")
        )
        jump = labels.select(F.col("v").alias("comp"), F.col("comp").alias("next"))
        new = stored(
            best.join(jump, "comp", "left").select(
                "v", "old", F.least("comp", F.coalesce("next", "comp")).alias("comp")
            ),
            "labels",
        )
        labels = new.select("v", "comp")
        if new.where("comp != old").isEmpty():
            return labels
