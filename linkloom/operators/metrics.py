"""Counters of a run: observed while data passes, or of a batch of updates."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..store import Files
from ..streaming import incremental


def observed(pages: DataFrame, name: str = "pages") -> tuple[DataFrame, Observation]:
    """pages with an observation that counts pages, pages without links and links as they pass: no extra job."""
    seen = Observation(name)
    n = F.size("outbound_links")
    return pages.observe(seen, F.count("*").alias("pages"), F.count_if(n <= 0).alias("empty_pages"), F.coalesce(F.sum(F.greatest(n, F.lit(0))), F.lit(0)).alias("links")), seen


def update_meters(tables: dict[str, DataFrame], updates: DataFrame, order: list[str], keep_linkless: bool = False) -> DataFrame:
    """One row: what a batch of updates brings and changes.

    updates_in, pages_changed, links_new, links_deleted, uris_changed, domains_new, domains_gone, domains_changed
    """
    touched, d = incremental.deltas(tables["pages"], incremental.last_updates(updates, order, keep_linkless))
    links = incremental.link_changes(touched).agg(F.count_if(F.col("change_kind") == "added").alias("links_new"), F.count_if(F.col("change_kind") == "deleted").alias("links_deleted"))
    dd = incremental.domain_deltas(tables["uri_info"], d).join(tables["domain_count"], "domain", "left").withColumn("was", F.coalesce("pagecount", F.lit(0)))
    now = F.col("was") + F.col("delta")
    domains = dd.agg(F.count_if(F.col("was") == 0).alias("domains_new"), F.count_if(now == 0).alias("domains_gone"), F.count("*").alias("domains_changed"))
    parts = [updates.agg(F.count("*").alias("updates_in")), touched.agg(F.count("*").alias("pages_changed")), links, d.agg(F.count("*").alias("uris_changed")), domains]
    out = parts[0].withColumn("one", F.lit(1))
    for p in parts[1:]:  # each is a single row
        out = out.join(F.broadcast(p.withColumn("one", F.lit(1))), "one")
    return out.drop("one")


class MeterLog:
    """Sink of the stream's meters: one JSON line per batch, in a file of its own below a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.files = Files(spark, folder)

    def __call__(self, batch: int, meters: dict) -> None:
        name = f"{batch:012d}.json"
        if name not in self.files.names(""):
            self.files.write(name, json.dumps({"batch": batch, **meters}))

    def rows(self) -> list[dict]:
        return [json.loads(self.files.read(n)) for n in self.files.names("") if n.endswith(".json")]
