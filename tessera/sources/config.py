"""Configuration to the sources table (S-01..S-03, T1)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

SOURCES = ("name string, url string, tags array<string>, body_quality string, gate_limit int, extract_limit int, max_silence_days int, naive_date_offset string, feed_kind string, retired boolean, retired_on date, ord int")
KINDS = ("stream", "sample")


def load_config(path: str) -> dict:
    """A YAML or JSON file whose top level is a mapping."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml
    except ImportError:  # JSON is a subset of what the file may hold
        found = json.loads(text)
    else:
        found = yaml.safe_load(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path}: the top level must be a mapping")
    return found


def sources(spark: SparkSession, config: dict) -> DataFrame:
    """All configured feeds in their order; an unknown feed_kind or a list that is none is an error."""
    from datetime import date

    block = (config.get("sources") or {})
    rows, at = [], 0
    for key, retired in (("rss", False), ("retired", True)):
        feeds = block.get(key) or []
        if not isinstance(feeds, list):
            raise ValueError(f"sources.{key} must be a list")
        for f in feeds:
            kind = f.get("feed_kind", "stream")
            if kind not in KINDS:
                raise ValueError(f"{f.get('name')}: feed_kind {kind!r} is none of {KINDS}")
            limits = f.get("limits") or {}
            on = f.get("retired_on")
            rows.append((f["name"], f.get("url"), list(f.get("tags") or []), f.get("body_quality"), limits.get("gate"), limits.get("extract"), f.get("max_silence_days"), f.get("naive_date_offset"), kind, retired, date.fromisoformat(str(on)) if on else None, at))
            at += 1
    return spark.createDataFrame(rows, SOURCES)


def active(table: DataFrame) -> DataFrame:
    return table.where("not retired").orderBy("ord")


def retired(table: DataFrame) -> DataFrame:
    return table.where("retired").orderBy("ord")


def limits(table: DataFrame, overrides: dict[str, tuple[int, int]] | None = None, ceilings: tuple[int, int] = (200, 100)) -> DataFrame:
    """Limits by source, and the run's ceilings: sums, at most the hard ones. Any override replaces all configured limits (O-04, A-29)."""
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    if overrides:
        rows = [(n, g, e) for n, (g, e) in overrides.items()]
        table = table.sparkSession.createDataFrame(rows, "name string, gate_limit int, extract_limit int")
    whole = W.partitionBy()  # a row a source
    return table.select("name", "gate_limit", "extract_limit", F.least(F.sum("gate_limit").over(whole), F.lit(ceilings[0])).alias("gate_ceiling"), F.least(F.sum("extract_limit").over(whole), F.lit(ceilings[1])).alias("extract_ceiling"))
