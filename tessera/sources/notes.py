"""Note sink: one Markdown file a row, as a Python data source (S-27, F-15, F-19)."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Order of a note's front matter. Fixed values.
KEYS = ("title", "date", "published_at", "source", "source_url", "tech_domain", "release_type", "companies", "prior_art", "impact_score", "impact_rationale", "extraction_model", "prompt_version", "processed_at")


def front_matter(values: dict) -> str:
    """A YAML block in the order of KEYS; strings are quoted where a bare one would read as something else."""
    import json
    import re

    def scalar(v) -> str:
        if v is None:
            return "null"
        if isinstance(v, (bool, int, float)):
            return json.dumps(v)
        text = str(v)
        bare = re.fullmatch(r"[^\W\d_][^:#\n\[\]{},&*!|>'\"%@`]*", text) and text == text.strip() and text.lower() not in ("null", "true", "false", "yes", "no", "on", "off")
        return text if bare else json.dumps(text, ensure_ascii=False)

    lines = []
    for k in (k for k in KEYS if k in values):
        v = values[k]
        if isinstance(v, (list, tuple)):
            lines += [f"{k}:", *(f"- {scalar(x)}" for x in v)] if v else [f"{k}: []"]
        else:
            lines.append(f"{k}: {scalar(v)}")
    return "\n".join(lines) + "\n"


@dataclass
class _Done(WriterCommitMessage):
    written: int
    skipped: int


class Notes(DataSource):
    """df(file, content).write.format("notes").option("path", folder).option("on_conflict", "skip" or "overwrite").mode("append").save()

    Each file is written beside its place and moved there, so none is ever half there. The folder must be one that all executors share.
    """

    @classmethod
    def name(cls) -> str:
        return "notes"

    def writer(self, schema, overwrite) -> DataSourceWriter:
        return _Writer(dict(self.options))


class _Writer(DataSourceWriter):
    def __init__(self, options: dict) -> None:
        self.path, self.policy = options["path"].removeprefix("file://"), options.get("on_conflict", "skip")
        if self.policy not in ("skip", "overwrite"):
            raise ValueError(f"on_conflict {self.policy!r} is not supported")

    def write(self, rows) -> _Done:
        os.makedirs(self.path, exist_ok=True)
        written = skipped = 0
        for row in rows:
            place = os.path.join(self.path, row["file"])
            if os.path.exists(place) and self.policy == "skip":
                skipped += 1
                continue
            part = f"{place}.{uuid.uuid4().hex}.tmp"
            with open(part, "w", encoding="utf-8") as f:
                f.write(row["content"])
            os.replace(part, place)
            written += 1
        return _Done(written, skipped)
