"""A run of named stages with soft failure: each one's table is written or its error is kept, and the run goes on.

A stage is a function of the session and the tables that it needs.  Its result is written below the run's folder and
counts once its marker is renamed into place; a run that is started again reads what is there and computes
the rest.  A stage whose input failed is skipped, one that only wants an input gets None for it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

STATUS = "ord int, stage string, status string, seconds double, rows long, error string"


@dataclass(frozen=True)
class Stage:
    """``run(spark, *needs, *wants)``: tables of the stages it needs (without them it's skipped) and of those it wants (None if there are none)."""

    name: str
    run: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    wants: tuple[str, ...] = ()
    vital: bool = False


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def run_stages(spark: SparkSession, stages: list[Stage], folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Run ``stages`` in order; their status (ord, stage, status, seconds, rows, error) and the tables of those that are done.

    Status is done, kept (from an earlier run), failed or skipped.  A vital stage that fails ends the run with its error.
    Names are unique, and a stage names only stages before it.
    """
    names = [s.name for s in stages]
    for i, s in enumerate(stages):
        if s.name in names[:i] or not {*s.needs, *s.wants} <= set(names[:i]):
            raise ValueError(f"stage {s.name} is named twice or asks for what doesn't stand before it")
    files, root = _filesystem(folder)
    files.create_dir(root, recursive=True)
    tables: dict[str, DataFrame] = {}
    rows = []
    for i, s in enumerate(stages):
        marker = f"{root}/{s.name}.json"
        if files.get_file_info(marker).type != fs.FileType.NotFound:
            with files.open_input_stream(marker) as f:
                kept = json.loads(f.read())
            tables[s.name] = spark.read.parquet(f"{folder}/{kept['part']}")
            rows.append((i, s.name, "kept", 0.0, kept["rows"], None))
            continue
        if missing := [n for n in s.needs if n not in tables]:
            rows.append((i, s.name, "skipped", 0.0, None, f"without {', '.join(missing)}"))
            continue
        began, part = time.time(), f"{s.name}-{uuid.uuid4().hex[:12]}"
        try:
            s.run(spark, *[tables[n] for n in s.needs], *[tables.get(n) for n in s.wants]).write.parquet(f"{folder}/{part}")
            table = spark.read.parquet(f"{folder}/{part}")
            n = table.count()
            with files.open_output_stream(f"{root}/{part}.tmp") as f:
                f.write(json.dumps({"part": part, "rows": n}).encode())
            files.move(f"{root}/{part}.tmp", marker)
        except Exception as e:
            if s.vital:
                raise
            rows.append((i, s.name, "failed", time.time() - began, None, f"{type(e).__name__}: {str(e).splitlines()[0][:500] if str(e) else ''}"))
            continue
        tables[s.name] = table
        rows.append((i, s.name, "done", time.time() - began, n, None))
    return spark.createDataFrame(rows, STATUS), tables
