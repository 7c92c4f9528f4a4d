"""ZIP archives as a source, the archive of runs, and the scan that reads changed files only."""

from __future__ import annotations

import io
import json
import re
import uuid
import zipfile
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quiremill.operators.jobs import COST_PER_PAGE

# Limits of an archive, and the suffixes of scans.
MAX_ENTRIES, MAX_BYTES = 2000, 1 << 30
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".tif", ".tiff", ".webp", ".bmp")


class ArchiveError(ValueError):
    """An archive that breaks a limit or names a file outside of its folder."""


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def checked_members(archive: zipfile.ZipFile, name: str, max_entries: int, max_bytes: int) -> list[zipfile.ZipInfo]:
    """Files of an archive within the limits; hidden ones and those of resource folders are left out."""
    members = archive.infolist()
    if len(members) > max_entries:
        raise ArchiveError(f"{name}: {len(members)} entries; at most {max_entries}")
    if (size := sum(m.file_size for m in members)) > max_bytes:
        raise ArchiveError(f"{name}: {size} bytes unpacked; at most {max_bytes}")
    out = []
    for m in members:
        parts = m.filename.replace("\\", "/").split("/")
        if m.filename.startswith("/") or ".." in parts or re.match("[A-Za-z]:", m.filename) or "\x00" in m.filename:
            raise ArchiveError(f"{name}: unsafe name {m.filename!r}")
        if not m.is_dir() and not parts[-1].startswith(".") and "__MACOSX" not in parts:
            out.append(m)
    return out


class _Members(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class ZipReader(DataSourceReader):
    """A partition per archive and range of members."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.entries, self.bytes = int(options.get("maxentries", MAX_ENTRIES)), int(options.get("maxbytes", MAX_BYTES))
        self.per_task = int(options.get("memberspertask", 64))
        self.suffixes = tuple(x.strip().lower() for x in options["suffixes"].split(",")) if options.get("suffixes") else None

    def _chosen(self, path: str) -> tuple[list[zipfile.ZipInfo], object]:
        files, at = _filesystem(path)
        stream = files.open_input_file(at)
        archive = zipfile.ZipFile(stream)
        members = checked_members(archive, path, self.entries, self.bytes)
        return [m for m in members if self.suffixes is None or m.filename.lower().endswith(self.suffixes)], archive

    def partitions(self) -> list[InputPartition]:
        files, root = _filesystem(self.path)
        info = files.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(root, recursive=True))
        out = []
        for f in sorted(found, key=lambda x: x.path):
            if f.type == fs.FileType.File and f.path.lower().endswith(".zip"):
                # an archive of few bytes has few members; only larger ones are opened here to be cut
                n = self.entries if f.size < 1 << 16 else len(self._chosen(f.path if "://" not in self.path else f"{self.path.split('://')[0]}://{f.path}")[0])
                step = n if f.size < 1 << 16 else self.per_task
                out += [_Members(f.path, lo, lo + step) for lo in range(0, max(n, 1), max(step, 1))]
        return out

    def read(self, partition: _Members | None) -> Iterator[tuple]:
        if partition is None:  # no archive at all
            return
        path = partition.path if "://" not in self.path else f"{self.path.split('://')[0]}://{partition.path}"
        members, archive = self._chosen(path)
        for m in members[partition.first : partition.last]:
            with archive.open(m) as f:
                data = f.read(self.bytes + 1)
            if len(data) != m.file_size:
                raise ArchiveError(f"{path}: {m.filename!r} has {len(data)} bytes, not {m.file_size}")
            yield partition.path, m.filename, m.filename.replace("\\", "/").split("/")[-1], len(data), data


class ZipSource(DataSource):
    """``spark.read.format("zip_members").load(folder)``: (archive, member, name, size, content).

    Options: ``suffixes`` (comma-separated), ``maxEntries``, ``maxBytes``, ``membersPerTask``.  An archive beyond a limit, with an
    unsafe name or with another size than it states is an error; a folder without archives is empty.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return "archive string, member string, name string, size long, content binary"

    def reader(self, schema) -> ZipReader:
        return ZipReader(dict(self.options))


def read_zips(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(ZipSource)
    return spark.read.format("zip_members").options(**options).load(path)


def zip_scans(spark: SparkSession, path: str, **options) -> DataFrame:
    """The images and PDFs in a folder's archives."""
    return read_zips(spark, path, suffixes=",".join([*IMAGE_SUFFIXES, ".pdf"]), **options)


def write_zip(files: dict[str, bytes]) -> bytes:
    """An archive of these files, for tests and exports."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in files.items():
            z.writestr(name, data)
    return out.getvalue()


# -- The archive of runs ----------------------------------------------------------------------


def run_snapshot(artifacts: DataFrame, reports: DataFrame, run_id: str, archived_at: str, note: str = "") -> tuple[DataFrame, DataFrame]:
    """The artefacts (job, name, kind, size) of a run and a row of data per job that has any.

    ``reports``: (job, status, passed, failed, fallback_ok, pages, threshold, lang), null or absent where unknown.  A run passes if nothing failed or
    something passed; else its reported status, else completed.
    """
    files = artifacts.select(F.lit(run_id).alias("run_id"), "job", "name", "kind", "size", F.round(F.col("size") / 1024, 1).alias("size_kb"))
    n = files.groupBy("job").agg(F.count("*").alias("artifacts"), F.round(F.sum("size_kb"), 1).alias("total_kb"))
    r = n.join(reports, "job", "left")
    status = F.when((F.coalesce("failed", F.lit(1)) == 0) | (F.coalesce("passed", F.lit(0)) > 0), "PASS").otherwise(F.coalesce(F.nullif("status", F.lit("")), F.lit("COMPLETED")))
    meta = r.select(
        F.lit(run_id).alias("run_id"), "job", F.lit(archived_at).alias("archived_at"), F.lit(note or "previous run").alias("note"), status.alias("status"), F.coalesce("threshold", F.lit(100.0)).alias("threshold"),
        F.coalesce("lang", F.lit("deu+eng")).alias("lang"), F.coalesce("pages", "artifacts").cast("long").alias("pages"), F.coalesce("passed", F.lit(0)).cast("long").alias("passed"), F.coalesce("failed", F.lit(0)).cast("long").alias("failed"),
        F.round(F.coalesce("fallback_ok", F.lit(0)) * COST_PER_PAGE, 4).alias("cost"), "artifacts", "total_kb",
    )
    return files, meta


def archive_run(artifacts: DataFrame, reports: DataFrame, folder: str, archived_at: str, note: str = "", run_id: str | None = None) -> str:
    """Append a run to the archive in ``folder`` and return its id.

    Tables are written below the run's own name; the manifest, written last and renamed into place, makes the run exist: a writer
    that is killed before leaves files that no reader sees.  A run id that is committed is an error.
    """
    run_id = run_id or f"run_{re.sub('[^0-9]', '', archived_at)[:14]}_{uuid.uuid4().hex[:8]}"
    files_, root = _filesystem(folder)
    files_.create_dir(f"{root}/runs", recursive=True)
    if files_.get_file_info(f"{root}/runs/{run_id}.json").type != fs.FileType.NotFound:
        raise ValueError(f"{run_id} is in the archive already")
    part = uuid.uuid4().hex[:12]
    files, meta = run_snapshot(artifacts, reports, run_id, archived_at, note)
    files.write.parquet(f"{folder}/files/{run_id}-{part}")
    meta.write.parquet(f"{folder}/meta/{run_id}-{part}")
    with files_.open_output_stream(f"{root}/runs/{run_id}.{part}.tmp") as f:
        f.write(json.dumps({"run_id": run_id, "part": part, "archived_at": archived_at}).encode())
    files_.move(f"{root}/runs/{run_id}.{part}.tmp", f"{root}/runs/{run_id}.json")
    return run_id


def read_runs(spark: SparkSession, folder: str, table: str = "meta") -> DataFrame | None:
    """The rows of all committed runs (``meta`` or ``files``), None before the first."""
    files, root = _filesystem(folder)
    if files.get_file_info(f"{root}/runs").type == fs.FileType.NotFound:
        return None
    runs = []
    for info in files.get_file_info(fs.FileSelector(f"{root}/runs")):
        if info.path.endswith(".json"):
            with files.open_input_stream(info.path) as f:
                runs.append(json.loads(f.read()))
    paths = [f"{folder}/{table}/{r['run_id']}-{r['part']}" for r in sorted(runs, key=lambda r: (r["archived_at"], r["run_id"]))]
    return spark.read.parquet(*paths) if paths else None


# -- Changed files ----------------------------------------------------------------------------


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, hash) of the files under ``path``."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.select("path", "length", F.sha2("content", 256).alias("hash"))


def changed_files(now: DataFrame, before: DataFrame | None, staged: DataFrame | None = None) -> DataFrame:
    """(path) of files that are new or have other bytes than ``before``, and of those in ``staged`` (path); each once."""
    new = now.select("path", "hash")
    if before is not None:
        new = new.join(before.select("path", "hash"), ["path", "hash"], "left_anti")
    paths = new.select("path")
    return (paths if staged is None else paths.union(staged.select("path"))).distinct()


def incremental_scan(spark: SparkSession, path: str, index: str, scan, schema: str) -> DataFrame:
    """Findings of ``scan`` (a function of files (path, content) to findings (path, ...) of ``schema``) for all files, reading changed ones only.

    ``index`` is a folder of generations, each a table of hashes and one of findings; a manifest names the last whole one, so a
    killed scan is as if it hadn't begun.  Findings of files that are gone go too.
    """
    files, root = _filesystem(index)
    files.create_dir(root, recursive=True)
    before = old = None
    if files.get_file_info(f"{root}/current").type != fs.FileType.NotFound:
        with files.open_input_stream(f"{root}/current") as f:
            last = f.read().decode()
        before = spark.read.schema("path string, length long, hash string").parquet(f"{index}/{last}/hashes")
        old = spark.read.schema(schema).parquet(f"{index}/{last}/findings")
    part = uuid.uuid4().hex[:12]
    file_hashes(spark, path).write.parquet(f"{index}/{part}/hashes")
    now = spark.read.schema("path string, length long, hash string").parquet(f"{index}/{part}/hashes")
    changed = [r.path for r in changed_files(now, before).limit(100_001).collect()]
    if len(changed) <= 100_000:  # paths are given to the reader, so that no other file is opened
        content = spark.read.format("binaryFile").load(changed).select("path", "content") if changed else None
    else:
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").join(changed_files(now, before), "path", "left_semi")
    found = scan(content) if content is not None else spark.createDataFrame([], schema)
    if old is not None:
        found = found.unionByName(old.join(now.join(before, ["path", "hash"]).select("path"), "path", "left_semi"))
    found.write.parquet(f"{index}/{part}/findings")
    with files.open_output_stream(f"{root}/current.{part}") as f:
        f.write(part.encode())
    files.move(f"{root}/current.{part}", f"{root}/current")
    return spark.read.schema(schema).parquet(f"{index}/{part}/findings")
