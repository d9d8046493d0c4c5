"""Manifests as a data source: its partitions are the files that they name.

``spark.read.format("manifest").load(path)`` reads one manifest, or every
``*.json`` manifest of a folder. The planner reads the manifests only; each
task looks for its files, checks their size and reads them, so a file that
no manifest names is never opened, and a file that is missing, too large or no
UTF-8 is a row with an error while the rest go on.

A relative path is looked for beside its manifest, then in the folders of the
option ``folders`` (comma-separated: a working folder, a root), and ``..`` is
followed. Any file system with an Arrow driver serves, by its scheme; a path
without one is a folder that driver and executors share.

``write`` is the other way: documents become files and manifests, written by
the tasks that hold them.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAX_BYTES = 50 * 1024 * 1024
#: Partitions at most; more files share them evenly.
PARTITIONS = 10_000
SCHEMA = "manifest string, figure string, pronoun string, source_ord int, file string, doc_type string, pub_year int, significance double, is_translation boolean, doc_title string, path string, text string, error string"
_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:")


def located(path: str):
    """The Arrow file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if not _SCHEME.match(path):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


def joined(folder: str, file: str) -> str:
    """``file`` as it lies from ``folder``, with . and .. resolved; an absolute one stands by itself."""
    if _SCHEME.match(file):
        return file
    scheme, rest = re.match(r"^((?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?)(.*)$", folder).groups()
    return (scheme if not file.startswith("/") else "") + posixpath.normpath(posixpath.join(rest or "/", file))


def find(file: str, folders: list[str]) -> tuple[str, object, str, int] | tuple[str, None, None, None]:
    """(path, file system, path in it, size) of the first place where the file is; its first place where it is in none."""
    from pyarrow import fs

    places = [file] if file.startswith("/") or _SCHEME.match(file) else [joined(f, file) for f in folders]
    for place in places:
        system, path = located(place)
        info = system.get_file_info(path)
        if info.type == fs.FileType.File:
            return place, system, path, info.size
    return places[0], None, None, None


def read(file: str | None, folders: list[str], most: int) -> tuple[str | None, str | None, str | None]:
    """(path, text, error) of one named file; text without error, or error without text."""
    if not file:
        return None, None, "no file"
    path = None
    try:
        path, system, inside, size = find(file, folders)
        if system is None:
            return path, None, "file not found"
        if size > most:
            return path, None, "file too large"
        with system.open_input_stream(inside) as f:
            return path, f.read().decode("utf-8-sig"), None
    except UnicodeDecodeError:
        return path, None, "file is not UTF-8"
    except (OSError, ValueError) as e:
        return path, None, f"file not read: {type(e).__name__}"


def _number(x: object) -> float | None:
    return float(x) if isinstance(x, int | float) and not isinstance(x, bool) else None


def entries(name: str, manifest: dict) -> Iterator[tuple]:
    """The sources that a manifest names, with its defaults: the columns up to ``doc_title``."""
    default = _number(manifest.get("default_significance"))
    for figure in manifest.get("figures") or []:
        for i, s in enumerate(figure.get("sources") or []):
            significance, year = _number(s.get("significance")), _number(s.get("pub_year"))
            yield (
                name, figure.get("name"), figure.get("pronoun") or "unknown", i, s.get("file"), s.get("doc_type") or "unknown", None if year is None else int(year),
                default if significance is None else significance, s.get("translation"), s.get("title") or "",
            )


class _Files(InputPartition):
    def __init__(self, rows: list[tuple]):
        self.rows = rows


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.most = options["path"], int(options.get("most", MAX_BYTES))
        self.folders = [f.strip() for f in options.get("folders", "").split(",") if f.strip()]

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, inside = located(self.path)
        info = system.get_file_info(inside)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"manifest not found: {self.path}")
        names = [self.path]
        if info.type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(inside))
            names = sorted(joined(self.path, f.base_name) for f in found if f.type == fs.FileType.File and f.base_name.endswith(".json"))
        rows = []
        for name in names:
            system, inside = located(name)
            with system.open_input_stream(inside) as f:
                try:
                    rows += entries(name, json.loads(f.read()))
                except json.JSONDecodeError as e:
                    raise ValueError(f"manifest is not valid JSON: {name}: {e}") from e
        each = -(-len(rows) // PARTITIONS) or 1
        return [_Files(rows[i:i + each]) for i in range(0, len(rows), each)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for row in partition.rows:
            yield (*row, *read(row[4], [posixpath.dirname(row[0]), *self.folders], self.most))


class Manifest(DataSource):
    """The data source ``manifest``; options: path, folders, most (bytes of a file)."""

    @classmethod
    def name(cls) -> str:
        return "manifest"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def documents(spark: SparkSession, path: str, folders: list[str] = (), most: int = MAX_BYTES) -> DataFrame:
    """The sources of the manifests at ``path`` with their texts or errors, and a doc_id of figure and file."""
    spark.dataSource.register(Manifest)
    df = spark.read.format("manifest").option("folders", ",".join(folders)).option("most", str(most)).load(path)
    return df.withColumn("doc_id", F.xxhash64("figure", "file"))


def put(path: str, text: str) -> None:
    """One file, with its folders."""
    system, inside = located(path)
    system.create_dir(posixpath.dirname(inside), recursive=True)
    with system.open_output_stream(inside) as f:
        f.write(text.encode())


def write(docs: DataFrame, path: str, partitions: int) -> DataFrame:
    """Write documents (figure, pronoun, file, doc_type, pub_year, text) below ``path``; (manifest, files) of each manifest written.

    Documents are dealt into ``partitions`` by the hash of their file; a task
    writes the texts of its documents to ``texts`` and one manifest that names
    them to ``manifests``. A document without text is named only. Names depend
    on the documents alone, so a task that runs again writes the same files.
    Choose as many partitions as keep one's texts within a task's memory.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        for file, text in zip(rows["file"], rows["text"], strict=True):
            if text is not None:
                put(f"{path}/texts/{file}", text)
        figures = []
        for name, own in rows.sort_values(["figure", "file"]).groupby("figure", dropna=False):
            sources = [{"file": f"../texts/{s.file}", "doc_type": s.doc_type, "pub_year": None if pd.isna(s.pub_year) else int(s.pub_year)} for s in own.itertuples()]
            figures.append({"name": name, "pronoun": own["pronoun"].iloc[0], "sources": sources})
        leaf = f"manifests/{rows['part'].iloc[0]:06d}.json"
        put(f"{path}/{leaf}", json.dumps({"corpus_name": leaf, "default_significance": 0.9, "figures": figures}))
        return pd.DataFrame({"manifest": [leaf], "files": [len(rows)]})

    part = F.pmod(F.xxhash64("file"), F.lit(partitions)).cast("int")
    return docs.select("figure", "pronoun", "file", "doc_type", "pub_year", "text", part.alias("part")).groupBy("part").applyInPandas(run, "manifest string, files long")
