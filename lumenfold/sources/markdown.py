"""Entries as markdown files with front matter, and reading folders of them."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.schema import SCOPE
from lumenfold.session import materialize_counting, qualified
from lumenfold.sources.comments import opened, write_files

INDEX_DIR = ".index"
#: Names handed on at once, tasks that list folders, files and bytes of a reading task, bytes of texts handed on at once.
LISTED, MOST_PARTS, PART_FILES, PART_BYTES, READ_BYTES = 4096, 256, 4096, 64 << 20, 8 << 20


def scan_markdown_folder(spark: SparkSession, path: str, index_dir: str = INDEX_DIR) -> DataFrame:
    """``(folder, filename, content)`` of every ``*.md`` below ``path``, outside index folders.

    ``folder`` is relative to ``path`` and null at the top. Names that Spark's readers leave out are left out. Folders
    are listed by tasks, one job per level, so the driver holds no list of files; a task then reads thousands of them.
    Where only Spark can open ``path``, its own reader lists and reads them.
    """
    root = qualified(spark, path).rstrip("/")
    try:
        store, base = opened(root)
        known = store.get_file_info(base).type == fs.FileType.Directory
    except (OSError, ValueError):  # pyarrow knows no such store; there is no such folder
        known = False
    if known:
        files = _read_files(_list_files(spark, root, index_dir), root)
        below = F.col("below")
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(path)
        below = F.col("path").substr(F.lit(len(root) + 2), F.length("path"))
    parts = F.split(below, "/")
    folder = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    return files.where(~F.array_contains(parts, index_dir)).select(
        tx.present(folder).alias("folder"), tx.display_filename(below).alias("filename"), F.decode("content", "UTF-8").alias("content")
    )


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _markdown(name: str, size: int | None) -> bool:
    """Files that count. Spark's readers pass over empty ones, and over files named like its summary files."""
    return name.endswith(".md") and size != 0 and not (name.startswith("_") and "=" not in name)


def _list_files(spark: SparkSession, root: str, index_dir: str) -> DataFrame:
    """``(below, size)`` of the markdown files below ``root``, stored; ``below`` is the path relative to it."""

    def look(batches):
        store, base = opened(root)
        for batch in batches:
            for folder in batch.column("below").to_pylist():
                found = store.get_file_info(fs.FileSelector(f"{base}/{folder}" if folder else base))
                found = [x for x in found if not _hidden(x.base_name) and x.base_name != index_dir]
                found = [x for x in found if x.type == fs.FileType.Directory or _markdown(x.base_name, x.size)]
                for at in range(0, len(found), LISTED):
                    some = found[at : at + LISTED]
                    yield pa.record_batch(
                        {
                            "below": pa.array([f"{folder}/{x.base_name}" if folder else x.base_name for x in some], pa.string()),
                            "size": pa.array([x.size or 0 for x in some], pa.int64()),
                            "deeper": pa.array([x.type == fs.FileType.Directory for x in some], pa.bool_()),
                        }
                    )

    levels, folders, deeper = [], spark.createDataFrame([("",)], "below string"), 1
    while deeper:
        listed = folders.repartition(min(deeper, MOST_PARTS), "below").mapInArrow(look, "below string, size long, deeper boolean")
        listed, deeper = materialize_counting(listed, "listed", F.col("deeper"))
        levels.append(listed.where("not deeper").select("below", "size"))
        folders = listed.where("deeper").select("below")
    return reduce(DataFrame.unionByName, levels)


def _read_files(names: DataFrame, root: str) -> DataFrame:
    """``(below, content)`` of the listed files. Tasks get about ``PART_FILES`` files or ``PART_BYTES`` bytes each."""

    def read(batches):
        store, base = opened(root)
        for batch in batches:
            held, contents, size = [], [], 0
            for below in batch.column("below").to_pylist():
                with store.open_input_stream(f"{base}/{below}") as file:
                    content = file.read()
                held.append(below)
                contents.append(content)
                size += len(content)
                if size > READ_BYTES:
                    yield pa.record_batch({"below": pa.array(held, pa.string()), "content": pa.array(contents, pa.binary())})
                    held, contents, size = [], [], 0
            yield pa.record_batch({"below": pa.array(held, pa.string()), "content": pa.array(contents, pa.binary())})

    files, size = names.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    spread = names.sparkSession.sparkContext.defaultParallelism
    parts = max(min(spread, files), files // PART_FILES, size // PART_BYTES, 1)
    return names.repartition(parts, "below").select("below").mapInArrow(read, "below string, content binary")


def list_folders(documents: DataFrame) -> DataFrame:
    """Folders that hold documents."""
    return documents.where("folder is not null").select("folder").distinct()


def link_mentions(body: Column, links: Column) -> Column:
    """Wrap the first unlinked, word-bounded occurrence of each link, in order."""

    def wrap(text: Column, link: Column) -> Column:
        quoted = F.concat(F.lit(r"\Q"), F.replace(link, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        pattern = F.concat(F.lit(r"(?sU)^(.*?)(?<!\[\[)\b("), quoted, F.lit(r")\b(?!\]\])"))
        return F.regexp_replace(text, pattern, F.lit("$1[[$2]]"))

    return F.coalesce(F.aggregate(links, body, wrap), body)


def _front_matter(metadata: Column) -> Column:
    """Metadata fields in their order: lists as bullets, the rest as quoted scalars."""
    fields = F.map_entries(F.from_json(metadata, "map<string,variant>"))

    def lines(field: Column) -> Column:
        name, value = field["key"], field["value"]
        items = F.from_json(F.to_json(value), "array<string>")
        bullets = F.transform(items, lambda i: F.concat(F.lit("  - "), i))
        scalar = F.concat(name, F.lit(': "'), F.coalesce(F.variant_get(value, "$", "string"), F.lit("None")), F.lit('"'))
        is_list = F.schema_of_variant(value).startswith("ARRAY")
        return F.when(is_list, F.concat(F.array(F.concat(name, F.lit(":"))), bullets)).otherwise(F.array(scalar))

    return F.coalesce(F.flatten(F.transform(fields, lines)), F.array().cast("array<string>"))


def render_markdown(entries: DataFrame, as_of: str) -> DataFrame:
    """``(scope, folder, filename, markdown)``; entries without a date get ``as_of``.

    The same file name in a folder is kept once, from the latest entry, by an
    aggregate that map tasks combine.
    """
    get = lambda name, kind="string": F.col(name) if name in entries.columns else F.lit(None).cast(kind)
    none = F.array().cast("array<string>")
    tags = F.coalesce(get("tags", "array<string>"), none)
    tag_lines = F.when(
        F.size(tags) > 0,
        F.concat(F.array(F.lit("tags:")), F.transform(tags, lambda t: F.concat(F.lit("  - "), F.regexp_replace(t, "^#+", "")))),
    ).otherwise(none)
    date = F.date_format(F.coalesce(get("created_at", "timestamp"), F.lit(as_of).cast("timestamp")), "yyyy-MM-dd")
    lines = F.concat(
        F.array(F.lit("---"), F.concat(F.lit('title: "'), "title", F.lit('"')), F.concat(F.lit("date: "), date)),
        tag_lines,
        _front_matter(get("metadata")),
        F.array(F.lit("---"), F.lit(""), F.concat(F.lit("# "), "title"), F.lit("")),
        F.array(link_mentions(F.col("content"), F.coalesce(get("links", "array<string>"), none)), F.lit("")),
    )
    rows = entries.select(
        *SCOPE, get("folder").alias("folder"), tx.safe_filename(F.col("title")).alias("filename"), "seq", F.array_join(lines, "\n").alias("markdown")
    )
    return rows.groupBy(*SCOPE, "folder", "filename").agg(F.max_by("markdown", "seq").alias("markdown"))


def export_markdown(entries: DataFrame, path: str, as_of: str) -> None:
    """Write ``<app>/<user>/<folder>/<file>.md`` below ``path`` from the tasks."""
    rendered = render_markdown(entries, as_of)
    write_files(rendered.select(F.concat_ws("/", *SCOPE, "folder", "filename").alias("name"), F.col("markdown").alias("body")), path)
