"""Comment files: JSON envelopes, CSV with a header, zipped CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfold.session import qualified

COMMENT_FIELDS = [
    "seq", "user_key", "user_id", "recipe_name", "comment", "date",
    "userDisplayName", "userID", "recipeName", "commentBody", "approveDate",
]
COMMENT_SCHEMA = T.StructType([T.StructField(f, T.LongType() if f == "seq" else T.StringType()) for f in COMMENT_FIELDS])


def scan_comments(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Rows of comment files. Give many files of moderate size: an envelope, a quoted CSV and an archive
    are read by one task each.

    A row without ``seq`` gets one from its place: files in the order of their names, rows as they stand there.
    CSV files of one folder share a header; a file with another one fails the job.
    """
    if fmt == "json":
        envelope = T.StructType([T.StructField("comments", T.ArrayType(COMMENT_SCHEMA))])
        read = spark.read.schema(envelope).option("multiLine", True).json(path)
        rows = read.select(F.col("_metadata.file_path").alias("_file"), F.posexplode("comments").alias("_place", "c"))
        return _with_arrival(rows.select("_file", "_place", "c.*"))
    if fmt == "csv":
        names = spark.read.option("header", True).csv(path).columns
        schema = T.StructType([T.StructField(n, T.LongType() if n == "seq" else T.StringType()) for n in names])
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("multiLine", True)
        read = reader.option("quote", '"').option("escape", '"').csv(path)
        placed = read.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_place"))
        if "seq" not in names:  # ids grow inside a file, which one task reads
            inside = Window.partitionBy("_file").orderBy("_place")
            placed = placed.withColumn("_place", F.row_number().over(inside) - 1).withColumn("seq", F.lit(None).cast("long"))
        return _with_arrival(placed)
    if fmt == "zip":
        return _with_arrival(_scan_zip(spark, path))
    raise ValueError("fmt must be json, csv or zip")


def _with_arrival(rows: DataFrame) -> DataFrame:
    """Fill ``seq`` where it is missing; only the list of files is put in order."""
    files = rows.select("_file").distinct()
    number = files.withColumn("_number", F.row_number().over(Window.orderBy("_file")) - 1)
    placed = rows.join(number, "_file")
    arrival = F.shiftleft(F.col("_number").cast("long"), 36) + F.col("_place")
    return placed.withColumn("seq", F.coalesce("seq", arrival)).drop("_file", "_place", "_number")


def _scan_zip(spark: SparkSession, path: str) -> DataFrame:
    """First CSV member of each archive, streamed in batches by one task per archive."""

    def unzip(batches):
        import csv
        import io
        import itertools
        import zipfile

        import pyarrow as pa

        texts = [f for f in COMMENT_FIELDS if f != "seq"]
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    member = next(n for n in archive.namelist() if n.endswith(".csv"))
                    with archive.open(member) as raw:
                        rows, place = csv.DictReader(io.TextIOWrapper(raw, encoding="utf-8", newline="")), 0
                        while piece := list(itertools.islice(rows, 10_000)):
                            numbers = [int(row["seq"]) if row.get("seq") else None for row in piece]
                            made = [pa.array(numbers, pa.int64()), *(pa.array([row.get(f) for row in piece], pa.string()) for f in texts)]
                            made += [pa.array([name] * len(piece)), pa.array(range(place, place + len(piece)), pa.int64())]
                            place += len(piece)
                            yield pa.record_batch(made, ["seq", *texts, "_file", "_place"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    made = T.StructType([*COMMENT_SCHEMA, T.StructField("_file", T.StringType()), T.StructField("_place", T.LongType())])
    return files.select("path", "content").mapInArrow(unzip, made)


def write_json_envelopes(rows: DataFrame, path: str, per_file: int = 50_000) -> None:
    """Write ``{"comments": […]}`` files of at most ``per_file`` rows."""
    row = F.struct(*[c for c in COMMENT_FIELDS if c in rows.columns])
    grouped = rows.groupBy(F.floor(F.col("seq") / per_file).alias("_part")).agg(
        F.array_sort(F.collect_list(row)).alias("comments")
    )
    name = F.concat(F.lit("part-"), "_part", F.lit(".json"))
    write_files(grouped.select(name.alias("name"), F.to_json(F.struct("comments")).alias("body")), path)


def write_zip_archives(rows: DataFrame, path: str, per_file: int = 50_000) -> None:
    """Write zipped CSV files of at most ``per_file`` rows each."""
    names = [c for c in COMMENT_FIELDS if c in rows.columns]

    def pack(frame):
        import io
        import zipfile

        import pandas as pd

        part = int(frame["part"].iloc[0])
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("comments.csv", frame.sort_values("seq")[names].to_csv(index=False))
        return pd.DataFrame({"part": [part], "content": [buffer.getvalue()]})

    parted = rows.select(*names, F.floor(F.col("seq") / per_file).cast("int").alias("part"))
    packed = parted.groupBy("part").applyInPandas(pack, "part int, content binary")
    name = F.concat(F.lit("part-"), "part", F.lit(".zip"))
    write_files(packed.select(name.alias("name"), F.col("content").alias("body")), path)


def write_files(files: DataFrame, path: str) -> None:
    """Write one file per row ``(name, body)`` below ``path`` from the tasks.

    A file is replaced as a whole, so a task that runs again writes the same.
    """
    names = files.mapInPandas(_file_writer(qualified(files.sparkSession, path)), "name string")
    names.write.format("noop").mode("overwrite").save()


def opened(path: str):
    """The store of a qualified path and the path in it."""
    from pyarrow import fs

    # "file:/x" and "file:///x" are the same local folder; other schemes go by their URI.
    local = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(local if path.startswith(("/", "file:")) else path)


def _file_writer(path: str):
    def write(batches):
        import pandas as pd

        store, base = opened(path)
        made = set()
        for batch in batches:
            for name, body in zip(batch["name"], batch["body"]):
                target = f"{base}/{name}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(target) as out:
                    out.write(body.encode() if isinstance(body, str) else body)
            yield pd.DataFrame({"name": batch["name"]})

    return write
