"""File sources and sinks: corpus shards, raw JSONL, logs, publish and verify.

(S1 read_jsonl_gz, S2 read_jsonl_xz, S3 read_corpus, S7 read_logs, S10
write_shards, S13 publish, S17 verify_corpus.)
"""

from __future__ import annotations

import itertools
import lzma
import posixpath
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.text import line_timestamp


def read_corpus(spark: SparkSession, path: str, text: str = "text",
                extra: Sequence[str] = ()) -> DataFrame:
    """S3: Parquet text with physical position (file name, row index in file).

    Only ``text`` (and ``extra``) are read; position comes from file metadata,
    so no sort or shuffle is needed to recover physical order.
    """
    df = spark.read.parquet(path)
    return df.select(F.col(text).alias("text"), *extra,
                     F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.row_index").alias("row_index"))


def read_sources(spark: SparkSession, specs: Sequence[dict]) -> DataFrame:
    """Declared sources, each with its own text column and pinned revision,
    renamed to ``text`` and tagged with ``source`` and ``revision`` (one scan each,
    only the text column read)."""
    parts = []
    for spec in specs:
        df = spark.read.parquet(spec["path"])
        parts.append(df.select(F.lit(spec["name"]).alias("source"), F.lit(spec.get("revision")).alias("revision"),
                               F.col(spec.get("text_column", "text")).alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_shards(spark: SparkSession, root: str, text: str = "text", extra: Sequence[str] = ()) -> DataFrame:
    """Corpus shards laid out as ``<root>/<source>/*.parquet`` -> rows with
    ``shard`` (the source folder, a ``key=`` prefix dropped), ``ord`` (catalogue
    ordinal: sources in name order) and ``pos`` (physical line in the source).

    ``pos`` is the Parquet ``row_index`` plus the file's offset inside its
    source (per-file counts in file-name order, one row per file), so physical
    order is recovered without sorting or moving any row.
    """
    from pyspark.sql import Window

    from quarry.operators.corpus import global_index

    df = spark.read.parquet(f"{root.rstrip('/')}/*/*.parquet")
    rows = df.select(F.col(text).alias("text"), *extra,
                     F.regexp_replace(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1),
                                      r"^[^=]+=", "").alias("shard"),
                     F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.row_index").alias("row_index"))
    rows = global_index(rows, group=["shard"], name="pos").drop("file_name", "row_index")
    ords = rows.select("shard").distinct().withColumn(
        "ord", (F.row_number().over(Window.orderBy("shard")) - 1).cast("int"))  # one row per source
    return rows.join(ords, "shard")


def append_log_lines(lines: DataFrame, path: str, ts: str = "ts", order: Sequence[str] = ("uid", "pos")) -> None:
    """Append parsed log lines under ``day=<date>`` folders (lines without a stamp
    go to ``day=__HIVE_DEFAULT_PARTITION__``), range-partitioned on (day, order)
    so a busy day is written by many tasks."""
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    cols = ["day", *order]
    (lines.withColumn("day", F.to_date(F.col(ts))).repartitionByRange(n, *cols).sortWithinPartitions(*cols)
          .write.mode("append").partitionBy("day").parquet(path))


def read_log_tail(spark: SparkSession, path: str, since: str, ts: str = "ts") -> DataFrame:
    """Lines stamped at or after ``since``: the day predicate prunes folders
    (the batch form of the reference's read-the-last-N-bytes tail)."""
    df = spark.read.parquet(path)
    cut = F.to_timestamp(F.lit(since))
    return df.filter((F.col("day") >= F.to_date(cut)) & (F.col(ts) >= cut.cast(df.schema[ts].dataType)))


def write_manifest(entries: DataFrame, path: str, header: dict | None = None) -> None:
    """S11 sink: one JSON document ``{..header, "sources": [entry, ...]}``.

    The entries are one row per source (a catalogue-sized table), gathered into
    the document's array in path order."""
    doc = entries.agg(F.sort_array(F.collect_list(F.struct(*entries.columns))).alias("sources"))
    for k, v in (header or {}).items():
        doc = doc.withColumn(k, F.lit(v))
    doc.select(F.to_json(F.struct(*[c for c in doc.columns])).alias("value")).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str, entry_schema: str) -> DataFrame:
    """Manifest document -> one row per source (``inline`` of ``sources``)."""
    doc = spark.read.text(path).select(
        F.from_json("value", f"struct<sources: array<struct<{entry_schema}>>>").alias("d"))
    return doc.select(F.inline("d.sources"))


def _numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines (file, file_name, pos, line); ``pos`` is the line's number in its file.

    A large file is read in blocks by several tasks: the lines of a block are
    numbered as read, and the counts of the blocks before it in its file are added.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("line")
    ).withColumn("_id", F.monotonically_increasing_id())
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    start = blocks.select("file", "_block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_start"))
    return lines.join(start, ["file", "_block"]).select("file", "file_name", (F.col("_id") + F.col("_start")).alias("pos"), "line")


def _json_texts(lines: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """The text field of the lines that are JSON objects (missing text -> '')."""
    v = F.try_parse_json(F.col("line"))
    text = F.coalesce(F.try_variant_get(v, f"$.{text_col}", "string"), F.lit(""))
    return lines.filter(v.isNotNull() & F.ltrim(F.col("line")).startswith("{")).select(*keep, text.alias("text"))


def read_jsonl(spark: SparkSession, path: str, text_col: str = "text") -> DataFrame:
    """JSON lines (plain or .gz); unparsable lines skipped, missing text -> ''.

    Lines are read as text first and parsed with ``try_parse_json`` (NULL on
    failure), so a malformed line is dropped without failing the job; ``pos``
    is the physical line number in the file, malformed lines counted.
    """
    if str(path).endswith(".xz"):
        raise ValueError(".xz is not readable by the text reader; use read_jsonl_xz")
    return _json_texts(_numbered_lines(spark, path), text_col, "file", "file_name", "pos")


def _xz_lines(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The lines of all streams of an .xz file; the decompressed text is never held whole."""
    view, tail, stream = memoryview(content), b"", lzma.LZMADecompressor()
    for off in range(0, len(view), step):
        data = bytes(view[off:off + step])
        while data:
            if stream.eof:  # another stream, perhaps after padding
                data = data.lstrip(b"\0")
                if not data:
                    break
                stream = lzma.LZMADecompressor()
            *lines, tail = (tail + stream.decompress(data)).split(b"\n")
            yield from lines
            data = stream.unused_data if stream.eof else b""
    if tail:
        yield tail


def read_jsonl_xz(spark: SparkSession, paths: str | Sequence[str], text_col: str = "text") -> DataFrame:
    """Xz-compressed JSON lines, decompressed per file with ``mapInPandas``.

    Files come from the ``binaryFile`` source (any storage the cluster reads,
    files up to 2 GB compressed) and lines leave in bounded batches; they are
    parsed like those of ``read_jsonl``. ``pos`` counts physical lines, including
    malformed ones; invalid UTF-8 is ignored.
    """
    listing = spark.read.format("binaryFile").load(paths)
    n = max(1, listing.select("path").count())  # file listing only; never the contents

    def lines_of(batches):
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                numbered = enumerate(_xz_lines(content))
                while part := list(itertools.islice(numbered, 10_000)):
                    yield pd.DataFrame({"shard": posixpath.basename(path), "pos": [i for i, _ in part],
                                        "line": [x.decode("utf-8", "ignore") for _, x in part]})

    lines = listing.select("path", "content").repartition(n, "path").mapInPandas(lines_of, "shard string, pos long, line string")
    return _json_texts(lines, text_col, "shard", "pos")


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """``uid<N>-<kind>.log`` files -> (uid, kind, pos, line, ts).

    uid and kind come from the file name; ``pos`` is the line number in the file.
    """
    m = r"^uid(\d+)-([A-Za-z0-9_]+)\.log$"
    return (_numbered_lines(spark, path)
            .withColumn("uid", F.regexp_extract("file_name", m, 1))
            .withColumn("kind", F.regexp_extract("file_name", m, 2))
            .filter(F.col("kind") != "")
            .select("file_name", F.col("uid").cast("long").alias("uid"), "kind", "pos", "line", line_timestamp("line").alias("ts")))


def write_shards(df: DataFrame, out_dir: str, rows_per_file: int = 50_000, index: str | None = None) -> None:
    """Zstd Parquet files of at most ``rows_per_file`` rows, text only.

    With ``index`` (0, 1, 2, ... over all rows) the files are packed exactly: rows
    in that order, every file but the last full, named ``part-00000.parquet`` on.
    """
    if index is None:
        (df.select("text").write.mode("errorifexists").option("compression", "zstd")
           .option("maxRecordsPerFile", rows_per_file).parquet(out_dir))
        return
    spark = df.sparkSession
    files = max(1, -(-df.count() // rows_per_file))
    part = F.floor(F.col(index) / rows_per_file).cast("int")
    (df.select(index, "text").repartitionById(files, part).sortWithinPartitions(index).select("text")
       .write.mode("errorifexists").option("compression", "zstd").parquet(out_dir))
    fs, root, jvm = _fs(spark, out_dir)
    for f in fs.listStatus(root):  # one file a partition, whose number its name begins with
        name = f.getPath().getName()
        if name.startswith("part-"):
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(root, f"{name[:10]}.parquet"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def put_file(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file at ``path``, on any storage the cluster reads."""
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(content))
    out.close()


def replace_version(spark: SparkSession, root: str, version: str, made: Callable[[str | None], DataFrame]) -> None:
    """Write ``made(live folder or None)`` as ``version``, make it live, and remove the version it replaces."""
    fs, current, jvm = _fs(spark, f"{root.rstrip('/')}/CURRENT")
    live = current_version(root, spark) if fs.exists(current) else None
    if live and live.rstrip("/").endswith(f"/{version}"):
        return
    made(live).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{version}")
    _move_pointer(spark, root, version)
    if live:
        fs.delete(jvm.org.apache.hadoop.fs.Path(live), True)


def _move_pointer(spark: SparkSession, root: str, version: str) -> None:
    """``CURRENT`` names ``version`` from here on; it is written aside and renamed over the old one."""
    aside = f"{root.rstrip('/')}/.CURRENT.{version}"
    put_file(spark, aside, version.encode("utf-8"))
    fs, tmp, jvm = _fs(spark, aside)
    cur = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/CURRENT"))
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE  # readers see the old pointer or the new one, never none
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(cur.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(tmp), cur, how)


def publish(df: DataFrame, root: str, rows_per_file: int = 50_000) -> str:
    """Write a new version, refuse an empty one, then move the pointer.

    The previous version stays; readers follow ``CURRENT``. The row count is
    read back from the written files (Parquet footers), not by re-running
    ``df``. The pointer is written through the Hadoop file API: created aside, then
    renamed over the old one, on any storage the cluster reads.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex[:12]}"
    target = f"{root.rstrip('/')}/{version}"
    write_shards(df, target, rows_per_file)
    if spark.read.parquet(target).count() == 0:
        raise RuntimeError("the new version is empty, so the live one stays")
    _move_pointer(spark, root, version)
    return target


def repack(rows: DataFrame, root: str, n_files: int, index: str = "gidx") -> str:
    """``rows`` in ``index`` order as exactly ``n_files`` contiguous files, then move the pointer.

    A row count that cannot fill n files is refused before anything is written.
    What was written is read back: with another number of files or rows the
    pointer stays, and readers keep the version they have.
    """
    from quarry.operators.corpus import repack_plan

    spark = rows.sparkSession
    version = f"v-{uuid.uuid4().hex[:12]}"
    target = f"{root.rstrip('/')}/{version}"
    (repack_plan(rows, n_files, index, strict=True).repartitionById(n_files, F.col("file_id").cast("int"))
     .sortWithinPartitions(index).drop(index, "file_id").write.option("compression", "zstd").parquet(target))
    found = spark.read.parquet(target).agg(F.count(F.lit(1)), F.countDistinct("_metadata.file_name")).first()
    if tuple(found) != (rows.count(), n_files):
        raise RuntimeError(f"{found[0]} rows in {found[1]} files were written, not {n_files} files of all rows")
    _move_pointer(spark, root, version)
    return target


def current_version(root: str, spark: SparkSession | None = None) -> str:
    """The folder ``CURRENT`` points at."""
    from pyspark.sql import SparkSession as _S

    spark = spark or _S.getActiveSession()
    name = spark.read.text(f"{root.rstrip('/')}/CURRENT").first()[0].strip()
    return f"{root.rstrip('/')}/{name}"


def append_events(df: DataFrame, path: str, key: str = "uid", buckets: int = 64,
                  order: Sequence[str] = ("pos",)) -> None:
    """Append rows so that each key's stream can be read on its own.

    Rows go to ``<key>_bucket=pmod(key, buckets)`` folders, range-partitioned
    on (bucket, key, order) and sorted that way inside each file: reading one
    uid prunes to one folder and skips row groups by min/max, and a uid with a
    third of the rows is written by many tasks. A folder per uid would mean
    millions of directories and tiny files at scale.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    bcol = f"{key}_bucket"
    cols = [bcol, key, *[o for o in order if o in df.columns]]
    (df.withColumn(bcol, F.pmod(F.col(key), F.lit(buckets))).repartitionByRange(n, *cols)
       .sortWithinPartitions(*cols).write.mode("append").partitionBy(bcol).parquet(path))


def read_events(spark: SparkSession, path: str, uid: int | None = None, key: str = "uid",
                buckets: int = 64) -> DataFrame:
    """Read appended events; with ``uid`` only that uid's bucket folder is scanned."""
    df = spark.read.parquet(path)
    if uid is not None:
        df = df.filter((F.col(f"{key}_bucket") == uid % buckets) & (F.col(key) == uid))
    return df.drop(f"{key}_bucket")


def verify_corpus(spark: SparkSession, corpus_dir: str, manifest: DataFrame) -> DataFrame:
    """Per source, shard count and rows on disk vs the manifest.

    ``manifest(source, shards, rows)``; shards live in ``<corpus_dir>/<source>/``.
    Files are listed without reading content; rows are counted per file with
    ``ignoreCorruptFiles`` so an unreadable file is listed instead of failing
    the job. The list of unreadable files per source is bounded by its files.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .option("pathGlobFilter", "*.parquet").load(corpus_dir).select("path"))
    listing = listing.select(F.regexp_extract("path", r"/([^/]+)/[^/]+\.parquet$", 1).alias("source"),
                             F.regexp_extract("path", r"/([^/]+\.parquet)$", 1).alias("file_name"))
    counted = (spark.read.schema("text string").option("ignoreCorruptFiles", "true")
               .parquet(f"{corpus_dir.rstrip('/')}/*/*.parquet")
               .select(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+\.parquet$", 1).alias("source"),
                       F.col("_metadata.file_name").alias("file_name"))
               .groupBy("source", "file_name").agg(F.count(F.lit(1)).alias("rows")))
    per_file = listing.join(counted, ["source", "file_name"], "left")
    per_src = per_file.groupBy("source").agg(
        F.count(F.lit(1)).alias("files_on_disk"), F.sum(F.coalesce("rows", F.lit(0))).alias("rows_on_disk"),
        F.sort_array(F.collect_list(F.when(F.col("rows").isNull(), F.col("file_name")))).alias("unreadable"))
    out = manifest.join(per_src, "source", "left").select(
        "source", "shards", "rows", F.coalesce("files_on_disk", F.lit(0)).alias("files_on_disk"),
        F.coalesce("rows_on_disk", F.lit(0)).alias("rows_on_disk"), "unreadable")
    return out.withColumn("ok", (F.col("files_on_disk") == F.col("shards")) &
                          (F.col("rows_on_disk") == F.col("rows")) &
                          (F.coalesce(F.size("unreadable"), F.lit(0)) == 0))
