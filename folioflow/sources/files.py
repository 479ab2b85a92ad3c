"""Reading folders and archives of pages: classification, precedence, safety, dimensions."""

from __future__ import annotations

import io
import posixpath
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

IMAGES = ("png", "jpg", "jpeg", "gif", "bmp", "tif", "tiff", "webp")
TEXTS = ("txt",)
EXECUTABLES = ("exe", "dll", "sh", "bat", "cmd", "ps1", "msi", "com", "scr")
# What an archive may hold.
ZIP_BYTES, ZIP_FILES, ZIP_RATIO = 500 * 1024 * 1024, 2000, 100


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, content and length of all files below a folder, or of one file."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content", "length")


def extension(c: Column | str) -> Column:
    """Extension of a path in lower case."""
    return F.lower(F.regexp_extract(c, r"\.([^./\\]+)$", 1))


def media(c: Column | str) -> Column:
    """'image', 'pdf', 'txt', 'zip' or 'other' of a path."""
    e = extension(c)
    return F.when(e.isin(*IMAGES), "image").when(e == "pdf", "pdf").when(e.isin(*TEXTS), "txt").when(e == "zip", "zip").otherwise("other")


def _members(name: str, content: bytes) -> list[tuple]:
    """(archive, member, content, reason) of one archive; an unsafe or unreadable one gives one row with the reason."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
        infos = [i for i in archive.infolist() if not i.is_dir()]
    except (zipfile.BadZipFile, OSError, ValueError):
        return [(name, None, None, "malformed archive")]
    if not infos:
        return [(name, None, None, "empty archive")]
    if len(infos) > ZIP_FILES:
        return [(name, None, None, "too many files")]
    out, total = [], 0
    for info in infos:
        member = info.filename.replace("\\", "/")
        if ".." in member.split("/") or member.startswith("/") or member[1:2] == ":":
            return [(name, member, None, "unsafe path")]
        total += info.file_size
        if total > ZIP_BYTES:
            return [(name, member, None, "too large")]
        if info.compress_size and info.file_size / info.compress_size > ZIP_RATIO:
            return [(name, member, None, "suspicious compression")]
        if posixpath.splitext(member)[1].lower().lstrip(".") in EXECUTABLES:
            out.append((name, member, None, "executable content"))
            continue
        try:
            out.append((name, member, archive.read(info), None))
        except (zipfile.BadZipFile, RuntimeError, NotImplementedError, OSError):
            return [(name, member, None, "malformed archive")]
    return out


def expand_archives(files: DataFrame) -> DataFrame:
    """Files(path, content) with each archive replaced by its members; path is archive!member, reason tells why one has no content."""
    schema = pa.schema([("path", pa.string()), ("content", pa.binary()), ("reason", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = [(f"{a}!{m}" if m else a, c, r) for a, m, c, r in _members(path, content or b"")]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    zipped = files.filter(media("path") == "zip").select("path", "content").mapInArrow(run, "path string, content binary, reason string")
    plain = files.filter(media("path") != "zip").select("path", "content", F.lit(None).cast("string").alias("reason"))
    return plain.unionByName(zipped)


_SIZE = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])


def image_size(data: bytes | None) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, JPEG, GIF or BMP; None for anything else."""
    if not data:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return struct.unpack("<HH", data[6:10])
    if data[:2] == b"BM" and len(data) >= 26:
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h)
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            marker, length = data[at + 1], struct.unpack(">H", data[at + 2:at + 4])[0]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5:at + 9])
                return w, h
            at += 2 + length
    return None


@F.pandas_udf(_SIZE)
def image_sizes(contents: pd.Series) -> pd.DataFrame:
    """image_size() over Arrow batches."""
    sizes = [image_size(c) or (None, None) for c in contents]
    return pd.DataFrame(sizes, columns=["width", "height"]).astype("Int32")


def plan_inputs(files: DataFrame, group: Column | None = None, max_pages: int | None = None) -> DataFrame:
    """Each file with page_index or the reason why it is none, per input group: images before the first PDF before all texts."""
    df = files.withColumns({"grp": group if group is not None else F.lit("input"), "kind": media("path")})
    if "reason" not in df.columns:
        df = df.withColumn("reason", F.lit(None).cast("string"))
    # only names are grouped and ranked; contents are joined to their places at the end
    names = df.select("grp", "path", "kind", "reason")
    usable = F.col("reason").isNull()
    have = names.groupBy("grp").agg(F.max((F.col("kind") == "image") & usable).alias("i"), F.max((F.col("kind") == "pdf") & usable).alias("p"), F.min(F.when((F.col("kind") == "pdf") & usable, F.col("path"))).alias("pdf"))
    names = names.join(have, "grp")
    why = (
        F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("kind").isin("other", "zip"), "unsupported file type").when(F.col("i") & (F.col("kind") != "image"), "image pages take precedence")
        .when(F.col("p") & (F.col("kind") == "txt"), "a PDF takes precedence").when((F.col("kind") == "pdf") & (F.col("path") != F.col("pdf")), "only one PDF is taken")
    )
    names = names.withColumn("ignored", why)
    place = F.row_number().over(Window.partitionBy("grp", F.col("ignored").isNull()).orderBy("path")) - 1
    page = F.when(F.col("ignored").isNull(), place).cast("int")
    names = names.withColumn("page_index", page).select("grp", "path", "kind", F.when(page >= max_pages, "beyond the page limit").otherwise(F.col("ignored")).alias("ignored"), F.when(page < max_pages, page).alias("page_index")) if max_pages is not None else names.select("grp", "path", "kind", "ignored", page.alias("page_index"))
    return names.join(df.select("grp", "path", "content"), ["grp", "path"]) if "content" in df.columns else names


def ingest_report(plan: DataFrame) -> DataFrame:
    """Files found, taken and ignored per input group; one without any taken is unsupported."""
    return plan.groupBy("grp").agg(F.count(F.lit(1)).alias("n_files"), F.count("page_index").alias("n_taken"), F.count("ignored").alias("n_ignored")).withColumn("supported", F.col("n_taken") > 0)


def page_provenance(plan: DataFrame) -> DataFrame:
    """Pages with media type, size in bytes, hash and dimensions."""
    pages = plan.filter("page_index is not null")
    return pages.select("grp", "page_index", "path", "kind", F.length("content").cast("bigint").alias("n_bytes"), F.sha2("content", 256).alias("sha256"), F.when(F.col("kind") == "image", image_sizes("content")).alias("size")).select("grp", "page_index", "path", "kind", "n_bytes", "sha256", "size.width", "size.height")
