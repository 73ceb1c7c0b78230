"""Markdown files, page payloads and archives as documents."""

from __future__ import annotations

import io
import zipfile
import zlib
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from lemmaflow.functions import patterns as R
from lemmaflow.functions import text as T
from lemmaflow.functions import values as V
from lemmaflow.operators.annotate import payload_error

PAGES = t.StructType([t.StructField("pages", t.ArrayType(t.StructType([t.StructField("page_idx", t.IntegerType()), t.StructField("md", t.StringType())])))])
#: Largest upload of each type, in bytes.
CAPS = {"md": 10 * 1024 * 1024, "pdf": 300 * 1024 * 1024, "jpg": 7 * 1024 * 1024, "jpeg": 7 * 1024 * 1024, "png": 7 * 1024 * 1024}


def markdown_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(doc_id, source_name, text) of Markdown files; doc_id is the path."""
    files = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.{md,MD}").text(path, wholetext=True)
    name = F.input_file_name()
    return files.select(name.alias("doc_id"), F.url_decode(F.element_at(F.split(name, "/"), -1)).alias("source_name"), F.col("value").alias("text"))


def uploads(spark: SparkSession, path: str) -> DataFrame:
    """Files by type, with the reason to refuse one: (path, name, kind, length, modified_at, digest, error)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    cap = F.element_at(F.create_map(*(F.lit(x) for kv in CAPS.items() for x in kv)), kind)
    error = F.when(cap.isNull(), "unsupported type").when(F.col("length") == 0, "empty file").when(F.col("length") > cap, "too large")
    return files.select("path", name.alias("name"), kind.alias("kind"), "length", F.col("modificationTime").alias("modified_at"), F.sha2("content", 256).alias("digest"), error.alias("error"))


def pages_markdown(pages: Column) -> Column:
    """Markdown of pages: what isn't blank, without trailing white space, joined by blank lines."""
    texts = F.transform(pages, lambda p: F.regexp_replace(F.coalesce(p["md"], F.lit("")), r"(?U)\s+$", ""))
    return F.array_join(F.filter(texts, lambda x: x != ""), "\n\n")


def merged_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks of a source (doc_id, chunk_index, start_page, pages) as one: page_idx counts on from each chunk's start."""
    moved = F.transform("pages", lambda p: F.struct((p["page_idx"] + F.col("start_page")).alias("page_idx"), p["md"].alias("md")))
    rows = chunks.select("doc_id", F.struct("chunk_index", moved.alias("pages")).alias("c"))
    return rows.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["pages"])).alias("pages")).withColumn("text", pages_markdown(F.col("pages")))


def _pages_of(v: Column) -> Column:
    """Markdown of a payload's pages."""
    texts = F.transform(F.filter(V.listed(V.field(v, "pages")), lambda p: V.is_text(V.field(p, "md"))), lambda p: F.regexp_replace(V.text(V.field(p, "md")), r"(?U)\s+$", ""))
    return F.coalesce(F.array_join(F.filter(texts, lambda x: x != ""), "\n\n"), F.lit(""))


def _filled(v: Column, name: str) -> Column:
    """A field's text if it isn't blank, else null."""
    own = F.when(V.is_text(V.field(v, name)), V.text(V.field(v, name)))
    return F.when(F.regexp_replace(own, r"(?U)\s+", "") != "", own)


def line_list_markdown(lines: Column) -> Column:
    """Markdown of a list (a variant) of texts, or of objects with one of several text fields; the first that isn't blank counts."""
    own = F.transform(V.listed(lines), lambda x: F.when(V.is_text(x), V.text(x)).when(V.is_object(x), F.coalesce(*(_filled(x, n) for n in R.OCR_LINE_TEXTS))))
    return F.coalesce(F.array_join(F.array_compact(own), "\n"), F.lit(""))


def image_markdown(answer: Column) -> Column:
    """Markdown of an image's OCR answer (JSON): a text field, else its pages, else its lines; null if the answer is a failure, empty without any text."""
    v = V.parsed(answer)
    code, data = V.field(v, "code"), V.field(v, "data")
    inner = F.when(V.is_object(V.field(data, "result")), V.field(data, "result")).when(V.is_object(V.field(data, "ocrResp")), V.field(data, "ocrResp")).otherwise(data)
    body = F.when(V.is_object(data), inner).otherwise(v)
    filled = lambda x: F.when(F.regexp_replace(x, r"(?U)\s+", "") != "", x)
    lists = (filled(F.when(V.listed(V.field(body, n)).isNotNull(), line_list_markdown(V.field(body, n)))) for n in R.OCR_LINES)
    failed = code.isNotNull() & ~F.is_variant_null(code) & (V.text(code) != "success")
    return F.when(~F.coalesce(failed, F.lit(False)), F.coalesce(*(_filled(body, n) for n in R.OCR_TEXTS), filled(_pages_of(body)), *lists, F.lit("")))


def archive_markdown(archives: DataFrame, most: int = CAPS["md"]) -> DataFrame:
    """(path, markdown, error) of zip archives (path, content): the Markdown file of the least depth, then name; null if there is none.

    ``error`` tells why an archive gives nothing: null content, no zip archive, a member that is broken, encrypted, larger than ``most`` bytes or not UTF-8. Other archives aren't touched by it.
    """

    def first(content: bytes | None) -> tuple[str | None, str | None]:
        if content is None:
            return None, "no content"
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                members = [m for m in archive.infolist() if not m.is_dir() and m.filename.lower().endswith(".md")]
                if not members:
                    return None, None
                chosen = min(members, key=lambda m: (len(PurePosixPath(m.filename).parts), m.filename))
                with archive.open(chosen) as f:
                    data = f.read(most + 1)  # the size that the archive tells may be wrong
                return (None, "too large") if len(data) > most else (data.decode(), None)
        except (zipfile.BadZipFile, zlib.error, EOFError) as e:
            return None, f"broken archive: {e}"
        except UnicodeDecodeError:
            return None, "not UTF-8"
        except (RuntimeError, NotImplementedError) as e:
            return None, f"unreadable member: {e}"

    @F.pandas_udf("markdown string, error string")
    def markdown(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([first(c) for c in content], columns=["markdown", "error"])

    return archives.select("path", markdown("content").alias("m")).select("path", "m.markdown", "m.error")


def traces(spark: SparkSession, path: str) -> DataFrame:
    """Traces below ``path`` (JSON files, however deep) as ``jobs.usage_by_phase`` takes them; the phase is the folder below ``path``. What doesn't parse has no usage."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    v, root = V.parsed(F.col("value")), path.rstrip("/").rsplit("/", 1)[-1]
    usage = V.field(v, "usage")
    number = lambda x, n: F.try_variant_get(x, f"$.{n}", "bigint")
    seconds = lambda x: F.when(V.kind(V.field(x, "elapsed_seconds")).isin("BIGINT", "DECIMAL", "DOUBLE"), F.try_variant_get(x, "$.elapsed_seconds", "double"))
    phase = F.regexp_extract(F.url_decode(F.input_file_name()), r"/\Q" + root + r"\E/([^/]+)/", 1)
    names = ("input_tokens", "prompt_tokens", "output_tokens", "completion_tokens", "total_tokens")
    return files.select(phase.alias("phase"), *(number(usage, n).alias(n) for n in names), F.coalesce(seconds(v), seconds(V.field(v, "timing"))).alias("elapsed_seconds"), V.is_object(usage).alias("has_usage"))


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """(id, payload, error) of annotation files: the id is the file's name without its suffix; ``error`` tells why one is refused."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    name = F.url_decode(F.element_at(F.split(F.input_file_name(), "/"), -1))
    return files.select(F.regexp_replace(name, r"\.json$", "").alias("id"), F.col("value").alias("payload")).withColumn("error", payload_error(F.col("payload")))


def source_folders(files: DataFrame) -> DataFrame:
    """(folder) of files (path) that have a finished ``output.md``."""
    return files.filter(F.element_at(F.split("path", "/"), -1) == "output.md").select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()


def relative_key(path: Column, root: str) -> Column:
    """A path below ``root`` without its suffix."""
    below = F.when(F.startswith(path, F.lit(root.rstrip("/") + "/")), F.substring(path, len(root.rstrip("/")) + 2, 1 << 30)).otherwise(path)
    return F.regexp_replace(below, r"(?<=[^/])\.[^./]*$", "")


def export_name(file: Column, most: int = R.EXPORT_NAME_BYTES) -> Column:
    """A file's name without its suffix as an export may be called: letters, digits and ``._- ``, in at most so many bytes of UTF-8, whole characters only."""
    stem = F.trim(F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"(.)\.[^.]*$", "$1"))
    named = lambda x: F.when(x == "", "output").otherwise(x)
    ends = F.lit(" ._")

    def short(whole: Column) -> Column:
        # the longest beginning that has no more bytes; a character has one at least
        head = F.substring(whole, F.lit(1), F.lit(most))
        size = F.array_max(F.filter(F.sequence(F.lit(0), F.length(head)), lambda n: F.octet_length(F.substring(head, F.lit(1), n)) <= most))
        return F.when(F.octet_length(whole) <= most, whole).otherwise(T.let(F.rtrim(F.substring(head, F.lit(1), size), ends), named))

    # each step is computed once, not for every length that is tried
    plain = F.regexp_replace(T.let(stem, named), r"[^\p{L}\p{N}._\- ]", "_")
    return T.let(T.let(F.btrim(plain, ends), named), short)
