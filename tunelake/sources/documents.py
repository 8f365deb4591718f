"""JSON documents, one to a file, however many files there are.

Spark's reader keeps every name and size on the driver. Here tasks list the folders, level after level, and
open the files, dealt by number and size; the driver sees sums and counts, and the names of the few files
above ``LARGE_FILE``, which Spark's reader streams. The rows are those of that reader. This needs a local or
mounted file system; documents of other stores are listed and read by Spark.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.session import ship_package
from tunelake.sources.artifacts import list_folders, local_path

#: Bytes and files that a task reads, bytes and files of a batch, bytes of a file that is read by Spark.
TASK_BYTES, TASK_FILES, BATCH_BYTES, BATCH_FILES, LARGE_FILE = 64 << 20, 2048, 4 << 20, 512, 32 << 20

_GLOB = re.compile(r"[{}\[\]*?\\]")
_HIDDEN = re.compile(r"(?!_metadata|_common_metadata)(?:_[^=]*|\..*|.*\._COPYING_)", re.DOTALL)
_TEXTS = "_file string, _text string"
_MARKS = (
    (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF16_BE, "utf-16-be"),
    (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF8, "utf-8"),
)


def is_shown(name: str) -> bool:
    """Whether Spark's readers look at files and folders of this name; they pass over bytes that are no text."""
    return not _HIDDEN.fullmatch(name) and not re.search("[\ud800-\udfff]", name)


def file_uri(path: str) -> str:
    """A ``file:`` path as Spark's ``file_path`` shows it: with escapes for what is no part of a URI's path."""

    def escaped(found: re.Match) -> str:
        char = found[0]
        if char.isascii() or unicodedata.category(char) in ("Cc", "Zs", "Zl", "Zp"):
            return "".join(f"%{byte:02X}" for byte in char.encode())
        return char

    return "file:" + re.sub(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=/@]", escaped, local_path(path))


def document_text(raw: bytes) -> str:
    """The text of a JSON document, whose encoding shows in its first bytes; it breaks off where bytes are invalid."""
    marks = _MARKS if len(raw) >= 4 else ()
    mark, encoding = next(((mark, name) for mark, name in marks if raw.startswith(mark)), (b"", None))
    raw = raw[len(mark):]
    if encoding is None:
        zeros = bytes(byte == 0 for byte in raw[:4])
        wide = {b"\1\1\1\0": "utf-32-be", b"\0\1\1\1": "utf-32-le"}.get(zeros)
        encoding = wide or {b"\1\0": "utf-16-be", b"\0\1": "utf-16-le"}.get(zeros[:2], "utf-8")
    try:
        return raw.decode(encoding)
    except UnicodeDecodeError as error:
        return raw[: error.start].decode(encoding) + "\ufffd"


def _texts(batches: Iterator[pa.RecordBatch], missing_ok: bool = False) -> Iterator[pa.RecordBatch]:
    """File and text of each file that is not blank, in batches of bounded size."""
    schema = pa.schema({"_file": pa.string(), "_text": pa.string()})
    files: list[str] = []
    texts: list[str] = []
    size = 0
    for given in batches:
        for path in given.column(0).to_pylist():
            try:
                with open(local_path(path), "rb") as file:
                    raw = file.read()
            except FileNotFoundError:
                if missing_ok:
                    continue
                raise
            text = document_text(raw)
            if not re.search(r"[^ \t\r\n]", text):
                continue
            files.append(file_uri(path))
            texts.append(text)
            size += len(raw)
            if size >= BATCH_BYTES or len(files) >= BATCH_FILES:
                yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(texts)], schema=schema)
                files, texts, size = [], [], 0
    if files:
        yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(texts)], schema=schema)


def _roots(spark: SparkSession, paths: list[str]) -> list[tuple[str, bool, int]] | None:
    """What the paths and patterns name, as path, whether it is a folder, and size; None if not all of it is local."""
    roots = {}
    settings = spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            system = place.getFileSystem(settings)
            place = system.makeQualified(place)
            if place.toUri().getScheme() != "file":
                return None
            found = system.globStatus(place) if _GLOB.search(path) else [system.getFileStatus(place)]
        except Py4JJavaError:  # Spark says what is wrong with it
            return None
        if not found:
            return None
        for status in found:
            roots[status.getPath().toString()] = (status.isDirectory(), status.getLen())
    return [(path, *facts) for path, facts in roots.items()]


def _read_by_spark(spark: SparkSession, paths: list[str], name: str, schema: str) -> DataFrame:
    documents = (
        spark.read.option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name)
        .schema(schema)
        .json(paths)
    )
    return documents.select(F.col("_metadata.file_path").alias("_file"), *documents.columns)


def read_documents(spark: SparkSession, path: str | list[str], name: str, schema: str) -> DataFrame:
    """The JSON documents in files called ``name`` below the paths, at any depth, after their ``_file``.

    The rows are those of Spark's multi-line reader: a list gives a row for each element, a text that is no
    document a row of nulls, a blank file none. Only a number or an object in a field for text is written
    anew (``1.50`` as ``1.5``).
    """
    paths = [path] if isinstance(path, str) else list(path)
    roots = _roots(spark, paths)
    if roots is None:
        return _read_by_spark(spark, paths, name, schema)
    ship_package(spark)
    folders = [place for place, is_folder, _ in roots if is_folder]
    files = spark.createDataFrame(
        [(place, length) for place, is_folder, length in roots if not is_folder], "path string, length long"
    )
    if folders:
        files = files.unionByName(list_folders(spark, folders, is_shown).select("path", "length"))
    files = files.filter((F.substring_index("path", "/", -1) == name) & (F.col("length") > 0))
    if len(roots) > 1:  # one may lie within the other
        files = files.dropDuplicates(["path"])
    large = F.col("length") > LARGE_FILE
    count, size = files.filter(~large).agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    least = min(count, spark.sparkContext.defaultParallelism)
    tasks = max(1, least, -(-count // TASK_FILES), -(-size // TASK_BYTES))
    missing_ok = spark.conf.get("spark.sql.files.ignoreMissingFiles", "false").lower() == "true"
    texts = (
        files.filter(~large).select("path").repartition(tasks, "path")
        .mapInArrow(lambda batches: _texts(batches, missing_ok), _TEXTS)
    )
    # A list is cut into the texts of its elements; one that is no object spoils the whole.
    is_list = F.col("_text").rlike(r"^[ \t\r\n]*\[")
    only_objects = F.forall("_elements", lambda element: element.startswith("{"))
    nothing = F.array(F.lit(None).cast("string"))
    documents = (
        texts.select("_file", "_text", F.when(is_list, F.from_json("_text", "array<string>")).alias("_elements"))
        .select("_file", F.when(~is_list, F.array("_text")).when(only_objects, F.col("_elements")).alias("_texts"))
        .select("_file", F.explode(F.coalesce("_texts", nothing)).alias("_text"))
        .select("_file", F.from_json("_text", schema).alias("_document"))
        .select("_file", "_document.*")
    )
    # Each of them is above LARGE_FILE.
    rest = [_GLOB.sub(r"\\\g<0>", row["path"]) for row in files.filter(large).select("path").toLocalIterator()]
    return documents.unionByName(_read_by_spark(spark, rest, name, schema)) if rest else documents
