"""What the operators share: the shared folder, written intermediate tables, stable row identifiers, word patterns."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space. ``bytes.split()`` splits the same way.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Only a local master may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="premia-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read again: lineage ends here, and the size is known to Catalyst."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def with_row_id(docs: DataFrame, name: str = "_rid") -> DataFrame:
    """Adds a string that names a row, the same each time the frame is read, also where doc_id is null or repeated.

    File and row number where the frame is a file scan; any other frame is written to the shared folder first.
    """
    try:
        return docs.select("*", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias(name))
    except AnalysisException:
        return with_row_id(written(docs, "rows"), name)


def chosen(docs: DataFrame, decide) -> DataFrame:
    """Rows of ``docs``, each as often as ``decide`` says: it gets the rows with their locator (rid) and returns rid and copies."""
    rows = with_row_id(docs, "_llm_rid")
    decided = decide(rows.withColumnRenamed("rid", "_llm_own").withColumn("rid", F.col("_llm_rid")))
    decided = decided.select(F.col("rid").alias("_llm_rid"), F.col("copies").cast("int").alias("_llm_copies")).filter("_llm_copies > 0")
    out = rows.join(decided, "_llm_rid").withColumn("_llm_copy", F.explode(F.expr("sequence(1, _llm_copies)")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def text_of(name: str = "text") -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def holdout(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32 of doc_id as text, modulo: the rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def digest_hex(column: Column) -> Column:
    return F.sha2(column, 256)


_SHIPPED: set = set()


def ship(spark: SparkSession) -> None:
    """Gives Python workers this package, once per application, so that jobs run without a PYTHONPATH on the executors."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="premia-code-")) / "premia.zip"  # Spark serves it to the executors
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


class Recent:
    """A table of bounded size that keeps what is used: full, it becomes the older half, and what is found there moves up."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value
