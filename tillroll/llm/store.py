"""Written tables in the shared folder: the only way lineage is cut here."""

from __future__ import annotations

import gc
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import checkpoint_dir, delete_folder


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application; tasks
    import it by name wherever the application was started.  Only the driver reads the
    file it makes; Spark hands it out."""
    sc = spark.sparkContext
    if getattr(sc, "_tillroll_sent", None) is None:
        root = pathlib.Path(__file__).resolve().parents[1]
        target = pathlib.Path(tempfile.mkdtemp(prefix="tillroll-"), "tillroll.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(target))
        sc._tillroll_sent = str(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the folder named in ``spark.checkpoint.dir`` and
    read it back.  Tasks that run again after a lost executor re-read files; they
    do not recompute the plan above, so rows, ids and offsets stay the same."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tillroll-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_in = path  # for drop_stored
    return out


def drop_stored(*tables: DataFrame) -> None:
    """Delete the folders of ``stored`` tables that every reader is done with (that is,
    has been stored itself)."""
    for t in tables:
        delete_folder(t.sparkSession, t._stored_in)


def tidy(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of finished writes now, not when the driver next
    happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions that the session sets for its data size."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fresh_name(taken, stem: str) -> str:
    """A column name that no input column has (names compare without case)."""
    low = {c.lower() for c in taken}
    name, k = stem, 0
    while name.lower() in low:
        k += 1
        name = f"{stem}_{k}"
    return name


#: Rows of a few numbers each (under 64 MB) that may be sent to every executor.
BROADCAST_ROWS = 2_000_000


def if_few(ids: DataFrame, cells: int | None = None) -> DataFrame:
    """``ids`` (a stored table) marked for broadcast if it has few rows - or ``cells``, if
    its rows hold lists - so that a join with it leaves texts where they are; a larger
    one is joined by shuffle."""
    return F.broadcast(ids) if (ids.count() if cells is None else cells) <= BROADCAST_ROWS else ids


def rewritten(rows: DataFrame, text_col: str, left: Callable[[str, list], str | None]) -> DataFrame:
    """``rows`` without their last column, a list of what goes from the text (null: nothing
    does); ``left(text, list)`` is the new text, or None for a row that goes as a whole."""
    names, at = rows.columns[:-1], rows.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                b = batch.slice(begin, 512)
                texts, lists = b.column(at), b.column(b.num_columns - 1)
                columns = b.columns[:-1]
                keep = [True] * b.num_rows
                if lists.null_count < b.num_rows:
                    new = texts.to_pylist()
                    for k, found in enumerate(lists.to_pylist()):
                        if found is not None:
                            new[k] = left(new[k], found)
                            keep[k] = new[k] is not None
                    columns[at] = pa.array(new, texts.type)
                yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    return rows.mapInArrow(run, T.StructType(rows.schema.fields[:-1]))
