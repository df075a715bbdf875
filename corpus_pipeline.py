"""The corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function).  Each function takes (spark, docs, sf_dir)
and returns a DataFrame; all but the last return the columns of
``documents``.  Between stages the rows are written as Parquet to the shared
folder and read again.

1. toxicity: documents that operator 8 rejects (score of 0.7 or more) go.
2. line_dedup: blocks of lines that an earlier document has go from later
   ones (operator 4); a document that loses all its lines goes.
3. near_dedup: the first document of each near-duplicate group stays
   (operator 2).
4. mixing: documents are repeated or left out by the mix (operator 3).
5. packing: the pieces of packed sequences (operator 6).

Folders: a stage's function keeps the intermediate tables that its result
reads.  It takes the stage before it, called by the same thread on the same
session and folder, for written, and clears that one's tables.  ``CorpusRun``
does the same for a whole run and also deletes each stage's output once the
next is written; its ``clear`` deletes the rest.  Runs in several threads don't
touch each other's folders.

Defined results: rows with a null ``doc_id`` go through each stage like any
other; the near-duplicate stage keeps such a row if it links with no other
document.  Null and empty texts pass the first three stages as they are, are
drawn by the mix like other documents of size 0, and are packed as their end
token.  Repeated rows lose their lines to the first and go.  A null source is
a source of its own.  Very long texts are read in blocks by each operator.
Empty tables give no rows; without labels nothing is toxic.  Columns other
than those of ``documents`` are dropped at the start, whatever their names.
"""

from __future__ import annotations

import threading
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.line_align import dedup_lines
from loanlens.llm.minhash_dedup import near_duplicates
from loanlens.llm.mixing import mix_documents
from loanlens.llm.packing import pack_documents
from loanlens.llm.storage import Workspace, read_table, ship_package, workspaces
from loanlens.llm.toxicity import score_toxicity

#: Folders of the last stage that a thread has called on a session and folder.
_last: dict[tuple, list[Workspace]] = {}
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _stage(function):
    """A stage to be called by itself: clears the tables of the one before it."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = (threading.get_ident(), id(spark), sf_dir)
        for work in _last.pop(key, []):
            work.clear()
        with workspaces() as opened:
            result = function(spark, docs, sf_dir)
        _last[key] = opened
        return result

    run_stage.plain = function
    return run_stage


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return score_toxicity(docs, read_table(spark, sf_dir, "labels"), COLUMNS).where("predicted = 0").select(*COLUMNS)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    cut = dedup_lines(docs.select(*COLUMNS)).where("n_removed = 0 OR text <> ''")
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*COLUMNS)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_duplicates(docs, COLUMNS).where("first").select(*COLUMNS)


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    mixed = mix_documents(docs, COLUMNS).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack_documents(docs, carry=F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
          ("packing", packing)]
#: Trees, alignment and tokenization have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


class CorpusRun:
    """All stages over ``documents``, with the folders that the result still reads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        outputs = Workspace(spark, "pipeline")
        self._held: list[Workspace] = [outputs]
        docs, before = read_table(spark, sf_dir, "documents"), None
        for name, stage in STAGES[:-1]:
            with workspaces() as opened:
                docs = outputs.write(stage.plain(spark, docs, sf_dir), name)
            for work in opened:
                work.clear()
            if before:
                outputs.remove(before)
            before = name
        with workspaces() as opened:
            self.result = STAGES[-1][1].plain(spark, docs, sf_dir)
        self._held += opened

    def clear(self) -> None:
        """Delete the folders; the result can't be read any more."""
        for work in self._held:
            work.clear()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    return CorpusRun(spark, sf_dir).result
