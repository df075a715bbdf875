"""Dummies of columns with many values, as one sparse vector a row.

Values are numbered on the cluster: the distinct (feature, value) pairs are
sorted by a distributed prefix count, so neither their list nor a column a value
is on the driver.  Rows get the number of each of their values by a join with
that index (broadcast only after counting it; beyond that adaptive execution
splits a value that a third of all rows has), and Spark's ``OneHotEncoder`` and
``VectorAssembler`` make the vector.

Defined results: a NULL or an unseen value has no entry; values are ordered by
their text; an empty table fits no values and every vector is empty; other
columns stay, those named ``{column}__place`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators.encoders import category_values
from loanlens.operators.ordered import prefix_counts
from loanlens.session import cut_lineage

#: Values of all columns together that are sent to every task.
SENT_VALUES = 500_000


@dataclass
class SparseDummies:
    """The numbered values of some columns; ``index`` is a written table (feature, value, place)."""

    cols: list[str]
    index: DataFrame
    sizes: dict[str, int]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> SparseDummies:
        values = category_values(df, cols).select("feature", "value", F.lit(1).alias("one"))
        index = prefix_counts(values, ["feature"], ["value"], "one").select("feature", "value", F.col("before").alias("place"))
        return cls._of(list(cols), cut_lineage(index))

    @classmethod
    def _of(cls, cols: list[str], index: DataFrame) -> SparseDummies:
        counted = {r["feature"]: r["n"] for r in index.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        return cls(cols, index, {c: counted.get(c, 0) for c in cols})

    @property
    def width(self) -> int:
        return sum(self.sizes.values())

    def save(self, path: str) -> None:
        """Write the index below ``path``, with the columns in order."""
        path = path.rstrip("/")
        self.index.write.mode("overwrite").parquet(f"{path}/index")
        SparkSession.active().createDataFrame(list(enumerate(self.cols)), "place int, feature string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/columns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SparseDummies:
        path = path.rstrip("/")
        cols = [r["feature"] for r in spark.read.parquet(f"{path}/columns").orderBy("place").collect()]
        return cls._of(cols, spark.read.parquet(f"{path}/index"))

    def names(self) -> DataFrame:
        """(place, name): the vector's entries as ``{column}_{value}``."""
        pairs, at = [], 0
        for c in self.cols:
            pairs += [F.lit(c), F.lit(at)]
            at += self.sizes[c]
        base = F.create_map(*pairs)
        return self.index.select((base[F.col("feature")] + F.col("place")).alias("place"),
                                 F.concat_ws("_", "feature", "value").alias("name"))

    def places(self, df: DataFrame) -> DataFrame:
        """``df`` with ``{column}__place``: the number of each value in its column, NULL where it has none."""
        few = self.width <= SENT_VALUES
        out = df.drop(*[f"{c}__place" for c in self.cols])
        for i, c in enumerate(self.cols):
            own = self.index.where(F.col("feature") == c).select(F.col("value").alias(f"_v{i}"), F.col("place").alias(f"{c}__place"))
            key = F.col(c).cast("string") == F.col(f"_v{i}")
            out = out.join(F.broadcast(own) if few else own, key, "left").drop(f"_v{i}")
        return out

    def transform(self, df: DataFrame, out: str = "dummies") -> DataFrame:
        """``df`` with one sparse vector of ``width`` entries in column ``out``."""
        spark, used = df.sparkSession, [c for c in self.cols if self.sizes[c]]
        rows = self.places(df)
        # the place behind a column's last is the encoder's invalid one, which it drops
        rows = rows.withColumns({f"_at{i}": F.coalesce(f"{c}__place", F.lit(self.sizes[c])).cast("double")
                                 for i, c in enumerate(used)}).drop(*[f"{c}__place" for c in self.cols])
        ats, parts = [f"_at{i}" for i in range(len(used))], [f"_part{i}" for i in range(len(used))]
        if used:
            # the encoder learns sizes only, from one row of the largest places
            largest = spark.createDataFrame([[float(self.sizes[c] - 1) for c in used]], ", ".join(f"{a} double" for a in ats))
            rows = OneHotEncoder(inputCols=ats, outputCols=parts, handleInvalid="keep", dropLast=True).fit(largest).transform(rows)
            return VectorAssembler(inputCols=parts, outputCol=out).transform(rows).drop(*ats, *parts)
        return rows.withColumn(out, array_to_vector(F.array().cast("array<double>")))
