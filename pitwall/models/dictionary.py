"""A dictionary of categories as a table, and the encoder that looks rows up in it.

Categories of all columns get dense slots by a prefix count over hashed slices,
so no task orders them all and the driver sees one row per column, however many
categories there are.  Rows find their slots by a join per column and leave as
sparse vectors.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators.scan import HASH_DIGITS, prefix_scan
from pitwall.session import materialise, shared_folder

INFREQUENT = "infrequent"


def category_counts(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of all categorical columns in one job; NULL is no category."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    long = train.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def dense_slots(counts: DataFrame, min_frequency: int = 1) -> DataFrame:
    """(column, value, n, slot): frequent categories are numbered from 0 in hash order,
    all rare ones of a column share the slot after them."""
    often = F.col("n") >= min_frequency
    hashed = counts.where(often).withColumn("__hash", F.md5("value"))
    frequent = prefix_scan(hashed, keys=["column"], order=["__hash", "value"],
                           slices=[F.substring("__hash", 1, HASH_DIGITS)], count="slot").drop("__hash")
    sizes = counts.groupBy("column").agg(F.count_if(often).alias("slot"))
    return frequent.unionByName(counts.where(~often).join(sizes, "column"))


def _sparse(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector from its parts.  Spark has no function for it, but reads one from JSON."""
    parts = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), schema)["v"]


def sparse_parts(vector: str) -> Column:
    """(size, indices, values) of a sparse vector column; nothing is made for slots that are 0."""
    held = F.unwrap_udt(vector)
    return F.struct(held["size"].alias("size"), held["indices"].alias("indices"), held["values"].alias("values"))


class Encoder(Transformer, MLReadable, MLWritable):
    """Rows to feature vectors: one-hot categories by the dictionary, then the numbers.

    ``categories`` are dicts of name, mode (fills NULL), slots and offset;
    ``numbers`` dicts of name, fill, mean and std (scaled where std is not None).
    A category that training did not have sets no slot.
    """

    def __init__(self, categories: Sequence[Mapping] = (), numbers: Sequence[Mapping] = (), path: str | None = None, output: str = "features"):
        super().__init__()
        self.categories, self.numbers, self.path, self.output = list(categories), list(numbers), path, output

    @property
    def size(self) -> int:
        return sum(c["slots"] for c in self.categories) + len(self.numbers)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def parts(self, dataset: DataFrame, indices: str, values: str) -> DataFrame:
        """Add the slots that are not zero and their values as two array columns."""
        out, slots = dataset, []
        for i, c in enumerate(self.categories):
            own = self.table(dataset.sparkSession).where(F.col("column") == c["name"]).select(
                F.col("value").alias(f"__v{i}"), (F.col("slot") + c["offset"]).cast("int").alias(f"__s{i}"))
            key = F.coalesce(F.col(c["name"]).cast("string"), F.lit(c["mode"]))
            out = out.withColumn(f"__k{i}", key).join(own, F.col(f"__k{i}") == F.col(f"__v{i}"), "left")
            slots.append(F.col(f"__s{i}"))
        first = self.size - len(self.numbers)
        # what is not set is taken out as slot -1 and value 0: plain expressions, compiled, unlike functions over arrays of structs
        entries = [(s, F.when(s.isNotNull(), 1.0).otherwise(0.0)) for s in slots]
        entries += [(F.lit(first + i), F.coalesce(v, F.lit(0.0))) for i, v in enumerate(self._values())]
        held = F.array(*[F.when(x != 0, s).otherwise(F.lit(-1)) for s, x in entries])
        drop = [f"__{p}{i}" for i in range(len(slots)) for p in "kvs"]
        return out.withColumns({indices: F.array_remove(held, -1), values: F.array_remove(F.array(*[x for _, x in entries]), 0.0)}).drop(*drop)

    def _values(self) -> list[Column]:
        out = []
        for n in self.numbers:
            x = F.coalesce(F.col(n["name"]).cast("double"), F.lit(n["fill"]))
            out.append(x if n["std"] is None else (x - F.lit(n["mean"])) / F.lit(n["std"]))
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.categories:
            vector = _sparse(self.size, F.col("__indices"), F.col("__values"))
            out = self.parts(dataset, "__indices", "__values").withColumn(self.output, vector).drop("__indices", "__values")
        else:
            out = dataset.withColumn(self.output, array_to_vector(F.array(*self._values())))
        return self._named(out)

    def written(self, dataset: DataFrame, *columns: str) -> DataFrame:
        """``columns`` and the vectors, written.  Parquet holds a vector as its parts, so none is made on the
        way, and each pass of a fit over the rows reads finished vectors."""
        held = self.parts(dataset, "__indices", "__values").select(*columns, F.struct(
            F.lit(0).cast("byte").alias("type"), F.lit(self.size).alias("size"),
            F.col("__indices").alias("indices"), F.col("__values").alias("values")).alias(self.output))
        schema = T.StructType([T.StructField(f.name, VectorUDT() if f.name == self.output else f.dataType) for f in held.schema])
        return self._named(materialise(held, schema))

    def _named(self, rows: DataFrame) -> DataFrame:
        return rows.withMetadata(self.output, {"slots": {
            "table": self.path, "size": self.size, "numbers": [n["name"] for n in self.numbers],
            "categories": [{k: c[k] for k in ("name", "offset", "slots")} for c in self.categories]}})

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader()


class _EncoderWriter(MLWriter):
    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def saveImpl(self, path: str) -> None:
        e, spark = self.encoder, self.sparkSession
        DefaultParamsWriter.saveMetadata(e, path, spark, extraMetadata={
            "encoder": {"categories": e.categories, "numbers": e.numbers, "output": e.output}})
        if e.categories:
            e.table(spark).write.parquet(f"{path}/dictionary")


class _EncoderReader(MLReader):
    def load(self, path: str) -> Encoder:
        facts = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        encoder = Encoder(**facts["encoder"], path=f"{path}/dictionary" if facts["encoder"]["categories"] else None)
        encoder._resetUid(facts["uid"])
        return encoder


def fit_categories(train: DataFrame, columns: Sequence[str], min_frequency: int = 1) -> tuple[list[dict], str]:
    """What an ``Encoder`` needs of the categorical columns, and the folder of the dictionary."""
    counts = materialise(category_counts(train, columns))
    rows = counts.groupBy("column").agg(
        F.count_if(F.col("n") >= min_frequency).alias("often"), F.count_if(F.col("n") < min_frequency).alias("rare"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect()  # one row a column
    found = {r["column"]: r for r in rows}
    out, offset = [], 0
    for c in columns:
        r = found.get(c)
        slots = r["often"] + (r["rare"] > 0) if r else 0
        out.append({"name": c, "mode": r["mode"] if r else "", "slots": slots, "offset": offset})
        offset += slots
    path = f"{shared_folder(train.sparkSession)}/pitwall-{uuid.uuid4().hex}"
    dense_slots(counts, min_frequency).write.parquet(path)
    return out, path


def slot_names(spark: SparkSession, facts: Mapping, slots: Sequence[int]) -> dict[int, str]:
    """Names of a few slots, ``facts`` being the metadata of the feature column."""
    first = facts["size"] - len(facts["numbers"])
    out = {s: facts["numbers"][s - first] + "__n" for s in slots if s >= first}
    wanted = [(c["name"], c["offset"], s - c["offset"]) for s in slots for c in facts["categories"]
              if c["offset"] <= s < c["offset"] + c["slots"]]
    if wanted:
        few = spark.createDataFrame([(c, s) for c, _, s in wanted], "column string, slot long")
        named = spark.read.parquet(facts["table"]).join(F.broadcast(few), ["column", "slot"]).groupBy("column", "slot").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("value")).collect()  # one row a wanted slot
        text = {(r["column"], r["slot"]): r["value"] if r["n"] == 1 else INFREQUENT for r in named}
        out.update({offset + s: f"{c}={text[(c, s)]}" for c, offset, s in wanted})
    return out
