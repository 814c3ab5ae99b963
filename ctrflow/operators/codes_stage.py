"""The encoder as a stage of a Spark ML pipeline, so that a saved model has the codes it was trained with."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from ctrflow.functions.codes import gender_code
from ctrflow.functions.time import time_of_day
from ctrflow.operators.encode import Encoder


class CodeLookup(Transformer, MLWritable, MLReadable):
    """Adds the codes of the encoder's columns, of the time of day (from the hour, where it is missing) and of gender.

    Unknown labels get a null code. Columns that a frame lacks, and codes that it has already, are left alone, so rows that
    are encoded pass through.
    """

    @keyword_only
    def __init__(self, *, encoder: Encoder | None = None):
        super().__init__()
        self.encoder = encoder

    def _transform(self, df: DataFrame) -> DataFrame:
        if "time_of_day" not in df.columns and "hour" in df.columns:
            df = df.withColumn("time_of_day", time_of_day(F.col("hour")))
        if "gender" in df.columns and "gender_encoding" not in df.columns:
            df = df.withColumn("gender_encoding", gender_code(F.col("gender")))
        open_ = [c for c in self.encoder.columns() if c in df.columns and f"{c}_encoding" not in df.columns]
        return self.encoder.transform(df, open_, on_unseen="null") if open_ else df

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, stage: CodeLookup):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.encoder.save(f"{path}/codes")


class _Reader(MLReader):
    def load(self, path: str) -> CodeLookup:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = CodeLookup(encoder=Encoder.load(self.sparkSession, f"{path}/codes"))
        stage._resetUid(metadata["uid"])
        return stage
