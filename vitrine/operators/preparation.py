"""Preparation of raw catalogue rows as an ``ml`` stage, so that a saved model can score rows as they arrive.

What the training rows decide (medians, label codes) is kept in the fitted stage and saved with it: medians in the
metadata, codes as a table beside it, as there may be as many as distinct labels. A loaded stage reads the codes as
files whose bytes the planner knows, so it broadcasts them only below the session's threshold.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import half_even
from ..functions import pricing
from .clean import MEDIAN_COLUMNS, coerce_numeric
from .features import FEATURE_PRESETS, label_codes, with_codes
from .ordering import quantile_record

LABELS = ["categorie", "plateforme", "pays_shop"]
FILLED = [c for c in MEDIAN_COLUMNS if c != "prix_promo"]
NUMBERS = [*MEDIAN_COLUMNS, "remise_pct", "en_stock"]
UNSEEN = -1


class _Settings(Params):
    preset = Param(Params._dummy(), "preset", "feature preset of the vector", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "name of the feature vector", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(preset="staged", outputCol="features")


class CataloguePreparation(Estimator, _Settings, MLReadable, MLWritable):
    """Learns medians and label codes of deduplicated rows."""

    @keyword_only
    def __init__(self, *, preset: str = "staged", outputCol: str = "features"):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> CataloguePreparationModel:
        filled = [c for c in FILLED if c in df.columns]
        medians = {}
        if filled:
            record = quantile_record(coerce_numeric(df, filled), {c: (c, 0.5) for c in filled})
            medians = df.sparkSession.range(1).select(record.alias("m")).first()["m"].asDict()
        model = CataloguePreparationModel(medians, label_codes(df, LABELS), [c for c in LABELS if c in df.columns])
        return self._copyValues(model)

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class CataloguePreparationModel(Model, _Settings, MLReadable, MLWritable):
    """Numbers from texts, medians for the missing, engagement, discount ratio, label codes and the feature vector.

    A column of the training rows that is absent is all missing. A label never seen gets the code -1; a missing one is
    the class ``nan``, as in training, or unseen if training had none missing. Rows are neither dropped nor merged.
    """

    def __init__(self, medians: dict[str, float | None] | None = None, codes: DataFrame | None = None,
                 labels: list[str] | None = None):
        super().__init__()
        self._defaults()
        self.medians, self.codes, self.labels = medians or {}, codes, labels or []

    def _transform(self, df: DataFrame) -> DataFrame:
        absent = {c: F.lit(None).cast("string") for c in [*NUMBERS, *self.labels] if c not in df.columns}
        numeric = coerce_numeric(df.withColumns(absent), NUMBERS)
        filled = numeric.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast("double")) for c, m in self.medians.items()})
        featured = filled.withColumns({
            "engagement": half_even(pricing.engagement(F.col("rating"), F.col("nb_reviews")), 3),
            "ratio_remise": pricing.discount_ratio_unit(F.col("prix"), F.col("prix_promo"))})
        coded = with_codes(featured, self.codes, self.labels, UNSEEN)
        names = [c for c in FEATURE_PRESETS[self.getOrDefault(self.preset)] if c in coded.columns]
        values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names])
        return coded.withColumn(self.getOrDefault(self.outputCol), array_to_vector(values))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: CataloguePreparationModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        kept = {"medians": self.model.medians, "labels": self.model.labels}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, kept)
        self.model.codes.write.parquet(f"{path}/codes")


class _ModelReader(MLReader):
    def load(self, path: str) -> CataloguePreparationModel:
        kept = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        codes = self.sparkSession.read.schema("column string, value string, code int").parquet(f"{path}/codes")
        model = CataloguePreparationModel(kept["medians"], codes, kept["labels"])
        model._resetUid(kept["uid"])
        DefaultParamsReader.getAndSetParams(model, kept)
        return model
