"""P43 as a run: the first master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authorlink.operators.load import bootstrap_load
from authorlink.options import Options
from authorlink.schemas import MASTER, PRIOR_DELIVERY
from authorlink.sources.tables import conform


def run_bootstrap(prior: DataFrame, options: Options = Options()) -> DataFrame:
    """The master made of an earlier delivery's result, ready to be written."""
    loaded = bootstrap_load(conform(prior, PRIOR_DELIVERY), options)
    return conform(loaded.withColumn("etl_updated_date", F.lit(None)), MASTER)
