"""Fitted models on disk."""

from __future__ import annotations

import logging

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from amberline.session import exists

log = logging.getLogger(__name__)


def load_model(path: str) -> PipelineModel | None:
    """The fitted pipeline saved at ``path``, or none, with a warning, when there is no such folder.

    A folder that is there must hold a whole model; anything else raises. Spark ML's own format is
    read; pickles are not, as unpickling can run any code.
    """
    if not exists(SparkSession.active(), path):
        log.warning("no model at %s; scoring by rules", path)
        return None
    return PipelineModel.load(path)
