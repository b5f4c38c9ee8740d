"""Sales-transaction cleaning, price imputation and reporting as Spark jobs."""

from salesmill.operators.clean import clean, finish
from salesmill.operators.impute import impute
from salesmill.plans.jobs import build_datamart
from salesmill.plans.session import tune
from salesmill.schemas import CLEAN_SCHEMA, RAW_SCHEMA, conform

__all__ = ["CLEAN_SCHEMA", "RAW_SCHEMA", "build_datamart", "clean", "conform", "finish", "impute", "tune"]
