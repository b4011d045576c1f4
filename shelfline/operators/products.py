"""Product versions out of JSON attribute and family documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.jsondocs import first_of_each, ids_of_type, list_length
from shelfline.functions.scalars import unsigned_or_null
from shelfline.sources.tables import recent_rows

# Names of the attributes inside a product document.
NAME = "12963"
TYPE = "01181"
MODEL = "model_modelID"
GAMMA = "letterRange"
DEPARTMENT = "mgtNomencProduct_mgtNomenc_departmentID"
SUBDEPARTMENT = "mgtNomencProduct_mgtNomenc_subDepartmentID"
CLASS = "mgtNomencProduct_mgtNomenc_categoryID"
SUBCLASS = "mgtNomencProduct_mgtNomenc_subCategoryID"

STANDARD_FAMILY = "STANDARD"


def shred_products(attributes: DataFrame, families: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """One product row per attribute document changed in the last days.

    Stamps are the later of the attribute and the family document's. Documents
    without a family list keep NULL families.
    """
    stamps = {"valid_from_dttm": "valid_from_dttm", "valid_to_dttm": "valid_to_dttm",
              "created_dttm": "stamp", "updated_dttm": "updated_dttm"}
    listed = families.where(list_length(F.col("families")) > 0).select(
        "product_id", ids_of_type(F.col("families"), STANDARD_FAMILY).alias("families"),
        *[F.col(source).alias(f"family_{out}") for out, source in stamps.items()])
    fields = [NAME, MODEL, TYPE, GAMMA, DEPARTMENT, SUBDEPARTMENT, CLASS, SUBCLASS]
    documents = attributes.withColumn("doc", first_of_each(F.col("attributes"), fields))

    def number(field: str, bits: int) -> Column:
        return unsigned_or_null(F.col("doc")[field], bits)

    products = documents.join(listed, "product_id", "left").select(
        unsigned_or_null(F.col("product_id"), 32).alias("item"),
        F.col("doc")[NAME].alias("name"),
        number(MODEL, 32).alias("model"),
        "families",
        F.col("doc")[TYPE].alias("type"),
        F.col("doc")[GAMMA].alias("gamma"),
        number(DEPARTMENT, 8).alias("dep"),
        number(SUBDEPARTMENT, 16).alias("subdep"),
        number(CLASS, 16).alias("class"),
        number(SUBCLASS, 16).alias("subclass"),
        *[F.when(F.col(source) <= F.col(f"family_{out}"), F.col(f"family_{out}"))
           .otherwise(F.col(source)).alias(out) for out, source in stamps.items()],
        F.lit("1").alias("is_actual"),
    )
    return recent_rows(products.where(F.col("item").isNotNull()), "created_dttm", as_of, days)
