"""Parameters of the tables kept up to date by the incremental merge."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.scalars import natural_key, parse_timestamp, true_flag
from shelfline.operators.keyed import merge_increment
from shelfline.operators.upsert import KeyedTable


class MergeSpec(NamedTuple):
    """Business key, order field, current-version flag and natural key parts."""

    key: tuple[str, ...]
    order_by: str | None = "created_dttm"
    is_act: str | None = "is_actual"
    nk: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()


# Flags of the substitute table that arrive as 't' or 'f'.
SUBSTITUTE_FLAGS = (
    "same_model_id", "same_type", "same_price_quartile", "same_price_quartile_per_unit",
    "same_brand", "same_dep", "same_subdep", "same_class", "same_subclass",
    "actual_gamma", "substitute_is_variant", "families_intersection",
)

# Business keys of the source tables.
MERGES: dict[str, MergeSpec] = {
    "class": MergeSpec(("dept", "class", "valid_from_dttm")),
    "deps": MergeSpec(("nk",)),
    "groups": MergeSpec(("group_no", "valid_from_dttm")),
    "item_loc": MergeSpec(("item", "loc")),
    "item_loc_hist": MergeSpec(("nk", "valid_from_dttm")),
    "item_loc_traits": MergeSpec(("nk",)),
    "item_master": MergeSpec(("nk",)),
    "item_supp_country": MergeSpec(("item", "supplier", "primary_supp_ind", "primary_country_ind")),
    "item_supp_country_dim": MergeSpec(("nk",)),
    "item_supplier": MergeSpec(("nk",)),
    "price_hist": MergeSpec(("nk",)),
    "subclass": MergeSpec(("dept", "class", "subclass", "valid_from_dttm")),
    "uda_item_date": MergeSpec(("item", "uda_id")),
    "uda_item_lov": MergeSpec(("item", "uda_id")),
    "uda_values": MergeSpec(("nk",)),
    "path_header": MergeSpec(("nk",)),
    "path_version": MergeSpec(("nk",)),
    "web_orders": MergeSpec(("id",), is_act=None, nk=("id", "updatedat")),
    "web_order_products": MergeSpec(("order_id", "productnumber"), is_act=None,
                                    nk=("id", "order_id", "productnumber", "updatedat")),
    "foreign_orders": MergeSpec(("order_num", "product"), order_by="order_create_ts", is_act=None),
    "item_pair_scores": MergeSpec(("item_a", "item_b"), order_by=None, is_act=None),
    "substitute_scores": MergeSpec(("product_id", "substitute"), order_by=None, is_act=None,
                                   flags=SUBSTITUTE_FLAGS),
    "product_documents": MergeSpec(("product_id",), order_by="stamp", is_act=None),
    "family_documents": MergeSpec(("product_id",), order_by="stamp", is_act=None),
}


def update_stamp_key(parts: tuple[str, ...]) -> Column:
    """Natural key whose update stamp, given as text, is brought to one layout."""
    return natural_key(*[
        parse_timestamp(F.col(part)) if part == "updatedat" else F.col(part) for part in parts])


def merge_columns(spec: MergeSpec) -> dict:
    """How an increment's natural key and flags are built."""
    return {
        "nk": update_stamp_key(spec.nk) if spec.nk else None,
        "mapping": {flag: true_flag(F.col(flag)) for flag in spec.flags},
    }


def keyed_table(name: str, path: str, schema: T.StructType, buckets: int) -> KeyedTable:
    """One of the listed tables, stored by key."""
    spec = MERGES[name]
    return KeyedTable(path, schema, spec.key, spec.order_by, buckets)


def merge_table(name: str, raw: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New content and current view of one of the listed tables."""
    spec = MERGES[name]
    return merge_increment(
        raw, target, list(spec.key), spec.order_by, is_act=spec.is_act, **merge_columns(spec))
