"""The raw datasets and where each layer keeps its tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Dataset:
    """One raw CSV dataset.

    `types` declares columns by name; every other column of the file stays a string, so
    codes keep their leading zeros. `multi_line` allows line breaks inside quoted fields,
    at the price of one task per file: supply such a dataset as many files.
    """

    name: str
    file: str
    types: Mapping[str, str] = field(default_factory=dict)
    multi_line: bool = False


MONEY = "decimal(20,4)"

# Dataset names, and the columns of each that are not plain text.
DATASETS = (
    # Its dates stay text until silver has filled the missing ones.
    Dataset("orders", "orders.csv"),
    Dataset(
        "order_items",
        "order_items.csv",
        {
            "order_item_id": "int",
            "shipping_limit_date": "timestamp",
            "price": MONEY,
            "freight_value": MONEY,
        },
    ),
    Dataset("products", "products.csv"),
    Dataset("customers", "customers.csv"),
    Dataset("reviews", "reviews.csv", {"review_score": "int"}, multi_line=True),
    Dataset("sellers", "sellers.csv"),
    Dataset("geolocation", "geolocation.csv"),
    Dataset("order_payments", "order_payments.csv", {"payment_value": MONEY}),
    Dataset("category_name_translation", "category_name_translation.csv"),
)

# Table names of the two derived layers.
SILVER_SALES = "denormalized_sales"
GOLD_SEGMENTS = "rfm_segments"


def with_files(files: Mapping[str, str], datasets: tuple[Dataset, ...] = DATASETS) -> tuple[Dataset, ...]:
    """The same datasets under the caller's own file names (name -> file, directory or glob)."""
    unknown = set(files) - {d.name for d in datasets}
    if unknown:
        raise KeyError(f"not in the registry: {sorted(unknown)}")
    return tuple(replace(d, file=files.get(d.name, d.file)) for d in datasets)


def only(*names: str, datasets: tuple[Dataset, ...] = DATASETS) -> tuple[Dataset, ...]:
    """The named datasets, in registry order."""
    unknown = set(names) - {d.name for d in datasets}
    if unknown:
        raise KeyError(f"not in the registry: {sorted(unknown)}")
    return tuple(d for d in datasets if d.name in names)


def source_path(raw_base: str, dataset: Dataset) -> str:
    return f"{raw_base.rstrip('/')}/{dataset.file}"


def layer_path(base: str, layer: str, table: str) -> str:
    """Folder of one table: `<base>/<bronze|silver|gold>/<table>`."""
    return f"{base.rstrip('/')}/{layer}/{table}"
