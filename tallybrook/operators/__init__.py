"""DataFrame -> DataFrame operators; column names are parameters."""

from tallybrook.operators.aggregates import (
    flagged_per_year,
    per_invoice,
    rows_per_partition,
    summarise_invoices,
    summarise_sales,
)
from tallybrook.operators.filters import flagged_detail, size_at_least, size_in_form
from tallybrook.operators.joins import join_shared_key
from tallybrook.operators.layout import partition_count, physical_partitions, spread
from tallybrook.operators.preview import counted, preview
from tallybrook.operators.windows import add_growth, cut_by_range, cut_evenly, number_rows

__all__ = [
    "add_growth",
    "counted",
    "cut_by_range",
    "cut_evenly",
    "flagged_detail",
    "flagged_per_year",
    "join_shared_key",
    "number_rows",
    "partition_count",
    "per_invoice",
    "physical_partitions",
    "preview",
    "rows_per_partition",
    "size_at_least",
    "size_in_form",
    "spread",
    "summarise_invoices",
    "summarise_sales",
]
