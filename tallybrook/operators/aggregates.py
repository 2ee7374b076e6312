"""Aggregates over sales lines and flagged rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import Addend, Span, exact_mean, parsed_date, spans


def _grouped(df: DataFrame, keys: Sequence[Column | str], measures: dict[str, Column],
             wanted: Sequence[str] | None) -> DataFrame:
    names = list(measures) if wanted is None else list(wanted)
    return df.groupBy(*keys).agg(*[measures[name].alias(name) for name in names])


def _spans(lines: DataFrame, quantity: str, price: str) -> dict[str, Span | None]:
    found = spans(lines, {"quantity": quantity, "price": price})
    amount, each = found["quantity"], found["price"]
    if amount and each:
        return {**found, "value": amount.times(each)}
    return {**found, **spans(lines, {"value": F.col(quantity) * F.col(price)})}


def summarise_sales(
    lines: DataFrame,
    keys: Sequence[Column | str] = (),
    wanted: Sequence[str] | None = None,
    *,
    invoice: str = "InvoiceNo",
    quantity: str = "Quantity",
    price: str = "UnitPrice",
    price_digits: int | None = None,
) -> DataFrame:
    """Measures over invoice lines, per group or over the whole table.

    Sums lose nothing and do not depend on the order of the rows; ``price_digits`` rounds
    the mean. For them the two columns are read once before, see :func:`spans`.
    """
    values = {"price": F.col(price), "quantity": F.col(quantity), "value": F.col(quantity) * F.col(price)}
    wide = _spans(lines, quantity, price)
    mean = exact_mean(values["price"], wide["price"])
    measures = {
        "num_records": F.count(F.lit(1)),
        "total_quantity": F.round(Addend.of(values["quantity"], wide["quantity"]).total(), 6),
        "avg_price": mean if price_digits is None else F.round(mean, price_digits),
        "num_invoices": F.count_distinct(F.col(invoice)),
        "invoice_value": F.round(Addend.of(values["value"], wide["value"]).total(), 2),
    }
    return _grouped(lines, keys, measures, wanted)


def per_invoice(
    lines: DataFrame,
    invoice: str = "InvoiceNo",
    quantity: str = "Quantity",
    price: str = "UnitPrice",
) -> DataFrame:
    """One row per invoice: the parts of its quantity and value, for :func:`summarise_invoices`.

    Done before lines meet their invoice headers, this makes the shuffle of the
    join as small as the number of invoices: an invoice that holds a large share
    of all lines is already one row per map task when it is shuffled. The
    grouping and the join share that one exchange.
    """
    wide = _spans(lines, quantity, price)
    value = F.col(quantity) * F.col(price)
    return lines.groupBy(invoice).agg(
        Addend.of(quantity, wide["quantity"]).partial().alias("InvoiceQuantity"),
        Addend.of(value, wide["value"]).partial().alias("InvoiceValue"),
    )


def summarise_invoices(
    invoices: DataFrame,
    keys: Sequence[Column | str],
    wanted: Sequence[str] | None = None,
    *,
    invoice: str = "InvoiceNo",
) -> DataFrame:
    """What :func:`summarise_sales` gives, from rows of :func:`per_invoice`."""
    measures = {
        "num_invoices": F.count_distinct(F.col(invoice)),
        "total_quantity": Addend.again(invoices, "InvoiceQuantity").total(),
        "invoice_value": F.round(Addend.again(invoices, "InvoiceValue").total(), 2),
    }
    return _grouped(invoices, keys, measures, wanted)


def flagged_per_year(
    df: DataFrame,
    key: str,
    flag: str,
    date_text: str,
    pattern: str = "d/M/yyyy",
    *,
    year: str,
    count: str,
) -> DataFrame:
    """Rows whose flag is 1 per key and year; rows without a readable date drop out."""
    year_of = F.year(parsed_date(date_text, pattern))
    return (
        df.filter((F.col(flag) == 1) & year_of.isNotNull())
        .groupBy(key, year_of.alias(year))
        .agg(F.count(F.lit(1)).alias(count))
    )


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Row count of every non-empty physical partition."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("num_rows")
    )
