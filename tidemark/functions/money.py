"""Measures of an order line. Inputs are decimals, so the results are exact."""

from __future__ import annotations

from pyspark.sql import Column

MONEY = "decimal(10,2)"


def line_gross(quantity: Column, unit_price: Column) -> Column:
    return quantity * unit_price


def line_net(quantity: Column, unit_price: Column, discount: Column) -> Column:
    return line_gross(quantity, unit_price) - discount
