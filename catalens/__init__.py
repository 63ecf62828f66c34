"""Catalog analytics on Spark: cleaning, exploration, forecasting of dated, categorised entities."""

from catalens.roles import Roles

__all__ = ["Roles"]
