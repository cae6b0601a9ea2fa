"""adspark: advertising analytics on Spark DataFrames.

Raw ad events, campaigns and users are cleaned (``operators.clean``), modelled as a
typed star schema (``operators.model``), checked (``operators.quality``), turned into
nested session documents and daily / regional rollups (``operators.documents``,
``operators.rollups``) and queried (``plans``).  Everything is a DataFrame transform;
only ``streaming`` runs Structured Streaming.
"""

from adspark.session import get_session, materialize

__all__ = ["get_session", "materialize"]
