"""Profiles to offers: encode, find the nearest, name them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from hirelattice.operators.encoders import encode
from hirelattice.operators.similarity import knn


def name_hits(hits: DataFrame, offers: DataFrame, offer_id: str, columns: list[str]) -> DataFrame:
    """The hits with their offers' columns: one equi join on the real id."""
    return hits.join(offers.select(F.col(offer_id).alias("offer_id"), *columns), "offer_id")


def match_profiles(
    profiles: DataFrame, offers: DataFrame, profile_id: str, profile_text: str, offer_id: str, offer_text: str,
    encoder_factory: Callable, k: int = 5, columns: list[str] | None = None, **options,
) -> DataFrame:
    """(query_id, rank, offer_id, similarity, offer columns) for a table of profiles in one job."""
    hits = knn(encode(profiles, profile_id, profile_text, encoder_factory),
               encode(offers, offer_id, offer_text, encoder_factory), k, **options)
    return name_hits(hits, offers, offer_id, columns or [])
