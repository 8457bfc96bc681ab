"""Batch plan: event hub -> typed tables -> facts (the view cascade of the
reference, as one lazy DataFrame graph).

Nothing here triggers a job except the bounded size checks of the broadcast
guards; the caller decides what to write or query.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from webmetrics.operators import enrich, rollup, route
from webmetrics.plans.strategy import CHECK_TTL_SECONDS
from webmetrics.sources import adapter, dims


@dataclass
class Model:
    event: DataFrame
    sources: DataFrame
    visitor: DataFrame
    session: DataFrame
    section: DataFrame
    click: DataFrame
    api_key_df: DataFrame | None = None
    rules_df: DataFrame | None = None
    blocks: DataFrame | None = None
    geo_mode: str = "range"

    def rebuild(self, event: DataFrame) -> "Model":
        """The same plan over another hub (e.g. the stored bronze table)."""
        return build(event, self.api_key_df, self.rules_df, self.blocks, self.geo_mode)

    @property
    def section_combined(self) -> DataFrame:
        return rollup.section_combined(self.section, self.session)

    @property
    def hierarchy(self) -> DataFrame:
        return rollup.hierarchy(self.section, self.session, self.visitor)

    @property
    def visitor_timeseries(self) -> DataFrame:
        return rollup.visitor_timeseries(self.visitor)


def build(event: DataFrame, api_key_df: DataFrame, rules_df: DataFrame,
          blocks: DataFrame, geo_mode: str = "range") -> Model:
    """Route, enrich and expose the typed tables and facts of one event batch."""
    src = dims.sources(dims.api_key_latest(api_key_df))
    session = enrich.enrich_sessions(route.sessions(event, src), rules_df, blocks, geo_mode)
    return Model(event=event, sources=src, visitor=route.visitors(event, src),
                 session=session, section=route.sections(event, src),
                 click=route.clicks(event), api_key_df=api_key_df, rules_df=rules_df,
                 blocks=blocks, geo_mode=geo_mode)


def geo_blocks(spark: SparkSession, sf_dir: str, mode: str = "range") -> DataFrame:
    return enrich.blocks_from_ranges(adapter.ip_ranges(spark, sf_dir),
                                     adapter.iso_country(spark, sf_dir), mode)


_MODELS: dict = {}


def driver_model(spark: SparkSession, sf_dir: str, geo_mode: str = "range") -> Model:
    """The model over the driver's test tables (see :mod:`webmetrics.sources.adapter`).

    The lazy plan is reused for CHECK_TTL_SECONDS per session and directory,
    the same lifetime as the dimension size checks baked into it.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), geo_mode)
    now = time.monotonic()
    hit = _MODELS.get(key)
    if hit and now - hit[0] < CHECK_TTL_SECONDS:
        return hit[1]
    m = build(adapter.event_hub(spark, sf_dir), adapter.api_keys(spark, sf_dir),
              dims.ua_rules_df(spark), geo_blocks(spark, sf_dir, geo_mode), geo_mode)
    _MODELS[key] = (now, m)
    return m
