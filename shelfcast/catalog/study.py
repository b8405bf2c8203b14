"""Retail tables plus the intermediate frames the registered queries share.

Frames that several parts of a query read are written once, when they are first asked for.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.catalog.settings import FOLDS, STEP_DAYS, VALID_DAYS
from shelfcast.operators import panel as P
from shelfcast.operators.evaluate import add_baselines
from shelfcast.operators.split import add_holdout
from shelfcast.plans import models
from shelfcast.plans.features import add_dimensions, make_features
from shelfcast.plans.scoring import registry_from_trend, request_from_features
from shelfcast.session import materialize
from shelfcast.sources.bindings import Retail


class Study(Retail):
    @cached_property
    def flagged(self) -> DataFrame:
        return P.add_holidays(P.add_stores(self.panel, self.stores), self.holidays)

    @cached_property
    def dims(self) -> DataFrame:
        return add_dimensions(
            self.panel, self.holidays, self.transactions, self.oil, self.stores
        )

    @cached_property
    def stored_days(self) -> DataFrame:
        """Store-days of the panel as a written table, small next to the panel."""
        days = P.store_days(
            self.stored_panel, self.holidays, self.transactions, self.oil, self.stores
        )
        return materialize(days, "store-days")

    @cached_property
    def features(self) -> DataFrame:
        return make_features(self.stored_panel, days=self.stored_days, drop_null_target=True)

    @cached_property
    def stored_panel(self) -> DataFrame:
        """The panel as a written table, for plans that pass over it several times: the
        roll-up of the line items then runs once."""
        return materialize(self.panel, "panel")

    @cached_property
    def daily(self) -> DataFrame:
        return P.add_trend(self.stored_panel)

    @cached_property
    def split(self) -> DataFrame:
        return add_holdout(add_baselines(self.daily), VALID_DAYS)

    @cached_property
    def fit(self) -> DataFrame:
        return models.fit_trend(self.split, ~F.col("is_valid"))

    @cached_property
    def held(self) -> DataFrame:
        return materialize(models.holdout_predictions(self.daily, VALID_DAYS), "held")

    @cached_property
    def metrics(self) -> DataFrame:
        found = models.metrics_per_pair(self.daily, VALID_DAYS, FOLDS, STEP_DAYS)
        return materialize(found, "metrics")

    @cached_property
    def point_registry(self) -> DataFrame:
        return registry_from_trend(models.fit_gated_trend(self.split))

    @cached_property
    def registry(self) -> DataFrame:
        """Point and quantile models of the pairs that pass the holdout gate, written:
        training stores them, scoring reads them."""
        params = materialize(models.fit_gated_trend(self.split), "params")
        shifts = models.residual_quantiles(self.split, params, ~F.col("is_valid"))
        return materialize(registry_from_trend(params, shifts), "registry")

    @cached_property
    def requests(self) -> DataFrame:
        """Scoring requests: every row of every pair as a feature map."""
        return request_from_features(self.daily, ["trend"])
