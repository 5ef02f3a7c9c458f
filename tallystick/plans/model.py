"""The views and offers over one set of tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystick.operators import customers, groups, offers, periods, purchases
from tallystick.plans import sql_functions
from tallystick.sources.delimited import read_analysis_date
from tallystick.sources.tables import ALIASES, Tables
from tallystick.sources.workspace import Workspace


def _staging(build: Callable) -> Callable:
    """What the method stages belongs to the model."""

    @wraps(build)
    def run(self, *arguments, **options):
        with self.workspace:
            return build(self, *arguments, **options)

    return run


class LoyaltyModel:
    """Lazy views over staged baskets.

    The baskets feed several branches of most plans. Staging them costs one write and
    saves a scan and join of all check lines per branch. That write, and the sorts behind the
    customer segments, run when a view is first asked for; all else runs with an action.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Tables,
        as_of: dt.datetime | None = None,
        margin: groups.MarginRule | None = None,
    ):
        self.spark = spark
        self.tables = tables
        self.workspace = Workspace(spark)
        self.margin = margin or groups.MarginRule()
        if as_of is not None:
            self.as_of = as_of

    @cached_property
    def as_of(self) -> dt.datetime:
        """The analysis moment, read from its table when first needed."""
        return read_analysis_date(self.tables.analysis_formation)

    @cached_property
    def baskets(self) -> DataFrame:
        """Staged by way of the lines, so that the shuffles of the joins are gone before the sums'."""
        lines = self.workspace.staged(purchases.basket_lines(self.tables), "lines", tidy=True)
        baskets = self.workspace.staged(purchases.baskets_of(lines, self.parts), "baskets", tidy=True)
        self.workspace.discard(lines)
        return baskets

    @cached_property
    def parts(self) -> int | None:
        return purchases.parts_for(self.tables)

    @cached_property
    def purchase_history(self) -> DataFrame:
        return purchases.history_of(self.baskets)

    @cached_property
    def periods(self) -> DataFrame:
        return periods.periods(self.baskets)

    @cached_property
    @_staging
    def customers(self) -> DataFrame:
        return customers.customers_view(self.tables, self.as_of)

    @cached_property
    def primary_stores(self) -> DataFrame:
        """Without the segments, which the cross-selling offers do not need."""
        return customers.primary_stores(
            customers.store_visits(self.tables), customers.loyal_customers(self.tables)
        )

    @cached_property
    def customer_frequencies(self) -> DataFrame:
        """Without the segments, which the visit offers do not need."""
        return customers.customer_metrics(customers.store_visits(self.tables), self.as_of)

    @cached_property
    @_staging
    def groups(self) -> DataFrame:
        return groups.groups_view(self.baskets, self.as_of, self.margin, self.parts)

    def _eligible(self, baskets: DataFrame, reward: offers.Reward) -> DataFrame:
        return offers.eligible_groups(groups.pair_indices(baskets, self.as_of), reward)

    def _best(self, reward: offers.Reward) -> DataFrame:
        eligible = self._eligible(self.baskets, reward).select(*groups.SPAN_COLUMNS, "offer_discount_depth")
        return offers.best_groups(groups.with_affinity(eligible, self.purchase_history, self.parts))

    def _all_eligible(self, reward: offers.Reward) -> DataFrame:
        """Reads the baskets once, so they are not staged for this alone."""
        baskets = self.__dict__.get("baskets")
        return self._eligible(
            purchases.baskets(self.tables) if baskets is None else baskets, reward
        )

    def group_margins(
        self,
        count_type: int = 1,
        limit: int | None = None,
        customer_id: int | None = None,
        group_id: int | None = None,
    ) -> DataFrame:
        """Margins of all pairs, or of one customer or group.

        One customer or group is looked for in the tables, without anybody else's baskets.
        """
        tables = self.tables
        if customer_id is not None:
            owned = F.col("customer_id") == customer_id
            tables = replace(
                tables,
                personal_details=tables.personal_details.where(owned),
                customer_cards=tables.customer_cards.where(owned),
            )
        if group_id is not None:
            inside = F.col("group_id") == group_id
            tables = replace(tables, product_matrix=tables.product_matrix.where(inside))
        if tables is self.tables:
            history = purchases.history_of(self.baskets, "basket_margin")
        else:
            history = purchases.margin_history(tables)
        return groups.group_margins(history, groups.MarginRule(count_type, limit), self.as_of)

    @_staging
    def generate_personal_offer(
        self,
        chosen_method: int,
        *arguments,
        all_groups: bool = False,
    ) -> DataFrame:
        """Offers for a larger average check.

        Method 1: ``(1, start, end, coefficient, max_churn, max_share, margin_share)``;
        method 2: ``(2, quantity, coefficient, max_churn, max_share, margin_share)``.
        """
        if chosen_method == 1 and len(arguments) == 6:
            start, end, coefficient, *limits = arguments
            check = offers.AverageCheck(1, start=start, end=end, coefficient=coefficient)
        elif chosen_method == 2 and len(arguments) == 5:
            quantity, coefficient, *limits = arguments
            check = offers.AverageCheck(2, quantity=quantity, coefficient=coefficient)
        else:
            raise ValueError("method 1 takes a period, method 2 a number of transactions")
        reward = offers.Reward(*limits)
        rewarded = self._all_eligible(reward) if all_groups else self._best(reward)
        return offers.average_check_offers(self.tables, rewarded, check)

    @_staging
    def generate_growth_offers(
        self,
        start: dt.datetime | str,
        end: dt.datetime | str,
        added_transactions: int = 1,
        max_churn: float = 4,
        max_discount_share: float = 80,
        margin_share: float = 50,
    ) -> DataFrame:
        """Offers for more frequent visits in the period."""
        return offers.visit_growth_offers(
            self.tables,
            self._best(offers.Reward(max_churn, max_discount_share, margin_share)),
            self.customer_frequencies,
            start,
            end,
            added_transactions,
        )

    @_staging
    def generate_cross_selling(
        self,
        number_of_groups: int = 5,
        max_churn: float = 3,
        max_stability: float = 0.5,
        max_sku_share: float = 100,
        margin_share: float = 30,
        with_ids: bool = False,
    ) -> DataFrame:
        """Offers that move a customer to the SKU of greatest margin.

        SKU names may repeat; ``with_ids`` adds the ids of SKU and group.
        """
        params = offers.CrossSell(
            number_of_groups, max_churn, max_stability, max_sku_share, margin_share
        )
        indices = groups.pair_indices(self.baskets, self.as_of)
        living = offers.living_groups(indices, params).select(
            *groups.SPAN_COLUMNS, "group_minimum_discount"
        )
        known = groups.with_affinity(living, self.purchase_history, self.parts)
        known = groups.with_stability(known, self.purchase_history, self.parts)
        steady = offers.steady_groups(known, params)
        offered = offers.cross_sell_offers(self.tables, steady, self.primary_stores, params)
        return offered if with_ids else offered.drop("sku_id", "group_id")

    @_staging
    def register_functions(self, *names: str) -> None:
        """Offers and margins as table functions for ``spark.sql``: all, or the named ones.

        ``SELECT * FROM generate_growth_offers('2022-06-20', '2022-08-25')``,
        ``... FROM periods p, LATERAL fnc_count_margin(p.customer_id, p.group_id, 2, 10)``.
        """
        sql_functions.register(self, names)

    def release(self) -> None:
        """Delete what this model staged; its views are built anew when asked for again."""
        self.workspace.release()
        for name, member in vars(type(self)).items():
            if isinstance(member, cached_property) and name != "as_of":
                self.__dict__.pop(name, None)

    def register_views(self) -> None:
        """Input tables and views under their names for ``spark.sql``, aliases included."""
        for name, frame in self.tables.items():
            frame.createOrReplaceTempView(name)
        for alias, name in ALIASES.items():
            self.tables[name].createOrReplaceTempView(alias)
        self.customers.createOrReplaceTempView("customersview")
        self.purchase_history.createOrReplaceTempView("purchase_history")
        self.periods.createOrReplaceTempView("periods")
        self.groups.createOrReplaceTempView("groupsview")
