"""Daily detection as one lazy plan; only what several steps reread is written."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairtrace.config import GraphConfig, PairConfig, RuleConfig, ShortlistConfig
from pairtrace.functions.expr import PAIR_KEY
from pairtrace.functions.shared import materialize
from pairtrace.operators import clean, graph, pairs, rules, scoring


class Detection:
    """Steps over all windows of ``orders`` at once; each property is a DataFrame."""

    def __init__(self, orders: DataFrame, pair_cfg=PairConfig(), short_cfg=ShortlistConfig(), rule_cfg=RuleConfig(), graph_cfg=GraphConfig()):
        self.orders, self.pair_cfg, self.short_cfg, self.rule_cfg, self.graph_cfg = orders, pair_cfg, short_cfg, rule_cfg, graph_cfg

    @cached_property
    def active(self) -> DataFrame:
        return clean.prepare_active_orders(self.orders)

    @cached_property
    def ids(self) -> DataFrame:
        """Ids, place and ghost mark of the active orders, written: what orders are made of is joined once for the steps that need no more of them."""
        return materialize(self.active.select(*PAIR_KEY, "order_id", "service_name", "pickup_province_name", "is_ghost"), "active-ids")

    @cached_property
    def base(self) -> DataFrame:
        return pairs.written_base(self.ids, self.pair_cfg)

    @cached_property
    def scored(self) -> DataFrame:
        return materialize(pairs.score_pairs(pairs.pair_stats(None, self.pair_cfg, self.base)), "scored-pairs")

    @cached_property
    def shortlist(self) -> DataFrame:
        """Pairs too small for the shortlist are scored only where a report has asked for all scores."""
        scored = self.__dict__.get("scored")
        if scored is None:
            scored = pairs.score_pairs(pairs.pair_stats(None, self.pair_cfg, self.base, self.short_cfg.min_pair_trips))
        return materialize(pairs.shortlist(scored, self.short_cfg), "shortlist")

    @cached_property
    def candidates(self) -> DataFrame:
        return materialize(pairs.candidate_orders(self.active, self.shortlist, self.ids), "candidates")

    @cached_property
    def details(self) -> DataFrame:
        return pairs.enrich_pair_details(self.candidates, self.shortlist)

    @cached_property
    def risk(self) -> DataFrame:
        return materialize(scoring.pair_risk_features(scoring.annotate_signals(self.details, self.rule_cfg)), "pair-risk")

    @cached_property
    def entities(self) -> DataFrame:
        return materialize(graph.pair_entities(self.candidates), "pair-entities")

    @cached_property
    def degrees(self) -> DataFrame:
        return materialize(graph.entity_degree(self.entities, self.graph_cfg), "entity-degrees")

    @cached_property
    def signal_edges(self) -> DataFrame:
        return graph.signal_edges(self.entities, self.degrees, self.graph_cfg)

    @cached_property
    def edges(self) -> DataFrame:
        return materialize(graph.pair_edges(self.signal_edges, self.graph_cfg), "pair-edges")

    @cached_property
    def members(self) -> DataFrame:
        return materialize(graph.components(self.shortlist, self.edges), "component-members")

    @cached_property
    def networked(self) -> DataFrame:
        df = graph.enrich_graph_features(self.risk, self.entities, self.degrees, self.edges, self.members)
        return materialize(scoring.business_rule_scores(df), "pair-network")

    @cached_property
    def reasons(self) -> DataFrame:
        return materialize(rules.with_triggered(rules.apply_reason_rules(self.networked, self.rule_cfg)), "pair-reasons")

    @cached_property
    def pair_summary(self) -> DataFrame:
        return rules.finalize_rule_assignment(self.networked, self.reasons.drop("triggered_business_rules", "triggered_reason_codes"))

    @cached_property
    def flags(self) -> DataFrame:
        """Not written: a report joins the written candidates and reasons for the few of the 100 columns that it reads."""
        return rules.flagged_orders(self.candidates, self.reasons)

    @cached_property
    def outputs(self) -> dict[str, DataFrame]:
        return {"flagged_orders": self.flags, "pair_summary": self.pair_summary, "pair_reasons": self.reasons}

    def known(self, known_pairs: DataFrame) -> DataFrame:
        return rules.evaluate_known_pairs(self.flags, known_pairs.select(F.trim("driver_id").alias("driver_id"), F.trim("customer_id").alias("customer_id")))
