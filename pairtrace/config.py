"""Frozen parameter sets; values outside their range are refused when the object is made."""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import ClassVar


class _Checked:
    """``BOUNDS``: least and most of a field, both included; other numbers are shares from 0 to 1."""

    BOUNDS: ClassVar[dict[str, tuple[float, float]]] = {}

    def __post_init__(self):
        for f in fields(self):
            v = getattr(self, f.name)
            low, high = self.BOUNDS.get(f.name, (0, 1))
            if not isinstance(v, str) and not low <= v <= high:
                raise ValueError(f"{f.name} is {v}, not within {low} and {high}")


MANY = float("inf")
POSITIVE = 5e-324


@dataclass(frozen=True)
class PairConfig(_Checked):
    BOUNDS = {"extreme_trip_quantile": (POSITIVE, 1 - 2**-53), "min_extreme_trip_threshold": (1, MANY)}
    extreme_trip_quantile: float = 0.9999
    min_extreme_trip_threshold: float = 2.0
    trip_count: str = "rows"

    def __post_init__(self):
        super().__post_init__()
        if self.trip_count not in ("rows", "distinct"):
            raise ValueError("trip_count is rows or distinct")


@dataclass(frozen=True)
class ShortlistConfig(_Checked):
    BOUNDS = {"min_pair_trips": (1, MANY), "min_pair_core_score": (0, 100)}
    min_pair_trips: int = 4
    min_concentration_score: float = 0.85
    min_pair_core_score: float = 50.0
    min_ghost_rate: float = 0.5
    min_repeat_share_driver: float = 0.4
    min_repeat_share_customer: float = 0.6


@dataclass(frozen=True)
class RuleConfig(_Checked):
    BOUNDS = {
        "superfast_gap_min": (POSITIVE, MANY), "min_pair_trips_for_share_rule": (2, MANY), "min_component_size": (1, MANY), "min_high_confidence_trips": (1, MANY),
        "min_superfast_trips": (2, MANY), "min_network_linked_pairs": (1, MANY), "min_network_supporting_signals": (1, MANY),
    }
    high_ghost_rate: float = 0.5
    superfast_gap_min: float = 2.0
    superfast_ghost_rate: float = 0.2
    tight_pair_share_driver: float = 0.6
    tight_pair_share_customer: float = 0.6
    dominant_route_share: float = 0.7
    min_pair_trips_for_share_rule: int = 8
    min_component_size: int = 3
    min_high_confidence_trips: int = 4
    min_superfast_trips: int = 6
    min_network_linked_pairs: int = 2
    min_network_supporting_signals: int = 2


@dataclass(frozen=True)
class GraphConfig(_Checked):
    BOUNDS = {
        **dict.fromkeys(("payment_max_degree", "promo_max_degree", "address_max_degree", "route_max_degree"), (2, MANY)), "min_shared_signals": (1, MANY),
        "min_edge_weight": (0, MANY), "single_signal_min_weight": (0, MANY), "single_signal_min_shared_entities": (1, MANY), "max_entity_gap_days": (0, MANY),
    }
    payment_max_degree: int = 50
    promo_max_degree: int = 40
    address_max_degree: int = 25
    route_max_degree: int = 20
    min_shared_signals: int = 2
    min_edge_weight: float = 1.35
    single_signal_min_weight: float = 1.75
    single_signal_min_shared_entities: int = 2
    max_entity_gap_days: int = 3
