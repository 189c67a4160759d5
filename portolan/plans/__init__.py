"""Table builders, the whole job and analyses on its result."""

from portolan.plans.analyses import destination_profile, travel_patterns
from portolan.plans.star import (
    airlines_dimension,
    airports_dimension,
    city_port_match_rate,
    dates_dimension,
    demographics_dimension,
    immigration_fact,
    modes_dimension,
    ports_dimension,
    record_losses,
    regions_dimension,
    visas_dimension,
)
from portolan.plans.job import Sources, build_star, check_star, publish, read_star

__all__ = [
    "Sources",
    "airlines_dimension",
    "airports_dimension",
    "build_star",
    "check_star",
    "city_port_match_rate",
    "dates_dimension",
    "demographics_dimension",
    "destination_profile",
    "immigration_fact",
    "modes_dimension",
    "ports_dimension",
    "publish",
    "read_star",
    "record_losses",
    "regions_dimension",
    "travel_patterns",
    "visas_dimension",
]
