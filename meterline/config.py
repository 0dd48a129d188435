"""What one fact table looks like: names, types, codes, origins, dictionary.

Operators take a :class:`TableSpec`, so the trip schema below is one instance
and any other table can be described the same way.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Origin:
    marker: str
    name: str
    code: int


@dataclass(frozen=True)
class TableSpec:
    renames: Mapping[str, str]
    types: Mapping[str, str]
    codes: Mapping[str, Mapping[int, str]]
    origins: tuple[Origin, ...] = ()
    unknown_origin: Origin = Origin("", "UNKNOWN", 99)
    zone_roles: tuple[str, ...] = ("pickup", "dropoff")
    dropped: tuple[str, ...] = ()
    dictionary: Mapping[str, str] = field(default_factory=dict)

    def text_column(self, id_column: str) -> str:
        return id_column.replace("_id", "")


# --- Fixed values: names, codes and types that silver tables must carry. ---

RENAMES = {
    "lpep_pickup_datetime": "pickup_datetime",
    "tpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "store_and_fwd_flag": "store_and_foward",
    "pu_location_id": "pickup_location_id",
    "do_location_id": "dropoff_location_id",
    "trip_distance": "trip_distance_mi",
    "payment_type": "payment_type_id",
    "trip_type": "trip_type_id",
}

TYPES = {
    "vendor_id": "tinyint",
    "payment_type_id": "tinyint",
    "trip_type_id": "tinyint",
    "ratecode_id": "tinyint",
    "passenger_count": "tinyint",
    "pickup_location_id": "smallint",
    "dropoff_location_id": "smallint",
    "store_and_foward": "string",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
}

RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null/unknown",
}

VENDORS = {
    1: "Creative Mobile Technologies, LLC",
    2: "Curb Mobility, LLC",
    6: "Myle Technologies Inc",
    7: "Helix",
}

PAYMENT_TYPES = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

TRIP_TYPES = {1: "Street-hail", 2: "Dispatch"}

YELLOW = Origin("yellow", "TPEP", 1)
GREEN = Origin("green", "LPEP", 2)

ZONE_TYPES = {"location_id": "int", "borough": "string", "zone": "string", "service_zone": "string"}

UNKNOWN_RATE = 99
NEGOTIATED_RATE = 5
NO_CHARGE = 3
MAX_PASSENGERS = 6
MAX_TRIP_HOURS = 12
MAX_MPH = 70

# --- End of fixed values. ---


def _with_codes(text: str, codes: Mapping[int, str]) -> str:
    return "\n".join([text, *(f"{code} = {name}" for code, name in codes.items())])


ZONE_DICTIONARY = {
    "location_id": "Taxi zone number, 1 to 265; trips refer to it at both ends.",
    "borough": "Borough of the zone, or the out-of-city area it stands for.",
    "zone": "Neighbourhood name of the zone.",
    "service_zone": "Who may take street hails there: Yellow Zone, Boro Zone, Airports or EWR.",
}

TRIP_DICTIONARY = {
    "origin": "Recording system: TPEP for yellow cabs, LPEP for green cabs, from the file name.",
    "origin_id": _with_codes("Code of the recording system.", {o.code: o.name for o in (YELLOW, GREEN)}),
    "vendor": "Name of the technology provider that sent the record.",
    "vendor_id": _with_codes("Code of the technology provider.", VENDORS),
    "pickup_datetime": "When the meter was switched on.",
    "dropoff_datetime": "When the meter was switched off; later than the pickup on a real trip.",
    "store_and_foward": "Y if the record waited in the vehicle for a connection, N if not; NULL if entered by hand.",
    "ratecode": "Name of the final rate.",
    "ratecode_id": _with_codes("Code of the final rate.", RATE_CODES),
    "pickup_location_id": "Zone where the trip began.",
    "dropoff_location_id": "Zone where the trip ended.",
    "passenger_count": "Passengers in the vehicle, as keyed in by the driver.",
    "trip_distance_mi": "Miles on the taximeter.",
    "fare_amount": "Time-and-distance fare, without taxes, tips and surcharges.",
    "mta_tax": "Metropolitan transport tax triggered by the metered rate.",
    "tip_amount": "Card tip; cash tips are not recorded.",
    "tolls_amount": "Bridge and tunnel tolls of the trip.",
    "improvement_surcharge": "Flat surcharge at the start of the trip, since 2015.",
    "total_amount": "Amount charged without cash tips; negative on voided or disputed trips.",
    "payment_type_id": _with_codes("Code of the payment method.", PAYMENT_TYPES),
    "payment_type": "Name of the payment method.",
    "trip_type_id": _with_codes("Code of how a green cab was hailed.", TRIP_TYPES),
    "trip_type": "How a green cab was hailed; NULL for yellow cabs.",
    "congestion_surcharge": "State congestion surcharge of the trip.",
    "cbd_congestion_fee": "Congestion relief zone fee, from January 2025.",
    "airport_fee": "Fee for pickups at the two city airports; yellow cabs only.",
    "extra": "Extras and surcharges without a column of their own.",
    "ehail_fee": "Fee for trips hailed by app; green cabs only, discontinued.",
    "year": "Year of the pickup.",
    "month": "Month of the pickup.",
    **{
        f"{role}_{column}": text
        for role in ("pickup", "dropoff")
        for column, text in ZONE_DICTIONARY.items()
        if column != "location_id"
    },
}

TRIPS = TableSpec(
    renames=RENAMES,
    types=TYPES,
    codes={
        "ratecode_id": RATE_CODES,
        "vendor_id": VENDORS,
        "payment_type_id": PAYMENT_TYPES,
        "trip_type_id": TRIP_TYPES,
    },
    origins=(YELLOW, GREEN),
    dropped=("ehail_fee",),
    dictionary=TRIP_DICTIONARY,
)
