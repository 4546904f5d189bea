"""Declared model: domains (enums with their sort order) and constraints.

Spark does not enforce constraints on Parquet, so every declaration below is
checked by a validation job in ``airdata.operators.constraints``.
"""

from __future__ import annotations

from dataclasses import dataclass

# Enum labels in declaration order (the order is the sort order).
FLIGHT_STATUS = ("Scheduled", "Departed", "Arrived", "Cancelled", "Diverted")
PAYMENT_METHOD = ("Card", "Points", "Voucher", "Cash")
PAYMENT_STATUS = ("Authorized", "Captured", "Refunded", "Failed")
LOYALTY_TIER = ("Basic", "Silver", "Gold", "Platinum")
MILES_TXN_TYPE = ("EARN", "REDEEM", "ADJUST")
# Fare classes and booking channels.
FARE_CLASSES = ("Basic", "Standard", "Flexible", "Business", "First")
BOOKING_CHANNELS = ("Web", "Mobile", "Call Center", "Travel Agent")


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str

    @property
    def name(self):
        return f"nn_{self.table}_{self.column}"


@dataclass(frozen=True)
class Check:
    """CHECK constraint as a Spark SQL boolean expression; NULL passes."""
    table: str
    name: str
    predicate: str


@dataclass(frozen=True)
class Unique:
    table: str
    columns: tuple[str, ...]
    name: str
    where_not_null: tuple[str, ...] = ()


@dataclass(frozen=True)
class ForeignKey:
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    name: str
    on_delete: str = "NO ACTION"   # CASCADE | SET NULL | RESTRICT | NO ACTION


@dataclass(frozen=True)
class Domain:
    table: str
    column: str
    values: tuple[str, ...]
    name: str


NOT_NULL = tuple(NotNull(t, c) for t, cols in {
    "airports": ("airport_id", "name"),
    "airlines": ("airline_id", "name"),
    "aircraft": ("aircraft_id", "model", "seat_capacity"),
    "routes": ("route_id", "airline_id", "origin_airport_id", "destination_airport_id"),
    "flights": ("flight_id", "airline_id", "origin_airport_id", "destination_airport_id",
                "flight_number", "flight_date", "scheduled_departure_utc", "scheduled_arrival_utc", "status"),
    "flight_changes": ("change_id", "flight_id", "changed_at"),
    "passengers": ("passenger_id", "first_name", "last_name", "created_at"),
    "bookings": ("booking_id", "passenger_id", "booking_date"),
    "payments": ("payment_id", "booking_id", "amount_usd", "method", "status", "paid_at"),
    "loyalty_accounts": ("loyalty_id", "passenger_id", "tier", "miles_balance", "enrolled_at"),
    "miles_transactions": ("miles_txn_id", "loyalty_id", "txn_type", "miles_delta", "posted_at"),
    "flight_performance": ("snapshot_id", "year", "month", "airline_iata", "airport_iata"),
}.items() for c in cols)

CHECKS = (
    Check("airports", "chk_airports_lat", "latitude BETWEEN -90 AND 90"),
    Check("airports", "chk_airports_lon", "longitude BETWEEN -180 AND 180"),
    Check("aircraft", "chk_aircraft_seats", "seat_capacity > 0"),
    Check("routes", "chk_routes_distance", "distance_nm >= 0"),
    Check("routes", "chk_routes_origin_dest", "origin_airport_id <> destination_airport_id"),
    Check("flights", "chk_flights_sched", "scheduled_departure_utc < scheduled_arrival_utc"),
    Check("flights", "chk_flights_origin_dest", "origin_airport_id <> destination_airport_id"),
    Check("bookings", "chk_bookings_price", "base_price_usd >= 0"),
    Check("payments", "chk_payments_amount", "amount_usd >= 0"),
    Check("loyalty_accounts", "chk_loyalty_balance", "miles_balance >= 0"),
)

UNIQUES = (
    Unique("airports", ("airport_id",), "pk_airports"),
    Unique("airports", ("iata_code",), "uq_airports_iata", ("iata_code",)),
    Unique("airports", ("icao_code",), "uq_airports_icao", ("icao_code",)),
    Unique("airlines", ("airline_id",), "pk_airlines"),
    Unique("airlines", ("iata_code",), "uq_airlines_iata", ("iata_code",)),
    Unique("airlines", ("icao_code",), "uq_airlines_icao", ("icao_code",)),
    Unique("aircraft", ("aircraft_id",), "pk_aircraft"),
    Unique("aircraft", ("tail_number",), "uq_aircraft_tail_number", ("tail_number",)),
    Unique("flight_changes", ("change_id",), "pk_flight_changes"),
    Unique("routes", ("route_id",), "pk_routes"),
    Unique("routes", ("airline_id", "origin_airport_id", "destination_airport_id"), "uq_routes"),
    Unique("flights", ("flight_id",), "pk_flights"),
    Unique("flights", ("airline_id", "flight_number", "flight_date"), "uq_flights"),
    Unique("passengers", ("passenger_id",), "pk_passengers"),
    Unique("passengers", ("email",), "uq_passengers_email", ("email",)),
    Unique("bookings", ("booking_id",), "pk_bookings"),
    Unique("bookings", ("passenger_id", "flight_id"), "uq_bookings_passenger_flight", ("flight_id",)),
    Unique("payments", ("payment_id",), "pk_payments"),
    Unique("loyalty_accounts", ("loyalty_id",), "pk_loyalty"),
    Unique("loyalty_accounts", ("passenger_id",), "uq_loyalty_passenger"),
    Unique("miles_transactions", ("miles_txn_id",), "pk_miles"),
    Unique("flight_performance", ("snapshot_id",), "pk_flight_performance"),
    Unique("flight_performance", ("year", "month", "airline_iata", "airport_iata"), "uq_fp"),
)

FOREIGN_KEYS = (
    ForeignKey("flights", ("airline_id",), "airlines", ("airline_id",), "fk_flights_airline", "RESTRICT"),
    ForeignKey("flights", ("origin_airport_id",), "airports", ("airport_id",), "fk_flights_origin_airport", "RESTRICT"),
    ForeignKey("flights", ("destination_airport_id",), "airports", ("airport_id",), "fk_flights_destination_airport", "RESTRICT"),
    ForeignKey("flights", ("aircraft_id",), "aircraft", ("aircraft_id",), "fk_flights_aircraft", "SET NULL"),
    ForeignKey("flight_changes", ("flight_id",), "flights", ("flight_id",), "fk_flight_changes_flight", "CASCADE"),
    ForeignKey("flight_changes", ("old_aircraft_id",), "aircraft", ("aircraft_id",), "fk_flight_changes_old_aircraft", "SET NULL"),
    ForeignKey("flight_changes", ("new_aircraft_id",), "aircraft", ("aircraft_id",), "fk_flight_changes_new_aircraft", "SET NULL"),
    ForeignKey("flights", ("route_id",), "routes", ("route_id",), "fk_flights_route", "SET NULL"),
    ForeignKey("routes", ("airline_id",), "airlines", ("airline_id",), "fk_routes_airline", "RESTRICT"),
    ForeignKey("routes", ("origin_airport_id",), "airports", ("airport_id",), "fk_routes_origin", "RESTRICT"),
    ForeignKey("routes", ("destination_airport_id",), "airports", ("airport_id",), "fk_routes_destination", "RESTRICT"),
    ForeignKey("bookings", ("passenger_id",), "passengers", ("passenger_id",), "fk_bookings_passenger", "CASCADE"),
    ForeignKey("bookings", ("flight_id",), "flights", ("flight_id",), "fk_bookings_flight", "SET NULL"),
    ForeignKey("payments", ("booking_id",), "bookings", ("booking_id",), "fk_payments_booking", "CASCADE"),
    ForeignKey("loyalty_accounts", ("passenger_id",), "passengers", ("passenger_id",), "fk_loyalty_passenger", "CASCADE"),
    ForeignKey("miles_transactions", ("loyalty_id",), "loyalty_accounts", ("loyalty_id",), "fk_miles_loyalty", "CASCADE"),
    ForeignKey("miles_transactions", ("flight_id",), "flights", ("flight_id",), "fk_miles_flight", "SET NULL"),
    ForeignKey("flight_performance", ("airline_iata",), "airlines", ("iata_code",), "fk_fp_airline", "RESTRICT"),
    ForeignKey("flight_performance", ("airport_iata",), "airports", ("iata_code",), "fk_fp_airport", "RESTRICT"),
)

DOMAINS = (
    Domain("flights", "status", FLIGHT_STATUS, "dom_flight_status"),
    Domain("payments", "method", PAYMENT_METHOD, "dom_payment_method"),
    Domain("payments", "status", PAYMENT_STATUS, "dom_payment_status"),
    Domain("loyalty_accounts", "tier", LOYALTY_TIER, "dom_loyalty_tier"),
    Domain("miles_transactions", "txn_type", MILES_TXN_TYPE, "dom_miles_txn_type"),
)
