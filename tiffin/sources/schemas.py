"""Column lists of the eight raw sources, as the staging models read them.

Raw sources may arrive untyped (CSV text) or already typed (Parquet); staging
casts every column, so both work. Timestamps are zone-less instants in UTC.
"""

from __future__ import annotations

RAW_COLUMNS: dict[str, list[str]] = {
    "couriers": ["courier_id", "city", "vehicle_type", "joined_at", "courier_tier", "rating"],
    "restaurants": ["restaurant_id", "restaurant_name", "cuisine_type", "city", "is_partner", "rating"],
    "exchange_rates_usd": ["month", "year", "period", "lcy", "usd_to_lcy", "lcy_to_usd", "source"],
    "users": ["customer_id", "city", "registered_at", "gender", "phone_number"],
    "sessions": ["session_id", "user_id", "channel", "campaign", "device", "city", "session_start_at"],
    "order_items": ["item_id", "order_id", "item_name", "cuisine_type", "unit_price", "quantity"],
    "events": [
        "event_id", "session_id", "user_id", "event_timestamp", "event_name", "page_name",
        "channel", "campaign", "device", "city", "voucher_code",
    ],
    "orders": [
        "order_id", "session_id", "customer_id", "restaurant_id", "courier_id", "channel", "campaign",
        "voucher_code", "device", "city", "destination_name", "delivery_distance_km", "order_type",
        "placed_at", "food_ready_at", "picked_up_at", "delivered_at", "order_status", "cancel_note",
        "food_price", "discount_amount",
    ],
}
