"""Declared schemas of every input. Readers never infer."""

from __future__ import annotations

# Column names, order and types must be those of the feeds.

ORDERS = (
    "order_id BIGINT, customer_id BIGINT, order_date STRING, status STRING, "
    "total_amount DOUBLE, source_system STRING, last_updated STRING"
)

CUSTOMERS = (
    "customer_id BIGINT, name STRING, email STRING, join_date STRING, segment STRING, "
    "phone STRING, address STRING, age INT, marketing_opt_in STRING, last_login STRING"
)

ORDER_ITEMS = (
    "item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, price DOUBLE, "
    "discount_percent DOUBLE, tax_amount DOUBLE, line_total DOUBLE"
)

PRODUCTS = (
    "product_id BIGINT, product_name STRING, category STRING, subcategory STRING, "
    "unit_price DOUBLE, cost DOUBLE, supplier_id BIGINT, is_active STRING, "
    "created_date STRING, weight_kg DOUBLE"
)

ORDER_EVENT = (
    "event_type STRING, event_timestamp STRING, order_id BIGINT, customer_id BIGINT, "
    "order_date STRING, status STRING, total_amount DOUBLE, source_system STRING"
)

ITEM_EVENT = (
    "event_type STRING, event_timestamp STRING, item_id BIGINT, order_id BIGINT, "
    "product_id BIGINT, quantity INT, price DOUBLE, discount_percent DOUBLE, line_total DOUBLE"
)

# Item events as the message log carries them.
ITEM_MESSAGE = (
    "event_type STRING, event_timestamp STRING, item_id BIGINT, order_id BIGINT, "
    "product_id STRING, product_name STRING, category STRING, quantity INT, "
    "unit_price DOUBLE, total_price DOUBLE"
)

CUSTOMER_EVENT = (
    "event_type STRING, event_timestamp STRING, customer_id BIGINT, name STRING, "
    "first_name STRING, last_name STRING, email STRING, phone STRING, address STRING, "
    "city STRING, state STRING, zip_code STRING, registration_date STRING, "
    "customer_segment STRING, last_updated STRING"
)

FRAUD_ALERT = (
    "event_type STRING, event_timestamp STRING, alert_id STRING, order_id BIGINT, "
    "customer_id BIGINT, fraud_score INT, risk_level STRING, reasons ARRAY<STRING>, "
    "total_amount DOUBLE, status STRING, requires_review BOOLEAN"
)

# Message log: column names of Spark's Kafka source, value as JSON text.
MESSAGES = (
    "topic STRING, partition INT, offset BIGINT, key STRING, value STRING, timestamp TIMESTAMP"
)
TOPICS = "topic STRING, partitions INT, retention_hours INT"
COMMITTED_OFFSETS = "group_id STRING, topic STRING, partition INT, committed_offset BIGINT"
