"""Declared layouts of the five sources and the product catalogue. Money is decimal."""

CUSTOMERS = (
    "customer_id string, first_name string, last_name string, region string, country string, "
    "customer_type string, signup_date date, preferred_channel string, email_opt_in int"
)
SALES = (
    "order_id string, customer_id string, order_date date, product_id string, product_name string, "
    "category string, quantity int, unit_price decimal(12,2), discount_pct decimal(5,4), "
    "revenue decimal(18,2), sales_channel string"
)
WEB = (
    "session_id string, customer_id string, session_date date, pages_viewed int, "
    "time_on_site_min decimal(12,2), device string, added_to_cart int, traffic_source string"
)
SUPPORT = (
    "ticket_id string, customer_id string, ticket_date date, ticket_type string, "
    "resolution_time_hours decimal(12,2), csat_score int, escalated int"
)
MARKETING = (
    "touch_id string, customer_id string, campaign_name string, channel string, sent_date date, "
    "opened int, converted int"
)
CATALOGUE = "product_id string, product_name string, category string, unit_price decimal(12,2)"

SOURCES = {
    "customers": CUSTOMERS,
    "sales_orders": SALES,
    "website_activity": WEB,
    "support_tickets": SUPPORT,
    "marketing": MARKETING,
}
