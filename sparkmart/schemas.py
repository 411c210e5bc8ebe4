"""Declared schemas (Spark DDL strings) and code lists of the three layers."""

from __future__ import annotations

# --- fixed values: document fields, code lists and flag names of the data model ---------------

ENVELOPE = "_id string, data string, _fivetran_synced timestamp, _fivetran_deleted boolean"

CUSTOMER_DOC = """
    username string, name string, address string, birthdate string, email string, active string,
    accounts array<int>,
    tier_and_details map<string, struct<tier: string, benefits: array<string>, active: boolean>>
"""

ACCOUNT_DOC = "account_id int, `limit` int, products array<string>"

TRANSACTION_DOC = """
    account_id int, transaction_count int, bucket_start_date string, bucket_end_date string,
    transactions array<struct<date: string, amount: int, transaction_code: string,
                              symbol: string, price: decimal(10,2), total: decimal(10,2)>>
"""

SOURCE_SYSTEM = "mongoDB_1"

TIER_FLAGS = {
    "bronze_tier": "Bronze",
    "silver_tier": "Silver",
    "gold_tier": "Gold",
    "platinum_tier": "Platinum",
}

BENEFIT_FLAGS = {
    "24_hour_dedicated_line_benefit": "24 hour dedicated line",
    "concert_ticket_benefit": "concert tickets",
    "travel_insurance_benefit": "travel insurance",
    "financial_planning_assistance_benefit": "financial planning assistance",
    "shopping_discounts_benefit": "shopping discounts",
    "sports_tickets_benefit": "sports tickets",
    "concierge_service_benefit": "concierge services",
    "car_rental_benefit": "car rental insurance",
    "airline_lounge_access_benefit": "airline lounge access",
    "dedicated_account_representative": "dedicated account representative",
}

PRODUCT_FLAGS = {
    "has_investment_stock": "InvestmentStock",
    "has_brokerage": "Brokerage",
    "has_commodity": "Commodity",
    "has_investment_fund": "InvestmentFund",
    "has_currency_service": "CurrencyService",
    "has_derivatives": "Derivatives",
}

FIRST_MARK = "1900-01-01 00:00:00"
CALENDAR_START, CALENDAR_END = "1962-01-01", "2030-12-31"

#: Why a document or row is kept apart; NULL for accepted ones.
REJECT_REASON = "reject_reason"

# --- processed layer --------------------------------------------------------------------------

PROCESSED_CUSTOMER = """
    id string, user_name string, name string, address string, birth_date date, email string,
    active_customer string, account_id int, tier_key string, tier string,
    benefits array<string>, tier_active boolean, ingest_date timestamp, create_date timestamp
"""

PROCESSED_ACCOUNT = """
    id string, account_id int, `limit` int, products array<string>,
    ingest_date timestamp, create_date timestamp
"""

PROCESSED_TRANSACTION = """
    transaction_id decimal(38,0), account_id int, transaction_date date, transaction_type string,
    symbol string, amount int, unit_price decimal(10,2), total_price decimal(10,2),
    bucket_start_date date, bucket_end_date date, transaction_count int,
    ingest_date timestamp, create_date timestamp
"""

#: Columns beside the declared ones: why a row is kept apart, which document it is from, and the text
#: of a document that gave no rows at all.
REJECT = f"{REJECT_REASON} string, document_id string, document string"

# --- presentation layer -----------------------------------------------------------------------


def _flags(names) -> str:
    return ", ".join(f"`{name}` boolean" for name in names)


VALIDITY = "start_date date, end_date date, is_current boolean, source_system string"

DIM_CUSTOMER = f"""
    customer_sk bigint, customer_bk string, name string, user_name string, address string,
    birth_date date, email string, active_customer boolean,
    {_flags(TIER_FLAGS)}, {_flags(BENEFIT_FLAGS)}, {VALIDITY}
"""

DIM_ACCOUNT = f"""
    account_sk bigint, account_id int, `limit` int, {_flags(PRODUCT_FLAGS)}, {VALIDITY}
"""

DIM_TRANSACTION_DETAILS = """
    transaction_details_pk bigint, transaction_type string, symbol string, source_system string
"""

DIM_DATE = """
    date_id int, date_full date, year int, quarter int, month int, week int, day int,
    day_of_week int, day_name string, month_name string, is_weekday int, is_leapyear int
"""

FACT_TRANSACTION = """
    fact_transactions_pk bigint, transaction_bk decimal(38,0), customer_fk bigint, account_fk bigint,
    transaction_details_fk bigint, transaction_date_fk int, account_bk int, customer_bk string,
    amount int, unit_price decimal(10,2), create_date timestamp
"""

#: A fact row that waits for its account or owner, and when it was first tried.
OPEN_FACT = f"{FACT_TRANSACTION}, {REJECT_REASON} string, opened timestamp"

# --- declared constraints ---------------------------------------------------------------------

NOT_NULL = {
    "customer": ["id", "user_name", "name", "birth_date", "email", "account_id", "ingest_date"],
    "account": ["id", "account_id", "limit", "ingest_date"],
    "transaction": [
        "transaction_id", "account_id", "transaction_date", "transaction_type", "ingest_date",
    ],
    "dim_customer": ["customer_bk", "name"],
    "dim_account": ["account_id"],
    "fact_transaction": [
        "transaction_bk", "customer_fk", "account_fk", "transaction_date_fk",
        "account_bk", "customer_bk",
    ],
}

UNIQUE = {
    "customer": ["id", "account_id", "tier_key"],
    "account": ["account_id"],
}

MAX_LENGTH = {
    "dim_customer": {
        "name": 50, "user_name": 100, "address": 255, "email": 100, "source_system": 20,
    },
    "dim_account": {"source_system": 20},
    "dim_transaction_details": {"transaction_type": 10, "symbol": 10, "source_system": 20},
}
